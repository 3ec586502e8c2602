"""The keyed merge all pipelines share: sums, first-seen and last-seen columns per key.

The merge is associative and commutative: rows reduce to partials, partials combine to partials in
any grouping and order, and the outcome depends only on the order columns. So the same object
serves a batch aggregation, a streaming one, and the merge of stored partials with new ones. Spark
reduces each input partition before the shuffle, hence a key that holds a third of all rows sends
at most one partial per task.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Merge:
    """firsts and lasts are taken from the first and the last row as a whole; each of the patches
    from the last row in which that column is not null, so a null leaves it as it was."""

    keys: Sequence[str]
    sums: Sequence[str] = ()
    firsts: Sequence[str] = ()
    lasts: Sequence[str] = ()
    patches: Sequence[str] = ()
    order: Sequence[str] = ("seq",)

    def _reduce(
        self, df: DataFrame, first: Column, last: Column, patches: Sequence[Column]
    ) -> DataFrame:
        aggs = [F.sum(c).alias(c) for c in self.sums]
        aggs += [F.max(p).alias(f"_patch_{c}") for c, p in zip(self.patches, patches)]
        if self.firsts:
            aggs.append(F.min(first).alias("_first"))
        if self.lasts:
            aggs.append(F.max(last).alias("_last"))
        if not aggs:
            return df.select(*self.keys).distinct()
        return df.groupBy(*self.keys).agg(*aggs)

    def _ordered(self, columns: Sequence[str]) -> Column:
        return F.struct(*self.order, *[c for c in columns if c not in self.order])

    def _patches(self) -> list[Column]:
        return [F.when(F.col(c).isNotNull(), self._ordered([c])) for c in self.patches]

    def partial(self, rows: DataFrame, unique_keys: bool = False) -> DataFrame:
        """One partial per key. The extreme is taken over (order, values), so a retried task and
        rows with equal order values still give one answer.

        Rows that hold each key once already (`unique_keys`) become partials without a shuffle.
        """
        first, last = self._ordered(self.firsts), self._ordered(self.lasts)
        if not unique_keys:
            return self._reduce(rows, first, last, self._patches())
        columns = [F.col(c) for c in self.sums]
        columns += [p.alias(f"_patch_{c}") for c, p in zip(self.patches, self._patches())]
        columns += [first.alias("_first")] if self.firsts else []
        columns += [last.alias("_last")] if self.lasts else []
        return rows.select(*self.keys, *columns)

    def combine(self, partials: DataFrame) -> DataFrame:
        patches = [F.col(f"_patch_{c}") for c in self.patches]
        return self._reduce(partials, F.col("_first"), F.col("_last"), patches)

    def finish(self, partials: DataFrame) -> DataFrame:
        """Partials as plain columns: keys, first-seen, last-seen, sums."""
        return partials.select(
            *self.keys,
            *[F.col("_first").getField(c).alias(c) for c in self.firsts],
            *[F.col("_last").getField(c).alias(c) for c in self.lasts],
            *[F.col(f"_patch_{c}").getField(c).alias(c) for c in self.patches],
            *self.sums,
        )

    def aggregate(self, rows: DataFrame) -> DataFrame:
        return self.finish(self.partial(rows))
