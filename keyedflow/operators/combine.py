"""Aggregates that the user makes: init, combine and finish in Python, over Arrow batches.

Rows become partials inside their task, so what is shuffled is one small partial for each key and task, also for a key that holds a
third of all rows. After one shuffle by key, partials are sorted, spilling if they must, and combined one after another
as they come: no group is ever collected. Partials have a Spark type, so they can be stored and combined again later.

Use built-in aggregates where they say what is meant: they stay in the JVM.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Keys that a task holds before it hands some on, and how much busier than the mean a key must be to stay.
HELD_KEYS, BUSY = 65_536, 8

_NAN = float("nan")


@dataclass(frozen=True)
class Combiner:
    """init makes a partial from a row's values, combine one from two, in any grouping and order.

    partial, result: their types as DDL; without `finish` the result is the partial.
    zero: what no rows give, which combine leaves others as they are with; it is the result of a grand total over nothing.
    init_batch: the faster form of init: it gets the number of each row's group, how many groups there are and the columns of values
      as Arrow arrays, and returns a partial for each group.
    """

    init: Callable
    combine: Callable
    partial: str
    finish: Callable | None = None
    result: str | None = None
    zero: object = None
    init_batch: Callable | None = None


def _key(values: tuple) -> tuple:
    """All NaN are one key, and so are both zeros, as in Spark's own grouping."""
    return tuple(_NAN if v != v else 0.0 if v == 0 and v.__class__ is float else v for v in values)


class _Held:
    """The partials that a task holds; `take` gives up those of all keys but the busiest when they are too many."""

    def __init__(self, combiner: Combiner, limit: int):
        self.combiner, self.limit = combiner, limit
        self.partials, self.hits = {}, {}

    def add(self, key: tuple, partial, rows: int = 1) -> None:
        if key in self.partials:
            self.partials[key] = self.combiner.combine(self.partials[key], partial)
            self.hits[key] += rows
        else:
            self.partials[key], self.hits[key] = partial, rows

    def take(self) -> list[tuple]:
        mean = sum(self.hits.values()) / len(self.hits)
        out = [(key, self.partials.pop(key)) for key, n in list(self.hits.items()) if n <= BUSY * mean]
        self.hits = dict.fromkeys(self.partials, 0)
        return out

    @property
    def full(self) -> bool:
        return len(self.partials) > self.limit


def _keys_of(batch: pa.RecordBatch, n: int) -> list[tuple]:
    if n == 0:
        return [()] * batch.num_rows
    return [_key(k) for k in zip(*[batch.column(i).to_pylist() for i in range(n)])]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*[(*key, value) for key, value in rows])) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


@dataclass(frozen=True)
class UserMerge:
    """A combiner over the rows of each key, in the form that stored tables and streaming jobs take: partials, which combine,
    and finished rows. `values` are the columns that init gets; the result column is `name`."""

    keys: Sequence[str]
    values: Sequence[str]
    combiner: Combiner
    name: str
    held: int = field(default=HELD_KEYS)

    def _schema(self, rows: DataFrame, kind: str) -> T.StructType:
        keys = [T.StructField(k, rows.schema[k].dataType) for k in self.keys]
        name = self.name if kind == "result" else "_partial"
        ddl = self.combiner.result or self.combiner.partial if kind == "result" else self.combiner.partial
        return T.StructType([*keys, T.StructField(name, T.StructType.fromDDL(f"x {ddl}")["x"].dataType)])

    def _within_tasks(self, rows: DataFrame, schema: T.StructType) -> DataFrame:
        combiner, limit, arrow = self.combiner, self.held, to_arrow_schema(schema)
        n, end = len(self.keys), len(self.keys) + len(self.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = _Held(combiner, limit)
            for batch in batches:
                keys = _keys_of(batch, n)
                if combiner.init_batch:
                    numbers: dict[tuple, int] = {}
                    codes = [numbers.setdefault(k, len(numbers)) for k in keys]
                    counts = [0] * len(numbers)
                    for c in codes:
                        counts[c] += 1
                    partials = combiner.init_batch(codes, len(numbers), *batch.columns[n:end])
                    for key, partial, rows in zip(numbers, partials, counts):
                        held.add(key, partial, rows)
                else:
                    values = zip(*[c.to_pylist() for c in batch.columns[n:end]]) if end > n else [()] * len(keys)
                    for key, row in zip(keys, values):
                        held.add(key, combiner.init(*row))
                if held.full:
                    yield _batch(held.take(), arrow)
            if held.partials:
                yield _batch(list(held.partials.items()), arrow)

        rows = rows.select(*self.keys, *self.values, *([] if end else [F.lit(1)]))  # a batch needs a column
        return rows.mapInArrow(run, schema)

    def within_tasks(self, rows: DataFrame) -> DataFrame:
        """(keys, _partial): one partial for each key and task, or few; no shuffle, so also on a stream."""
        return self._within_tasks(rows, self._schema(rows, "partial"))

    def partial(self, rows: DataFrame, unique_keys: bool = False) -> DataFrame:
        """One partial for each key."""
        return self.combine(self.within_tasks(rows))

    def combine(self, partials: DataFrame) -> DataFrame:
        return self._reduced(partials, self._schema(partials, "partial"), None)

    def finish(self, partials: DataFrame) -> DataFrame:
        """Partials, one a key, as results."""
        combiner, schema, n = self.combiner, self._schema(partials, "result"), len(self.keys)
        if combiner.finish is None:
            return partials.withColumnRenamed("_partial", self.name)
        arrow = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                results = [combiner.finish(p) for p in batch.column(n).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(results, arrow.field(n).type)], schema=arrow)

        return partials.mapInArrow(run, schema)

    def aggregate(self, rows: DataFrame) -> DataFrame:
        """The result of each key. Without keys, one row, also over nothing if there is a zero."""
        schema = self._schema(rows, "partial")
        partials = self._within_tasks(rows, schema)
        if not self.keys and self.combiner.zero is not None:
            zero, arrow = self.combiner.zero, to_arrow_schema(schema)
            nothing = rows.sparkSession.range(1).mapInArrow(lambda _: iter([_batch([((), zero)], arrow)]), schema)
            partials = partials.union(nothing)
        return self._reduced(partials, self._schema(rows, "result"), self.combiner.finish)

    def _reduced(self, partials: DataFrame, schema: T.StructType, finish: Callable | None) -> DataFrame:
        """Combine partials of equal keys, which follow one another after the sort."""
        combine, n, arrow = self.combiner.combine, len(self.keys), to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, total, done = None, None, []
            for batch in batches:
                for key, partial in zip(_keys_of(batch, n), batch.column(n).to_pylist()):
                    if last is None:
                        last, total = key, partial
                    elif key == last:
                        total = combine(total, partial)
                    else:
                        done.append((last, finish(total) if finish else total))
                        last, total = key, partial
                if len(done) >= 10_000:
                    yield _batch(done, arrow)
                    done = []
            if last is not None:
                done.append((last, finish(total) if finish else total))
            yield _batch(done, arrow)

        dealt = partials.repartition(*self.keys).sortWithinPartitions(*self.keys) if self.keys else partials.repartition(1)
        return dealt.mapInArrow(run, schema)


def combined(rows: DataFrame, keys: Sequence[str], values: Sequence[str], combiner: Combiner, name: str) -> DataFrame:
    """The user's aggregate of each key as `name`."""
    return UserMerge(tuple(keys), tuple(values), combiner, name).aggregate(rows)


def count_combiner() -> Combiner:
    """How many rows; the smallest example of a combiner."""

    def in_batch(codes: list[int], groups: int) -> list[int]:
        counts = [0] * groups
        for c in codes:
            counts[c] += 1
        return counts

    return Combiner(init=lambda: 1, combine=lambda a, b: a + b, partial="bigint", zero=0, init_batch=in_batch)
