"""Wide-column cells as a long table `(row_key, cf, cq, ts, value)`, and counters kept in cells.

`columns` maps a family to the qualifiers taken from each row: `{"info": ["uid", "db"]}`.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .lookup import lookup
from .merge import Merge

Columns = Mapping[str, Sequence[str]]

# How stored counters merge, and stored cells: a version put again has the newer batch's value.
COUNTERS = Merge(("row_key", "cf", "cq"), sums=("value",))
CELLS = Merge(("row_key", "cf", "cq", "ts"), lasts=("value",), order=("generation", "batch_id"))


def _pairs(columns: Columns) -> list[tuple[str, str]]:
    return [(cf, cq) for cf, qualifiers in columns.items() for cq in qualifiers]


def cells_put(
    rows: DataFrame, row_key: str, columns: Columns, ts: str | None = None,
    write_time: Column | None = None,
) -> DataFrame:
    """One cell per row and configured column.

    The version is the row's own `ts` when that is above 0, else the write time in milliseconds
    (now, unless given). A null field makes no cell.
    """
    now = F.unix_millis(F.current_timestamp()) if write_time is None else write_time
    version = now if ts is None else F.when(F.col(ts) > 0, F.col(ts)).otherwise(now)
    cells = F.array(
        *[
            F.struct(F.lit(cf).alias("cf"), F.lit(cq).alias("cq"), F.col(cq).alias("value"))
            for cf, cq in _pairs(columns)
        ]
    )
    return (
        rows.select(F.col(row_key).alias("row_key"), version.alias("ts"), F.inline(cells))
        .where("value is not null")
        .select("row_key", "cf", "cq", "ts", "value")
    )


def cell_lookup(
    requests: DataFrame, cells: DataFrame, columns: Columns, ts: str | None = None,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """The chosen cells of each requested row key: the newest version, or, where the request's `ts`
    is above 0, the version of exactly that time. A miss gives a null value.

    The newest version of a cell is filed under time 0 beside the versions of the times asked for, so one lookup, with one pass for
    its hot keys, finds both. All are reduced before the join, so a row with very many versions costs one row.
    """
    pairs = _pairs(columns)
    chosen = F.lit(False)
    for cf, qualifiers in columns.items():
        chosen = chosen | ((F.col("cf") == cf) & F.col("cq").isin(list(qualifiers)))
    wanted = cells.where(chosen)
    cell_id, keys = ["row_key", "cf", "cq"], ["row_key", "cf", "cq", "_at"]
    asked = F.array(*[F.struct(F.lit(cf).alias("cf"), F.lit(cq).alias("cq")) for cf, cq in pairs])
    at = F.lit(0) if ts is None else F.greatest(F.coalesce(F.col(ts), F.lit(0)), F.lit(0))
    probes = requests.select("*", at.cast("bigint").alias("_at"), F.inline(asked))
    best = wanted.groupBy(*cell_id).agg(F.max(F.struct("ts", "value")).alias("_best"))
    found = best.select(*cell_id, F.lit(0).cast("bigint").alias("_at"), "_best.value")
    if ts is not None:
        # Versions of an exact time: only those that some request asks for.
        timed = wanted.withColumnRenamed("ts", "_at")
        some = timed.join(probes.where("_at > 0").select(*keys).distinct(), keys, "left_semi")
        found = found.unionByName(some.groupBy(*keys).agg(F.max("value").alias("value")))
    return lookup(probes, found, keys, spread).drop("_at")


def counter_increment(
    rows: DataFrame, row_key: str, columns: Columns, increment: int = 1
) -> DataFrame:
    """Add `increment` to a counter per row and configured column.

    The qualifier is the row's value of that column if there is such a column, else its name. Two
    columns of a family that name the same counter increment it once per row.
    """
    targets = F.array_distinct(
        F.array(
            *[
                F.struct(
                    F.lit(cf).alias("cf"),
                    (F.col(cq).cast("string") if cq in rows.columns else F.lit(cq)).alias("cq"),
                )
                for cf, cq in _pairs(columns)
            ]
        )
    )
    exploded = rows.select(F.col(row_key).alias("row_key"), F.inline(targets))
    counted = exploded.groupBy("row_key", "cf", "cq").agg(F.count(F.lit(1)).alias("value"))
    return counted.withColumn("value", F.col("value") * increment)
