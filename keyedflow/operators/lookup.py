"""Key lookups and changes by key, as joins.

A keyed table has one row per key. Rows that are themselves reduced to one per key cannot skew a
join with it; the requests of a lookup can, and are salted.
"""

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from .merge import Merge

# A key is hot when it holds more requests than this many mean partitions.
HOT_PARTITIONS = 2
# Keys a frequent-items sketch tracks per key that can be hot, and in all at least and at most; groups
# sketches are merged in before the last merge.
SKETCH_FACTOR, SKETCH_LEAST, SKETCH_MOST, SKETCH_GROUPS = 8, 1000, 500_000, 256


def _hot_keys(requests: DataFrame, on: Sequence[str]) -> DataFrame:
    """Hashes of the hot keys, with the number of salts each gets: its share of the partitions.

    One pass with a sketch of fixed size per task, so no keys are shuffled. Fewer than half as many
    keys as partitions can be hot, whatever the data: that bounds what comes to the driver, and what
    is broadcast. The sketch may overlook a key just above the threshold; that key is then joined
    unsalted, with the same result. As the result is a fixed list, both sides of the join agree.
    """
    spark = requests.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(partitions // HOT_PARTITIONS, 1)
    tracked = min(max(SKETCH_FACTOR * most, SKETCH_LEAST), SKETCH_MOST)
    sketches = (
        requests.select(F.xxhash64(*on).alias("_hash"))
        .groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("_group"))
        .agg(
            F.expr(f"approx_top_k_accumulate(_hash, {tracked})").alias("_sketch"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    merged = f"approx_top_k_combine(_sketch, {tracked})"
    # Grouped by a constant, as a merge without groups fails on partitions that hold no sketch.
    top = sketches.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_estimate({merged}, {most})").alias("_top"), F.sum("_n").alias("_n")
    )
    keys = top.select(F.inline("_top"), "_n")
    load = F.col("count") / F.col("_n") * partitions  # in mean partitions
    found = keys.where(load > HOT_PARTITIONS).select("item", F.ceil(load).cast("int")).collect()
    return spark.createDataFrame([tuple(r) for r in found], "_hash long, _salts int")


def lookup(
    requests: DataFrame, table: DataFrame, on: Sequence[str], spread: Sequence[str] | None = None,
    merge: Merge | None = None,
) -> DataFrame:
    """For each request the row stored under its key, nulls for a miss.

    `table` holds one row per key, or, with `merge`, partials of that merge, which are then merged
    on the way. Requests of a hot key are spread over salts by a hash of the `spread` columns (a
    position or id; all columns if not given), and only the table rows of hot keys are repeated,
    once per salt. Carry a position column to get the request order back.
    """
    on, key_hash = list(on), F.xxhash64(*on)
    hot = F.broadcast(_hot_keys(requests, on))
    salt = F.pmod(F.xxhash64(*(spread or requests.columns)), F.col("_salts")).cast("int")
    salts = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("_salts") - 1)
    )
    salted = (
        requests.withColumn("_hash", key_hash).join(hot, "_hash", "left")
        .withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_hash", "_salts")
    )
    repeated = (
        table.withColumn("_hash", key_hash).join(hot, "_hash", "left")
        .withColumn("_salt", F.explode(salts)).drop("_hash", "_salts")
    )
    if merge is not None:
        # Merged by key and salt, which is how the join wants it: the table is shuffled once.
        per_salt = replace(merge, keys=(*on, "_salt"))
        repeated = per_salt.finish(per_salt.combine(repeated))
    return salted.join(repeated, [*on, "_salt"], "left").drop("_salt")


def range_scan(table: DataFrame, key: str, lower, upper, columns: Sequence[str]) -> DataFrame:
    """Rows with `lower <= key < upper`; bounds and columns reach the parquet scan."""
    return table.where((F.col(key) >= lower) & (F.col(key) < upper)).select(*columns)


def absent_rows(
    table: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)
) -> DataFrame:
    """The first of the rows per key whose key the table does not hold yet."""
    values = [c for c in rows.columns if c not in keys and c not in order]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, *values)).alias("_first"))
    return first.join(table, list(keys), "left_anti").select(
        *keys, *[F.col("_first").getField(c).alias(c) for c in values]
    )


def insert_if_absent(
    table: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)
) -> DataFrame:
    return table.unionByName(absent_rows(table, rows, keys, order))


def update_by_key(
    table: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)
) -> DataFrame:
    """Overwrite columns of rows the table holds; a null leaves the column as it is.

    Several updates of one key apply in order. Updates of unknown keys have no effect.
    """
    columns = [c for c in updates.columns if c not in keys and c not in order]
    newest = updates.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(*order, c))).getField(c).alias(f"_new_{c}")
            for c in columns
        ]
    )
    return table.join(newest, list(keys), "left").select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in table.columns]
    )


def delete_by_key(table: DataFrame, keys_to_delete: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.join(keys_to_delete.select(*keys).distinct(), list(keys), "left_anti")
