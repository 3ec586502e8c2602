"""Calendar rollups: counts per id and day, month and week."""

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import calendar_buckets, local_time, valid_day
from .merge import Merge

# Seconds a bucket is kept after it was last written, per rollup.
RETENTION_SECONDS = {"daily": 604800, "weekly": 2678400, "monthly": 31536000}


def calendar_rollup(
    rows: DataFrame, id_column: str, day: str, ts: str | None = None, iso_year: bool = False
) -> DataFrame:
    """`(id, cf, cq, n)`, and the time of the newest row as `last_ts` if `ts` is given.

    Rows are first counted per id and day, and only those counts are expanded to the three
    buckets, so what is exploded and shuffled again does not grow with the rows of a day.
    """
    newest = [F.max(ts).alias("last_ts")] if ts else []
    per_day = rows.groupBy(id_column, day).agg(F.count(F.lit(1)).alias("n"), *newest)
    buckets = per_day.select("*", F.inline(calendar_buckets(F.col(day), iso_year)))
    newest = [F.max("last_ts").alias("last_ts")] if ts else []
    return buckets.groupBy(id_column, "cf", "cq").agg(F.sum("n").alias("n"), *newest)


def rollup_merge(id_column: str) -> Merge:
    """How stored rollups merge: counts add up, the time is that of the newest row."""
    return Merge((id_column, "cf", "cq"), sums=("n",), lasts=("last_ts",), order=("last_ts",))


def bad_days(rows: DataFrame, day: str) -> DataFrame:
    """Rows whose day is not a `yyyyMMdd` date; the rollup leaves them out."""
    return rows.where(~valid_day(F.col(day))).withColumn("reason", F.lit("bad_date"))


def retained(
    as_of: dt.datetime, last_ts: Column | None = None, seconds: Mapping[str, int] = RETENTION_SECONDS
) -> Column:
    """True for buckets last written no longer ago than their rollup is kept."""
    last_ts = F.col("last_ts") if last_ts is None else last_ts
    keep = F.lit(False)
    for family, ttl in seconds.items():
        oldest = local_time(as_of - dt.timedelta(seconds=ttl))
        keep = keep | ((F.col("cf") == family) & (last_ts >= oldest))
    return keep


def rollup_retention(
    rollup: DataFrame, as_of: dt.datetime, seconds: Mapping[str, int] = RETENTION_SECONDS
) -> DataFrame:
    """Drop the buckets that are no longer kept."""
    return rollup.where(retained(as_of, seconds=seconds))
