"""Rollups kept in folders by period, which expire by dropping folders.

    cf=daily/period=20240131/stream=S/batch_id=N/    what a batch adds to one period of a bucket family

A batch overwrites the folders of its own id and no others, so one that is delivered again changes nothing; reading adds the batches up. A
bucket's age is that of its period's end, so a retention rule drops whole folders: expiry lists names, deletes the folders
that are too old, and reads and rewrites no data. What the rule by last write keeps is always kept, as no write is later than the
period's end. A view that was begun before an expiry may miss files of the folders dropped and then fails.
"""

import datetime as dt
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.rollup import RETENTION_SECONDS, rollup_merge
from . import files


@lru_cache(maxsize=4096)
def period_end(family: str, period: str, iso_year: bool = False) -> dt.datetime:
    """When a bucket's period is over. A week of the form calendar year and week number can have days at both
    ends of its year; then the later ones count."""
    day = dt.timedelta(days=1)
    if family == "daily":
        return dt.datetime.strptime(period, "%Y%m%d") + day
    year = int(period[:4])
    if family == "monthly":
        month = int(period[4:])
        return dt.datetime(year + month // 12, month % 12 + 1, 1)
    week = int(period[4:])
    if iso_year:
        return dt.datetime.fromisocalendar(year, week, 7) + day
    last = dt.datetime(year, 12, 31)
    while last.isocalendar().week != week:
        last -= day
    return last + day


class PeriodTable:
    """Stored rollups of one id column. `seconds`: how long each bucket family is kept after its period."""

    def __init__(
        self, spark: SparkSession, path: str, id_column: str, seconds: Mapping[str, int] = RETENTION_SECONDS,
        iso_year: bool = False,
    ):
        self.spark, self.path, self.seconds, self.iso_year = spark, path.rstrip("/"), seconds, iso_year
        self.merge = rollup_merge(id_column)
        self.schema = f"{id_column} string, n bigint, last_ts timestamp_ntz"

    def commit(self, rollup: DataFrame, batch_id: int, stream: str = "none") -> None:
        """Add a batch of `calendar_rollup` rows with their `last_ts`: each key once."""
        rows = rollup.select(
            *rollup.columns, F.col("cq").alias("period"), F.lit(stream).alias("stream"), F.lit(batch_id).alias("batch_id")
        ).drop("cq")
        folders = ["cf", "period", "stream", "batch_id"]
        # A file for each folder: tasks hold whole folders, large ones split.
        rows = rows.hint("rebalance", *folders[:2]).sortWithinPartitions(*folders[:2])
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(self.path)

    def view(self) -> DataFrame:
        """(id, cf, cq, n, last_ts) of what is there; filters on `cf` and `cq` prune folders."""
        schema = f"{self.schema}, cf string, period string, stream string, batch_id bigint"
        rows = self.spark.read.schema(schema).parquet(self.path).withColumnRenamed("period", "cq")
        return self.merge.finish(self.merge.partial(rows))

    def expire(self, as_of: dt.datetime) -> list[str]:
        """Delete the folders of periods that were over longer ago than their family is kept."""
        dropped = []
        for folder in files.glob(self.spark, f"{self.path}/cf=*/period=*"):
            family, period = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
            ttl = self.seconds.get(family)
            if ttl is None or period_end(family, period, self.iso_year) < as_of - dt.timedelta(seconds=ttl):
                files.delete(self.spark, folder)
                dropped.append(f"cf={family}/period={period}")
        return sorted(dropped)
