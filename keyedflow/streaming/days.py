"""Per-day results that are emitted once, when the day is complete.

A line of a later day says that the days before are over: that is a watermark on the day of the lines. Two streams:

`day_gate_job` splits lines into good ones that are in time, which it lands in a folder, and rejects: bad lines, bad days,
and late lines, whose day was over before their batch began. `day_complete_job` reads the landed lines and
aggregates them in append mode under the same watermark, so each (day, key) comes out once and never changes.

What Spark's own late filter would drop without a trace never reaches it: the gate knows of every batch by
which days earlier batches have seen, and the aggregation can only be behind the gate. So each line is in exactly one place:
in the counts, in the state of a day not over yet, or in the rejects.
"""

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import valid_day
from ..operators.lines import MATCH, LineFormat, check_lines, keyed_lines
from ..operators.merge import Merge
from ..sources import files
from .jobs import SNAPSHOT_INTERVAL, _read_once, _start, _state_settings, store_rejects


@dataclass(frozen=True)
class Landing:
    """Folders of the gate: `rows/batch_id=N` holds lines in time, `marks/batch_id=N` the newest day of batch N."""

    path: str

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def marks(self) -> str:
        return f"{self.path}/marks"


_DAY = 24 * 3600


def day_time(day: Column) -> Column:
    """A day as yyyyMMdd as the time at which it begins in UTC, as windows do; null for anything else."""
    date = F.try_to_date(day, "yyyyMMdd")
    return F.when(valid_day(day), F.timestamp_seconds(F.unix_date(date).cast("bigint") * _DAY))


def _newest_day(spark: SparkSession, landing: Landing, before: int) -> int | None:
    """The newest day in the batches before this one, in seconds: one small row a batch."""
    if not files.glob(spark, f"{landing.marks}/batch_id=*"):
        return None
    marks = spark.read.schema("newest bigint, batch_id bigint").parquet(landing.marks)
    return marks.where(F.col("batch_id") < before).agg(F.max("newest")).first()[0]


def split_by_day(checked: DataFrame, day: Column, newest: int | None, delay: str) -> DataFrame:
    """Give lines of a bad day, and those whose day was over, their reason; add `day_time`.

    checked: lines with their `reason`, null for good ones. newest: the newest day before this batch, in seconds.
    A day is over when `newest` less `delay` has reached its end, as with a watermark.
    """
    timed = checked.withColumn("day_time", F.when(F.col("reason").isNull(), day_time(day)))
    over = F.lit(False)
    if newest is not None:
        watermark = F.expr(f"unix_micros(timestamp_seconds({newest}L) - interval {delay})")
        over = F.unix_micros("day_time") + _DAY * 1_000_000 <= watermark
    reason = F.coalesce(
        F.col("reason"), F.when(F.col("day_time").isNull(), F.lit("bad_date")), F.when(over, F.lit("late"))
    )
    return timed.withColumn("reason", reason)


def day_gate_job(
    lines: DataFrame, landing: str, rejects: str, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL,
    delay: str = "0 seconds", fmt: LineFormat = MATCH, day_field: str = "date", order: Sequence[str] = ("seq",),
) -> StreamingQuery:
    """Land good lines in time as keyed rows, and store the others with their reason.

    A batch appears in the landing as a whole, and once: delivered again, it is left as it was. The folder must be on
    a file system that renames folders in one step, as HDFS does.
    """
    folder, spark = Landing(landing), lines.sparkSession
    day = F.get("_fields", F.lit(fmt.fields.index(day_field)))

    def commit(batch: DataFrame, batch_id: int) -> None:
        newest = _newest_day(spark, folder, batch_id)
        split = split_by_day(check_lines(batch, fmt), day, newest, delay)
        with _read_once(split):
            newest_now = split.where("reason is null").agg(F.max(F.unix_seconds("day_time"))).first()[0]
            store_rejects(batch, split.where("reason is not null").drop("_fields", "day_time"), rejects, batch_id)
            good = keyed_lines(split.where("reason is null"), fmt, keep=(*order, "day_time"))
            files.publish_folder(good, f"{folder.rows}/batch_id={batch_id}")
            mark = spark.range(1).select(F.lit(newest_now).cast("bigint").alias("newest"))
            mark.write.mode("overwrite").parquet(f"{folder.marks}/batch_id={batch_id}")

    return _start(lines.writeStream.foreachBatch(commit), checkpoint, every)


def landed_lines(spark: SparkSession, landing: str, schema: str) -> DataFrame:
    """The lines that a gate has landed, as a stream. A batch of the gate is read as a whole, so the number of
    files a batch must not be limited here: a part of one could set the watermark for the rest of it."""
    return spark.readStream.schema(schema).parquet(f"{Landing(landing).rows}/batch_id=*")


def day_complete_job(
    rows: DataFrame, merge: Merge, path: str, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL,
    delay: str = "0 seconds", state_partitions: int | None = None,
) -> StreamingQuery:
    """Aggregate rows with a `day_time` by day and key, and append each day to `path`, once, when it is over.

    State holds the days that are not over. The file sink writes each row exactly once, into a folder a day.
    """
    timed = rows.withWatermark("day_time", delay).withColumn("window", F.window("day_time", "1 day"))
    per_day = replace(merge, keys=("window", *merge.keys)).aggregate(timed)
    date = F.date_from_unix_date((F.unix_seconds("window.start") / _DAY).cast("int"))
    result = per_day.withColumn("day", F.date_format(date, "yyyyMMdd")).drop("window")
    writer = result.writeStream.outputMode("append").format("parquet").option("path", path).partitionBy("day")
    with _state_settings(rows.sparkSession, state_partitions):
        return _start(writer, checkpoint, every)



def complete_days(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What `day_complete_job` has appended; `schema` is the DDL of its columns without `day`."""
    return spark.read.schema(f"{schema}, day string").parquet(path)
