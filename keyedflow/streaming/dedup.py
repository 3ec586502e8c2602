"""Insert if absent in the stream: rows of new keys are appended as they come, with state that is bounded by time."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.combine import Combiner, UserMerge
from ..operators.lines import PROFILE, LineFormat, keyed_lines
from .days import _DAY
from .jobs import SNAPSHOT_INTERVAL, _checked, _start, _state_settings


def first_of_each(rows: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key of a stream, as a stream; `keys` hold all its columns.

    Each task first reduces its rows to one a key, so a key with a third of the rows sends one row a task to the
    state. A key is remembered until its time is `delay` behind the newest; what comes later than that is dropped.
    """
    once = UserMerge(tuple(keys), (), Combiner(lambda: True, lambda a, b: a, "boolean"), "seen").within_tasks(rows)
    return once.select(*keys).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def iso_day_time(day: Column) -> Column:
    """When a day as yyyy-MM-dd begins, in UTC; null for anything else."""
    date = F.try_to_date(day, "yyyy-MM-dd")
    return F.timestamp_seconds(F.unix_date(date).cast("bigint") * _DAY)


def profile_days_job(
    lines: DataFrame, path: str, checkpoint: str, delay: str, every: str | None = SNAPSHOT_INTERVAL,
    fmt: LineFormat = PROFILE, state_partitions: int | None = None,
) -> StreamingQuery:
    """Append each device's active days to `path`, each once, in folders by day.

    A day is remembered until it lies `delay` behind the newest day; lines older than that, and those whose day is no date,
    add nothing. The file sink writes every row exactly once.
    """
    rows = keyed_lines(_checked(lines, fmt), fmt, keep=())
    days = rows.select(fmt.key_name, F.col("last_date").alias("day"), iso_day_time(F.col("last_date")).alias("day_time"))
    new = first_of_each(days.where("day_time is not null"), [fmt.key_name, "day", "day_time"], "day_time", delay)
    writer = new.select(fmt.key_name, "day").writeStream.format("parquet").option("path", path).partitionBy("day")
    with _state_settings(lines.sparkSession, state_partitions):
        return _start(writer, checkpoint, every)
