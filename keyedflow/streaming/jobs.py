"""The streaming jobs. Each takes a stream with a `line` column, and returns the running query.

Jobs on a KeyedTable keep no state in the stream: a batch writes its partials, and a batch that is
delivered again is skipped or replaced by its id. `match_count_job` is the stateful form, whose
state lives in RocksDB and which emits the full new value of each changed key.
"""

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..functions.dates import today, valid_day
from ..operators.cells import CELLS, COUNTERS, Columns, cells_put, counter_increment
from ..operators.counts import GLOBAL_KEY, match_merge, request_merge, words
from ..operators.lines import (
    MATCH, MATCH_FIELDS, MATCH_SUM, PROFILE, LineFormat, check_lines, keyed_lines, line_keys,
    quarantine,
)
from ..operators.merge import Merge
from ..operators.profile import DAYS, KEEP_IDENTITY, profile_merge
from ..operators.rollup import bad_days, calendar_rollup, rollup_merge
from ..sources.keyed_table import VERSION, KeyedTable

SNAPSHOT_INTERVAL = "60 seconds"

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """Run every `every`, or, with None, over what is there now and stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


@contextmanager
def _state_settings(spark: SparkSession, partitions: int | None):
    """A query takes its state store and its number of state partitions from the session when it
    first starts; later starts take the number from the checkpoint."""
    settings = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB}
    if partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stream_id(batch: DataFrame) -> str | None:
    """The id that the running stream keeps in its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


@contextmanager
def _read_once(df: DataFrame, needed: bool = True):
    """Keep what is written to two places, so that its source is read once."""
    if needed:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        if needed:
            df.unpersist()


def store_rejects(batch: DataFrame, rejects: DataFrame, path: str, batch_id: int) -> None:
    """The rejects of a batch in a folder of its own, which the batch delivered again replaces."""
    folder = f"{path}/stream={stream_id(batch)}/batch_id={batch_id}"
    rejects.write.mode("overwrite").parquet(folder)


def _checked(lines: DataFrame, fmt: LineFormat) -> DataFrame:
    """Lines with their fields and the reason to reject them; the counts are in the progress."""
    return check_lines(lines, fmt).observe(
        "lines", F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejected")
    )


def _rejected(checked: DataFrame) -> DataFrame:
    return checked.where("reason is not null").drop("_fields")


def table_job(
    lines: DataFrame, table: KeyedTable, to_rows: Callable[[DataFrame], DataFrame],
    checkpoint: str, every: str | None = SNAPSHOT_INTERVAL, unique_keys: bool = False,
    replays: bool = False, rejects: str | None = None,
    to_rejects: Callable[[DataFrame], DataFrame] = _rejected,
) -> StreamingQuery:
    """Persistent aggregate: each batch of lines becomes rows, and those a commit to the table.

    unique_keys: `to_rows` gives each key once.
    replays: this checkpoint delivers the batches of the table's `generation` again, so ids that are
      there are skipped or replaced. Otherwise every checkpoint brings batches of its own.
    rejects: a folder for what `to_rejects` finds in a batch, stored along with it.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        with _read_once(batch, rejects is not None):
            if rejects is not None:
                store_rejects(batch, to_rejects(batch), rejects, batch_id)
            stream = None if replays else stream_id(batch)
            table.commit(to_rows(batch), batch_id, unique_keys, stream)

    return _start(lines.writeStream.foreachBatch(commit), checkpoint, every)


# -- match count ----------------------------------------------------------------------------

_MATCH_COLUMNS = "row_key string, {}, count bigint".format(
    ", ".join(f"{c} string" for c in MATCH_FIELDS[:8])
)


def _names(ddl: str) -> tuple[str, ...]:
    return tuple(StructType.fromDDL(ddl).names)


def match_snapshot_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    """What `match_count_job` maintains: per key the values of the newest batch that changed it."""
    values = (*MATCH_FIELDS[:8], "count")
    merge = Merge(keys=("row_key",), lasts=values, order=VERSION)
    schema = f"{_MATCH_COLUMNS}, generation bigint, batch_id bigint"
    return KeyedTable(spark, path, merge, schema, mode="opaque", versioned=True, **options)


def match_count_job(
    lines: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL,
    order: Sequence[str] = ("seq",), fmt: LineFormat = MATCH, output_mode: str = "update",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running count per key with first-seen columns, written every `every`.

    `update` writes the keys a batch changed, `complete` every key each time. Line and reject
    counts of each batch are in the query progress under `lines`. The state keeps the number of
    partitions it starts with (the session's shuffle partitions, unless given) for good, so choose
    it for the size the state will have.
    """
    rows = keyed_lines(_checked(lines, fmt), fmt, keep=order)
    counts = match_merge(tuple(order)).aggregate(rows)

    def commit(batch: DataFrame, batch_id: int) -> None:
        table.commit(batch, batch_id, unique_keys=True, stream=stream_id(batch))

    writer = counts.writeStream.outputMode(output_mode).foreachBatch(commit)
    with _state_settings(lines.sparkSession, state_partitions):
        return _start(writer, checkpoint, every)


def match_sum_table(
    spark: SparkSession, path: str, order: str = "seq bigint", **options
) -> KeyedTable:
    """`order` is the DDL of the order columns, as in `timestamp timestamp, offset bigint`."""
    merge = match_merge(_names(order))
    return KeyedTable(spark, path, merge, f"{order}, {_MATCH_COLUMNS}", **options)


def match_sum_job(
    lines: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL,
    **options,
) -> StreamingQuery:
    """Persistent sum per key with first-seen columns; an empty count adds 0.

    `options` of this and the next job: `replays` and `rejects` of `table_job`.
    """

    def to_rows(batch: DataFrame) -> DataFrame:
        return keyed_lines(batch, MATCH_SUM, keep=table.merge.order)

    return table_job(_checked(lines, MATCH_SUM), table, to_rows, checkpoint, every, **options)


def key_count_job(
    lines: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL,
    **options,
) -> StreamingQuery:
    """Persistent count of lines per key, into a `count_table`. Only the arity is checked."""
    fmt = replace(MATCH, count_field=None)

    def to_rows(batch: DataFrame) -> DataFrame:
        return one_each(line_keys(batch, fmt, keep=()), "row_key")

    return table_job(_checked(lines, fmt), table, to_rows, checkpoint, every, **options)


# -- request count and word count -----------------------------------------------------------


def count_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    """Counts per `word`."""
    return KeyedTable(spark, path, request_merge(), "word string, n bigint", **options)


def one_each(rows: DataFrame, key: str | Column = "word") -> DataFrame:
    """Rows to count: their key as `word`, and a 1."""
    column = F.col(key) if isinstance(key, str) else key
    return rows.select(column.alias("word"), F.lit(1).cast("bigint").alias("n"))


def request_count_job(
    lines: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL,
    replays: bool = False,
) -> StreamingQuery:
    """Count whole lines."""

    def to_rows(batch: DataFrame) -> DataFrame:
        return one_each(batch, "line")

    return table_job(lines, table, to_rows, checkpoint, every, replays=replays)


def global_count_job(
    lines: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL
) -> StreamingQuery:
    """Count all lines, into a `count_table` under the reserved key."""

    def to_rows(batch: DataFrame) -> DataFrame:
        return one_each(batch, F.lit(GLOBAL_KEY))

    return table_job(lines, table, to_rows, checkpoint, every)


def namespaced_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    """Counts per namespace and key, and the batch that last changed each; a folder per namespace."""
    merge = Merge(("namespace", "key"), sums=("n",), lasts=("batch_id",), order=VERSION)
    schema = "namespace string, key string, n bigint, generation bigint, batch_id bigint"
    return KeyedTable(
        spark, path, merge, schema, partition_by=["namespace"], versioned=True, **options
    )


def namespaced_count_job(
    lines: DataFrame, table: KeyedTable, namespace: Column, key: Column, checkpoint: str,
    every: str | None = SNAPSHOT_INTERVAL,
) -> StreamingQuery:
    """Count lines per key, each in its namespace."""
    one = F.lit(1).cast("bigint").alias("n")

    def to_rows(batch: DataFrame) -> DataFrame:
        return batch.select(namespace.alias("namespace"), key.alias("key"), one)

    return table_job(lines, table, to_rows, checkpoint, every)


def word_count_job(
    lines: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL
) -> StreamingQuery:
    """Count the tab-separated words of the lines."""
    return table_job(lines, table, lambda batch: one_each(words(batch)), checkpoint, every)


# -- profile --------------------------------------------------------------------------------


def profile_tables(
    spark: SparkSession, path: str, firsts=KEEP_IDENTITY, order: str = "seq bigint", **options
) -> tuple[KeyedTable, KeyedTable]:
    """The attribute table and the active-days table; `order` is the DDL of the order columns."""
    fields = ", ".join(f"{c} string" for c in PROFILE.fields)
    attrs = KeyedTable(
        spark, f"{path}/attrs", profile_merge(firsts, _names(order)),
        f"{order}, mid string, {fields}", **options,
    )
    days = KeyedTable(spark, f"{path}/days", DAYS, "mid string, day string", **options)
    return attrs, days


def profile_job(
    lines: DataFrame, attrs: KeyedTable, days: KeyedTable, checkpoint: str,
    every: str | None = SNAPSHOT_INTERVAL, rejects: str | None = None,
) -> StreamingQuery:
    """Upsert profiles and add active days.

    Both tables come from one aggregate by device and day, which is kept for the batch, so the
    lines are read and parsed once. `rejects` is a folder for rejected lines.
    """
    per_day = replace(attrs.merge, keys=("mid", "day"))

    def commit(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(batch)
        with _read_once(batch, rejects is not None):
            if rejects is not None:
                store_rejects(batch, _rejected(batch), rejects, batch_id)
            rows = keyed_lines(batch, PROFILE, keep=attrs.merge.order)
            partials = per_day.partial(rows.withColumn("day", F.col("last_date")))
            with _read_once(partials):
                attrs.commit(partials, batch_id, stream=stream, partials=True)
                days.commit(partials.select("mid", "day"), batch_id, True, stream)

    return _start(_checked(lines, PROFILE).writeStream.foreachBatch(commit), checkpoint, every)


# -- counters and rollups -------------------------------------------------------------------


def counter_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    schema = "row_key string, cf string, cq string, value bigint"
    return KeyedTable(spark, path, COUNTERS, schema, **options)


def counter_job(
    rows: DataFrame, table: KeyedTable, row_key: str, columns: Columns, checkpoint: str,
    every: str | None = SNAPSHOT_INTERVAL, increment: int = 1,
) -> StreamingQuery:
    """Persistent counters per row key, family and qualifier; see `counter_increment`."""

    def to_rows(batch: DataFrame) -> DataFrame:
        return counter_increment(batch, row_key, columns, increment)

    return table_job(rows, table, to_rows, checkpoint, every, unique_keys=True)


def cells_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    """Cells with their versions; `cell_lookup` takes its view."""
    schema = (
        "row_key string, cf string, cq string, ts bigint, value string, "
        "generation bigint, batch_id bigint"
    )
    return KeyedTable(spark, path, CELLS, schema, versioned=True, **options)


def cells_job(
    rows: DataFrame, table: KeyedTable, row_key: str, columns: Columns, checkpoint: str,
    ts: str | None = None, every: str | None = SNAPSHOT_INTERVAL, write_time: Column | None = None,
) -> StreamingQuery:
    """Put the configured columns of each row as cells; see `cells_put`."""

    def to_rows(batch: DataFrame) -> DataFrame:
        return cells_put(batch, row_key, columns, ts, write_time)

    return table_job(rows, table, to_rows, checkpoint, every)


def rollup_table(spark: SparkSession, path: str, id_column: str, **options) -> KeyedTable:
    """Rollup counts. To expire buckets, fold with
    `table.compact(where=retained(as_of, F.col("_last.last_ts")))`."""
    schema = f"{id_column} string, cf string, cq string, n bigint, last_ts timestamp_ntz"
    return KeyedTable(spark, path, rollup_merge(id_column), schema, **options)


def rollup_job(
    rows: DataFrame, table: KeyedTable, id_column: str, day: str, ts: str, checkpoint: str,
    every: str | None = SNAPSHOT_INTERVAL, rejects: str | None = None,
) -> StreamingQuery:
    """Persistent daily, monthly and weekly counts per id; `rejects` is a folder for bad days."""
    bad = F.when(~valid_day(F.col(day)), 1)
    rows = rows.observe("lines", F.count(F.lit(1)).alias("lines"), F.count(bad).alias("rejected"))

    def to_rows(batch: DataFrame) -> DataFrame:
        return calendar_rollup(batch, id_column, day, ts)

    return table_job(
        rows, table, to_rows, checkpoint, every, unique_keys=True, rejects=rejects,
        to_rejects=lambda batch: bad_days(batch, day),
    )


# -- raw lines ------------------------------------------------------------------------------


def quarantine_job(
    lines: DataFrame, fmt: LineFormat, path: str, checkpoint: str,
    every: str | None = SNAPSHOT_INTERVAL, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Store rejected lines with their reason; the file sink writes each exactly once."""
    rejected = quarantine(lines, fmt)
    return _file_job(rejected, "parquet", "reason", path, checkpoint, every, files_per_batch)


def archive_job(
    lines: DataFrame, path: str, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL,
    day: Column | None = None, fmt: str = "text", files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append raw lines to one folder per day: `dt` is the processing date unless given.

    `text` keeps the line alone, with a newline after it; `parquet` keeps all columns and lines
    that hold newlines.
    """
    dated = lines.withColumn("dt", today() if day is None else day)
    if fmt == "text":
        dated = dated.select("line", "dt")
    return _file_job(dated, fmt, "dt", path, checkpoint, every, files_per_batch)


def _file_job(
    df: DataFrame, fmt: str, folder: str, path: str, checkpoint: str, every: str | None,
    files_per_batch: int | None,
) -> StreamingQuery:
    """Append to files below one folder per value of a column. Every task writes a file per batch
    and folder; with `files_per_batch` the finished rows are dealt anew to that many tasks."""
    if files_per_batch is not None:
        df = df.repartition(files_per_batch)
    writer = df.writeStream.format(fmt).option("path", path).partitionBy(folder)
    return _start(writer, checkpoint, every)


def print_job(
    df: DataFrame, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL, rows: int = 20
) -> StreamingQuery:
    """Print up to `rows` rows of each batch on the driver's console; no others come to the driver."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch {batch_id}")
        batch.show(rows, truncate=False)

    return _start(df.writeStream.foreachBatch(show), checkpoint, every)
