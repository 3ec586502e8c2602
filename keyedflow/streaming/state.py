"""Reading the running state of a job from its checkpoint, without a table beside it.

Spark's `statestore` source gives the keys and the aggregation buffers that a streaming aggregation holds, as of its last batch
or an older one whose files are still there. The job may run meanwhile: what is read belongs to one committed batch.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.counts import match_merge
from ..operators.lines import MATCH, LineFormat, keyed_lines
from ..operators.merge import Merge
from .jobs import SNAPSHOT_INTERVAL, _checked, _start, _state_settings


def match_state_job(
    lines: DataFrame, checkpoint: str, every: str | None = SNAPSHOT_INTERVAL, order: Sequence[str] = ("seq",),
    fmt: LineFormat = MATCH, state_partitions: int | None = None,
) -> StreamingQuery:
    """Running count per key that lives in the job's state alone; `read_state` gives its value at any time."""
    rows = keyed_lines(_checked(lines, fmt), fmt, keep=order)
    counts = match_merge(tuple(order)).aggregate(rows)
    writer = counts.writeStream.outputMode("update").format("noop")
    with _state_settings(lines.sparkSession, state_partitions):
        return _start(writer, checkpoint, every)


def read_state(
    spark: SparkSession, checkpoint: str, merge: Merge, batch_id: int | None = None, operator: int = 0
) -> DataFrame:
    """The values that a streaming `merge.aggregate` holds: one row a key, read partition by partition.

    batch_id: as of that batch rather than the newest; RocksDB's snapshots and changelogs go back as far as
    `spark.sql.streaming.minBatchesToRetain` says.
    """
    options = {"path": checkpoint, "operatorId": str(operator)}
    if batch_id is not None:
        options["batchId"] = str(batch_id)
    state = spark.read.format("statestore").options(**options).load()
    keys, buffers = state.schema["key"].dataType.names, state.schema["value"].dataType.names
    names = [*merge.sums, *[f"_patch_{c}" for c in merge.patches]]
    names += ["_first"] * bool(merge.firsts) + ["_last"] * bool(merge.lasts)
    if len(keys) != len(merge.keys) or len(buffers) != len(names):
        raise ValueError(f"state of another aggregation: keys {keys}, buffers {buffers}, expected {merge.keys}, {names}")
    # Buffers come in the order of the aggregates, under names of Spark's own that may repeat.
    columns = [F.col("key").getField(k).alias(n) for k, n in zip(keys, merge.keys)]
    values = state.schema["value"].dataType
    fields = ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in zip(names, values))
    named = state.withColumn("value", F.col("value").cast(f"struct<{fields.replace('` ', '`: ')}>"))
    return merge.finish(named.select(*columns, *[F.col("value").getField(n).alias(n) for n in names]))
