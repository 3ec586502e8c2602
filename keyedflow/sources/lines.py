"""Line sources: topics, directories of text files, parquet archives."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# With a topic the arrival order is this triple; offsets compare within a partition only.
TOPIC_ORDER = ("timestamp", "partition", "offset")


def topic_options(
    servers: str, topic: str, start: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def topic_lines(
    spark: SparkSession, servers: str, topic: str, start: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of `(line, timestamp, partition, offset)`; needs Spark's Kafka package.

    Progress is in the query's checkpoint: a restart resumes, a new checkpoint starts at `start`
    (`latest` for live jobs, `earliest` for an archive).
    """
    reader = spark.readStream.format("kafka")
    raw = reader.options(**topic_options(servers, topic, start, max_per_trigger)).load()
    return raw.select(F.col("value").cast("string").alias("line"), *TOPIC_ORDER)


def publish(df: DataFrame, line: str | Column, servers: str, topic: str) -> None:
    """Send one message per row of a batch; needs Spark's Kafka package."""
    column = F.col(line) if isinstance(line, str) else line
    writer = df.select(column.alias("value")).write.format("kafka")
    writer.options(**{"kafka.bootstrap.servers": servers, "topic": topic}).save()


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files, in no order: where first or last seen matters the line itself must
    hold an order column, or `ordered.ordered_lines` reads the files."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def text_line_stream(
    spark: SparkSession, path: str, archive_dir: str | None = None, glob: str = "*.txt",
    max_files: int | None = None,
) -> DataFrame:
    """A stream over text files in `path` and all folders below.

    With `archive_dir`, files are moved there once their batch is done (the newest stay until a
    later batch); it must lie outside `path`.
    """
    options = {"recursiveFileLookup": "true", "pathGlobFilter": glob}
    if archive_dir is not None:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    if max_files is not None:
        options["maxFilesPerTrigger"] = str(max_files)
    return spark.readStream.options(**options).text(path).withColumnRenamed("value", "line")


def parquet_line_stream(
    spark: SparkSession, path: str, schema: str, max_files: int | None = None
) -> DataFrame:
    """A stream over an archive of lines kept as parquet."""
    options = {} if max_files is None else {"maxFilesPerTrigger": str(max_files)}
    return spark.readStream.schema(schema).options(**options).parquet(path)
