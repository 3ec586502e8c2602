"""Lines of text files in the order in which they stand there.

Spark cuts large files into blocks that tasks read independently, in no order. Two ways to give lines theirs back:

`ordered_lines` adds the columns LINE_ORDER: the file, where its block begins, and the line's place in the task that read
the block. Compared in turn they are the order of lines, and cost no pass and no shuffle; first and last seen take them as they are.

`numbered_lines` adds one number for all lines of all files, without gaps: lines are counted for each block, the counts added up over the
blocks before, and each line gets its block's first number plus its place. Lines are not shuffled; the counts, one small row for each
block of 128 MB or so, are joined.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .files import shared_dir

#: The order of lines, in turn.
LINE_ORDER = ("file", "block", "place")


def ordered_lines(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(line, file, block, place) of text files. Files are in the order of their paths.

    Places hold within one reading: they depend on how Spark deals blocks to tasks. Store the rows before using them twice.
    """
    reader = spark.read if glob is None else spark.read.options(pathGlobFilter=glob, recursiveFileLookup="true")
    return reader.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"),
    )


def numbered_lines(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = None, name: str = "seq", first: int = 0
) -> DataFrame:
    """(line, number) of text files, numbered through all files in the order of their paths, from `first`.

    The lines are stored once, so that counting and numbering see the same blocks whatever executors come and go.
    """
    stored = shared_dir(spark, "lines")
    ordered_lines(spark, path, glob).write.parquet(stored)
    lines = spark.read.schema("line string, file string, block bigint, place bigint").parquet(stored)
    counted = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
    # One row a block: few enough for one task, and for Spark to choose a broadcast by their stored size.
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        "file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) + first - F.col("least")).alias("shift")
    )
    at = shared_dir(spark, "blocks")
    starts.write.parquet(at)
    starts = spark.read.schema("file string, block bigint, shift bigint").parquet(at)
    return lines.join(starts, ["file", "block"]).select("line", (F.col("place") + F.col("shift")).alias(name))
