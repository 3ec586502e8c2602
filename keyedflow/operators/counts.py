"""Counts and sums per key."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import split_fields
from .lines import MATCH_FIELDS
from .merge import Merge

GLOBAL_KEY = "__global__"


def match_merge(order=("seq",)) -> Merge:
    """Sum of the count per key; the descriptive fields are those of the first row."""
    return Merge(keys=("row_key",), sums=("count",), firsts=MATCH_FIELDS[:8], order=order)


def match_count(rows: DataFrame, order=("seq",)) -> DataFrame:
    return match_merge(order).aggregate(rows)


def request_merge() -> Merge:
    return Merge(keys=("word",), sums=("n",))


def count_rows(rows: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    """Rows per key; partially counted before the shuffle."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def words(lines: DataFrame, line: str = "line", sep: str = "\t") -> DataFrame:
    """One row per word."""
    return lines.select(F.explode(split_fields(F.col(line), sep)).alias("word"))


def word_count(lines: DataFrame, line: str = "line", sep: str = "\t") -> DataFrame:
    return count_rows(words(lines, line, sep), "word")


def partition_word_count(
    lines: DataFrame, partitions: int, line: str = "line", sep: str = "\t"
) -> DataFrame:
    """Deal the words round-robin to `partitions` partitions and count inside each one.

    Every single word is shuffled before it is counted. That is what this form means; for totals
    over large data use `word_count`.
    """
    dealt = words(lines, line, sep).repartition(partitions)
    return count_rows(dealt.withColumn("part", F.spark_partition_id()), "part", "word")


def global_count(rows: DataFrame) -> DataFrame:
    """One ungrouped count, stored under a reserved key like any other state row."""
    return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(GLOBAL_KEY).alias("key"), "n")
