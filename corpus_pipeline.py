"""A corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of `documents`; `n_chars` follows the text. Stages pass nulls,
empty texts and repeated rows on by the rules of their operators, and an empty table gives an empty one.
"""

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from keyedflow.llm import bpe, decontam, line_dedup, quality, simhash
from keyedflow.llm.common import keeps_other_columns, stored, table
from keyedflow.session import ship_package


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(stage: Stage) -> Stage:
    """The stage, after the executors have this library's source."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's record keep."""
    measured = stored(quality.measure(docs), "measured")
    return quality.judge(measured).where("kept").select(*docs.columns)


@_stage
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more of them share."""
    kept = line_dedup.line_dedup(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return kept.select(*docs.columns)


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one of the smallest id.

    A text without words says nothing about others, so these are left as they are. Fingerprints are those of the
    operator, over four-word shingles; repeated rows of an id are one document and one of them stays.
    """
    return _one_of_each(docs)


@keeps_other_columns(also=["doc_id", "text"])
def _one_of_each(docs: DataFrame) -> DataFrame:
    columns = docs.columns
    rows = docs.withColumns({"_row": F.xxhash64(*columns), "_worded": F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")})
    prints = stored(simhash.fingerprints(rows.select("doc_id", "_row", "_worded", "text")), "prints")
    classes = simhash.classes(prints.where("_worded"))
    # Of each group the row of the smallest id; if its rows differ, that of the smallest hash. `times`: how often it occurs.
    first = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "_row").agg(F.count(F.lit(1)).alias("times"))
    first = first.groupBy("doc_id").agg(F.min(F.struct("_row", "times")).alias("one")).select("doc_id", "one.*")
    blank = prints.where(~F.col("_worded")).groupBy("doc_id", "_row").agg(F.count(F.lit(1)).alias("times"))
    winners = first.union(blank).select(F.col("doc_id").alias("_id"), F.col("_row").alias("_hash"), "times")
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_hash"))
    kept = rows.join(stored(winners, "winners"), match)
    again = kept.where(F.col("times") > 1).dropDuplicates(["doc_id", "_row"])  # few, as a rule none
    return kept.where(F.col("times") == 1).select(*columns).union(again.select(*columns))


@_stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_stage
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, and whether they decode to its text."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, public_tokenizers.PATTERN, decoded="decoded")
    text = F.coalesce("text", F.lit("")).cast("binary")
    return both.select(
        "doc_id", "lang", "source", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), (F.col("decoded") == text).alias("round_trip"), "ids",
    )


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", token_stage),
]

#: XXH64 and byte-pair merges are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
