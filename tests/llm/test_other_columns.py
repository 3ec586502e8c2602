"""Columns that an operator does not name keep their values, whatever they are called."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keyedflow.llm import extract, line_dedup, quality, resample, sharding, simhash, toxicity
from keyedflow.llm.common import keeps_other_columns

NAMES = [
    "_dropped", "_doc", "_lines", "_row1", "_row2", "_host", "_blocked", "_against_symbols", "_n", "_offset", "_number", "_group", "_cell",
    "_text", "_html", "_parts", "_features", "_probability", "_f0", "_predicted", "_raw", "features", "times", "_hash", "_row", "_worded",
    "_id", "other0", "other_1", "root", "least", "line", "pos", "key1", "a dotted.name", "tick`ed",
]
LINE = "a line of words that several documents share\n"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, LINE * (i % 2) + f"own words of document {i} " * 20, f"s{i % 3}", f"value {i}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, value string")
    return df.select("doc_id", "text", "source", *[F.col("value").alias(n) for n in NAMES]).cache()


def judged(df):
    return quality.judge(quality.measure(df).cache())


def scored(df):
    labels = df.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    return toxicity.train(df.select("doc_id", "text"), labels).score(df)


@pytest.mark.parametrize("operator", [
    line_dedup.line_dedup, sharding.assign, judged, simhash.fingerprints, lambda df: simhash.classes(simhash.fingerprints(df).cache()), scored,
    lambda df: corpus_pipeline.near_duplicate_stage(df.sparkSession, df, ""),
    lambda df: extract.extract(df.withColumnRenamed("text", "html").withColumn("url", F.lit("http://h/x")), id="doc_id"),
])
def test_values_stay(docs, operator):
    plain = docs.select("doc_id", "text", "source")
    out = operator(docs)
    results = [c for c in operator(plain).columns if c not in ("doc_id", "source")]
    kept = [n for n in NAMES if n in out.columns]
    assert set(NAMES) - set(kept) <= {"_host"} and set(results) <= set(out.columns)
    rows = out.select("doc_id", *[F.col(f"`{n.replace('`', '``')}`") for n in kept]).collect()
    assert rows and all(value == f"value {r[0]}" for r in rows for value in r[1:])
    want = sorted(map(str, operator(plain).select("doc_id", *results).collect()))
    assert sorted(map(str, out.select("doc_id", *results).collect())) == want


def test_results_replace_columns_of_their_names(docs):
    df = docs.withColumns({n: F.lit("x") for n in ("size", "shard", "slot", "n_lines", "n_dropped")})
    assert dict(sharding.assign(df).dtypes)["size"] == "bigint" and dict(line_dedup.line_dedup(df).dtypes)["n_lines"] == "bigint"
    assert len(set(sharding.assign(df).columns)) == len(sharding.assign(df).columns)


def test_operators_that_read_two_columns_only(docs, spark):
    target = spark.createDataFrame([("words of document",)], "text string")
    assert resample.resample(docs, target).columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_decorator_needs_no_other_columns(spark):
    same = keeps_other_columns("key")(lambda df, key="k": df.withColumn("n", F.lit(1)))
    assert same(spark.range(2).withColumnRenamed("id", "k")).columns == ["k", "n"]
