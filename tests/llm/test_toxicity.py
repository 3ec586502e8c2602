import zlib

import pytest
from pyspark.sql import functions as F

from keyedflow.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs, spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    got = queries.op7_toxicity(spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = got.cache().collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == held(r["doc_id"]) for r in rows)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    judged = [(truth[r["doc_id"]], r["predicted"], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    hits = sum(t and p for t, p, _ in judged)
    recall, precision = hits / sum(t for t, _, _ in judged), hits / max(sum(p for _, p, _ in judged), 1)
    assert recall > 0.85 and precision > 0.85, (recall, precision)
    # calibrated: the mean score is near the share of toxic texts
    assert abs(sum(s for _, _, s in judged) / len(judged) - sum(t for t, _, _ in judged) / len(judged)) < 0.04


def test_labels_of_the_held_out_fold_are_not_read(tables):
    docs, labels = tables
    labels = labels.where("doc_id < 3000")
    docs = docs.where("doc_id < 3000").cache()
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, x) for x in (labels, turned))
    assert (a.strong, a.moderate, a.steps, a.share) == (b.strong, b.moderate, b.steps, b.share)
    assert a.trees.toDebugString.split("\n")[1:] == b.trees.toDebugString.split("\n")[1:]


def test_sample_is_bounded(tables):
    docs, labels = tables
    n = toxicity.labelled(docs, labels, sample=500).count()
    assert 350 < n < 650


def test_features():
    kinds = toxicity.Kinds(frozenset({"lowei*"}), frozenset())
    f = lambda t: dict(zip(toxicity.FEATURES, toxicity.features_of(t, kinds)))
    assert f("")["words"] == 0 and not any(f("").values())
    assert f("You 1d10t, go")["insults"] == f("you idiot go")["insults"] == pytest.approx(1 / 3)
    assert f("You 1d10t, go")["near_you"] == 1 and f("1d10t a b c d e f you")["near_you"] == 0
    assert f("loweixyz ja")["strong"] == 0.5 and f("SHOUTED word")["shouted"] == 0.5
    assert f("wh4t is this")["obfuscated"] == pytest.approx(1 / 3) and f("a!! b??")["mark_runs"] == 1


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, None), (99, 1)], "doc_id long, toxic int")
    clash = edge_docs.withColumnRenamed("shard", "score")
    scorer = toxicity.train(clash, labels)
    rows = scorer.score(clash).collect()
    assert len(rows) == clash.count() and {r["score"] for r in rows} == {scorer.share}
    assert toxicity.train(no_docs, labels.limit(0)).score(no_docs).count() == 0


def test_steps():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.1, 0.15, 0.2, 0.5, 0.9)], "x double")
    got = [r[0] for r in df.select(toxicity._interpolated(F.col("x"), [(0.1, 0.0), (0.2, 0.5), (0.8, 0.9)])).collect()]
    assert got == pytest.approx([0.0, 0.0, 0.25, 0.5, 0.7, 0.9])
