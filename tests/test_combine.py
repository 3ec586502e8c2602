"""User-made combiners against plain Python, and what they shuffle."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from keyedflow.operators.combine import Combiner, UserMerge, combined, count_combiner
from keyedflow.plans.event_queries import SPAN
from keyedflow.sources.keyed_table import KeyedTable

LONGEST = Combiner(init=lambda s: s or "", combine=lambda a, b: max(a, b, key=lambda s: (len(s), s)), partial="string", zero="")
MEAN = Combiner(
    init=lambda x: [0, 0.0] if x is None else [1, x], combine=lambda a, b: [a[0] + b[0], a[1] + b[1]], partial="array<double>",
    finish=lambda p: p[1] / p[0] if p[0] else None, result="double", zero=[0, 0.0],
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot"] * 10 + [f"k{i}" for i in range(20)] + [None]), rng.choice([1.5, 2.0, None, -3.0]), f"t{rng.randint(0, 999)}") for _ in range(3000)]
    return data, spark.createDataFrame(data, "k string, x double, s string").repartition(6).cache()


def grouped(data, at):
    out = defaultdict(list)
    for row in data:
        out[row[0]].append(row[at])
    return out


def test_against_python(rows):
    data, df = rows
    got = {r["k"]: r["longest"] for r in combined(df, ["k"], ["s"], LONGEST, "longest").collect()}
    assert got == {k: max(v, key=lambda s: (len(s), s)) for k, v in grouped(data, 2).items()}
    got = {r["k"]: r["mean"] for r in combined(df, ["k"], ["x"], MEAN, "mean").collect()}
    known = {k: [x for x in v if x is not None] for k, v in grouped(data, 1).items()}
    assert got == pytest.approx({k: sum(v) / len(v) for k, v in known.items()})
    got = {r["k"]: r["n"] for r in combined(df, ["k"], [], count_combiner(), "n").collect()}
    assert got == {k: len(v) for k, v in grouped(data, 1).items()}


def test_a_hot_key_sends_one_partial_for_each_task(rows):
    data, df = rows
    assert sum(r[0] == "hot" for r in data) > len(data) / 4
    partials = UserMerge(("k",), ("s",), LONGEST, "longest").within_tasks(df)
    assert partials.where("k = 'hot'").count() == df.rdd.getNumPartitions() == 6


def test_busy_keys_stay_when_a_task_holds_too_many(spark):
    rows = spark.range(0, 60_000, 1, 1).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    merge = UserMerge(("k",), (), count_combiner(), "n", held=1000)
    partials = merge.within_tasks(rows)
    assert partials.where("k = 'hot'").count() == 1
    found = merge.aggregate(rows).where("k = 'hot'").collect()
    assert [r["n"] for r in found] == [20_000] and merge.aggregate(rows).count() == 40_001


def test_one_shuffle_and_no_collected_group(rows):
    plan = combined(rows[1], ["k"], ["s"], LONGEST, "longest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "FlatMapGroups" not in plan and plan.count("MapInArrow") == 2


def test_grand_totals_and_nothing(spark, rows):
    data, df = rows
    assert combined(df, [], [], count_combiner(), "n").collect() == [(len(data),)]
    none = df.where("false")
    assert combined(none, [], [], count_combiner(), "n").collect() == [(0,)]
    assert combined(none, ["k"], [], count_combiner(), "n").collect() == []
    assert combined(none, [], ["x"], MEAN, "mean").collect() == [(None,)]


def test_keys_of_every_kind_group_as_in_spark(spark):
    nan = float("nan")
    data = [(1.0, "2024-01-01", 1), (nan, None, 1), (0.0, None, 2), (-0.0, None, 3), (nan, None, 4), (None, "2024-01-01", 5), (1.0, "2024-01-01", 6)]
    df = spark.createDataFrame(data, "f double, d string, v int").select("f", F.to_date("d").alias("d"), F.to_timestamp("d").alias("t"), "v").repartition(4)
    merge = UserMerge(("f", "d", "t"), ("v",), Combiner(lambda v: v, lambda a, b: a + b, "bigint"), "total")
    got = sorted(map(str, merge.aggregate(df).collect()))
    assert got == sorted(map(str, df.groupBy("f", "d", "t").agg(F.sum("v").alias("total")).collect()))


def test_partials_are_stored_and_replayed(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), UserMerge(("k",), ("seq",), SPAN, "span"), "k string, seq bigint")
    batches = [spark.createDataFrame([("a", i), ("b", i * 2)] * 3, "k string, seq bigint") for i in range(4)]
    for n in (0, 1, 2, 1, 3):
        table.commit(batches[n], n)
    want = {"a": "0-3/12", "b": "0-6/12"}
    assert {r["k"]: r["span"] for r in table.view().collect()} == want
    table.compact(keep=1)
    assert {r["k"]: r["span"] for r in table.view().collect()} == want
