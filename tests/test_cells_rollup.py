import datetime as dt

from pyspark.sql import functions as F

from keyedflow.operators.cells import cell_lookup, cells_put, counter_increment
from keyedflow.operators.rollup import bad_days, calendar_rollup, rollup_retention


def test_cells_put_versions(spark):
    rows = spark.createDataFrame(
        [("r", "x", "y", 5), ("r", "z", None, 0)], "k string, a string, b string, t bigint"
    )
    found = cells_put(rows, "k", {"f": ["a", "b"]}, ts="t", write_time=F.lit(99).cast("bigint"))
    assert found.columns == ["row_key", "cf", "cq", "ts", "value"]
    assert sorted(map(tuple, found.collect())) == [
        ("r", "f", "a", 5, "x"), ("r", "f", "a", 99, "z"), ("r", "f", "b", 5, "y"),
    ]
    assert cells_put(rows, "k", {"f": ["a"]}).first().ts > 1_600_000_000_000


def test_cell_lookup_newest_and_exact(spark):
    cells = spark.createDataFrame(
        [("r", "f", "a", 1, "v1"), ("r", "f", "a", 3, "v3"), ("r", "g", "a", 9, "other")],
        "row_key string, cf string, cq string, ts bigint, value string",
    )
    requests = spark.createDataFrame(
        [(0, "r", 0), (1, "r", 1), (2, "r", 2), (3, "miss", 0)], "pos int, row_key string, at bigint"
    )
    found = cell_lookup(requests, cells, {"f": ["a"]}, ts="at", spread=["pos"])
    assert {r.pos: r.value for r in found.collect()} == {0: "v3", 1: "v1", 2: None, 3: None}
    newest = cell_lookup(requests.drop("at"), cells, {"f": ["a"], "g": ["a"]}, spread=["pos"])
    assert {(r.pos, r.cf): r.value for r in newest.collect() if r.pos < 3} == {
        (p, cf): v for p in range(3) for cf, v in (("f", "v3"), ("g", "other"))
    }


def test_counter_qualifier_is_the_value_or_the_name(spark):
    rows = spark.createDataFrame([("r", "x", "x"), ("r", "x", "y")], "k string, a string, b string")
    found = counter_increment(rows, "k", {"f": ["a", "b", "hits"]}, 5)
    # In the first row both columns name the counter x, which counts once.
    assert {(r.cf, r.cq): r.value for r in found.collect()} == {
        ("f", "x"): 10, ("f", "y"): 5, ("f", "hits"): 10,
    }


def test_calendar_rollup_and_bad_days(spark):
    rows = spark.createDataFrame(
        [("u", "20120816"), ("u", "20120816"), ("u", "20120817"), ("u", "20121399")],
        "id string, day string",
    )
    found = {(r.cf, r.cq): r.n for r in calendar_rollup(rows, "id", "day").collect()}
    assert found == {
        ("daily", "20120816"): 2, ("daily", "20120817"): 1,
        ("monthly", "201208"): 3, ("weekly", "201233"): 3,
    }
    assert [tuple(r) for r in bad_days(rows, "day").collect()] == [("u", "20121399", "bad_date")]


def test_retention_per_rollup(spark):
    as_of = dt.datetime(2024, 6, 1)
    ages = [("daily", 7), ("daily", 8), ("weekly", 31), ("weekly", 32), ("monthly", 365), ("monthly", 366)]
    rows = spark.createDataFrame(
        [(cf, days, as_of - dt.timedelta(days=days)) for cf, days in ages],
        "cf string, days int, last_ts timestamp_ntz",
    )
    kept = {(r.cf, r.days) for r in rollup_retention(rows, as_of).collect()}
    assert kept == {("daily", 7), ("weekly", 31), ("monthly", 365)}
