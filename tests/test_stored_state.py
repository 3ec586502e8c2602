"""Running state from the checkpoint, rollups by folder, bounded insert-if-absent, bitmaps, table functions, limits."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from keyedflow.operators import bitmaps
from keyedflow.operators.counts import match_count, match_merge
from keyedflow.operators.lines import MATCH, PROFILE, keyed_lines
from keyedflow.operators.profile import profile_days
from keyedflow.operators.rollup import calendar_rollup
from keyedflow.operators.table_function import append_each, register_each
from keyedflow.plans import fixtures
from keyedflow.plans.queries import derived
from keyedflow.sources.periods import PeriodTable, period_end
from keyedflow.streaming import dedup, jobs, state
from keyedflow.streaming.limits import RejectLimit
from test_streaming import Source, finish, same

# -- running state --------------------------------------------------------------------------


def test_state_is_that_of_any_batch(spark, tmp_path):
    source = Source(spark, tmp_path / "in", fixtures.match_lines)
    checkpoint = str(tmp_path / "c")
    for files, below in ((2, 301), (2, 1000)):
        source.send(files)
        finish(state.match_state_job(source.stream(), checkpoint, None, state_partitions=3))
        found = state.read_state(spark, checkpoint, match_merge())
        same(found, match_count(keyed_lines(source.lines.where(F.col("seq") < below), MATCH)))
    older = state.read_state(spark, checkpoint, match_merge(), batch_id=1)
    same(older, match_count(keyed_lines(source.lines.where("seq < 301"), MATCH)))


def test_state_of_another_aggregation_is_refused(spark, tmp_path):
    source = Source(spark, tmp_path / "in", fixtures.match_lines)
    source.send(1)
    finish(state.match_state_job(source.stream(), str(tmp_path / "c"), None))
    with pytest.raises(ValueError, match="another aggregation"):
        state.read_state(spark, str(tmp_path / "c"), jobs.request_merge())


# -- rollups by folder ----------------------------------------------------------------------


def rollup(spark, days):
    rows = spark.createDataFrame([("a", d, dt.datetime.strptime(d, "%Y%m%d")) for d in days], "id string, day string, at timestamp_ntz")
    return calendar_rollup(rows, "id", "day", ts="at")


def test_expiry_reads_no_data(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path), "id")
    table.commit(rollup(spark, ["20240101", "20240120", "20240131"]), 0)
    for old in (tmp_path / "cf=daily" / "period=20240101").rglob("*.parquet"):
        old.write_bytes(b"not parquet at all")  # reading it would fail
    with pytest.raises(Exception):
        table.view().collect()
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    dropped = table.expire(dt.datetime(2024, 2, 5))
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert dropped == ["cf=daily/period=20240101", "cf=daily/period=20240120"]
    assert {(r["cf"], r["cq"], r["n"]) for r in table.view().collect()} == {
        ("daily", "20240131", 1), ("monthly", "202401", 3), ("weekly", "20241", 1), ("weekly", "20243", 1), ("weekly", "20245", 1)}


def test_a_batch_again_replaces_itself_alone(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path), "id")
    for batch_id, stream in ((0, "s"), (1, "s"), (0, "s"), (0, "other")):
        table.commit(rollup(spark, ["20240101", "20240102"]), batch_id, stream)
    assert {r["cq"]: r["n"] for r in table.view().where("cf = 'daily'").collect()} == {"20240101": 3, "20240102": 3}
    plan = table.view().where("cf = 'daily'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cf" in plan


def test_a_bucket_goes_when_its_period_is_old_enough(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path), "id", {"daily": 86400, "monthly": 86400})
    table.commit(rollup(spark, ["20240131", "20240201"]), 0)
    assert table.expire(dt.datetime(2024, 2, 2)) == ["cf=weekly/period=20245"]  # a family without a rule is not kept
    assert table.expire(dt.datetime(2024, 2, 2, 0, 0, 1)) == ["cf=daily/period=20240131", "cf=monthly/period=202401"]


def test_period_ends():
    assert period_end("daily", "20240229") == dt.datetime(2024, 3, 1)
    assert period_end("monthly", "202412") == dt.datetime(2025, 1, 1) and period_end("monthly", "20242") == dt.datetime(2024, 3, 1)
    assert period_end("weekly", "20247") == dt.datetime(2024, 2, 19)
    assert period_end("weekly", "20241") == dt.datetime(2025, 1, 1)  # also the last two days of 2024
    assert period_end("weekly", "202501", iso_year=True) == dt.datetime(2025, 1, 6)


# -- insert if absent in the stream ---------------------------------------------------------


def test_days_repeated_over_batches_are_inserted_once(spark, tmp_path):
    source = Source(spark, tmp_path / "in", fixtures.profile_lines)
    source.send(4)
    source.sent = 0
    for files in (1, 3):  # all lines again, with a restart in between
        source.send(files)
        finish(dedup.profile_days_job(
            source.stream(), str(tmp_path / "out"), str(tmp_path / "c"), "60 days", None, state_partitions=3))
    same(spark.read.schema("mid string, day string").parquet(str(tmp_path / "out")), profile_days(keyed_lines(source.lines, PROFILE)))


def test_state_is_bounded_by_the_delay(spark, tmp_path):
    lines = [f"u,pt,s,n,l,5,p,g,{day},{day}" for day in ("2024-01-01", "2024-01-02", "2024-03-01", "2024-03-02")]
    for i, text in enumerate(lines):
        spark.createDataFrame([(i, text)], "seq bigint, line string").write.parquet(f"{tmp_path}/in/n={i}")
        stream = spark.readStream.schema("seq bigint, line string").parquet(f"{tmp_path}/in/n=*")
        query = finish(dedup.profile_days_job(stream, str(tmp_path / "out"), str(tmp_path / "c"), "3 days", None))
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal == 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


# -- bitmaps --------------------------------------------------------------------------------


def test_bitmaps_hold_every_day_of_a_year(spark):
    first = dt.date(2023, 12, 30)
    days = [(("a", "b")[i % 2], (first + dt.timedelta(i)).isoformat()) for i in range(370)]
    rows = spark.createDataFrame(days * 2 + [("a", "2024-02-30"), ("a", None), ("c", "x")], "k string, day string").repartition(3)
    found = bitmaps.day_bitmaps(rows, ["k"], "day")
    assert found.groupBy("k").count().count() == 2 and found.count() <= 6
    assert sorted(map(tuple, bitmaps.unpack_days(found, ["k"]).collect())) == sorted(days)
    assert {r["k"]: r["days"] for r in bitmaps.count_days(found, ["k"]).collect()} == {"a": 185, "b": 185}
    assert sorted(map(str, bitmaps.other_days(rows, ["k"], "day").collect())) == sorted(
        ["Row(k='a', day='2024-02-30')", "Row(k='a', day=None)", "Row(k='c', day='x')"])


def test_bitmaps_are_hashed_partial_aggregates(spark):
    rows = spark.createDataFrame([("a", "2024-01-01")], "k string, day string")
    text = bitmaps.day_bitmaps(rows, ["k"], "day")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in text and "SortAggregate" not in text and "ObjectHash" not in text


# -- table functions ------------------------------------------------------------------------


@pytest.fixture
def pieces():
    def cut(text, sep=","):  # not of this module, which workers do not have
        for i, part in enumerate(text.split(sep) if text else []):
            yield i, part

    return cut


def test_output_is_appended_to_the_fields(spark, pieces):
    rows = spark.createDataFrame([(1, "a,b", True), (2, "", False), (3, None, True)], "id int, text string, flag boolean")
    got = append_each(rows, pieces, ["text"], "n int, part string")
    assert got.columns == ["id", "text", "flag", "n", "part"]
    assert sorted(map(tuple, got.collect())) == [(1, "a,b", True, 0, "a"), (1, "a,b", True, 1, "b")]
    kept = append_each(rows, pieces, ["text"], "n int, part string", keep_empty=True)
    assert sorted((r["id"], r["part"]) for r in kept.where("part is null").collect()) == [(2, None), (3, None)]


def test_rows_reach_a_table_function_many_at_a_time(spark):
    def letters(x):
        yield (f"u{x}",)

    got = append_each(spark.range(10), letters, ["id"], "word string")
    assert "ArrowEvalPythonUDTF" not in got._jdf.queryExecution().toString()  # which makes a batch for each row
    assert sorted(r["word"] for r in got.collect()) == sorted(f"u{x}" for x in range(10))


def test_numbers_fit_their_columns(spark):
    def numbers(x):
        yield (x, x + 0.5, [x], {"a": x}, x, None)

    got = append_each(spark.range(1, 2), numbers, ["id"], "d double, i int, l array<double>, s struct<a: double>, t string, b boolean")
    assert tuple(got.first()) == (1, 1.0, 1, [1.0], (1.0,), "1", None)
    for value, kind in ((2**40, "int"), ("5", "double"), (True, "int"), (1, "boolean"), (1, "binary")):
        with pytest.raises(Exception, match="is no"):
            append_each(spark.range(1), lambda _, v=value: [(v,)], ["id"], f"c {kind}").collect()


def test_callable_from_sql(spark, pieces):
    register_each(spark, "cut_pieces", pieces, "n int, part string")
    spark.createDataFrame([(1, "a;b"), (2, "c")], "id int, text string").createOrReplaceTempView("texts")
    got = spark.sql("select t.id, p.part from texts t, lateral cut_pieces(t.text, ';') p").collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (1, "b"), (2, "c")]


def test_set_up_once_a_task_and_cleaned_up(spark, tmp_path):
    log = tmp_path / "log"

    def opened():
        with open(log, "a") as out:
            out.write("open\n")
        return "r"

    def closed(resource):
        with open(log, "a") as out:
            out.write(f"close {resource}\n")

    def tag(x, resource):
        yield (f"{x}{resource}",)

    rows = spark.range(40).repartition(2)
    got = append_each(rows, tag, ["id"], "tagged string", setup=opened, cleanup=closed)
    assert sorted(r["tagged"] for r in got.collect())[:2] == ["0r", "10r"]
    lines = log.read_text().split("\n")
    assert 1 <= lines.count("open") == lines.count("close r") <= 4


def test_a_batch_of_the_day_stream_is_a_copy_of_the_lines(spark, tmp_path, monkeypatch):
    """The number of batches does not grow with the number of files."""
    from keyedflow.plans import event_queries

    events = spark.range(400).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 20 as int)) as ts", "id % 7 as user_id",
        "'view' as event_type", "1.0d as value", "'{}' as props",
    )
    events.repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    queries = []

    def run(job, *args, **kwargs):
        queries.append(job(*args, every=None, **kwargs))
        queries[-1].awaitTermination()

    monkeypatch.setattr(event_queries, "_run", run)
    monkeypatch.setattr(event_queries, "derived", lambda spark, sf_dir, fixture: derived(spark, sf_dir, fixture).repartition(6))
    got = event_queries.profile_days_dedup_stream(spark, str(tmp_path))
    days = derived(spark, str(tmp_path), fixtures.profile_lines)
    same(got, profile_days(keyed_lines(days, PROFILE)))
    read = [p["numInputRows"] for p in queries[0].recentProgress if p["numInputRows"]]
    assert read == [400, 400]


# -- a limit on rejects ---------------------------------------------------------------------


@pytest.fixture
def limit(spark):
    listener = RejectLimit(spark, share=0.2, lines=50)
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def feed(spark, path, batches):
    for i, (good, bad) in enumerate(batches):
        rows = [(j, f"u{j},db,t,r,e,v,n,p,1,20240101") for j in range(good)] + [(j, "bad") for j in range(bad)]
        spark.createDataFrame(rows, "seq bigint, line string").coalesce(1).write.mode("append").parquet(str(path))
    options = {"maxFilesPerTrigger": "1"}
    return spark.readStream.schema("seq bigint, line string").options(**options).parquet(str(path))


def run(spark, tmp_path, batches, limit):
    table = jobs.match_sum_table(spark, str(tmp_path / "t"))
    stream = feed(spark, tmp_path / "in", batches)
    query = jobs.match_sum_job(stream, table, str(tmp_path / "c"), "100 milliseconds", rejects=str(tmp_path / "r"))
    deadline = time.time() + 60
    while query.isActive and time.time() < deadline:
        time.sleep(0.2)
        done = sum(p.numInputRows for p in query.recentProgress)
        if done == sum(map(sum, batches)) and str(query.id) not in limit.stopped:
            time.sleep(2)  # the listener has had its time
            if str(query.id) not in limit.stopped:
                break
    active = query.isActive
    query.stop()
    return query, active, table


def test_a_bad_feed_stops_its_job_with_its_rejects_stored(spark, tmp_path, limit):
    query, active, _ = run(spark, tmp_path, [(60, 0), (30, 30), (60, 0), (60, 0)], limit)
    assert not active and "50.0%" in limit.stopped[str(query.id)]
    with pytest.raises(RuntimeError, match="rejected"):
        limit.check(query)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 30


def test_a_good_feed_runs_on(spark, tmp_path, limit):
    query, active, table = run(spark, tmp_path, [(60, 5), (55, 10), (60, 0)], limit)
    assert active and not limit.stopped
    limit.check(query)
    assert table.view().agg(F.sum("count")).first()[0] == 175


def test_few_lines_are_no_verdict(spark, tmp_path, limit):
    query, active, _ = run(spark, tmp_path, [(5, 30)], limit)
    assert active and not limit.stopped
