"""Complete days: each comes out once, late lines are rejected, nothing is lost or counted twice."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keyedflow.operators.counts import match_merge
from keyedflow.operators.lines import MATCH, MATCH_FIELDS
from keyedflow.streaming import days, jobs

ROWS = "seq bigint, day_time timestamp, row_key string, {}, count bigint".format(", ".join(f"{c} string" for c in MATCH_FIELDS[:8]))
COLUMNS = "row_key string, {}, count bigint".format(", ".join(f"{c} string" for c in MATCH_FIELDS[:8]))


def line(seq, day, uid="u", count="1"):
    return seq, f"{uid},db,tab,rec,ext,v{seq},us,pid,{count},{day}"


class Feed:
    """Batches of lines that arrive one after another, the gate and the aggregation behind it."""

    def __init__(self, spark, path, delay="0 seconds"):
        self.spark, self.path, self.delay, self.sent = spark, str(path), delay, 0

    def send(self, *lines):
        df = self.spark.createDataFrame(list(lines), "seq bigint, line string").coalesce(1)
        df.write.parquet(f"{self.path}/in/arrival={self.sent}")
        self.sent += 1
        self.gate()

    def gate(self):
        stream = self.spark.readStream.schema("seq bigint, line string").parquet(f"{self.path}/in/arrival=*")
        query = days.day_gate_job(
            stream, f"{self.path}/landing", f"{self.path}/rejects", f"{self.path}/gate", None, self.delay)
        query.awaitTermination()

    def complete(self):
        landed = days.landed_lines(self.spark, f"{self.path}/landing", ROWS)
        days.day_complete_job(landed, match_merge(), f"{self.path}/days", f"{self.path}/agg", None, self.delay, 3).awaitTermination()
        found = days.complete_days(self.spark, f"{self.path}/days", COLUMNS).collect()
        assert max(Counter((r["day"], r["row_key"]) for r in found).values(), default=1) == 1
        return {(r["day"], r["uid"]): (r["count"], r["ver"]) for r in found}

    def rejected(self):
        stored = self.spark.read.schema("seq bigint, line string, reason string").parquet(f"{self.path}/rejects")
        return {r["seq"]: r["reason"] for r in stored.collect()}


def test_a_day_is_emitted_once_and_late_lines_are_rejected(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.send(line(1, "20240101"), line(0, "20240101", count="4"), line(2, "20240102"), (3, "short"), line(4, "20241301"))
    # The second day says that the first one is over; it is not over itself.
    assert feed.complete() == {("20240101", "u"): (5, "v0")}
    feed.send(line(5, "20240101"), line(6, "20240102", "w"), line(7, "20240102", count="x"))
    assert feed.complete() == {("20240101", "u"): (5, "v0")}
    feed.send(line(8, "20240105"), line(9, "20240102"))  # the newest day before this batch is the second
    want = {("20240101", "u"): (5, "v0"), ("20240102", "u"): (2, "v2"), ("20240102", "w"): (1, "v6")}
    assert feed.complete() == want
    feed.send(line(10, "20240104"), line(11, "20240105"))
    assert feed.complete() == want
    assert feed.rejected() == {3: "arity", 4: "bad_date", 5: "late", 7: "bad_count", 10: "late"}


def test_delay_keeps_days_open(spark, tmp_path):
    feed = Feed(spark, tmp_path, "2 days")
    feed.send(line(0, "20240101"), line(1, "20240103"))
    feed.send(line(2, "20240101"))
    assert feed.complete() == {} and feed.rejected() == {}
    feed.send(line(3, "20240104"))
    assert feed.complete() == {("20240101", "u"): (2, "v0")}
    feed.send(line(4, "20240101"), line(5, "20240102"))
    assert feed.rejected() == {4: "late"}


def test_every_line_is_in_one_place_whatever_the_batches(spark, tmp_path):
    import random

    rng = random.Random(4)
    feed, sent = Feed(spark, tmp_path), {}
    for batch in range(5):
        lines = []
        for _ in range(40):
            seq = len(sent)
            sent[seq] = f"202402{rng.randint(max(1, 5 * batch - 4), 5 * batch + 5):02d}"
            lines.append(line(seq, sent[seq], f"u{seq % 3}"))
        feed.send(*lines)
        done = feed.complete()
    feed.send(line(10_000, "20240401"))
    done = feed.complete()
    late = feed.rejected()
    assert set(late.values()) == {"late"} and 0 < len(late) < 100
    want = Counter((day, f"u{seq % 3}") for seq, day in sent.items() if seq not in late)
    assert {k: n for k, (n, _) in done.items()} == want


def test_a_batch_delivered_again_lands_once(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    write = days.files.publish_folder

    def lost(*args):
        write(*args)
        monkeypatch.setattr(days.files, "publish_folder", write)
        raise RuntimeError("lost")

    monkeypatch.setattr(days.files, "publish_folder", lost)
    with pytest.raises(Exception, match="lost"):
        feed.send(line(0, "20240101"), line(1, "20240102"), (2, "bad"))
    feed.gate()
    feed.send(line(3, "20240103"), line(4, "20240101"))
    assert feed.complete() == {("20240101", "u"): (1, "v0"), ("20240102", "u"): (1, "v1")}
    assert feed.rejected() == {2: "arity", 4: "late"}


def test_the_plan_keeps_state_behind_partial_sums(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.send(line(0, "20240101"), line(1, "20240102"))
    landed = days.landed_lines(spark, f"{tmp_path}/landing", ROWS)
    query = days.day_complete_job(landed, match_merge(), f"{tmp_path}/days", f"{tmp_path}/agg", None)
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p.numInputRows][0]
    assert progress.stateOperators[0].numRowsDroppedByWatermark == 0
    assert query.recentProgress[-1].eventTime["watermark"].startswith("2024-01-02")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_days_are_days_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("20240310",), ("20241103",), ("2024031",), (None,), ("20240230",)], "day string")
        found = df.select(F.unix_seconds(days.day_time(F.col("day"))).alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = dt.date(1970, 1, 1)
    assert [r["s"] for r in found] == [(dt.date(2024, 3, 10) - epoch).days * 86400, (dt.date(2024, 11, 3) - epoch).days * 86400, None, None, None]


def test_jobs_share_the_line_format():
    assert MATCH.fields[-1] == "date" and jobs.MATCH is MATCH
