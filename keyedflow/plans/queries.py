"""The query catalogue: each entry takes (spark, folder of the tables) and returns a DataFrame."""

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import decode_state, encode_state, format_percent, salted_surrogate
from ..functions.dates import local_time
from ..operators import cells, counts, lines, lookup, profile, rollup
from ..operators.each import each
from ..operators.lines import (
    MATCH, MATCH_FIELDS, MATCH_SUM, PROFILE, keyed_lines, line_keys, parse_fields, quarantine,
)
from ..operators.merge import Merge
from ..sources import lines as line_sources
from ..sources import files
from ..sources.files import shared_dir
from ..sources.keyed_table import KeyedTable
from ..streaming import jobs
from . import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, fixture) -> DataFrame:
    return spark.sql(
        fixture(fixtures.SPARK).replace("from events", "from {events}"),
        events=load(spark, sf_dir, "events"),
    )


# -- lines ----------------------------------------------------------------------------------


@query("parse_fields")
def parse_match_fields(spark, sf_dir):
    return parse_fields(derived(spark, sf_dir, fixtures.match_lines), MATCH_FIELDS)


@query("quarantine")
def quarantine_match(spark, sf_dir):
    return quarantine(derived(spark, sf_dir, fixtures.match_lines).select("seq", "line"), MATCH)


@query("row_key")
def row_key(spark, sf_dir):
    profiles = line_keys(derived(spark, sf_dir, fixtures.profile_lines), PROFILE)
    matches = line_keys(derived(spark, sf_dir, fixtures.match_lines), MATCH)
    return profiles.select(F.lit("profile").alias("kind"), "seq", F.col("mid").alias("key")).union(
        matches.select(F.lit("match"), "seq", "row_key")
    )


@query("etl_rows")
def etl_rows(spark, sf_dir):
    """The ten-column row: key, then every field but the first, with the count as a number."""
    rows = keyed_lines(derived(spark, sf_dir, fixtures.match_lines), MATCH_SUM)
    return rows.select("seq", "row_key", *MATCH_FIELDS[1:])


@query("rekey_lines")
def rekey_lines(spark, sf_dir):
    raw = derived(spark, sf_dir, fixtures.raw_profile_lines)
    uid = F.split_part("line", F.lit(","), F.lit(2))
    return lines.rekey_lines(raw, salted_surrogate(uid, "s1"))


@query("format_percent")
def percent_format(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem")
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        format_percent(F.col("l_discount"), 1).alias("discount_pct"),
        format_percent(-F.col("l_tax"), 2).alias("tax_pct"),
        format_percent(F.col("l_quantity"), 0).alias("quantity_pct"),
    )


# -- counts and sums ------------------------------------------------------------------------


@query("match_count")
def match_count(spark, sf_dir):
    return counts.match_count(keyed_lines(derived(spark, sf_dir, fixtures.match_lines), MATCH))


@query("match_sum_state")
def match_sum_state(spark, sf_dir):
    return counts.match_count(keyed_lines(derived(spark, sf_dir, fixtures.match_lines), MATCH_SUM))


@query("request_count")
def request_count(spark, sf_dir):
    requests = derived(spark, sf_dir, fixtures.request_lines)
    return counts.count_rows(requests, F.col("line").alias("word"))


@query("key_count")
def key_count(spark, sf_dir):
    keys = line_keys(derived(spark, sf_dir, fixtures.match_lines), MATCH)
    return counts.count_rows(keys, "row_key")


@query("global_count")
def global_count(spark, sf_dir):
    return counts.global_count(load(spark, sf_dir, "events"))


@query("word_count")
def word_count(spark, sf_dir):
    return counts.word_count(derived(spark, sf_dir, fixtures.tab_lines))


@query("document_word_count")
def document_word_count(spark, sf_dir):
    """Whole texts, split at spaces."""
    return counts.word_count(load(spark, sf_dir, "documents"), "text", " ")


@query("each_word_count")
def each_word_count(spark, sf_dir):
    def split(batch: pd.DataFrame) -> pd.DataFrame:
        return batch["line"].str.rstrip("\t").str.split("\t").explode().to_frame("word")

    tabs = derived(spark, sf_dir, fixtures.tab_lines).select("line")
    return counts.count_rows(each(tabs, split, "word string"), "word")


@query("partition_word_count")
def partition_word_count(spark, sf_dir):
    """Counts inside each partition, added up: partition ids themselves are physical."""
    parts = counts.partition_word_count(derived(spark, sf_dir, fixtures.tab_lines), 8)
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


# -- profiles -------------------------------------------------------------------------------


def _profile_rows(spark, sf_dir):
    return keyed_lines(derived(spark, sf_dir, fixtures.profile_lines), PROFILE)


@query("profile_upsert_keep")
def profile_upsert_keep(spark, sf_dir):
    return profile.profile_upsert(_profile_rows(spark, sf_dir))


@query("profile_upsert_refresh")
def profile_upsert_refresh(spark, sf_dir):
    return profile.profile_upsert(_profile_rows(spark, sf_dir), profile.REFRESH_IDENTITY)


@query("profile_days")
def profile_days(spark, sf_dir):
    return profile.profile_days(_profile_rows(spark, sf_dir))


# -- lookups and changes by key -------------------------------------------------------------


@query("range_scan")
def range_scan(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    lower, upper = (local_time(dt.datetime(y, 1, 1)) for y in (1996, 1998))
    return lookup.range_scan(
        orders, "o_orderdate", lower, upper, ["o_orderkey", "o_orderpriority"]
    )


@query("insert_if_absent")
def insert_if_absent(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + 500).alias("c_custkey"),
        F.concat(F.lit("Order#"), "o_orderkey").alias("c_name"),
        F.col("o_orderkey").alias("seq"),
    )
    table = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return lookup.insert_if_absent(table, rows, ["c_custkey"])


def _updates(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        F.expr("case when o_orderstatus = 'F' then o_totalprice end").alias("c_acctbal"),
    )


@query("update_by_key")
def update_by_key(spark, sf_dir):
    customers = load(spark, sf_dir, "customer")
    return lookup.update_by_key(customers, _updates(spark, sf_dir), ["c_custkey"])


@query("update_stored")
def update_stored(spark, sf_dir):
    """The same updates, stored in batches: a null leaves the column as it is. Rows that were put
    are present; updates of other keys wait for such a row and do not show."""
    customers = load(spark, sf_dir, "customer")
    columns = [c for c in customers.columns if c != "c_custkey"]
    merge = Merge(["c_custkey"], sums=["present"], patches=columns)
    rows = customers.withColumns({
        "seq": F.lit(-1).cast("bigint"), "present": F.lit(1).cast("bigint")
    })
    table = KeyedTable(spark, shared_dir(spark, "customers"), merge, rows.schema, compact_every=3)
    table.commit(rows, 0, unique_keys=True)
    updates = _updates(spark, sf_dir).withColumn("present", F.lit(0).cast("bigint"))
    missing = {c: F.lit(None).cast(rows.schema[c].dataType) for c in columns if c not in updates.columns}
    updates = updates.withColumns(missing).select(*rows.columns)
    for batch in (3, 1, 2):  # in any order: the order column decides
        table.commit(updates.where(F.col("seq") % 3 == batch - 1), batch)
    return table.view().where("present > 0").drop("present")


@query("delete_by_key")
def delete_by_key(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    gone = orders.select(F.col("o_custkey").alias("c_custkey"))
    return lookup.delete_by_key(load(spark, sf_dir, "customer"), gone, ["c_custkey"])


@query("state_lookup")
def state_lookup(spark, sf_dir):
    requests = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"),
        F.concat("event_type", F.lit("/"), F.col("user_id") % 12).alias("word"),
    )
    return lookup.lookup(requests, request_count(spark, sf_dir), ["word"], spread=["pos"])


# -- keyed tables: commit modes, compaction, deletes, namespaces ------------------------------


def _request_batches(spark, sf_dir) -> list[DataFrame]:
    """The request lines in three batches by time; the bounds reach the parquet scan."""
    requests = derived(spark, sf_dir, fixtures.request_lines)
    ts = F.col("ts")
    first, second = (F.lit(b).cast("timestamp_ntz") for b in fixtures.BATCH_BOUNDS)
    return [
        requests.where(ts < first),
        requests.where((ts >= first) & (ts < second)),
        requests.where(ts >= second),
    ]


def _request_table(spark, mode="transactional"):
    return jobs.count_table(spark, shared_dir(spark, "request_count"), mode=mode)


def _commit(table: KeyedTable, batch_id: int, batch: DataFrame) -> None:
    table.commit(jobs.one_each(batch, "line"), batch_id)


def _replay(spark, sf_dir, mode, change=lambda batch: batch) -> DataFrame:
    """Commit three batches, then deliver the middle one again, with `change` made to its lines."""
    table = _request_table(spark, mode)
    batches = _request_batches(spark, sf_dir)
    for batch_id, batch in enumerate(batches):
        _commit(table, batch_id, batch)
    _commit(table, 1, change(batches[1]))
    return table.view()


@query("table_lookup")
def table_lookup(spark, sf_dir):
    """Look every request up in a table that holds a base and newer batches."""
    table = _request_table(spark)
    for batch_id, batch in enumerate(_request_batches(spark, sf_dir)):
        _commit(table, batch_id, batch)
    table.compact(keep=1)
    requests = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"),
        F.concat("event_type", F.lit("/"), F.col("user_id") % 12).alias("word"),
    )
    return table.lookup(requests, spread=["pos"])


@query("replay_transactional")
def replay_transactional(spark, sf_dir):
    return _replay(spark, sf_dir, "transactional")


@query("replay_opaque")
def replay_opaque(spark, sf_dir):
    def change(batch):
        return batch.withColumn("line", F.concat(F.lit("again/"), "line"))

    return _replay(spark, sf_dir, "opaque", change)


@query("replay_non_transactional")
def replay_non_transactional(spark, sf_dir):
    return _replay(spark, sf_dir, "non_transactional")


@query("compacted_table")
def compacted_table(spark, sf_dir):
    """Fold all but the last batch; what is replayed after that still counts once."""
    table = _request_table(spark)
    batches = _request_batches(spark, sf_dir)
    for batch_id, batch in enumerate(batches):
        _commit(table, batch_id, batch)
    table.compact(keep=1)
    table.vacuum()
    for batch_id, batch in enumerate(batches):
        _commit(table, batch_id, batch)
    return table.view()


@query("deleted_keys")
def deleted_keys(spark, sf_dir):
    """Delete the keys of one event type after the first batch; later batches count afresh."""
    table = _request_table(spark)
    batches = _request_batches(spark, sf_dir)
    _commit(table, 0, batches[0])
    table.delete(batches[0].where("line like 'click/%'").withColumnRenamed("line", "word"), 0)
    _commit(table, 1, batches[1])
    _commit(table, 2, batches[2])
    return table.view()


@query("snapshot_new_checkpoint")
def snapshot_new_checkpoint(spark, sf_dir):
    """Snapshots by a stream of a new checkpoint win, though its batch ids start again at 0."""
    table = jobs.match_snapshot_table(spark, shared_dir(spark, "snapshots"))
    rows = match_count(spark, sf_dir)
    for batch_id in (0, 5):
        older = rows.withColumn("count", F.col("count") - 1)
        table.commit(older, batch_id, unique_keys=True, stream="first checkpoint")
    table.commit(rows, 0, unique_keys=True, stream="second checkpoint")
    return table.view()


@query("delete_then_first_batch")
def delete_then_first_batch(spark, sf_dir):
    """A delete before the first batch of a table, and of a checkpoint, covers none of it."""
    table = _request_table(spark)
    batches = _request_batches(spark, sf_dir)
    gone = batches[0].where("line like 'click/%'").withColumnRenamed("line", "word")
    table.delete(gone)
    table.commit(jobs.one_each(batches[0], "line"), 0, stream="first checkpoint")
    table.delete(gone)
    for batch_id in (1, 2):
        table.commit(
            jobs.one_each(batches[batch_id], "line"), batch_id - 1, stream="second checkpoint"
        )
    return table.view()


@query("late_batch_after_fold")
def late_batch_after_fold(spark, sf_dir):
    """A batch that was not folded with the later ones counts when it comes, and once."""
    table = _request_table(spark)
    batches = _request_batches(spark, sf_dir)
    for batch_id in (0, 2):
        _commit(table, batch_id, batches[batch_id])
    table.compact(keep=0)
    for batch_id in (1, 0, 1, 2):
        _commit(table, batch_id, batches[batch_id])
    table.compact(keep=0)
    _commit(table, 1, batches[1])
    table.vacuum()
    return table.view()


def _namespaced_table(spark, sf_dir) -> KeyedTable:
    table = jobs.namespaced_table(spark, shared_dir(spark, "kv"))
    parts = F.split("line", "/")
    one = F.lit(1).cast("bigint").alias("n")
    for batch_id, batch in enumerate(_request_batches(spark, sf_dir)):
        table.commit(batch.select(parts[0].alias("namespace"), parts[1].alias("key"), one), batch_id)
    return table


@query("kv_namespaced")
def kv_namespaced(spark, sf_dir):
    """One hash per namespace, each value in the JSON form an external store holds."""
    state = _namespaced_table(spark, sf_dir).view()
    return state.select("namespace", "key", encode_state(F.col("n"), F.col("batch_id")).alias("state"))


@query("namespaced_lookup")
def namespaced_lookup(spark, sf_dir):
    """Look keys up in one namespace; only its folder is read."""
    state = _namespaced_table(spark, sf_dir).view().where("namespace = 'click'").select(
        "key", encode_state(F.col("n"), F.col("batch_id")).alias("state")
    )
    requests = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pos"), (F.col("c_custkey") % 13).cast("string").alias("key")
    )
    found = lookup.lookup(requests, state, ["key"], spread=["pos"])
    return found.select("pos", "key", decode_state(F.col("state")).getField("value").alias("n"))


@query("rekey_files")
def rekey_files(spark, sf_dir):
    """Lines read from text files, re-keyed, and written to text files again."""
    source, target = shared_dir(spark, "raw"), shared_dir(spark, "rekeyed")
    raw = derived(spark, sf_dir, fixtures.raw_profile_lines)
    raw.select("line").write.text(source)
    uid = F.split_part("line", F.lit(","), F.lit(2))
    read = line_sources.text_lines(spark, source)
    lines.rekey_lines(read, salted_surrogate(uid, "s1")).write.text(target)
    return line_sources.text_lines(spark, target)


# -- cells and rollups ----------------------------------------------------------------------

_INFO = {"info": ["event_type", "props"], "who": ["uid"]}


def _cells(spark, sf_dir) -> DataFrame:
    rows = load(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), F.col("user_id")).alias("row"),
        "event_type", "props", F.concat(F.lit("u"), F.col("user_id")).alias("uid"),
        F.expr("case when event_id % 10 = 0 then 0 else event_id end").alias("version"),
        "event_id",
    )
    return cells.cells_put(rows, "row", _INFO, ts="version", write_time=-F.col("event_id") - 1)


_WANTED = {"info": ["event_type", "none"], "who": ["uid"]}


def _cell_requests(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"),
        F.concat(F.lit("r"), F.col("user_id")).alias("row_key"),
        F.expr("case when event_id % 2 = 0 then 0 else event_id end").alias("asked"),
    )


@query("cells_put")
def cells_put(spark, sf_dir):
    return _cells(spark, sf_dir)


@query("cell_lookup")
def cell_lookup(spark, sf_dir):
    """Newest versions where the asked time is 0, the version of that time otherwise."""
    requests = _cell_requests(spark, sf_dir)
    return cells.cell_lookup(requests, _cells(spark, sf_dir), _WANTED, "asked", spread=["pos"])


@query("counter_increment")
def counter_increment(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), F.col("user_id")).alias("row"), "event_type"
    )
    return cells.counter_increment(rows, "row", {"daily": ["event_type", "hits"], "all": ["hits"]}, 2)


@query("calendar_rollup")
def calendar_rollup(spark, sf_dir):
    return rollup.calendar_rollup(derived(spark, sf_dir, fixtures.url_events), "shortid", "day")


@query("calendar_rollup_iso")
def calendar_rollup_iso(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select(
        "o_orderstatus", F.date_format("o_orderdate", "yyyyMMdd").alias("day")
    )
    return rollup.calendar_rollup(orders, "o_orderstatus", "day", iso_year=True)


@query("rollup_bad_days")
def rollup_bad_days(spark, sf_dir):
    events = derived(spark, sf_dir, fixtures.url_events)
    return rollup.bad_days(events.select("seq", "shortid", "day"), "day")


@query("rollup_retention")
def rollup_retention(spark, sf_dir):
    events = derived(spark, sf_dir, fixtures.url_events)
    rolled = rollup.calendar_rollup(events, "shortid", "day", ts="ts")
    return rollup.rollup_retention(rolled, dt.datetime(2024, 2, 10))


# -- streams --------------------------------------------------------------------------------


def _archived(spark, sf_dir, fixture, columns=("seq", "line"), fmt="parquet") -> str:
    """The lines written as an archive of daily folders, which the streams read."""
    path = shared_dir(spark, "lines")
    dated = derived(spark, sf_dir, fixture).select(
        *columns, F.date_format("ts", "yyyyMMdd").alias("dt")
    )
    dated.write.partitionBy("dt").format(fmt).save(path)
    return path


def _a_third(spark, path: str) -> int:
    """Files per batch that make about three batches."""
    return max(1, -(-len(files.glob(spark, f"{path}/dt=*/part-*")) // 3))


def _line_stream(spark, sf_dir, fixture) -> DataFrame:
    path = _archived(spark, sf_dir, fixture)
    return line_sources.parquet_line_stream(
        spark, path, "seq bigint, line string", _a_third(spark, path)
    )


def _run(job, *args, **kwargs) -> None:
    """Run a job over what there is and wait for its end."""
    job(*args, every=None, **kwargs).awaitTermination()


@query("match_count_stream")
def match_count_stream(spark, sf_dir):
    stream = _line_stream(spark, sf_dir, fixtures.match_lines)
    table = jobs.match_snapshot_table(spark, shared_dir(spark, "match"))
    _run(jobs.match_count_job, stream, table, shared_dir(spark, "checkpoint"))
    return table.view()


@query("match_sum_stream")
def match_sum_stream(spark, sf_dir):
    stream = _line_stream(spark, sf_dir, fixtures.match_lines)
    table = jobs.match_sum_table(spark, shared_dir(spark, "match_sum"))
    _run(jobs.match_sum_job, stream, table, shared_dir(spark, "checkpoint"))
    return table.view()


@query("key_count_stream")
def key_count_stream(spark, sf_dir):
    stream = _line_stream(spark, sf_dir, fixtures.match_lines)
    table = _request_table(spark)
    _run(jobs.key_count_job, stream, table, shared_dir(spark, "checkpoint"))
    return table.view().withColumnRenamed("word", "row_key")


@query("request_count_stream")
def request_count_stream(spark, sf_dir):
    stream = _line_stream(spark, sf_dir, fixtures.request_lines)
    table = _request_table(spark)
    _run(jobs.request_count_job, stream, table, shared_dir(spark, "checkpoint"))
    return table.view()


def _profile_stream(
    spark, sf_dir, firsts=profile.KEEP_IDENTITY
) -> tuple[KeyedTable, KeyedTable]:
    stream = _line_stream(spark, sf_dir, fixtures.profile_lines)
    attrs, days = jobs.profile_tables(spark, shared_dir(spark, "profile"), firsts)
    _run(jobs.profile_job, stream, attrs, days, shared_dir(spark, "checkpoint"))
    return attrs, days


@query("global_count_stream")
def global_count_stream(spark, sf_dir):
    """All lines, stored under the reserved key."""
    stream = _line_stream(spark, sf_dir, fixtures.request_lines)
    table = _request_table(spark)
    _run(jobs.global_count_job, stream, table, shared_dir(spark, "checkpoint"))
    return table.view().withColumnRenamed("word", "key")


@query("namespaced_stream")
def namespaced_stream(spark, sf_dir):
    stream = _line_stream(spark, sf_dir, fixtures.request_lines)
    table = jobs.namespaced_table(spark, shared_dir(spark, "kv"))
    parts = F.split("line", "/")
    checkpoint = shared_dir(spark, "checkpoint")
    _run(jobs.namespaced_count_job, stream, table, parts[0], parts[1], checkpoint)
    return table.view().select("namespace", "key", "n")


def _rejects_of(spark, sf_dir, fixture, job, *tables) -> DataFrame:
    path = shared_dir(spark, "rejects")
    stream = _line_stream(spark, sf_dir, fixture)
    _run(job, stream, *tables, shared_dir(spark, "checkpoint"), rejects=path)
    stored = spark.read.schema("seq bigint, line string, reason string, stream string, batch_id long")
    return stored.parquet(path).select("seq", "line", "reason")


@query("match_sum_rejects")
def match_sum_rejects(spark, sf_dir):
    """What the running job rejects, stored beside its table."""
    table = jobs.match_sum_table(spark, shared_dir(spark, "match_sum"))
    return _rejects_of(spark, sf_dir, fixtures.match_lines, jobs.match_sum_job, table)


@query("key_count_rejects")
def key_count_rejects(spark, sf_dir):
    table = _request_table(spark)
    return _rejects_of(spark, sf_dir, fixtures.match_lines, jobs.key_count_job, table)


@query("profile_rejects")
def profile_rejects(spark, sf_dir):
    tables = jobs.profile_tables(spark, shared_dir(spark, "profile"))
    return _rejects_of(spark, sf_dir, fixtures.profile_lines, jobs.profile_job, *tables)


@query("profile_stream")
def profile_stream(spark, sf_dir):
    return _profile_stream(spark, sf_dir)[0].view().select("mid", *PROFILE.fields)


@query("profile_refresh_stream")
def profile_refresh_stream(spark, sf_dir):
    attrs, _ = _profile_stream(spark, sf_dir, profile.REFRESH_IDENTITY)
    return attrs.view().select("mid", *PROFILE.fields)


@query("profile_days_stream")
def profile_days_stream(spark, sf_dir):
    return _profile_stream(spark, sf_dir)[1].view()


@query("quarantine_stream")
def quarantine_stream(spark, sf_dir):
    stream = _line_stream(spark, sf_dir, fixtures.match_lines)
    path = shared_dir(spark, "rejected")
    _run(jobs.quarantine_job, stream, MATCH, path, shared_dir(spark, "checkpoint"))
    return spark.read.schema("seq bigint, line string, reason string").parquet(path)


@query("word_count_stream")
def word_count_stream(spark, sf_dir):
    """Text files in nested folders, moved to another folder once they are counted."""
    path = _archived(spark, sf_dir, fixtures.tab_lines, ["line"], "text")
    stream = line_sources.text_line_stream(
        spark, path, archive_dir=shared_dir(spark, "done"), max_files=_a_third(spark, path)
    )
    table = _request_table(spark)
    _run(jobs.word_count_job, stream, table, shared_dir(spark, "checkpoint"))
    return table.view()


@query("archive_daily")
def archive_daily(spark, sf_dir):
    """The raw lines as text below their processing date, here a given one."""
    stream = _line_stream(spark, sf_dir, fixtures.request_lines)
    path = shared_dir(spark, "archive")
    _run(
        jobs.archive_job, stream, path, shared_dir(spark, "checkpoint"), day=F.lit("2024-02-01")
    )
    return spark.read.schema("value string, dt string").text(path).groupBy("value", "dt").agg(
        F.count(F.lit(1)).alias("n")
    )


def _url_stream(spark, sf_dir) -> DataFrame:
    path = _archived(spark, sf_dir, fixtures.url_events, ["seq", "ts", "shortid", "day"])
    schema = "seq bigint, ts timestamp_ntz, shortid string, day string"
    return line_sources.parquet_line_stream(spark, path, schema, _a_third(spark, path))


@query("rollup_stream")
def rollup_stream(spark, sf_dir):
    """Stored rollups, expired when they are folded."""
    table = jobs.rollup_table(spark, shared_dir(spark, "rollup"), "shortid")
    checkpoint = shared_dir(spark, "checkpoint")
    _run(jobs.rollup_job, _url_stream(spark, sf_dir), table, "shortid", "day", "ts", checkpoint)
    last_ts = F.col("_last.last_ts")
    table.compact(keep=0, where=rollup.retained(dt.datetime(2024, 2, 10), last_ts))
    return table.view()


@query("counter_stream")
def counter_stream(spark, sf_dir):
    table = jobs.counter_table(spark, shared_dir(spark, "counters"))
    checkpoint = shared_dir(spark, "checkpoint")
    columns = {"daily": ["day", "hits"], "all": ["hits"]}
    _run(jobs.counter_job, _url_stream(spark, sf_dir), table, "shortid", columns, checkpoint)
    return table.view()


@query("rollup_rejects")
def rollup_rejects(spark, sf_dir):
    """Rows of bad days, stored by the running rollup."""
    table, path = jobs.rollup_table(spark, shared_dir(spark, "rollup"), "shortid"), shared_dir(spark, "bad")
    checkpoint = shared_dir(spark, "checkpoint")
    _run(jobs.rollup_job, _url_stream(spark, sf_dir), table, "shortid", "day", "ts", checkpoint, rejects=path)
    stored = spark.read.schema("seq bigint, shortid string, day string, reason string")
    return stored.parquet(path).select("seq", "shortid", "day", "reason")


@query("cells_stream")
def cells_stream(spark, sf_dir):
    """Cells put in batches, folded and partly delivered again, read back by newest and exact version."""
    path = shared_dir(spark, "events")
    events = load(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), F.col("user_id")).alias("row"),
        "event_type", "props", F.concat(F.lit("u"), F.col("user_id")).alias("uid"),
        F.expr("case when event_id % 10 = 0 then 0 else event_id end").alias("version"), "event_id",
        F.date_format("ts", "yyyyMMdd").alias("dt"),
    )
    events.write.partitionBy("dt").parquet(path)
    schema = "row string, event_type string, props string, uid string, version bigint, event_id bigint"
    table = jobs.cells_table(spark, shared_dir(spark, "cells"), compact_every=2)
    # The second checkpoint delivers everything again: a version put twice is there once.
    for checkpoint in ("first", "second"):
        stream = line_sources.parquet_line_stream(spark, path, schema, _a_third(spark, path))
        _run(
            jobs.cells_job, stream, table, "row", _INFO, shared_dir(spark, checkpoint), ts="version",
            write_time=-F.col("event_id") - 1,
        )
    return cells.cell_lookup(
        _cell_requests(spark, sf_dir), table.view(), _WANTED, "asked", spread=["pos"]
    )


from . import event_queries  # noqa: E402, F401  registers its queries with the functions above
