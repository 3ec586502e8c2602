"""More of the query catalogue: complete days, user-made combiners, ordered text lines, running state, bitmaps, expiry by folder."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import bitmaps, counts, lines, rollup
from ..operators.combine import Combiner, UserMerge, combined, count_combiner
from ..operators.counts import match_merge
from ..operators.lines import MATCH, MATCH_FIELDS, PROFILE, keyed_lines
from ..operators.table_function import append_each
from ..sources import files, lines as line_sources, ordered
from ..sources.files import shared_dir
from ..sources.batch_table import BatchTable
from ..sources.keyed_table import KeyedTable
from ..sources.periods import PeriodTable
from ..streaming import days, dedup, jobs, state
from . import fixtures
from .queries import _line_stream, _request_batches, _run, derived, query

# -- complete days --------------------------------------------------------------------------


def _slices(df: DataFrame) -> list[DataFrame]:
    """Rows before, between and after the two times of the fixtures."""
    first, second = (F.lit(b).cast("timestamp_ntz") for b in fixtures.BATCH_BOUNDS)
    return [df.where(F.col("ts") < first), df.where((F.col("ts") >= first) & (F.col("ts") < second)), df.where(F.col("ts") >= second)]


def _gated(spark, sf_dir, order: tuple[int, ...]) -> tuple[str, str]:
    """The gate over match lines that arrive in slices of time: its landing and its rejects."""
    landing, rejects, checkpoint = (shared_dir(spark, n) for n in ("landing", "late", "gate"))
    source = shared_dir(spark, "arriving")
    slices = _slices(derived(spark, sf_dir, fixtures.match_lines))
    for i, n in enumerate(order):
        slices[n].select("seq", "line").write.parquet(f"{source}/arrival={i}")
        arrived = spark.readStream.schema("seq bigint, line string").parquet(f"{source}/arrival=*")
        _run(days.day_gate_job, arrived, landing, rejects, checkpoint)  # resumes from its checkpoint
    return landing, rejects


_DAY_ROWS = "seq bigint, day_time timestamp, row_key string, {}, count bigint".format(
    ", ".join(f"{c} string" for c in MATCH_FIELDS[:8])
)


@query("day_complete_stream")
def day_complete_stream(spark, sf_dir):
    """Match counts by day and key, of the days that a later day has shown to be over."""
    landing, _ = _gated(spark, sf_dir, (0, 1, 2))
    path = shared_dir(spark, "days")
    landed = days.landed_lines(spark, landing, _DAY_ROWS)
    _run(days.day_complete_job, landed, match_merge(), path, shared_dir(spark, "checkpoint"))
    columns = "row_key string, {}, count bigint".format(", ".join(f"{c} string" for c in MATCH_FIELDS[:8]))
    return days.complete_days(spark, path, columns)


@query("day_late_rejects_stream")
def day_late_rejects_stream(spark, sf_dir):
    """The earliest lines arrive second: their days are over by then, so all of them are rejected, and nothing else is lost."""
    _, rejects = _gated(spark, sf_dir, (1, 0, 2))
    stored = spark.read.schema("seq bigint, line string, reason string, stream string, batch_id bigint").parquet(rejects)
    return stored.select("seq", "line", "reason")


# -- user-made combiners --------------------------------------------------------------------


@query("combiner_count")
def combiner_count(spark, sf_dir):
    """Request count by a combiner in Python."""
    requests = derived(spark, sf_dir, fixtures.request_lines).select(F.col("line").alias("word"))
    return combined(requests, ["word"], [], count_combiner(), "n")


def _span(a: dict, b: dict) -> dict:
    return {"n": a["n"] + b["n"], "first": min(a["first"], b["first"]), "last": max(a["last"], b["last"])}


SPAN = Combiner(
    init=lambda seq: {"n": 1, "first": seq, "last": seq}, combine=_span,
    partial="struct<n: bigint, first: bigint, last: bigint>",
    finish=lambda p: f"{p['first']}-{p['last']}/{p['n']}", result="string",
)


@query("combiner_span")
def combiner_span(spark, sf_dir):
    """A partial of several fields, finished as text: where each key was seen first and last, and how often."""
    rows = keyed_lines(derived(spark, sf_dir, fixtures.match_lines), MATCH)
    return combined(rows, ["row_key"], ["seq"], SPAN, "span")


@query("combiner_count_stream")
def combiner_count_stream(spark, sf_dir):
    """The combiner's partials, stored batch by batch and combined on reading."""
    merge = UserMerge(("word",), (), count_combiner(), "n")
    table = KeyedTable(spark, shared_dir(spark, "combined"), merge, "word string")
    stream = _line_stream(spark, sf_dir, fixtures.request_lines)
    words = lambda batch: batch.select(F.col("line").alias("word"))
    _run(jobs.table_job, stream, table, words, shared_dir(spark, "checkpoint"))
    return table.view()


# -- ordered lines --------------------------------------------------------------------------


def _text_in_order(spark, sf_dir, fixture) -> str:
    """The lines in text files whose paths and lines are in the order of `seq`."""
    path = shared_dir(spark, "text")
    lines = derived(spark, sf_dir, fixture).select("seq", "line")
    lines.repartitionByRange(8, "seq").sortWithinPartitions("seq").select("line").write.text(path)
    return path


@query("ordered_lines_match_count")
def ordered_lines_match_count(spark, sf_dir):
    """First-seen fields from plain text files, by the place of each line in them."""
    read = ordered.ordered_lines(spark, _text_in_order(spark, sf_dir, fixtures.match_lines))
    return counts.match_count(keyed_lines(read, MATCH, keep=ordered.LINE_ORDER), ordered.LINE_ORDER)


@query("numbered_lines_files")
def numbered_lines_files(spark, sf_dir):
    """Every line of the files with its number through all of them."""
    return ordered.numbered_lines(spark, _text_in_order(spark, sf_dir, fixtures.match_lines), name="number")


# -- running state --------------------------------------------------------------------------


@query("state_snapshot_stream")
def state_snapshot_stream(spark, sf_dir):
    """Running match counts read from the job's own state; there is no table beside it."""
    stream, checkpoint = _line_stream(spark, sf_dir, fixtures.match_lines), shared_dir(spark, "checkpoint")
    _run(state.match_state_job, stream, checkpoint)
    return state.read_state(spark, checkpoint, match_merge())


# -- rollups by folder, active days ---------------------------------------------------------


@query("rollup_retention_drop_stored")
def rollup_retention_drop_stored(spark, sf_dir):
    """Rollups in folders by period, stored in three batches, one of them twice; old periods are dropped by folder."""
    table = PeriodTable(spark, shared_dir(spark, "periods"), "shortid")
    events = _slices(derived(spark, sf_dir, fixtures.url_events))
    for batch_id in (0, 1, 2, 1):
        table.commit(rollup.calendar_rollup(events[batch_id], "shortid", "day", ts="ts"), batch_id)
    table.expire(dt.datetime(2024, 2, 10))
    return table.view()


@query("profile_days_dedup_stream")
def profile_days_dedup_stream(spark, sf_dir):
    """Active days inserted if absent while they stream in; every line comes twice, in different batches."""
    path = shared_dir(spark, "lines")
    rows = derived(spark, sf_dir, fixtures.profile_lines).select("seq", "line")
    rows.write.parquet(path)
    once = max(1, len(files.glob(spark, f"{path}/part-*")))  # a batch is all files of one copy, however many there are
    rows.write.mode("append").parquet(path)
    stream = line_sources.parquet_line_stream(spark, path, "seq bigint, line string", once)
    out = shared_dir(spark, "active")
    _run(dedup.profile_days_job, stream, out, shared_dir(spark, "checkpoint"), delay="60 days")
    return spark.read.schema("mid string, day string").parquet(out)


@query("profile_days_bitmap")
def profile_days_bitmap(spark, sf_dir):
    """Active days as a bitmap a device and year, stored in three batches and OR-ed on reading."""
    path = shared_dir(spark, "bitmaps")
    for batch in _slices(derived(spark, sf_dir, fixtures.profile_lines)):
        found = bitmaps.day_bitmaps(keyed_lines(batch, PROFILE), ["mid"], "last_date")
        found.write.mode("append").parquet(path)
    stored = spark.read.schema("mid string, year int, bits array<bigint>").parquet(path)
    return bitmaps.unpack_days(bitmaps.merge_bitmaps(stored, ["mid"]), ["mid"])


@query("profile_day_counts")
def profile_day_counts(spark, sf_dir):
    """How many days each device was active, counted in bitmaps."""
    rows = keyed_lines(derived(spark, sf_dir, fixtures.profile_lines), PROFILE)
    return bitmaps.count_days(bitmaps.day_bitmaps(rows, ["mid"], "last_date"), ["mid"])


# -- table functions ------------------------------------------------------------------------


def _split_words(line: str):
    for word in line.rstrip("\t").split("\t"):
        yield (word,)


@query("table_function_word_count")
def table_function_word_count(spark, sf_dir):
    """Words by a table function, appended to the fields of their line."""
    tabs = derived(spark, sf_dir, fixtures.tab_lines).select("seq", "line")
    return counts.count_rows(append_each(tabs, _split_words, ["line"], "word string"), "word")


# -- tables as a folder a batch ---------------------------------------------------------------


def _batch_table(spark, mode="transactional") -> BatchTable:
    return BatchTable(spark, shared_dir(spark, "batches"), counts.request_merge(), "word string, n bigint", mode)


def _delivered(spark, sf_dir, mode, change=lambda batch: batch) -> DataFrame:
    """Three batches of requests, the middle one again with `change` made to its lines, folded before the last."""
    table, batches = _batch_table(spark, mode), _request_batches(spark, sf_dir)
    for batch_id, batch in ((0, batches[0]), (1, batches[1]), (1, change(batches[1])), (2, batches[2])):
        table.commit(jobs.one_each(batch, "line"), batch_id)
    table.fold(keep=1)
    return table.view()


@query("batch_table_transactional")
def batch_table_transactional(spark, sf_dir):
    return _delivered(spark, sf_dir, "transactional")


@query("batch_table_opaque")
def batch_table_opaque(spark, sf_dir):
    return _delivered(spark, sf_dir, "opaque", lambda batch: batch.withColumn("line", F.concat(F.lit("again/"), "line")))


@query("batch_table_non_transactional")
def batch_table_non_transactional(spark, sf_dir):
    return _delivered(spark, sf_dir, "non_transactional")


@query("batch_table_stream")
def batch_table_stream(spark, sf_dir):
    """A running request count into such a table."""
    table = _batch_table(spark)
    _run(jobs.request_count_job, _line_stream(spark, sf_dir, fixtures.request_lines), table, shared_dir(spark, "checkpoint"))
    table.fold(keep=1)
    return table.view()
