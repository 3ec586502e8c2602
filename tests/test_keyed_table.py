"""Commit modes, crashes, folding, deletes, and independence of how the input is cut in batches."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from keyedflow.operators.merge import Merge
from keyedflow.sources import files
from keyedflow.sources.keyed_table import KeyedTable

SCHEMA = "k string, n bigint, a string, b string, seq bigint"
MERGE = Merge(keys=["k"], sums=["n"], firsts=["a"], lasts=["b"])


def table(spark, path, mode="transactional", generation=0):
    return KeyedTable(spark, str(path), MERGE, SCHEMA, mode, generation)


def rows(spark, *tuples):
    return spark.createDataFrame(list(tuples), SCHEMA)


def view(t):
    return {r.k: (r.a, r.b, r.n) for r in t.view().collect()}


def expected(tuples):
    out = {}
    for k, n, a, b, _ in sorted(tuples, key=lambda t: t[4]):
        first, _, total = out.get(k, (a, None, 0))
        out[k] = (first, b, total + n)
    return out


def test_empty_table(spark, tmp_path):
    t = table(spark, tmp_path)
    assert view(t) == {} and t.view().columns == ["k", "a", "b", "n"] and not t.compact()
    t.vacuum()


def test_commit_modes(spark, tmp_path):
    first, second = ("x", 1, "a0", "b0", 0), ("x", 2, "a1", "b1", 1)
    changed = ("x", 5, "a2", "b2", 2)
    totals = {}
    for mode in ("transactional", "opaque", "non_transactional"):
        t = table(spark, tmp_path / mode, mode)
        assert t.commit(rows(spark, first), 0) and t.commit(rows(spark, second), 1)
        done = t.commit(rows(spark, changed), 1)
        assert done == (mode != "transactional")
        totals[mode] = view(t)["x"]
    assert totals == {
        "transactional": ("a0", "b1", 3),
        "opaque": ("a0", "b2", 6),
        "non_transactional": ("a0", "b2", 8),
    }


def test_opaque_replacement_is_reversible(spark, tmp_path):
    t = table(spark, tmp_path, "opaque")
    t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0)
    before = view(t)
    t.commit(rows(spark, ("y", 9, "c", "d", 0)), 0)
    assert set(view(t)) == {"y"}
    t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0)
    assert view(t) == before


def test_a_write_that_died_does_not_count_and_is_redone(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0)
    with monkeypatch.context() as m:  # the data is there, the manifest is not
        m.setattr(t, "_publish", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.commit(rows(spark, ("x", 1, "a", "c", 1)), 1)
    assert view(t) == {"x": ("a", "b", 1)}
    assert t.commit(rows(spark, ("x", 1, "a", "c", 1)), 1)
    assert view(t) == {"x": ("a", "c", 2)}
    assert len(files.glob(spark, f"{tmp_path}/log/generation=*/batch_id=*/attempt=*")) == 3
    t.vacuum()
    assert len(files.glob(spark, f"{tmp_path}/log/generation=*/batch_id=*/attempt=*")) == 2


@pytest.mark.parametrize("mode", ["transactional", "opaque", "non_transactional"])
def test_folding_changes_nothing(spark, tmp_path, mode):
    t = table(spark, tmp_path, mode)
    batches = [[("x", i, f"a{i}", f"b{i}", i), (f"y{i}", 1, "a", "b", i)] for i in range(5)]
    for i, batch in enumerate(batches):
        t.commit(rows(spark, *batch), i)
    before = view(t)
    assert before == expected(sum(batches, []))
    assert t.compact(keep=2) and view(t) == before
    t.vacuum()
    assert view(t) == before
    assert len(files.glob(spark, f"{tmp_path}/log/generation=*/batch_id=*")) >= 2
    assert not t.compact(keep=2)
    assert t.compact(keep=0) and view(t) == before
    t.vacuum()
    assert view(t) == before
    t.commit(rows(spark, ("x", 10, "a9", "b9", 9)), 5)
    assert view(t)["x"] == ("a0", "b9", 20)


def test_folding_by_itself(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path), MERGE, SCHEMA, compact_every=3, keep=1, retain=0)
    data = [("x", i, f"a{i}", f"b{i}", i) for i in range(7)]
    for i, row in enumerate(data):
        t.commit(rows(spark, row), i)
        assert view(t) == expected(data[: i + 1])
    assert [r.version for r in t.manifest().runs] == [(0, 1), (0, 3), (0, 5)]
    assert t.manifest().folded == {0: [[0, 5]]} and len(t.manifest().log) == 1
    assert len(files.glob(spark, f"{tmp_path}/log/generation=*/batch_id=*/attempt=*")) == 1


def test_levels_listings_and_folders_stay_few(spark, tmp_path, monkeypatch):
    """A row is rewritten once per level, and a commit lists the same few files ever after."""
    t = KeyedTable(spark, str(tmp_path), MERGE, SCHEMA, compact_every=2, keep=0, retain=0, buckets=2)
    calls, merged = [], []
    glob, live = files.glob, t._live
    monkeypatch.setattr(files, "glob", lambda *a: calls.append(len(r := glob(*a))) or r)
    monkeypatch.setattr(t, "_live", lambda s, pieces, *a: merged.append(len(pieces)) or live(s, pieces, *a))
    per_commit = []
    for i in range(50):
        calls.clear()
        t.commit(rows(spark, ("x", 1, "a", "b", i), (f"k{i}", 1, "a", "b", i)), i)
        per_commit.append((len(calls), max(calls, default=0)))
    assert max(per_commit[10:]) == max(per_commit[30:]) and max(n for n, _ in per_commit) <= 3
    state = t.manifest()
    assert max(r.level for r in state.runs) == 2 and len(state.runs) <= 3 * 3
    # 25 folds of two batches: three in four read the log alone.
    assert len(merged) == 25 and sum(n == 2 for n in merged) >= 18
    assert len(view(t)) == 51 and view(t)["x"][2] == 50


def test_a_fold_reads_the_log_and_lookups_read_their_buckets(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path), MERGE, SCHEMA, buckets=8)
    for i in range(3):
        data = [(f"k{n}", 1, "a", "b", i) for n in range(100)]
        t.commit(rows(spark, *data), i)
        if i == 0:
            t.compact(keep=0)
    state = t.manifest()
    inputs = t._live(state, state.log).inputFiles()
    assert inputs and all("/log/" in f for f in inputs)
    asked = spark.createDataFrame([("k7", 0)], "k string, pos int")
    found = t.lookup(asked, ["pos"], selective=True)
    assert found.first().n == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket#\d+ (=|IN)", plan)


def test_a_view_begun_before_a_fold_and_vacuum_is_complete_or_fails(spark, tmp_path):
    t = table(spark, tmp_path)
    for i in range(4):
        t.commit(rows(spark, ("x", 1, "a", "b", i)), i)
    begun = t.view()
    t.compact(keep=0)
    t.vacuum(retain=3600)
    assert begun.first().n == 4
    begun = t.view()
    t.commit(rows(spark, ("x", 1, "a", "b", 4)), 4)
    t.compact(keep=0, where=F.lit(True))
    t.vacuum()
    with pytest.raises(Exception, match="(?i)not exist|FileNotFound"):
        begun.collect()
    assert view(t)["x"][2] == 5


def test_rows_with_unique_keys_need_no_shuffle(spark, tmp_path):
    data = [("x", 1, "a0", "b0", 0), ("y", 2, "a1", "b1", 1)]
    t = table(spark, tmp_path)
    t.commit(rows(spark, *data), 0, unique_keys=True)
    t.commit(rows(spark, ("x", 1, "a2", "b2", 2)), 1)
    assert view(t) == {"x": ("a0", "b2", 2), "y": ("a1", "b1", 2)}
    plan = MERGE.partial(rows(spark, *data), unique_keys=True)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_replay_of_folded_batches(spark, tmp_path):
    for mode in ("transactional", "opaque"):
        t = table(spark, tmp_path / mode, mode)
        for i in range(3):
            t.commit(rows(spark, ("x", 1, "a", "b", i)), i)
        t.compact(keep=1)
        if mode == "transactional":
            assert not t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0)
        else:
            with pytest.raises(ValueError, match="folded"):
                t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0)
            t.commit(rows(spark, ("x", 4, "a", "b", 2)), 2)
        assert view(t)["x"][2] == (3 if mode == "transactional" else 6)


def test_generations_keep_batch_ids_apart(spark, tmp_path):
    table(spark, tmp_path).commit(rows(spark, ("x", 1, "a", "b", 0)), 0)
    again = table(spark, tmp_path, generation=1)
    assert again.commit(rows(spark, ("x", 1, "a", "c", 1)), 0)
    again.compact(keep=0)
    assert view(again) == {"x": ("a", "c", 2)}
    assert not table(spark, tmp_path).commit(rows(spark, ("x", 1, "a", "b", 0)), 0)


def test_streams_have_their_own_generations(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0, stream="s")
    assert not t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0, stream="s")
    assert t.commit(rows(spark, ("x", 1, "a", "c", 1)), 0, stream="t")
    t.compact(keep=0)
    assert not t.commit(rows(spark, ("x", 1, "a", "c", 1)), 0, stream="t")
    assert t.commit(rows(spark, ("x", 1, "a", "d", 2)), 1, stream="s")
    assert view(t) == {"x": ("a", "d", 3)}


@pytest.mark.parametrize("mode", ["transactional", "opaque"])
def test_a_late_batch_counts_once(spark, tmp_path, mode):
    t = table(spark, tmp_path, mode)
    for i in (0, 2):
        t.commit(rows(spark, ("x", 1, "a", "b", i)), i)
    t.compact(keep=0)
    assert t.manifest().folded == {0: [[0, 0], [2, 2]]}
    assert t.commit(rows(spark, ("x", 1, "a", "b", 1)), 1)
    t.compact(keep=0)
    assert view(t) == {"x": ("a", "b", 3)} and t.manifest().folded == {0: [[0, 2]]}


def test_a_delete_covers_no_later_batch(spark, tmp_path):
    gone = spark.createDataFrame([("x",)], "k string")
    t = table(spark, tmp_path)
    assert not t.delete(gone) and not t.delete(gone, 0)
    t.commit(rows(spark, ("x", 7, "a", "b", 0)), 0)
    assert view(t) == {"x": ("a", "b", 7)}
    assert t.delete(gone, 5)  # made for a batch to come: covers what there is
    t.commit(rows(spark, ("x", 2, "c", "d", 1)), 1)
    assert view(t) == {"x": ("c", "d", 2)}
    again = table(spark, tmp_path, generation=1)
    again.delete(gone)
    again.commit(rows(spark, ("x", 3, "e", "f", 2)), 0)
    assert view(again) == {"x": ("e", "f", 3)}
    again.compact(keep=0)
    again.vacuum()
    assert view(again) == {"x": ("e", "f", 3)} and not again.manifest().deletes


def test_a_batch_behind_a_folded_delete_is_refused(spark, tmp_path):
    t = table(spark, tmp_path)
    t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0)
    t.commit(rows(spark, ("y", 1, "a", "b", 2)), 2)
    t.delete(spark.createDataFrame([("x",)], "k string"), 2)
    t.compact(keep=0)
    with pytest.raises(ValueError, match="delete"):
        t.commit(rows(spark, ("x", 1, "a", "b", 1)), 1)
    assert view(t) == {"y": ("a", "b", 1)}


def test_deletes_reach_older_runs(spark, tmp_path):
    t = table(spark, tmp_path)
    for i in range(6):
        t.commit(rows(spark, ("x", 1, "a", "b", i), ("y", 1, "a", "b", i)), i)
        if i % 2:
            t.compact(keep=0)
    t.delete(spark.createDataFrame([("x",)], "k string"))
    assert set(view(t)) == {"y"}
    t.commit(rows(spark, ("x", 5, "c", "d", 9)), 6)
    for _ in range(2):
        assert view(t) == {"x": ("c", "d", 5), "y": ("a", "b", 6)}
        t.compact(keep=0)
        t.vacuum()
    assert not t.manifest().deletes and len(t.manifest().runs) == 1


def test_delete_acts_between_batches(spark, tmp_path):
    t = table(spark, tmp_path)
    t.commit(rows(spark, ("x", 1, "a0", "b0", 0), ("y", 1, "a0", "b0", 0)), 0)
    t.delete(spark.createDataFrame([("x",), ("none",)], "k string"), 0)
    assert set(view(t)) == {"y"}
    t.commit(rows(spark, ("x", 7, "a1", "b1", 1)), 1)
    expected_view = {"x": ("a1", "b1", 7), "y": ("a0", "b0", 1)}
    assert view(t) == expected_view
    t.compact(keep=0)
    t.vacuum()
    assert view(t) == expected_view
    t.delete(spark.createDataFrame([("y",)], "k string"), 2)
    assert set(view(t)) == {"x"}


@pytest.mark.parametrize("mode", ["transactional", "non_transactional"])
def test_delete_of_everything_so_far(spark, tmp_path, mode):
    t = table(spark, tmp_path, mode)
    gone = spark.createDataFrame([("x",)], "k string")
    for i in range(3):
        t.commit(rows(spark, ("x", 1, "a", "b", i), ("y", 1, "a", "b", i)), i)
    t.compact(keep=0)
    t.delete(gone)
    t.vacuum()
    assert view(t) == {"y": ("a", "b", 3)}
    t.commit(rows(spark, ("x", 5, "c", "d", 9)), 3)
    assert view(t) == {"x": ("c", "d", 5), "y": ("a", "b", 3)}
    t.compact(keep=0)
    t.vacuum()
    assert view(t) == {"x": ("c", "d", 5), "y": ("a", "b", 3)}


def test_delete_within_what_is_folded(spark, tmp_path):
    gone = spark.createDataFrame([("x",)], "k string")
    for mode in ("transactional", "opaque"):
        t = table(spark, tmp_path / mode, mode)
        for i in range(3):
            t.commit(rows(spark, ("x", 1, "a", "b", i)), i)
            if i == 0:
                t.delete(gone, 0)
        t.compact(keep=0)
        if mode == "transactional":
            assert not t.delete(gone, 0)  # the same delete again
        with pytest.raises(ValueError, match="folded"):
            t.delete(gone, 1)
        assert view(t) == {"x": ("a", "b", 2)}


def test_compound_keys_and_namespace_folders(spark, tmp_path):
    merge = Merge(keys=["ns", "k"], sums=["n"])
    t = KeyedTable(
        spark, str(tmp_path), merge, "ns string, k string, n bigint", partition_by=["ns"]
    )
    data = [("1", "a", 1), ("1", "b", 2), ("x/y=z", "a", 3)]
    t.commit(spark.createDataFrame(data, "ns string, k string, n bigint"), 0)
    t.commit(spark.createDataFrame(data[:1], "ns string, k string, n bigint"), 1)
    t.compact(keep=1)
    assert sorted(map(tuple, t.view().collect())) == [("1", "a", 2), ("1", "b", 2), ("x/y=z", "a", 3)]
    requests = spark.createDataFrame([("1", "a", 0), ("2", "a", 1)], "ns string, k string, pos int")
    assert {r.pos: r.n for r in t.lookup(requests, ["pos"]).collect()} == {0: 2, 1: None}
    scan = t.view().where("ns = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ns" in scan


def test_lookup_merges_base_and_batches(spark, tmp_path):
    t = table(spark, tmp_path)
    data = [(f"k{i % 7}", 1, f"a{i:02}", f"b{i:02}", i) for i in range(40)]
    for batch in range(4):
        t.commit(rows(spark, *data[batch::4]), batch)
    t.compact(keep=2)
    asked = ["k0"] * 30 + ["k3", "k9"]
    requests = spark.createDataFrame(list(enumerate(asked)), "pos int, k string")
    state = expected(data)
    for selective in (False, True):
        found = t.lookup(requests, ["pos"], selective)
        assert {r.pos: (r.a, r.b, r.n) for r in found.collect()} == {
            i: state.get(k, (None, None, None)) for i, k in enumerate(asked)
        }


def test_lookup_shuffles_the_state_once(spark, tmp_path):
    t = table(spark, tmp_path)
    t.commit(rows(spark, ("x", 1, "a", "b", 0)), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = t.lookup(spark.createDataFrame([("x", 1)], "k string, pos int"), ["pos"])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Requests and state, by key and salt, and no exchange of either by key alone.
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+, _salt#\d+, ", plan)) == 2
    assert not re.search(r"Exchange hashpartitioning\(k#\d+, \d", plan)


keys = st.sampled_from(["x", "y", "z"])
events = st.lists(st.tuples(keys, st.integers(-3, 9), st.integers(1, 4)), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=events, seed=st.integers(0, 1000))
def test_any_cut_in_batches_in_any_order_gives_the_same_view(spark, tmp_path_factory, events, seed):
    data = [(k, n, f"a{i}", f"b{i}", i) for i, (k, n, _) in enumerate(events)]
    batches = {}
    for row, (_, _, batch) in zip(data, events):
        batches.setdefault(batch, []).append(row)
    order = list(batches.values())
    random.Random(seed).shuffle(order)
    t = table(spark, tmp_path_factory.mktemp("t"))
    for i, batch in enumerate(order):
        t.commit(rows(spark, *batch), i)
        if i == seed % 3:
            t.compact(keep=seed % 2)
    assert view(t) == expected(data)


def test_ties_have_one_answer(spark, tmp_path):
    same = [("x", 1, a, a, 0) for a in "cab"]
    for i, order in enumerate((same, same[::-1])):
        t = table(spark, tmp_path / str(i))
        t.commit(rows(spark, *order).repartition(3), 0)
        assert view(t) == {"x": ("a", "c", 3)}
