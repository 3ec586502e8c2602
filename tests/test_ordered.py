"""Lines of text files that are cut into many blocks, in their order."""

import pytest
from pyspark.sql import functions as F

from keyedflow.operators.counts import match_count
from keyedflow.operators.lines import MATCH, keyed_lines
from keyedflow.plans import fixtures
from keyedflow.plans.queries import derived
from keyedflow.sources.ordered import LINE_ORDER, numbered_lines, ordered_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_blocks(spark):
    """Blocks of about 4 KB, many to a file; the ends of files share a task."""
    names = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "16"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Three files of lines; their paths, and the lines in order."""
    folder = tmp_path_factory.mktemp("text")
    lines = [r["line"] for r in derived(spark, SF, fixtures.match_lines).orderBy("seq").collect()]
    lines[10] = ""  # empty lines are lines
    lines[500:500] = ["", "é" * 9000, ""]  # longer than a block
    for name, low, high in (("b.txt", 300, 900), ("a.txt", 0, 300), ("c.txt", 900, None)):
        (folder / name).write_text("\n".join(lines[low:high]) + ("\n" if name != "c.txt" else ""))
    (folder / "d.txt").write_text("")
    return str(folder), lines


def test_numbers_are_those_of_the_lines(spark, files, small_blocks):
    folder, lines = files
    found = numbered_lines(spark, folder, first=5).collect()
    assert sorted((r["seq"], r["line"]) for r in found) == list(enumerate(lines, 5))


def test_order_columns_are_the_order(spark, files, small_blocks):
    folder, lines = files
    read = ordered_lines(spark, folder)
    assert read.rdd.getNumPartitions() > 10 and read.select("file", "block").distinct().count() > 10
    assert [r["line"] for r in read.orderBy(*LINE_ORDER).collect()] == lines


def test_first_seen_on_raw_text_equals_that_by_number(spark, files, small_blocks):
    folder, lines = files
    numbered = spark.createDataFrame(list(enumerate(lines)), "seq bigint, line string")
    want = match_count(keyed_lines(numbered, MATCH))
    got = match_count(keyed_lines(ordered_lines(spark, folder), MATCH, keep=LINE_ORDER), LINE_ORDER)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lines_are_not_shuffled(spark, files):
    plan = numbered_lines(spark, files[0])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    plan = ordered_lines(spark, files[0])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "x.txt").write_text("")
    assert numbered_lines(spark, str(tmp_path)).collect() == []


def test_nested_folders_by_glob(spark, tmp_path):
    for i, name in enumerate(("n/a.txt", "n/m/b.txt", "n/m/skip.csv")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"line {i}\n")
    found = numbered_lines(spark, str(tmp_path), glob="*.txt").orderBy("seq").collect()
    assert [(r["seq"], r["line"]) for r in found] == [(0, "line 0"), (1, "line 1")]
    assert ordered_lines(spark, str(tmp_path), "*.txt").where(F.col("line") == "line 1").count() == 1
