import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from keyedflow.llm import queries, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def hashes(text, buckets):
    words = words_of(text)
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return [crc32(g.encode()) % buckets for g in grams]


def brute(docs, target, buckets=10_000, least=20, percent=25, seed=7):
    """Sorted (id, features, weight, score, rank), straight from the definition."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(hashes(text, buckets))
    for text in target:
        t.update(hashes(text, buckets))
    s_all, t_all = s.total(), t.total()
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)
    ]
    rows = []
    for i, text in docs:
        found = hashes(text, buckets)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score, len(words_of(text)) >= least))
    chosen = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0]))
    drawn = [(*r[:4], n + 1) for n, r in enumerate(chosen[: percent * len(chosen) // 100])]
    rest = [(*r[:4], None) for r in chosen[len(drawn):]] + [(*r[:4], None) for r in rows if not r[4]]
    return sorted(drawn + rest, key=str)


def rows_of(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark, sf_dir, documents):
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = rows_of(queries.op12_resampling(spark, sf_dir))
    assert got == brute(documents, target) and sum(r[4] is not None for r in got) > 20


def test_segments():
    lines = resample.segments("Ab c\n\n --\r\nD1 é\x0bf\n\ng")
    assert lines == [[b"ab", b"c"], [b"d1", "é".encode(), b"f"], [b"g"]]
    assert resample.crossing(lines) == [crc32(b"c d1"), crc32(b"f g")]
    assert resample.features([b"a", b"b", b"c"]) == [crc32(x) for x in (b"a", b"b", b"c", b"a b", b"b c")]
    assert resample.segments(None) == resample.segments("\n") == []


@pytest.mark.parametrize("options", [{}, {"buckets": 7, "least_words": 0, "percent": 100}, {"buckets": 70_000, "percent": 0}, {"least_words": 3, "seed": 1}])
def test_edges(spark, edge_docs, options):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    names = {"buckets": "buckets", "least_words": "least", "percent": "percent", "seed": "seed"}
    target = spark.createDataFrame([("same text here\nA b",), (None,), ("word1 and",)], "text string")
    got = rows_of(resample.resample(edge_docs, target, **options))
    assert got == brute(rows, ["same text here\nA b", None, "word1 and"], **{names[k]: v for k, v in options.items()})


def test_clashing_columns_and_null_ids(spark):
    """Columns named like those of the operator, ids that are null or repeated, and hot lines."""
    text = "One two three four five six\nseven eight nine ten\n" * 4
    rows = [(i if i % 7 else None, f"{text}tail {i % 3}\nown {i}", "x") for i in range(150)] * 2
    names = ["id", "row", "key", "keys", "n", "total", "n_words", "rank", "score", "weight", "buckets", "segment", "place", "range"]
    df = spark.createDataFrame(rows, "doc_id long, text string, x string").withColumns({n: F.col("x") for n in names}).drop("x")
    target = spark.createDataFrame([("seven eight",)], "text string").withColumns({n: F.lit("y") for n in names})
    assert rows_of(resample.resample(df.repartition(6), target)) == brute([r[:2] for r in rows], ["seven eight"])


def test_empty_tables(spark, no_docs, documents):
    none = spark.createDataFrame([], "text string")
    assert rows_of(resample.resample(no_docs, none)) == []
    some = spark.createDataFrame(documents[:30], "doc_id long, text string")
    assert rows_of(resample.resample(some, none)) == brute(documents[:30], [])


def test_each_distinct_segment_is_counted_once(spark):
    rows = [(i, "A shared line of words\nb" + "\n" + "a  SHARED line, of words!") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stored = resample._distinct_segments(df, "text", 100).collect()
    assert sorted(r["n"] for r in stored) == [9, 18]


def test_ranks_across_ranges(spark):
    rows = spark.range(5000).select(F.col("id"), (F.col("id") % 13).alias("score")).repartition(7)
    found = resample.ranked(rows, [F.col("score").desc(), F.col("id").asc()]).collect()
    want = sorted(range(5000), key=lambda i: (-(i % 13), i))
    assert {r["id"]: r["rank"] for r in found} == {i: n + 1 for n, i in enumerate(want)}
