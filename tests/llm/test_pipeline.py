import hashlib
import struct
from collections import Counter

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F
from test_decontam import brute as brute_hits
from test_line_dedup import brute as brute_lines
from test_simhash import brute_classes

import corpus_pipeline
from keyedflow.llm import bpe, quality, simhash


def brute(rows, benchmark):
    """rows: (doc_id, text), all of hosts that are neither blocked nor distrusted."""
    kept = []
    for d, t in rows:
        n, *_, repeats = quality.measure_text(t or "")
        if n >= 50 and 100 * repeats <= 50 * n:
            kept.append((d, t))
    rows = [(d, t) for d, _, _, t in brute_lines(kept)]
    worded = [(d, simhash.fingerprint_of(t)) for d, t in rows if t.split()]
    least = brute_classes(worded)
    rows = [(d, t) for d, t in rows if least.get(d, d) == d]
    hit = {d for d, _, n, _ in brute_hits(rows, benchmark) if n}
    return {d: t for d, t in rows if d not in hit}


def test_run(spark, sf_dir, documents):
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(documents, benchmark)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == set(want) and 0 < len(want) < len(documents)
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for d, text in want.items():
        ids = own.encode_ordinary(text)
        assert got[d]["n_tokens"] == len(ids) and got[d]["round_trip"]
        assert got[d]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name


def test_stages_on_edges(spark, sf_dir, edge_docs, no_docs):
    docs = edge_docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.lit(0).cast("long").alias("n_chars")).cache()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0
        out = stage(spark, docs, sf_dir)
        out.collect()
    near = corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).collect()
    ids = sorted(r["doc_id"] for r in near)
    assert {0, 1, 2, 3, 4} <= set(ids) and 11 in ids and 12 not in ids and len(ids) == len(set(ids))


def test_host_verdicts_reach_the_pipeline(spark, sf_dir):
    """A blocked host loses all, a distrusted one what fails the rule, another host nothing of that kind."""
    clean = lambda i: " ".join(f"word{i}x{k}" for k in range(80))
    noisy = lambda i: " ".join(f"#{i}x{k} $$ word" for k in range(40))
    rows = [("good", clean, 60), ("good", noisy, 2), ("noisy", noisy, 50), ("noisy", clean, 10), ("bad", clean, 1)]
    docs = [(host, make.__code__ is clean.__code__, make) for host, make, times in rows for _ in range(times)]
    docs += [("bad", False, lambda i: "short")] * 400 + [(f"h{i}", True, clean) for i in range(40)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    table = [(i, make(i), "en", host, len(make(i))) for i, (host, _, make) in enumerate(docs)]
    kept = Counter(
        (docs[r["doc_id"]][0][0], docs[r["doc_id"]][1])
        for r in corpus_pipeline.quality_stage(spark, spark.createDataFrame(table, columns), sf_dir).collect()
    )
    assert kept == {("g", True): 60, ("g", False): 2, ("n", True): 10, ("h", True): 40}
