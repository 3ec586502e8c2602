import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from keyedflow.llm import queries, simhash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    """rows: (id, fingerprint); id -> smallest id over links of at most four bits."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (id, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, id), id)
    return {id: least[find(i)] for i, (id, _) in enumerate(rows)}


def test_fingerprints(both):
    for _, text in both:
        if text is None or len(text) < 20000:
            assert simhash.fingerprint_of(text or "") == brute_print(text)


def test_query(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in queries.op9_simhash(spark, sf_dir).collect()}
    prints = [(d, simhash.fingerprint_of(t or "")) for d, t in documents]
    assert {d: int(r["fingerprint"], 16) for d, r in got.items()} == dict(prints)
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in got.values())
    assert {d: r["component_id"] for d, r in got.items()} == brute_classes(prints)


@pytest.mark.parametrize("tile", [2048, 16, 3])
def test_classes(spark, tile):
    """Chains of steps of four bits, a dense cloud and noise; small tiles force many pairs of them."""
    rng = random.Random(tile)
    prints = [rng.getrandbits(64) for _ in range(60)]
    at = rng.getrandbits(64)
    for _ in range(40):
        for bit in rng.sample(range(64), 4):
            at ^= 1 << bit
        prints.append(at)
    centre = rng.getrandbits(64)
    prints += [centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)]
    prints += [0, 0, 1, (1 << 64) - 1] + prints[:5]
    rng.shuffle(prints)
    rows = [(i * 3, int(np.uint64(p).view(np.int64))) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long").cache()
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(df, tile=tile).collect()}
    assert got == brute_classes([(i * 3, p) for i, p in enumerate(prints)])


def test_tile_pairs_out_of_reach_are_skipped():
    low, high = np.array([0, 1], np.uint64), np.array([(1 << 40) - 1, (1 << 41) - 1], np.uint64)
    assert list(simhash._pairs(low, high, 4)) == []


def test_edges(edge_docs, no_docs):
    prints = simhash.fingerprints(edge_docs.withColumnRenamed("shard", "component_id")).cache()
    got = simhash.classes(prints).collect()
    assert len(got) == edge_docs.count()
    assert {r["component_id"] for r in got if r["doc_id"] in (0, 1, 2, 3, 4)} == {0}
    assert simhash.classes(simhash.fingerprints(no_docs)).count() == 0
