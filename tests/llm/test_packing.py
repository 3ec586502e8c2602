import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keyedflow.llm import packing, queries
from keyedflow.llm.tokenfile import IdEncoder

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids_of():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def check_sequences(rows, capacity):
    """rows: (sequence, offset, length). Places are gapless and fit; the share of padding."""
    sequences = defaultdict(list)
    for sequence, offset, length in rows:
        sequences[sequence].append((offset, length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    used = sum(r[2] for r in rows)
    return 1 - used / (capacity * len(sequences)) if rows else 0


def check(df, docs, ids_of, capacity=1024):
    """The pieces of the documents are exactly their ids, each once."""
    found = df.collect()
    assert df.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    want = Counter()
    for doc_id, text in docs:
        ids, start = ids_of(text), 0
        for length in packing.cut(len(ids), capacity, capacity // 64):
            want[doc_id, start, length, tuple(ids[start : start + length]), len(ids)] += 1
            start += length
        assert start == len(ids)
    got = Counter((r[0], r[1], r[2], tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["doc_tokens"]) for r in found)
    assert got == want
    return check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in found], capacity)


def test_query(spark, sf_dir, documents, ids_of):
    df = queries.op13_harmonic_packing(spark, sf_dir)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = defaultdict(list)
    rows = df.collect()
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for doc_id, text in documents:
        ids, at = np.array(ids_of(text), "<u4"), 0
        for r in sorted(pieces.pop(doc_id), key=lambda r: r["start"]):
            own = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(own.tobytes()))
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    assert check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 1024) < 0.015


def test_edges(spark, edge_docs, no_docs, ids_of):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check(packing.pack(edge_docs, PATH, P.PATTERN, 0), docs, ids_of)
    check(packing.pack(edge_docs, PATH, P.PATTERN, 0, capacity=100), docs, ids_of, 100)
    assert packing.pack(no_docs, PATH, P.PATTERN, 0).collect() == []


def test_clashing_columns_null_and_repeated_ids(spark, ids_of):
    docs = [(i % 50 if i % 9 else None, "word " * (i % 40) + "<|endoftext|>" * (i % 2)) for i in range(400)]
    names = ["start", "length", "ids", "task", "sequence_id", "offset", "id"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({n: F.lit("x") for n in names})
    check(packing.pack(df.repartition(9), PATH, P.PATTERN, 0), docs, ids_of)


@pytest.mark.parametrize("capacity", [1, 2, 7, 100, 1024, 4096])
def test_pieces_and_classes(capacity):
    slack = capacity // 64
    for length in {*range(1, min(3 * capacity, 3000)), 10 * capacity + 3}:
        pieces = packing.cut(length, capacity, slack)
        assert sum(pieces) == length and min(pieces) > 0 and len(pieces) <= length // capacity + 5
        for p in pieces[length // capacity :]:
            count = packing.pieces_a_sequence(p, capacity)
            assert 1 <= count <= capacity // p  # they fit
            if count < packing.TAIL:  # and leave little room
                assert capacity - count * p <= max(slack, count)


def test_full_classes_hold_a_fixed_count(spark, ids_of):
    """Sequences that a task fills by itself hold as many pieces as their class says, of that class alone."""
    rng = random.Random(3)
    docs = [(i, "x" + " word" * rng.choice([0, 3, 20, 170, 250, 340, 509, 800, 1500])) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = defaultdict(list)
    for r in packing.pack(df, PATH, P.PATTERN, 0).collect():
        found[r["sequence_id"]].append(r["length"])
    own = [v for k, v in found.items() if k < 1 << 62]
    assert len(own) > 300
    for lengths in own:
        assert {packing.pieces_a_sequence(n, 1024) for n in lengths} == {len(lengths)}
    classes = {packing.pieces_a_sequence(n, 1024) for lengths in found.values() for n in lengths}
    left = sum(map(len, found.values())) - sum(map(len, own))
    assert left <= 4 * sum(count - 1 for count in classes)  # by four tasks


def test_first_fit():
    sequences = packing.first_fit([(n,) for n in (3, 7, 5, 5, 10, 1)], 10)
    assert [[p[0] for p in s] for s in sequences] == [[10], [7, 3], [5, 5], [1]]


def test_ids_pass_through_python_once(spark, edge_docs, capsys):
    """Stored pieces hold the ids as they are returned: what reads them does so without another pass through Python."""
    packing.pack(edge_docs, PATH, P.PATTERN, 0).explain()
    plan = capsys.readouterr().out
    assert "FlatMapGroupsInArrow" in plan and "MapInArrow" not in plan.replace("FlatMapGroupsInArrow", "")


@pytest.mark.parametrize("entries,again", [(50, 0), (5, 1)])
def test_parts_held_by_a_task_are_encoded_once(entries, again):
    """A cache encodes a part once if its generation holds all parts, and gives the same ids if it does not."""
    encoder, made = IdEncoder(PATH, P.PATTERN, entries=entries), []
    make = encoder.cache.parts.make
    encoder.cache.parts.make = lambda part: made.append(part) or make(part)
    texts = [f"x {'ab'[i % 2] * (i % 40 + 1)}" for i in range(120)]
    whole = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, encoder.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids
    assert (len(made) > len(set(made))) == bool(again) and len(set(made)) == 40
    encoder.cache.forget()
    assert not encoder.cache.parts and packing.HELD_PARTS > 500_000
