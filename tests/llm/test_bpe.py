import hashlib
import random
import struct

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from keyedflow.llm import bpe, queries

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, P.PATTERN)


def ids(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_random_texts_as_tiktoken(codec, reference):
    rng = random.Random(5)
    for alphabet in ("ab're 1²٣  \n\t\r 　é😀.,\x00<|>Ā", "a \x1c\x1f\x85​ b", "ab\n.  "):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(3000)]
        assert [ids(x) for x in codec.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_every_token_is_itself(codec, reference):
    texts = []
    for piece in codec.pieces:
        try:
            texts.append(piece.decode())
        except UnicodeDecodeError:
            pass
    assert [ids(x) for x in codec.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_full_caches_change_nothing(codec, reference, monkeypatch):
    from keyedflow.llm import pretokens

    monkeypatch.setattr(pretokens, "CACHE_ENTRIES", 5)
    monkeypatch.setattr(pretokens, "SLICE_CHARS", 40)
    own = bpe.Codec(PATH, P.PATTERN)
    texts = [f"some words {i} and more {i * i} of them" for i in range(50)]
    assert [ids(x) for x in own.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_rows(spark, edge_docs, no_docs, reference):
    clash = edge_docs.withColumnsRenamed({"shard": "ids", "n_words": "decoded"})
    rows = bpe.decode(bpe.encode(clash, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert len(rows) == clash.count()
    for r in rows:
        assert ids(r["ids"]) == reference.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    empty = bpe.decode(bpe.encode(no_docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert empty.count() == 0 and empty.columns[-2:] == ["ids", "decoded"]


def test_query(spark, sf_dir, documents, reference):
    got = {r["doc_id"]: r for r in queries.op1_byte_bpe(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        want = reference.encode_ordinary(text or "")
        r = got[doc_id]
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_a_task_ends_without_a_cache(spark, codec, monkeypatch):
    """A worker that waits for its next task holds none of the last one's parts."""
    tasks = []
    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", lambda rows, run, schema: tasks.append(run))
    text = "a common word, a common word, a common word"
    bpe.encode(spark.createDataFrame([(text,)], "text string"), PATH, P.PATTERN)
    (out,) = tasks[0](iter([pa.RecordBatch.from_pydict({"text": [text], "_in": [text]})]))
    assert ids(out.column("ids")[0].as_py()) and not codec.cache.parts
