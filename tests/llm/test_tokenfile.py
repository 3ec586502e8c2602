import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from keyedflow.llm import queries, tokenfile

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("values", [
    [], [0], [7], [0, 0, 0], list(range(5000)), [3, 3, 9, 2**40, 2**40, 2**62],
    np.cumsum(np.random.default_rng(1).integers(0, 3000, 20000)).tolist(),
])
def test_elias_fano(values):
    code = tokenfile.EliasFano.encode(np.array(values, np.int64))
    back = tokenfile.EliasFano.read(code.n, code.low_bits, *code.parts())
    assert back.get(np.arange(len(values))).tolist() == values
    some = np.arange(len(values))[::-7]
    assert back.get(some).tolist() == [values[i] for i in some]
    if len(values) > 10000:  # near-minimal: 2 + log2(range / n) bits a value, and the counts
        bits = 8 * sum(map(len, back.parts())) / len(values)
        assert bits < 2.2 + np.log2(values[-1] / len(values))


def test_same_ids_as_the_library(both, reference):
    own = tokenfile.IdEncoder(PATH, P.PATTERN)
    texts = [t or "" for _, t in both] + ["<|endoftext|> a", "  x ", "\n\n a\n \nb", "a b 　c"]
    got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts)]
    assert got == [reference(t) for t in texts]


def rows(df, folder, files):
    written = tokenfile.write_ids(df, PATH, P.PATTERN, 2, folder=str(folder), docs_per_file=files)
    return tokenfile.read_ids(written, docs_at_once=5).collect(), written


def check(got, docs, reference):
    want = Counter((d, tuple(reference(t) + [2])) for d, t in docs)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    order = [-(1 << 70) if r["doc_id"] is None else r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)


def test_round_trip(spark, edge_docs, tmp_path, reference):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()] + [(None, "no id"), (None, None), (-5, "x"), (1 << 62, "far")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got, files = rows(df, tmp_path / "a", 6)
    assert files.count() > 2
    check(got, docs, reference)
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_empty(no_docs, tmp_path):
    got, files = rows(no_docs, tmp_path / "b", 6)
    assert got == [] and files.count() == 0


def test_query(spark, sf_dir, documents, reference):
    got = {r["doc_id"]: r for r in queries.op8_token_files(spark, sf_dir).collect()}
    at = 0
    for doc_id, text in sorted(documents):
        ids = np.array(reference(text) + [2], "<u4")
        r = got.pop(doc_id)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not got


def test_added_tokens(spark, tmp_path):
    """Added tokens in a text have their own ids, as the library gives them by default."""
    library = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "plain words", "", "<|endoftext |>"]
    assert 50256 in library.encode(texts[0], add_special_tokens=False).ids
    got, _ = rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2), tmp_path / "c", 4)
    check(got, list(enumerate(texts)), lambda t: library.encode(t or "", add_special_tokens=False).ids)


def test_white_space_of_every_kind(reference):
    """Parts are cut where the library's pattern starts a match, whatever stands beside a space."""
    import random

    rng = random.Random(9)
    kinds = [" ", " ", " ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "a", "B", "é", ".", "7", "'s", "\x00"]
    texts = ["".join(rng.choice(kinds) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    own = tokenfile.IdEncoder(PATH, P.PATTERN)
    assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts)] == [reference(t) for t in texts]


def test_number_of_files_is_bounded_by_size(spark, tmp_path, reference):
    docs = [(i, f"text {i}") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got, files = rows(df, tmp_path / "d", 1)
    assert files.count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    check(got, docs, reference)


def test_forgotten_parts_are_met_anew():
    own = tokenfile.IdEncoder(PATH, P.PATTERN)
    texts = ["a common word, a common word", "another word: 12 words"]
    before = list(own.encode(texts))
    assert len(own.cache.parts) and len(own.cache.words)
    own.cache.forget()
    assert not own.cache.parts and not own.cache.parts.older and not own.cache.words
    assert list(own.encode(texts)) == before
