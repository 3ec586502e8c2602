import math
import os
import time
import zlib
from collections import Counter

import pyarrow as pa
import pytest
import xxhash

from keyedflow.llm import lm, queries


def tokens(text):
    return [w.decode() for w in lm.tokens_of(text)]


class Brute:
    """The model by its recursive definition, with all counts in dictionaries."""

    def __init__(self, texts, order, share):
        seqs = [tokens(t) for t in texts]
        self.c = Counter(tuple(s[i : i + n]) for s in seqs for n in range(1, order + 1) for i in range(len(s) - n + 1))
        self.n = sum(map(len, seqs))
        self.v = sum(len(k) == 1 for k in self.c)
        self.least = max(2, math.ceil(share * self.n))
        self.order = order

    def uni(self, w):
        return (self.c[(w,)] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def kept(self, h):
        return [k[-1] for k in self.c if len(k) == len(h) + 1 and k[:-1] == h and self.c[k] >= self.least]

    def p(self, h, w):
        if not h:
            return self.uni(w)
        kept = self.kept(h)
        if not kept:
            return self.p(h[1:], w)
        if w in kept:
            return (self.c[(*h, w)] - 0.5) / self.c[h]
        spent = sum((self.c[(*h, x)] - 0.5) / self.c[h] for x in kept)
        below = sum(self.p(h[1:], x) for x in kept)
        return (1 - spent) / (1 - below) * self.p(h[1:], w)

    def score(self, text):
        s = tokens(text)
        return sum(math.log10(self.p(tuple(s[max(0, i - self.order + 1) : i]), w)) for i, w in enumerate(s))


TEXTS = ["the cat sat on the mat", "The cat sat on the hat", "a cat sat on a mat and the cat sat", "the the the the", "", None,
         "dog", "the dog sat on the mat", "cat sat on cat sat on cat sat on", "unseen words here the cat", "the cat sat"] * 3


@pytest.mark.parametrize("head,share", [(1e-6, 1e-5), (0.03, 0.03), (0.2, 0.05)])
def test_scores_by_definition(spark, head, share):
    rows = list(enumerate(TEXTS)) + [(7, TEXTS[7])]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), head=head, share=share).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    model = Brute([t for i, t in rows if not held(i)], 3, max(share, head if share < head else share))
    if share < head:  # n-grams hold frequent words only
        return
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        s = tokens(text[r["doc_id"]])
        assert r["held_out"] == held(r["doc_id"]) and r["n_tokens"] == len(s)
        assert r["train_tokens"] == model.n and r["n_known"] == sum(model.c[(w,)] > 0 for w in s)
        assert r["base_score"] == pytest.approx(sum(math.log10(model.uni(w)) for w in s))
        assert r["score"] == pytest.approx(model.score(text[r["doc_id"]]))


def test_probabilities_sum_to_one():
    model = Brute(TEXTS, 3, 1e-5)
    words = [k[0] for k in model.c if len(k) == 1] + ["never"]
    for h in [(), ("the",), ("cat", "sat"), ("sat", "on"), ("never", "the")]:
        assert sum(model.p(h, w) for w in words) == pytest.approx(1)


def test_table(spark, sf_dir, documents):
    got = queries.op3_lm_scores(spark, sf_dir).collect()
    counts = Counter(w for d, t in documents if zlib.crc32(str(d).encode()) % 10 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    text = dict(documents)
    assert len(got) == len(documents)
    for r in got:
        s = tokens(text[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(s), sum(counts[w] > 0 for w in s), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in s))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # better on texts not trained on


def test_edges(spark, edge_docs, no_docs):
    got = lm.score(edge_docs.withColumnRenamed("shard", "n")).collect()
    assert len(got) == edge_docs.count()
    assert all(math.isfinite(r["score"]) and r["n_tokens"] >= 1 for r in got)
    assert lm.score(no_docs).count() == 0
    only_held = spark.createDataFrame([(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0], "doc_id long, text string")
    rows = lm.score(only_held).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in rows} == {(0, 0, 0.0)}


def test_rare_phrases_count_at_any_size(spark, monkeypatch):
    """An n-gram of two occurrences is kept however many tokens there are, looked up in place or joined."""
    filler = [(i, " ".join(f"w{(i * 7919 + j * j) % 5003}" for j in range(1200))) for i in range(300)]
    rows = filler + [(1000 + i, "seldom seen phrase") for i in range(2)]
    model = Brute([t for i, t in rows if zlib.crc32(str(i).encode()) % 10], 3, 0)
    assert 1e-5 * model.n > 2 and model.c[("seldom", "seen", "phrase")] == 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for direct in (1 << 20, 10):
        monkeypatch.setattr(lm, "DIRECT", direct, raising=False)
        got = {r["doc_id"]: r["score"] for r in lm.score(docs).where("doc_id >= 1000").collect()}
        assert got == {1000 + i: pytest.approx(model.score("seldom seen phrase")) for i in range(2)}


@pytest.mark.parametrize("head,share", [(0.2, 0.05), (0.5, 0.0), (1e-6, 0.1)])
def test_what_is_sent_to_all_tasks_changes_nothing(spark, head, share):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    model = Brute([t for i, t in enumerate(TEXTS) if zlib.crc32(str(i).encode()) % 10], 3, share)
    got = lm.score(docs, head=head, share=share).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert r["score"] == pytest.approx(model.score(TEXTS[r["doc_id"]]))


def automaton(order, grams):
    """grams: words joined by a space -> (arc, failure)."""
    words = lm.Words()
    hashes = lambda text: [words.of([w.encode()])[0] for w in text.split()]
    keys = []
    for text in grams:
        ids = hashes(text)
        found = words.hashes()
        keys.append(lm.keys_of([found[[i]] for i in ids])[0])
    values = list(grams.values())
    own = lm.Automaton(order, -9.0, lm.np.array(keys, lm.np.uint64), lm.np.array([v[0] for v in values]), lm.np.array([v[1] for v in values]))

    def score(*texts):
        ids = [hashes(t) for t in texts]
        found = words.hashes()
        return own.traverse(lm.np.concatenate([found[i] for i in ids]), lm.np.cumsum([len(i) for i in ids]).tolist())

    return score


def test_a_traversal_follows_failure_arcs():
    score = automaton(3, {
        "a": (-1, -0.1), "b": (-2, -0.2), "c": (-3, -0.3), "a b": (-0.5, -0.05), "b c": (-0.6, -0.06), "a b c": (-0.25, 0)})
    [(known, base, path)] = score("a b c")
    assert (known, base, path) == (3, -6, pytest.approx(-1 - 0.5 - 0.25))
    # From "a b" there is no arc for "a": its failure arc, then that of "b", then the arc of the empty state.
    assert score("a b a")[0][2] == pytest.approx(-1 - 0.5 - 0.05 - 0.2 - 1)
    # From "a" to "c": one failure arc; from "c" on to "b": another, and "b c" is found from state "b".
    assert score("a c b c")[0][2] == pytest.approx(-1 - 0.1 - 3 - 0.3 - 2 - 0.6)
    # An unseen word leads to the empty state, and texts do not run on into one another.
    assert score("a x b", "c", "b c")[0] == (2, -12, pytest.approx(-1 - 0.1 - 9 - 2))
    assert [r[2] for r in score("b", "c", "b c")] == [-2, -3, pytest.approx(-2 - 0.6)]


def test_a_chunk_asks_for_each_arc_once(spark, monkeypatch):
    """Scores do not depend on how texts are dealt to chunks."""
    rows = list(enumerate(TEXTS))
    monkeypatch.setattr(lm, "DIRECT", 0)
    results = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        results.append(sorted((r["doc_id"], round(r["score"], 9)) for r in lm.score(docs, head=1.0).collect()))
    assert results[0] == results[1]


def test_clashing_columns_do_no_harm(spark):
    names = ["id", "chunk", "key", "needed", "arc", "failure", "n", "order", "word", "held_out", "score"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, x string")
    plain = sorted((r["doc_id"], round(r["score"], 9)) for r in lm.score(docs.drop("x")).collect())
    clash = docs.select("doc_id", "text", *[docs["x"].alias(n) for n in names])
    assert sorted((r["doc_id"], round(r["score"], 9)) for r in lm.score(clash).collect()) == plain


def test_nothing_is_broadcast_and_little_stored(spark, monkeypatch):
    """Tables of the size of the model, or of a bitmap of its n-grams, go neither to the driver nor to all tasks."""
    sent, tables = [], {}
    broadcast, stored = type(spark.sparkContext).broadcast, lm.stored

    def store(df, name):
        tables[name] = stored(df, name)
        return tables[name]

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or broadcast(self, value))
    monkeypatch.setattr(lm, "stored", store)
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7919 + j * j) % 5003}" for j in range(2000))) for i in range(100)], "doc_id long, text string")
    assert lm.score(docs).count() == 100
    assert not sent
    size = sum(os.path.getsize(f.removeprefix("file:").replace("//", "/")) for t in tables.values() for f in t.inputFiles())
    assert size < 4 * 100 * 2001  # bytes a token


def test_tokens_by_arrow_are_those_of_each_text():
    texts = ["a b", None, "", "  A\tb\x0b\x0c\r\nC  ", "\x1c \x1f\x85 \xa0x\u2003y \x00 \u0130\xc4Z", " ", "b", "\n"]
    words, lengths = lm.words_of(pa.array(texts, pa.string()))
    assert lengths.tolist() == [len(lm.tokens_of(t)) for t in texts]
    more, more_lengths = lm.words_of(pa.array(["c b", "new"]))
    hashes, tokens = lm.numbered([words, more], lm.np.concatenate([lengths, more_lengths]))
    assert len(set(hashes.tolist())) == len(hashes)
    own = [xxhash.xxh64_intdigest(w, 42) for t in [*texts, "c b", "new"] for w in lm.tokens_of(t)]
    assert hashes[tokens].tolist() == own


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [7, 300, 2**63, 2**64 - 1], list(range(1000))])
def test_lists_are_what_they_were(values):
    values = lm.np.array(values, lm.np.uint64)
    assert lm.unpacked(lm.packed(values)).tolist() == values.tolist()
    assert lm.unpacked_rising(lm.packed_rising(values), len(values)).tolist() == values.tolist()


def test_many_chunks_and_parts(spark, monkeypatch):
    """Scores by definition, with chunks of a few texts and more parts than some chunk has n-grams."""
    monkeypatch.setattr(lm, "HELD_TOKENS", 10)
    monkeypatch.setattr(lm, "PART_TOKENS", 20)
    rows = list(enumerate(TEXTS)) + [(7, TEXTS[7]), (None, "the cat sat on a dog")]
    rows += [(100 + i, " ".join(f"w{(i * 31 + j * j) % 17}" for j in range(40))) for i in range(12)]
    model = Brute([t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10], 3, 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(lm, "slices", lambda batches, column: (b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    got = lm.score(docs).collect()
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["train_tokens"] == model.n
        assert r["score"] == pytest.approx(model.score(text[r["doc_id"]]))


@pytest.mark.parametrize("order", [1, 2, 4])
def test_other_orders(spark, order):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    model = Brute([t for i, t in enumerate(TEXTS) if zlib.crc32(str(i).encode()) % 10], order, 0)
    for r in lm.score(docs, order=order).collect():
        assert r["score"] == pytest.approx(model.score(TEXTS[r["doc_id"]]))


def test_the_disk_holds_one_round_at_a_time(spark, monkeypatch):
    """Shuffles go with their round, chunks when their texts are in buckets, and buckets meet without another shuffle."""
    conf, names = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [r.tableName for r in spark.sql("SHOW TABLES").collect()]
    before, paths, shared = spark.conf.get(conf), [], lm.shared_dir
    monkeypatch.setattr(lm, "shared_dir", lambda spark, name: paths.append(shared(spark, name)) or paths[-1])
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7919 + j * j) % 5003}" for j in range(2000))) for i in range(100)], "doc_id long, text string")
    there = shuffles()
    scored = lm.score(docs)
    assert len(scored.collect()) == len(scored.collect()) == 100
    for _ in range(50):  # files are removed in the background
        if not shuffles() - there:
            break
        time.sleep(0.1)
    assert not shuffles() - there
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    sizes = [sum(os.path.getsize(os.path.join(at, f)) for at, _, found in os.walk(p.removeprefix("file:")) for f in found) for p in paths]
    assert [os.path.basename(p).split("-")[0] for p, size in zip(paths, sizes) if size] == ["texts", "answers"]
    assert sum(sizes) < 8 * 100 * 2001  # bytes a token
    assert spark.conf.get(conf) == before and [r.tableName for r in spark.sql("SHOW TABLES").collect()] == names
