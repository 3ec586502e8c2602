"""Language-model scores by a trigram backoff model: a weighted automaton with failure arcs, of which each chunk of texts has its part.

Tokens are words, lower-cased in A-Z, that end at U+0020 and U+0009 to U+000D, then one end token per text. Training
texts are those whose crc32(id as text) mod 10 is not 0.

The model. Unigrams have (c + 0.1) / (N + 0.1 * (V + 1)), where the one in V + 1 stands for all unseen tokens. An n-gram
of a higher order is kept if it occurs `LEAST` times, at any size of the corpus (or makes up `share` of the training tokens,
if that is given and more). A kept n-gram has (c - 0.5) / c(context); what a context has left goes to its backoff, in
proportion to the next lower order, so that the probabilities of every context sum to one.

The automaton. Its states are the kept n-grams below the highest order, and the empty one. A state has an arc for each kept n-gram
that goes on from it, with the n-gram's log-probability, and a failure arc to the state without its first word, with its
backoff. A text is traversed once, from left to right: where the state has no arc for the next word, its failure arcs are followed, adding
their weights, until one has; the empty state has an arc for every word. The next state is the longest kept n-gram that ends there.

The whole automaton is in no one place. Texts are stored once as chunks of about `HELD_TOKENS` word numbers. In a round, each chunk
deals the different n-grams of one order that occur in it, with their training counts, to parts by key; a part adds the counts up
and answers each chunk in the order asked: the count of each and, of the kept ones, a number. The key of a longer n-gram is made of
the numbers of its beginning and its last word, so it is asked for only if all that it is made of was kept, and is exact. What the kept
n-grams take from their contexts is added up alike: the first chunk that asked for an n-gram is the one that gives its share, and the
sums of a context are answered to chunks where some text takes its failure arc.
With the answers a chunk has its arcs and failure arcs and traverses its texts. Parts grow in number with the corpus, an n-gram comes once
from each chunk, and nothing goes through the driver but sums over all chunks and parts.

Words are known by their 64-bit hash. Lists are sorted, and sent as compressed differences. Texts and answers are stored in buckets by
chunk, so each round only shuffles its own questions and answers, whose files go when the round is stored: the disk holds one round at a
time. Stored rounds stay where they are until the application's folder goes, so lost executors can be made up for.

Null and empty texts consist of the end token. Rows of one id are scored one by one; repeated rows train as often as they
occur. Null ids train, as they have no fold. Without training texts every token is unseen. Only the id and the text are read.
"""

import math
from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.files import delete, shared_dir
from .common import residue, shuffles_removed, slices, stored

HEAD, LEAST, ORDER = 1e-6, 2, 3
ADD, DISCOUNT = 0.1, 0.5
#: Bounds of what was once sent to all tasks, as is `head`. Nothing is now, so they change nothing.
DIRECT = 1 << 20
#: A word never holds white space, so this can stand for the end of a text.
END = b" "
#: Tokens of a chunk; tokens for each part that counts; tokens that are traversed at a time.
HELD_TOKENS, PART_TOKENS, WALKED = 1_200_000, 2_000_000, 200_000
COUNT, SUM = 0, 1
ASKS = "what int, size int, part int, chunk long, a binary, b binary, c binary, d binary, e binary, room long"
ANSWERS = "what int, size int, part int, chunk long, a binary, b binary, c binary, room long, seen long"


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split() + [END]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Words:
    """Texts as numbers of the words met so far, with the hashes by number."""

    def __init__(self):
        self.number = _Numbers()

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))

    def hashes(self) -> np.ndarray:
        import xxhash

        digest = xxhash.xxh64_intdigest
        return np.fromiter((digest(w, 42) for w in self.number), np.uint64, len(self.number))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after another, and how many tokens each text has, its end counted: `tokens_of` by Arrow."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    text, words = pc.list_parent_indices(words).to_numpy(), words.flatten()
    some = pc.not_equal(words, "")  # beside white space at either end of a text
    return words.filter(some), np.bincount(text[some.to_numpy(zero_copy_only=False)], minlength=len(texts)) + 1


def numbered(words: list[pa.Array], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the different words and of the end token, and the texts of these `lengths` as their numbers."""
    import xxhash

    coded = pa.chunked_array(words).dictionary_encode().unify_dictionaries()
    different = coded.chunk(0).dictionary.cast(pa.binary()).to_pylist() + [END]
    tokens, inside = np.full(lengths.sum(), len(different) - 1, np.int32), np.ones(lengths.sum(), bool)
    inside[np.cumsum(lengths) - 1] = False
    tokens[inside] = np.concatenate([part.indices.to_numpy() for part in coded.chunks])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, 42) for w in different), np.uint64, len(different)), tokens


def keys_of(hashes: list[np.ndarray]) -> np.ndarray:
    """The keys of n-grams (uint64): their words' hashes, each rotated by its place."""
    key = hashes[0].copy()
    for i, h in enumerate(hashes[1:], 1):
        turn = 17 * i % 64
        key ^= (h << np.uint64(turn)) | (h >> np.uint64(64 - turn))
    return key


# -- lists of numbers -------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on, the bytes of each weight compressed by themselves."""
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    out = [len(values).to_bytes(8, "little"), bytes([width])]
    for plane in planes:
        data = pa.compress(plane.tobytes(), codec="zstd", asbytes=True)
        out += [len(data).to_bytes(8, "little"), data]
    return b"".join(out)


def unpacked(data: bytes) -> np.ndarray:
    """The same numbers (uint64)."""
    length, width = int.from_bytes(data[:8], "little"), data[8]
    out = np.zeros((length, 8), np.uint8)
    begin = 9
    for weight in range(width):
        end = begin + 8 + int.from_bytes(data[begin : begin + 8], "little")
        out[:, weight] = np.frombuffer(pa.decompress(data[begin + 8 : end], decompressed_size=length, codec="zstd", asbytes=True), np.uint8)
        begin = end
    return out.view("<u8").reshape(-1)


def packed_rising(values: np.ndarray) -> bytes:
    """The same for a list in rising order, by differences."""
    values = values.astype(np.uint64)
    return (values[:1].tobytes() or bytes(8)) + packed(np.diff(values))


def unpacked_rising(data: bytes, length: int) -> np.ndarray:
    if not length:
        return np.empty(0, np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(data[:8], np.uint64), unpacked(data[8:])]), dtype=np.uint64)


# -- parts ------------------------------------------------------------------------------------


def _counted(rows: list[dict], size: int, least: int, highest: bool = False) -> Iterator[dict]:
    """Each chunk's answer: counts in training (a), the numbers of kept n-grams (b) and whether the chunk is the first to ask (c)."""
    counts = [unpacked(r["b"]).astype(np.int64) for r in rows]
    keys = np.concatenate([unpacked_rising(r["a"], len(n)) for r, n in zip(rows, counts)])
    ends = np.cumsum([len(n) for n in counts])
    at = np.argsort(keys, kind="stable")
    keys = keys[at]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    totals = np.add.reduceat(np.concatenate(counts)[at], starts) if len(starts) else np.empty(0, np.int64)
    kept, run = totals >= least, np.cumsum(new) - 1
    n, number, first = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64), np.zeros(len(keys), bool)
    n[at] = (totals if size == 1 else np.where(kept, totals, 0))[run]
    number[at] = np.where(kept, np.cumsum(kept) - 1, -1)[run]
    first[at[starts]] = True
    for row, begin, end in zip(rows, [0, *ends.tolist()], ends.tolist()):
        own, good = slice(begin, end), number[begin:end] >= 0
        yield row | {
            "a": packed(n[own]), "b": None if highest else packed_rising(number[own][good]), "c": np.packbits(first[own][good]).tobytes(),
            "room": int(kept.sum()), "seen": int((totals > 0).sum()),
        }


def _summed(rows: list[dict]) -> Iterator[dict]:
    """Each chunk's answer: three sums over all chunks for the numbers (a) that it needs (e)."""
    sums = np.zeros((3, rows[0]["room"]), np.int64)
    given = []
    for row in rows:
        values = [unpacked(row[name]).astype(np.int64) for name in "bcd"]
        given.append(unpacked_rising(row["a"], len(values[0])).astype(np.int64))
        for total, value in zip(sums, values):
            total[given[-1]] += value  # a chunk has a number once
    for row, numbers in zip(rows, given):
        numbers = numbers[np.unpackbits(np.frombuffer(row["e"], np.uint8), count=len(numbers)).astype(bool)]
        yield row | {name: packed(total[numbers]) for name, total in zip("abc", sums)} | {"seen": 0}


def _answers(asks: DataFrame, least: int, order: int) -> DataFrame:
    names = [f.split()[0] for f in ANSWERS.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("chunk").to_pylist()
        size = rows[0]["size"]
        answered = _counted(rows, size, least, size == order) if rows[0]["what"] == COUNT else _summed(rows)
        answered = [[r[name] for name in names] for r in answered]
        types = [pa.int32()] * 3 + [pa.int64()] + [pa.binary()] * 3 + [pa.int64()] * 2
        return pa.table([pa.array(c, t) for c, t in zip(zip(*answered), types)], names=names)

    return asks.groupBy("what", "size", "part").applyInArrow(run, ANSWERS)


# -- chunks -----------------------------------------------------------------------------------


def _chunks(rows: DataFrame) -> DataFrame:
    """Texts as numbers of their chunk's words: the hashes in rising order, the rank of each number's, the words as numbers, and
    each text's id, fold and length."""
    id_type = dict(rows.dtypes)["id"]
    names = ["chunk", "n_tokens", "n_training", "hashes", "ranks", "tokens", "id", "held_out", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        parts, size = [], 0

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches([ids for ids, _, _ in parts])
            lengths, held_out = np.concatenate([n for _, _, n in parts]), np.array(table.column(1).to_pylist(), bool)
            hashes, tokens = numbered([words for _, words, _ in parts], lengths)
            columns = [pa.array([int(v)], pa.int64()) for v in (chunk, lengths.sum(), lengths[~held_out].sum())]
            at = np.argsort(hashes)
            columns += [pa.array([v], pa.binary()) for v in (packed_rising(hashes[at]), packed(np.argsort(at)), packed(tokens))]
            for values in (pa.concat_arrays(table.column(0).chunks), pa.array(held_out), pa.array(lengths, pa.int64())):
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in slices(batches, 2):
            parts.append((batch.select([0, 1]), *words_of(batch.column(2))))
            size += int(parts[-1][2].sum())
            if size > HELD_TOKENS:
                yield flush()
                chunk, parts, size = chunk + 1, [], 0
        if parts:
            yield flush()

    schema = f"chunk long, n_tokens long, n_training long, hashes binary, ranks binary, tokens binary, id array<{id_type}>, held_out array<boolean>, length array<long>"
    return rows.mapInArrow(run, schema)


class Buckets:
    """A table of rows by chunk: as many buckets as chunks, so what it holds meets what another one holds without a shuffle."""

    def __init__(self, spark: SparkSession, name: str, n_chunks: int):
        self.spark, self.n_chunks, self.path = spark, n_chunks, shared_dir(spark, name)
        self.table = f"lm_{name}_{uuid4().hex}"

    def add(self, rows: DataFrame) -> None:
        rows.write.bucketBy(self.n_chunks, "chunk").mode("append").option("path", self.path).saveAsTable(self.table)

    def deal(self, rows: DataFrame) -> None:
        """The same for rows that lie elsewhere. They are stored before they are dealt, so that what they were made from goes first."""
        folder = shared_dir(self.spark, "undealt")
        rows.write.parquet(folder)
        self.add(self.spark.read.schema(rows.schema).parquet(folder).repartition(self.n_chunks, "chunk"))
        delete(self.spark, folder)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def forget(self) -> None:
        """Take its name out of the catalog. The files stay, and so does what was read of it."""
        self.spark.sql(f"DROP TABLE {self.table}")


def at_places(values: np.ndarray, place: np.ndarray, fill: int) -> np.ndarray:
    out = np.full(len(place), fill, values.dtype)
    found = place >= 0
    out[found] = values[place[found]]
    return out


class Grams:
    """The different n-grams of one size in a chunk, in rising order of their keys, whose high ends name the parts.

    place: for each token the n-gram that begins there, or -1; first: a place where each begins; from the answers: n, its count in
    training (0: not kept, of words not seen), number (-1: not kept), own (whether this chunk gives its share).
    """

    def __init__(self, size: int, keys: np.ndarray | None, place: np.ndarray, first: np.ndarray):
        self.size, self.keys, self.place, self.first = size, keys, place, first

    def asks(self, training: np.ndarray, bits: int) -> Iterator[dict]:
        begins = [part << (64 - bits) for part in range(1, 1 << bits)]
        cuts = [0, *np.searchsorted(self.keys, np.array(begins, np.uint64)).tolist(), len(self.keys)]
        n = np.bincount(self.place[training & (self.place >= 0)], minlength=len(self.keys))
        for part, (begin, end) in enumerate(zip(cuts, cuts[1:])):
            yield {"what": COUNT, "size": self.size, "part": part, "a": packed_rising(self.keys[begin:end]), "b": packed(n[begin:end])}

    def hear(self, answers: list[dict], least: int) -> None:
        found = [unpacked(r["a"]).astype(np.int64) for r in answers]
        self.n = np.concatenate(found)
        good = self.n >= least
        self.kept = np.flatnonzero(good)
        sizes = [int((n >= least).sum()) for n in found]
        self.ends = np.cumsum([0, *sizes]).tolist()
        self.own = np.zeros(len(good), bool)
        own = [np.unpackbits(np.frombuffer(r["c"], np.uint8), count=size) for r, size in zip(answers, sizes)]
        self.own[self.kept] = np.concatenate(own).astype(bool)
        if answers[0]["b"] is None:  # nothing goes on from those of the highest order
            return
        self.numbers = [unpacked_rising(r["b"], size).astype(np.int64) for r, size in zip(answers, sizes)]
        self.rooms = [r["room"] for r in answers]
        before = np.cumsum([0, *self.rooms]).tolist()
        self.number = np.full(len(good), -1)
        self.number[self.kept] = np.concatenate([numbers + b for numbers, b in zip(self.numbers, before)])


class Chunk:
    """The texts of a chunk, and what it was told of their n-grams."""

    def __init__(self, row: dict, bits: int, least: int, base: int, answers: pa.Table | None = None):
        self.bits, self.least, self.base = bits, least, base
        self.lengths = np.array(row["length"])
        self.training = np.repeat(~np.array(row["held_out"], bool), self.lengths)
        ranks, tokens = unpacked(row["ranks"]).astype(np.int64), unpacked(row["tokens"]).astype(np.int64)
        self.tokens, first = ranks[tokens], np.empty(len(ranks), np.int64)
        first[self.tokens] = np.arange(len(tokens))
        self.end = self.tokens[-1]  # the end token's number
        hashes = unpacked_rising(row["hashes"], len(ranks)) if "hashes" in row else None  # asked for in the first round only
        self.grams = [Grams(1, hashes, self.tokens, first)]
        self.sums = {}
        told = {}
        for r in answers.sort_by("part").to_pylist() if answers else []:
            told.setdefault((r["what"], r["size"]), []).append(r)
        for (what, size), rows in sorted(told.items()):
            if what == SUM:
                needed, self.sums[size] = self.needed(size), []
                for name in "abc":
                    self.sums[size].append(np.zeros(len(needed), np.int64))
                    self.sums[size][-1][needed] = np.concatenate([unpacked(r[name]) for r in rows])
                continue
            if size > 1:
                self.grams.append(self.longer())
            self.grams[-1].hear(rows, least)

    def longer(self) -> Grams:
        """The n-grams one word longer than the longest known, as far as they may be kept."""
        size, length = len(self.grams) + 1, max(0, len(self.tokens) - len(self.grams))
        number = [at_places(g.number, g.place, -1) for g in (self.grams[0], self.grams[-1])]
        good = (number[1][:length] >= 0) & (number[1][1 : length + 1] >= 0)
        if size == 2:  # nothing goes on behind an end token
            good &= self.tokens[:length] != self.end
        at = np.flatnonzero(good)
        keys = number[1][at].astype(np.uint64) * np.uint64(self.base) + number[0][at + size - 1].astype(np.uint64)
        if self.bits:  # the low end, in which neighbours differ, becomes the high one
            keys = (keys >> np.uint64(self.bits)) | (keys << np.uint64(64 - self.bits))
        order = np.argsort(keys)
        keys, new = keys[order], np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        which, place = np.empty(len(keys), np.int64), np.full(len(self.tokens), -1)
        which[order] = np.cumsum(new) - 1
        place[at] = which
        return Grams(size, keys[new], place, at[order[new]])

    def needed(self, size: int) -> np.ndarray:
        """Which kept n-grams of a size are somewhere followed by a word to which they have no arc, so that their failure arc may be taken."""
        context, longer = self.grams[size - 1], self.grams[size]
        length = max(0, len(self.tokens) - size + 1)
        fails = ~at_places(longer.n > 0, longer.place, False)[:length] & (context.place[:length] >= 0)
        fails &= self.tokens[size - 1 :] != self.end  # nothing follows the end of a text
        out = np.zeros(len(context.n), bool)
        out[context.place[:length][fails]] = True
        return out[context.kept]

    def share_asks(self, size: int) -> Iterator[dict]:
        """Of the kept n-grams of a size, what this chunk adds to the sums of their kept continuations: how many, their counts,
        and the counts of what they are without their first word. Those to which it adds nothing and whose sums it does not need
        are left out."""
        context, longer = self.grams[size - 1], self.grams[size]
        own = longer.own & (longer.n > 0)
        first = longer.first[own]
        of, n, lower = context.place[first], longer.n[own], context.n[context.place[first + 1]]
        sums = [np.bincount(of, weights=w, minlength=len(context.n)).astype(np.int64)[context.kept] for w in (None, n, lower)]
        needed = self.needed(size)
        asked = needed | (sums[0] > 0)
        for part, (begin, end) in enumerate(zip(context.ends, context.ends[1:])):
            some = asked[begin:end]
            values = {name: packed(s[begin:end][some]) for name, s in zip("bcd", sums)}
            values |= {"a": packed_rising(context.numbers[part][some]), "e": np.packbits(needed[begin:end][some]).tobytes()}
            yield {"what": SUM, "size": size, "part": part, "room": context.rooms[part]} | values

    def failures(self, size: int, total: float) -> np.ndarray:
        """The weights of the failure arcs of the n-grams of a size."""
        grams, out = self.grams[size - 1], np.zeros(len(self.grams[size - 1].n))
        if size in self.sums:
            k, n, lower = self.sums[size]
            left = 1 - (n - DISCOUNT * k) / grams.n[grams.kept]
            if size == 1:
                below = 1 - (lower + ADD * k) / total
            else:
                shorter = self.grams[size - 2]
                below = 1 - (lower - DISCOUNT * k) / shorter.n[shorter.place[grams.first[grams.kept] + 1]]
            some = k > 0
            out[grams.kept[some]] = np.log10(left[some] / below[some])
        return out

    def arcs(self, total: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of the n-grams of each size: whether there is one in the automaton, its arc, and its failure arc."""
        out = []
        for size, grams in enumerate(self.grams, 1):
            there = grams.n > 0
            if size == 1:
                arc = np.log10((grams.n + ADD) / total)
            else:
                shorter, arc = self.grams[size - 2], np.zeros(len(there))
                arc[there] = np.log10((grams.n[there] - DISCOUNT) / shorter.n[shorter.place[grams.first[there]]])
            out.append((there, arc, self.failures(size, total)))
        return out

    def ending(self, size: int, begin: int, end: int) -> np.ndarray:
        """The n-gram of a size that ends at each token of a range, or -1."""
        start, place = begin - size + 1, self.grams[size - 1].place
        short = min(max(0, -start), end - begin)  # no n-gram ends at the first tokens
        return np.concatenate([np.full(short, -1), place[max(0, start) : max(0, end - size + 1)]])


# -- the automaton ----------------------------------------------------------------------------


def walk(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], ends: np.ndarray) -> list[tuple[int, float, float]]:
    """(known words, unigram score, score) of texts that follow one another and end at `ends`.

    levels: of the n-grams of each order that end at a token: whether there is one in the same text, its arc, and its failure arc.
    With an n-gram there are all that it is made of.
    """
    known, unigram, _ = levels[0]
    sizes, arcs = np.ones(len(known), np.int64), unigram.copy()  # of the longest n-gram that ends at a token
    for size, (there, arc, _) in enumerate(levels[1:], 2):
        sizes[there], arcs[there] = size, arc[there]
    states = np.where(known, np.minimum(sizes, len(levels) - 1), 0).tolist()  # where its arc leads to: a state of so many words
    sizes, arcs, failures = sizes.tolist(), arcs.tolist(), [None, *(failure.tolist() for _, _, failure in levels)]
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    paths = []
    for begin, end in zip(begins.tolist(), ends.tolist()):
        state, path = 0, 0.0
        for token in range(begin, end):
            size = sizes[token]
            while state >= size:  # no arc for this token
                path += failures[state][token - 1]
                state -= 1
            path += arcs[token]
            state = states[token]
        paths.append(path)
    return list(zip(np.add.reduceat(known.astype(np.int64), begins).tolist(), np.add.reduceat(unigram, begins).tolist(), paths))


class Automaton:
    """An automaton by itself: arcs and failure arcs by key."""

    def __init__(self, order: int, unseen: float, keys: np.ndarray, arcs: np.ndarray, failures: np.ndarray):
        at = np.argsort(keys)
        self.order, self.unseen = order, unseen
        self.keys, self.arcs, self.failures = keys[at], arcs[at], failures[at]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether there is an n-gram of each key, its arc and its failure arc."""
        there, arc, failure = np.zeros(len(keys), bool), np.full(len(keys), self.unseen), np.zeros(len(keys))
        if len(self.keys):
            at = np.searchsorted(self.keys, keys)
            at[at == len(self.keys)] = 0
            there = self.keys[at] == keys
            arc[there], failure[there] = self.arcs[at[there]], self.failures[at[there]]
        return there, arc, failure

    def traverse(self, hashes: np.ndarray, ends: list[int]) -> list[tuple[int, float, float]]:
        """(known words, unigram score, score) of texts that follow one another in `hashes` and end at `ends`."""
        levels, ends = [], np.array(ends)
        begins = np.concatenate([[0], ends[:-1]])
        for size in range(1, self.order + 1):
            length, level = max(len(hashes) - size + 1, 0), []
            within = np.arange(len(hashes)) - np.repeat(begins, np.diff(ends, prepend=0)) >= size - 1
            for values in self.find(keys_of([hashes[i : i + length] for i in range(size)])):
                short = np.zeros(len(hashes) - length, values.dtype)  # no n-gram ends at the first tokens
                level.append(np.concatenate([short, values]))
            levels.append((level[0] & within, *level[1:]))
        return walk(levels, ends)


def _traversed(chunk: Chunk, total: float) -> list[tuple[int, float, float]]:
    """The scores of a chunk's texts by its part of the automaton, some texts at a time."""
    arcs, ends, out = chunk.arcs(total), np.cumsum(chunk.lengths), []
    for texts in np.split(ends, np.flatnonzero(np.diff(ends // WALKED)) + 1):
        begin, end = int(ends[len(out) - 1]) if out else 0, int(texts[-1])
        places = [chunk.ending(size, begin, end) for size in range(1, len(arcs) + 1)]
        levels = [tuple(at_places(values, place, 0) for values in level) for level, place in zip(arcs, places)]
        out += walk(levels, texts - begin)
    return out


# -- the operator -----------------------------------------------------------------------------


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = ORDER, head: float = HEAD,
          share: float = 0.0) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    held_out = F.coalesce(residue(id, 10) == 0, F.lit(False))
    rows = docs.select(F.col(id).alias("id"), held_out.alias("held_out"), F.col(text).alias("text"))
    spark = docs.sparkSession
    with shuffles_removed(spark):
        scored, n = _scored(spark, rows, order, share)
    return scored.select(
        F.col("id").alias(id), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _scored(spark: SparkSession, rows: DataFrame, order: int, share: float) -> tuple[DataFrame, int]:
    id_type, folder = dict(rows.dtypes)["id"], shared_dir(spark, "chunks")
    chunks = _chunks(rows)
    chunks.write.parquet(folder)
    chunks = spark.read.schema(chunks.schema).parquet(folder)
    n_tokens, n, n_chunks = (v or 0 for v in chunks.agg(F.sum("n_tokens"), F.sum("n_training"), F.count("chunk")).first())
    n_chunks = max(1, n_chunks)
    texts, told = (Buckets(spark, name, n_chunks) for name in ("texts", "answers"))
    bits = max(0, math.ceil(n_tokens / PART_TOKENS) - 1).bit_length()
    least = max(LEAST, math.ceil(share * n))
    ask_names = [f.split()[0] for f in ASKS.split(", ")]
    ask_types = [pa.int32()] * 3 + [pa.int64()] + [pa.binary()] * 5 + [pa.int64()]

    def sent(asks: Iterable[dict], chunk: int) -> pa.RecordBatch:
        rows = [[(r | {"chunk": chunk}).get(name) for name in ask_names] for r in asks]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ask_types)], names=ask_names)

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                [row] = batch.slice(i, 1).to_pylist()
                own = Chunk(row, bits, least, 0)
                yield sent(own.grams[0].asks(own.training, bits), row["chunk"])

    needed = chunks.select("chunk", "hashes", "ranks", "tokens", "held_out", "length")
    told.deal(_answers(needed.mapInArrow(ask_words, ASKS), least, order))
    texts.add(chunks.select("chunk", "ranks", "tokens", "id", "held_out", "length"))
    delete(spark, folder)  # what is needed of it is in the buckets
    parts = stored(told.rows().groupBy("part").agg(F.first("room").alias("room"), F.first("seen").alias("seen")), "parts")
    kept, distinct = (v or 0 for v in parts.agg(F.sum("room"), F.sum("seen")).first())
    total = n + ADD * (distinct + 1)
    base = kept | 1  # odd, so that n-grams of one last word are dealt to all parts, and those of one beginning too

    def chunk_of(table: pa.Table, answers: pa.Table) -> tuple[dict, Chunk]:
        [row] = table.drop_columns("id").to_pylist()
        return row, Chunk(row, bits, least, base, answers)

    def asking(what: int, size: int):
        def run(table: pa.Table, answers: pa.Table) -> pa.Table:
            row, own = chunk_of(table, answers)
            asks = own.longer().asks(own.training, bits) if what == COUNT else own.share_asks(size)
            return pa.Table.from_batches([sent(asks, row["chunk"])])

        return run

    def scores(table: pa.Table, answers: pa.Table) -> pa.Table:
        _, own = chunk_of(table, answers)
        known, base_score, path = zip(*_traversed(own, total))
        ids, held_out = (table.column(name).combine_chunks().flatten() for name in ("id", "held_out"))
        columns = [ids, held_out, own.lengths, known, base_score, path]
        return pa.table(columns, names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    def told_chunks():
        return texts.rows().groupBy("chunk").cogroup(told.rows().groupBy("chunk"))

    for what, size in [(COUNT, size) for size in range(2, order + 1)] + [(SUM, size) for size in range(1, order)]:
        told.deal(_answers(told_chunks().applyInArrow(asking(what, size), ASKS), least, order))
    scored = told_chunks().applyInArrow(
        scores, f"id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    for bucket in (texts, told):
        bucket.forget()
    return scored, n
