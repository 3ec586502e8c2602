"""Benchmark decontamination with suffix arrays of the training texts.

Words are runs of letters and digits (all of U+0080 and above count), A-Z in lower case. The training words of a task are
taken in shards. For a shard, the positions of its words are sorted by the `window` words that follow: a suffix array to
the depth that matters, over those suffixes only whose first words begin some test suffix, as no other can be found. Each
test suffix is then looked up by binary search for both ends of its range, which gives all its places; places that
follow one another in both texts are one match, so matches come out at their longest, with their locations.

Test items of fewer than `window` words are looked up whole. The benchmark is dealt to blocks of at most `BLOCK_BYTES`;
each block is broadcast and takes one pass over the documents. With a single block that is all, without a shuffle. With more,
the documents are stored with a row number; a pass stores what it found by row, and its block is freed before the next is
brought to the driver; the passes are joined by row at the end. So what is held at once has a bound, and the number of blocks
grows with the benchmark. A lost task is run again.

Null and empty texts and items have no words and match nothing. Repeated rows each get their result. With an
empty benchmark no document is affected. Other columns are passed on, results replace columns of their names.
"""

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import slices, stored

WINDOW, BLOCK_BYTES, SHARD_WORDS = 10, 16 << 20, 1 << 20

MATCHES = "array<struct<item:string,item_start:int,start:int,words:int>>"

#: Bytes to bytes: A-Z in lower case, everything in ASCII that is no letter or digit to a space.
_FOLD = bytes(
    b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class TestSuffixes:
    """The windows of a block of test items, as numbers of their words."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window = window
        self.names, self.vocabulary = [], {}
        keys: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for name, text in items:
            number = self.vocabulary
            ids = [number.setdefault(w, len(number) + 1) for w in words_of(text)]
            for start in range(max(len(ids) - window + 1, min(len(ids), 1))):
                keys.setdefault(tuple(ids[start : start + window]), []).append((len(self.names), start))
            self.names.append(name)
        self.places = list(keys.values())
        self.lengths = np.array([len(k) for k in keys], np.int64)
        padded = np.zeros((len(keys), window), ">u4")
        for row, key in zip(padded, keys):
            row[: len(key)] = key
        self.low = self._bytes(padded)
        for row, key in zip(padded, keys):
            row[len(key) :] = 0xFFFFFFFF
        self.high = self._bytes(padded)
        # What the first words of a suffix must be for it to matter.
        self.depth = int(min(self.lengths.min(), 2)) if keys else 1
        base = len(self.vocabulary) + 1
        self.base = base
        self.heads = np.unique([k[0] if self.depth == 1 else k[0] * base + k[1] for k in keys])

    def _bytes(self, rows: np.ndarray) -> np.ndarray:
        """Rows as byte strings, which compare like their numbers in order."""
        return np.array(rows, order="C").view(f"S{4 * self.window}").ravel()

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence in `ids`, where 0 is any other word."""
        ids = np.concatenate([ids, np.zeros(self.window, np.int64)])
        n = len(ids) - self.window
        head = ids[:n] if self.depth == 1 else ids[:n] * self.base + ids[1 : n + 1]
        at = np.searchsorted(self.heads, head)
        at[at == len(self.heads)] = 0
        starts = np.flatnonzero((self.heads[at] == head) & (ids[:n] > 0)) if len(self.heads) else []
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = self._bytes(ids[starts[:, None] + np.arange(self.window)].astype(">u4"))
        order = np.argsort(keys, kind="stable")
        array, keys = starts[order], keys[order]
        first = np.searchsorted(keys, self.low, "left")
        count = np.searchsorted(keys, self.high, "right") - first
        found = np.flatnonzero(count > 0)
        count, first = count[found], first[found]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(found, count), array[np.repeat(first, count) + within]

    def matches(self, docs: list[list[bytes]]) -> list[list[dict]]:
        """For each document its longest verbatim matches."""
        get, zero = self.vocabulary.get, repeat(0)
        sizes = np.array([len(d) + 1 for d in docs])  # a 0 ends each document
        ids = np.zeros(int(sizes.sum()), np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        for words, start in zip(docs, bounds.tolist()):
            ids[start : start + len(words)] = np.fromiter(map(get, words, zero), np.int64, len(words))
        window, position = self.find(ids)
        out: list[list[dict]] = [[] for _ in docs]
        if not len(window):
            return out
        # Every place of a window in the items, next to every place of it here.
        uses = np.array([len(p) for p in self.places])[window]
        flat = np.array([p for ps in self.places for p in ps], np.int64).reshape(-1, 2)
        first = np.concatenate([[0], np.cumsum([len(p) for p in self.places])])[window]
        within = np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
        item, offset = flat[np.repeat(first, uses) + within].T
        position, length = np.repeat(position, uses), np.repeat(self.lengths[window], uses)
        order = np.lexsort((position, position - offset, item))
        item, offset, position, length = (a[order] for a in (item, offset, position, length))
        new = np.ones(len(item), bool)
        new[1:] = (
            (np.diff(item) != 0) | (np.diff(position) != 1) | (np.diff(position - offset) != 0)
            | (length[1:] < self.window)
        )
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(item)) - 1
        doc = np.searchsorted(bounds, position[begin], "right") - 1
        total = position[end] + length[end] - position[begin]
        for d, i, o, p, n in zip(
            doc.tolist(), item[begin].tolist(), offset[begin].tolist(),
            (position[begin] - bounds[doc]).tolist(), total.tolist(),
        ):
            out[d].append({"item": self.names[i], "item_start": o, "start": p, "words": n})
        return out


def _dealt(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The items with words, and the number of blocks that they are dealt to."""
    items = benchmark.where(F.col(text) != "").select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    return items, math.ceil(total / block_bytes)


def _block(items: DataFrame, blocks: int, n: int) -> list[tuple[str, str]]:
    """The items of a block; what is brought to the driver at once has that size."""
    part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == n) if blocks else items.limit(0)
    return [(r["item"], r["text"]) for r in part.collect()]


def _pass(docs: DataFrame, text: str, sent: Broadcast, window: int, keep_text: bool) -> DataFrame:
    """`docs`, whose last column is the text, with `n_words` and `matches` in one block."""
    columns = docs.columns[:-1]
    at = len(columns)
    schema = T.StructType([
        *docs.select(*columns).schema, T.StructField("n_words", T.LongType()),
        *docs.select(F.lit(None).cast(MATCHES).alias("matches")).schema, *(docs.select(text).schema if keep_text else []),
    ])
    matches_type = pa.list_(pa.struct([
        ("item", pa.string()), ("item_start", pa.int32()), ("start", pa.int32()), ("words", pa.int32())
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(sent.value, window)
        for batch in slices(batches, at, 16 << 20):
            found, counts, shard, size = [], [], [], 0
            for value in batch.column(at):
                words = words_of(value.as_py())
                counts.append(len(words))
                shard.append(words)
                size += len(words)
                if size >= SHARD_WORDS:
                    found += tests.matches(shard)
                    shard, size = [], 0
            found += tests.matches(shard) if shard else []
            arrays = [*batch.columns[:at], pa.array(counts, pa.int64()), pa.array(found, matches_type), batch.column(at)]
            yield pa.RecordBatch.from_arrays(arrays[: len(schema)], names=schema.names)

    return docs.mapInArrow(run, schema)


def find_matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep_text: bool = True,
) -> DataFrame:
    """`docs` with `n_words` and `matches`: of each longest verbatim match the item, the word at which it
    begins there and here, and its words. Without `keep_text` the text is left out."""
    context = docs.sparkSession.sparkContext
    docs = docs.drop("n_words", "matches")
    columns = [c for c in docs.columns if c != text]
    docs = docs.select(*columns, text)
    items, blocks = _dealt(benchmark, item, item_text, block_bytes)
    if blocks < 2:
        return _pass(docs, text, context.broadcast(_block(items, blocks, 0)), window, keep_text)
    row = "_row"
    while row in docs.columns:
        row += "_"
    docs = stored(docs.select(F.monotonically_increasing_id().alias(row), "*"), "numbered")
    passes = []
    for n in range(blocks):
        sent = context.broadcast(_block(items, blocks, n))
        found = _pass(docs.select(row, text), text, sent, window, False)
        # The first pass gives every row its number of words.
        found = found if n == 0 else found.where(F.size("matches") > 0)
        passes.append(stored(found.withColumn("pass", F.lit(n)), f"matches{n}"))
        sent.destroy()
        del sent, found  # else the driver holds this block while it collects the next
    by_pass = F.array_sort(F.collect_list(F.struct("pass", "matches")))
    found = reduce(DataFrame.union, passes).groupBy(row).agg(
        F.max(F.when(F.col("pass") == 0, F.col("n_words"))).alias("n_words"),
        F.flatten(F.transform(by_pass, lambda p: p["matches"])).alias("matches"),
    )
    return docs.join(found, row).select(*columns, "n_words", "matches", *([text] if keep_text else []))


def n_hit() -> Column:
    """Words inside any match: the union of the spans in `matches`."""
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["start"], (m["start"] + m["words"]).alias("end"))))
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("total"))

    def add(acc, span):
        new = F.greatest(span["end"] - F.greatest(span["start"], acc["upto"]), F.lit(0))
        return F.struct(F.greatest(acc["upto"], span["end"]).alias("upto"), (acc["total"] + new).alias("total"))

    return F.aggregate(spans, start, add, lambda acc: acc["total"])


def items() -> Column:
    """The items with a match, sorted as strings."""
    return F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` without those that hold a window of any item, in the columns they had."""
    found = find_matches(docs, benchmark, text, **options)
    return found.where(F.size("matches") == 0).select(*docs.columns)
