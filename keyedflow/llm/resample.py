"""Importance resampling of documents towards a target text, by hashed n-grams counted over distinct lines.

Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case; features are the runs of 1 and 2
consecutive words, each hashed into one of `buckets` by crc32. A document's weight is the floored mean of its features'
gains, log ratios of the target's and the corpus's smoothed bucket shares. With noise from a hash of the id
added, the highest scores are a draw without replacement (Gumbel top-k).

Separator newlines cut a text into segments, as no word holds one. A first pass gives of each document the digests of its
segments and the buckets of the few features that cross from one line with words to the next; segments are the words of a
line joined by one space. The segments themselves are counted, so each distinct one is hashed into buckets once, for all
documents: its counts times its occurrences are what it adds to the corpus, and the gains of its features, added up once, are
what it gives to each document that holds it. Sums are integers, so the result does not depend on partitions or retries.

At scale: segments are counted in each task before the shuffle. Segments found in so large a share of places that they would make
a partition of the join uneven are few (at most two for each partition) and broadcast; the others are joined by digest. The driver
gets the bucket counts (`buckets` rows) and a row for each range of the final order. Stored are the documents' digests, 16 bytes
a line, and the distinct segments' buckets, two or four bytes a feature; texts are read twice and not stored.

Null and empty texts have no words: weight 0. A null id draws its noise as an empty text. Very long texts are cut into their lines and go
through tasks in slices of bounded size; one line is held whole. Repeated rows are documents of their own. Ties of score go to the smaller id
(null first), then to equal rows in any order. An empty table gives an empty one, an empty target has no counts. Only the id and the
text are read, so other columns and their names do no harm. Digests are 128 bits; results are exact but for their collisions.
"""

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, stored

DIGEST = 16
_WORD = (*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100))
#: Bytes that part words become spaces, but for the newline; A-Z become a-z.
_FOLD = bytes(10 if b == 10 else b + 32 * (0x41 <= b <= 0x5A) if b in _WORD else 32 for b in range(256))


def segments(text: str | None) -> list[list[bytes]]:
    """The words of each line that has any."""
    folded = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    return [words for line in folded.split(b"\n") if (words := line.split())]


def features(words: list[bytes]) -> list[int]:
    """crc32 of each word and of each two neighbours joined by a space."""
    single = list(map(crc32, words))
    return single + list(map(crc32, [b" " + w for w in words[1:]], single))


def crossing(lines: list[list[bytes]]) -> list[int]:
    """crc32 of the pairs of words that have a line's end between them."""
    return [crc32(b"%b %b" % (a[-1], b[0])) for a, b in zip(lines, lines[1:])]


def _packed(hashes: list[int], buckets: int) -> bytes:
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    return (np.array(hashes, np.uint32) % np.uint32(buckets)).astype(kind).tobytes()


def _unpacked(packed: bytes, buckets: int) -> np.ndarray:
    return np.frombuffer(packed, "<u2" if buckets <= 1 << 16 else "<u4")


def _outlines(docs: DataFrame, id: str, text: str, buckets: int) -> DataFrame:
    """(row, id, n_words, keys, crossing) of each document, stored: no text in it.

    `keys` holds the distinct segments' digests one after another, each as often as it occurs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            n_words, keys, crossed = [], [], []
            for value in batch.column(1).to_pylist():
                lines = segments(value)
                n_words.append(sum(map(len, lines)))
                keys.append([blake2b(b" ".join(words), digest_size=DIGEST).digest() for words in lines])
                crossed.append(_packed(crossing(lines), buckets))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(keys, pa.list_(pa.binary())), pa.array(crossed, pa.binary())],
                names=["id", "n_words", "keys", "crossed"],
            )

    read = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    made = read.mapInArrow(run, "id long, n_words long, keys array<binary>, crossed binary")
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "outlines")


def _distinct_segments(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """(key, n, buckets): each distinct segment's digest, occurrences and features' buckets, stored."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            found = Counter(b" ".join(words) for value in batch.column(0).to_pylist() for words in segments(value))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["segment", "n"]
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([blake2b(t, digest_size=DIGEST).digest() for t in texts], pa.binary()), batch.column(1),
                pa.array([_packed(features(t.split(b" ")), buckets) for t in texts], pa.binary()),
            ], names=["key", "n", "buckets"])

    lines = docs.select(F.col(text).alias("text")).mapInArrow(cut, "segment binary, n long")
    distinct = lines.groupBy("segment").agg(F.sum("n").alias("n"))
    return stored(distinct.mapInArrow(hashed, "key binary, n long, buckets binary"), "segments")


def _joined(packed: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch in one array, and where each row's end."""
    joined = _unpacked(b"".join(packed), buckets)
    width = joined.itemsize
    return joined, np.cumsum([len(p) // width for p in packed], dtype=np.int64)


def _bucket_counts(packed: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences by bucket of (buckets, n) rows: added up in each task, then by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, 0):
            values, ends = _joined(batch.column(0).to_pylist(), buckets)
            np.add.at(total, values, np.repeat(batch.column(1).to_numpy(), np.diff(ends, prepend=0)))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for row in packed.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def feature_counts(outlines: DataFrame, distinct: DataFrame, buckets: int) -> np.ndarray:
    """Features by bucket: those of distinct segments times their occurrences, and those that cross lines."""
    within = _bucket_counts(distinct.select("buckets", "n"), buckets)
    return within + _bucket_counts(outlines.select("crossed", F.lit(1).cast("long").alias("n")), buckets)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, rounded down."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (s_all + buckets) / ((float(s) + 1) * (t_all + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def _gain_sums(rows: DataFrame, keep: str, gain: np.ndarray) -> DataFrame:
    """`gain` added up over the buckets of each row, behind the columns of the DDL `keep`; rows hold those, then buckets."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ends = _joined(batch.columns[-1].to_pylist(), buckets)
            sums = np.concatenate([[0], np.cumsum(gain[values])])[np.concatenate([[0], ends])]
            kept = [*batch.columns[:-1], pa.array(np.diff(sums), pa.int64())]
            yield pa.RecordBatch.from_arrays(kept, names=[*batch.schema.names[:-1], "total"])

    return rows.mapInArrow(run, f"{keep}, total long")


def _totals(outlines: DataFrame, distinct: DataFrame, gain: np.ndarray) -> DataFrame:
    """(row, id, n_words, total) of each document: the gains of its segments and of its crossing features."""
    of_segment = _gain_sums(distinct.select("key", "n", "buckets"), "key binary, n long", gain)
    # At most 2 * partitions segments hold so large a share of all places.
    partitions = int(outlines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = distinct.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * (2 * partitions) >= max(places, 1)
    frequent = of_segment.where(hot).select("key", F.col("total").alias("hot_total"))
    placed = outlines.select("row", F.explode("keys").alias("key")).join(F.broadcast(frequent), "key", "left")
    rare = placed.where("hot_total is null").select("row", "key").join(of_segment.where(~hot).select("key", "total"), "key")
    own = _gain_sums(outlines.select("row", "id", "n_words", "crossed"), "row long, id long, n_words long", gain)
    missing = [F.lit(None).cast("long").alias(c) for c in ("id", "n_words")]
    parts = own.union(rare.select("row", *missing, "total")).union(
        placed.where("hot_total is not null").select("row", *missing, "hot_total")
    )
    return parts.groupBy("row").agg(F.max("id").alias("id"), F.max("n_words").alias("n_words"), F.sum("total").alias("total"))


def noise(id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of sha256("seed:id")."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`rows` with `rank`, from 1, in a total order, without one task that holds them all.

    Ranges of the order are sorted each by itself and stored with every row's place in its range; a range's first
    rank is the number of rows in the ranges before. One small row a range is added up in one task.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(dealt.withColumn("place", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumns({"range": F.shiftright("place", 33), "place": F.col("place").bitwiseAND((1 << 33) - 1)})
    before = F.expr("coalesce(sum(n) over (order by range rows between unbounded preceding and 1 preceding), 0)")
    starts = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", before.alias("start"))
    found = placed.join(F.broadcast(starts), "range")
    return found.select(*rows.columns, (F.col("start") + F.col("place") + 1).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = 10_000, least_words: int = 20, percent: int = 25, seed: int = 7,
    id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; `rank` is null unless the document is drawn.

    `percent` of the documents with at least `least_words` words are drawn, rounded down.
    """
    outlines, distinct = _outlines(docs, id, text, buckets), _distinct_segments(docs, text, buckets)
    wanted = target.select(F.lit(None).alias("id"), F.col(target_text).alias("text"))
    aim = feature_counts(_outlines(wanted, "id", "text", buckets), _distinct_segments(wanted, "text", buckets), buckets)
    gain = gains(feature_counts(outlines, distinct, buckets), aim)
    n_features = F.greatest(2 * F.col("n_words") - 1, F.lit(0))  # n words and n - 1 pairs
    mean = F.expr("case when n_features > 0 then (total - pmod(total, n_features)) div n_features else 0L end")
    weighed = _totals(outlines, distinct, gain).withColumn("n_features", n_features).withColumn("weight", mean)
    scored = stored(weighed.select(
        "row", "id", "n_words", "n_features", "weight", (F.col("weight") + noise(F.col("id"), seed)).alias("score")
    ), "scored")
    eligible = scored.where(F.col("n_words") >= least_words)
    drawn = eligible.count() * percent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("row").asc()]
    first = ranked(eligible, order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return first.union(others).select(F.col("id").alias(id), "n_features", "weight", "score", "rank")
