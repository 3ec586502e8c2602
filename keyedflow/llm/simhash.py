"""Near-duplicates by 64-bit simhash, compared exactly in tiles.

A fingerprint takes, bit by bit, the majority over the hashes of a text's shingles. Two fingerprints link when they differ in
at most `radius` bits. Equal fingerprints are one from the start. The distinct ones are laid out in tiles: of
`radius + 1` segments of the 64 bits, two linked fingerprints agree in at least one, so only tiles of the same segment value
meet, and no link is lost. Tiles hold at most `tile` fingerprints or so; where a segment value has more, they are dealt by
population count and hash, and a pair of tiles whose population counts differ by more than the radius is skipped. Within a
pair of tiles, fingerprints are compared by numpy: exclusive-or and bit counts, in blocks sorted by population count, which
are skipped alike. A pair of tiles gives a spanning forest of its links, never all pairs. Components are then
joined by the large-star, small-star algorithm on these links, each round written to the shared folder.

Nulls are empty texts; texts without a shingle have fingerprint zero and link like any other. Rows of one id count as one
node when fingerprints coincide. Empty tables give empty ones. Other columns are passed on.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import keeps_other_columns, slices, stored

RADIUS, TILE, BLOCK = 4, 2048, 512


# -- fingerprints -----------------------------------------------------------------------------


def fingerprint_of(text: str, size: int = 4) -> int:
    """Words are lower-cased in A-Z and end at U+0020 and U+0009 to U+000D; shingles hold `size` words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return digest(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    n = len(starts)
    hashes = np.fromiter(
        (digest(joined[s:e], 42) for s, e in zip(starts, ends[size - 1 :].tolist())), np.uint64, n
    )
    counts = np.zeros(64, np.int64)
    for part in range(0, n, 65536):  # bits of a very long text, a part at a time
        raw = hashes[part : part + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


@keeps_other_columns("text")
def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4) -> DataFrame:
    """`docs` with `fingerprint` (long, its 64 bits) in place of `text`; whole texts."""
    kept = docs.drop(text, "fingerprint")
    schema = T.StructType([*kept.schema, T.StructField("fingerprint", T.LongType())])
    width = len(kept.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, width):
            texts = batch.column(width).to_pylist()
            found = np.array([fingerprint_of(t or "", shingle) for t in texts], np.uint64)
            columns = [*batch.columns[:-1], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*kept.columns, F.col(text).alias("_text")).mapInArrow(run, schema)


# -- tiles ------------------------------------------------------------------------------------


def _segments(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 1 segments."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _tiled(distinct: DataFrame, radius: int, tile: int) -> DataFrame:
    """(bucket, tile1, tile2, side, fingerprint): the members of each pair of tiles to compare.

    A bucket is a segment and its value: there are few, so their sizes are a small table. A bucket
    of at most `tile` fingerprints is one tile, paired with itself (side 0). Larger ones are dealt.
    """
    fp = F.col("fingerprint")
    keys = [
        F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1)) * 16 + n
        for n, (first, bits) in enumerate(_segments(radius))
    ]
    rows = distinct.select(
        "fingerprint", F.bit_count(fp).cast("int").alias("ones"), F.explode(F.array(*keys)).alias("bucket")
    )
    sizes = rows.groupBy("bucket", "ones").agg(F.count(F.lit(1)).alias("n"))
    parts = F.struct(F.col("ones"), F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    dealt = (
        sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.collect_list(parts).alias("tiles"))
        .where(F.col("n") > tile).drop("n")
    )
    rows = rows.join(dealt, "bucket", "left")
    # A tile's number is its population count * 2^20 + its part.
    own = F.filter("tiles", lambda t: t["ones"] == F.col("ones"))[0]["parts"]
    rows = rows.withColumn("own", F.when(
        F.col("tiles").isNotNull(),
        F.col("ones").cast("long") * (1 << 20) + F.pmod(F.xxhash64("fingerprint"), own),
    ).otherwise(F.lit(0)))
    near = F.filter("tiles", lambda t: F.abs(t["ones"] - F.col("ones")) <= radius)
    others = F.flatten(F.transform(near, lambda t: F.transform(
        F.sequence(F.lit(0), t["parts"] - 1), lambda p: t["ones"].cast("long") * (1 << 20) + p
    )))
    rows = rows.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(0).cast("long")))))
    return rows.select(
        "bucket", F.least("own", "other").alias("tile1"), F.greatest("own", "other").alias("tile2"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "fingerprint",
    )


def _pairs(left: np.ndarray, right: np.ndarray | None, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked fingerprints, block by block. Both are sorted by population count;
    without `right`, `left` is compared with itself."""
    ones1 = np.bitwise_count(left)
    other = left if right is None else right
    ones2 = ones1 if right is None else np.bitwise_count(other)
    for i in range(0, len(left), BLOCK):
        a, low, high = left[i : i + BLOCK], int(ones1[i]), int(ones1[i : i + BLOCK][-1])
        for j in range(i if right is None else 0, len(other), BLOCK):
            b = other[j : j + BLOCK]
            if int(ones2[j]) > high + radius or int(ones2[j : j + BLOCK][-1]) < low - radius:
                continue
            x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
            yield x + i, y + j


def _forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) for each fingerprint that another one in these tiles is linked with."""
    left = left[np.argsort(np.bitwise_count(left), kind="stable")]
    if right is not None:
        right = right[np.argsort(np.bitwise_count(right), kind="stable")]
    nodes = left if right is None else np.concatenate([left, right])
    shift = 0 if right is None else len(left)
    root = np.arange(len(nodes))
    for x, y in _pairs(left, right, radius):
        y = y + shift
        different = x != y
        x, y = x[different], y[different]
        while len(x):  # hook the larger root to the smaller one, then shorten all paths
            a, b = root[x], root[y]
            high, low = np.maximum(a, b), np.minimum(a, b)
            np.minimum.at(root, high, low)
            while not np.array_equal(up := root[root], root):
                root = up
            open_pairs = root[x] != root[y]
            x, y = x[open_pairs], y[open_pairs]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct fingerprints whose transitive closure is that of all links."""
    members = _tiled(distinct, radius, tile)
    key = ["bucket", "tile1", "tile2"]
    dealt = members.repartition(*key).sortWithinPartitions(*key, "side")

    def compare(rows: np.ndarray, side: np.ndarray, crossed: bool):
        if crossed:
            if not side.any() or side.all():
                return None
            return _forest(rows[side == 0], rows[side == 1], radius)
        return _forest(rows, None, radius) if len(rows) > 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last group so far; it may go on in the next batch
        for batch in _with_end(batches):
            if batch is not None:
                columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
                rest = columns if rest is None else [np.concatenate(c) for c in zip(rest, columns)]
            if rest is None or not len(rest[0]):
                continue
            k1, k2, k3, side, rows = rest
            change = np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0) | (np.diff(k3) != 0)) + 1
            ends = [*change.tolist(), *([len(k1)] if batch is None else [])]
            start, a, b = 0, [], []
            for end in ends:
                fps = rows[start:end].view(np.uint64)
                found = compare(fps, side[start:end], k2[start] != k3[start])
                if found:
                    a.append(found[0].view(np.int64))
                    b.append(found[1].view(np.int64))
                start = end
            rest = [c[start:] for c in rest]
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
                )

    return dealt.mapInArrow(run, "a long, b long")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


# -- components -------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of `edges` (a, b) is connected with.

    Large-star and small-star rounds. The smallest neighbour is an aggregate with partial sums
    in each task, so a node with very many neighbours does no harm there.
    """
    def state(df: DataFrame) -> tuple[DataFrame, tuple]:
        saved = stored(df.where("a != b").distinct(), "links")
        return saved, tuple(saved.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges, before = state(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: every larger neighbour points to the smallest neighbour
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large, _ = state(large)
        # small star: the node and its smaller neighbours point to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges, after = state(small)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


@keeps_other_columns("id", also=["fingerprint"])
def classes(prints: DataFrame, id: str = "doc_id", radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """`prints` (with `fingerprint`; read several times, so store it first) with `component_id`:
    the smallest id that is reachable over links, the row's own included."""
    distinct = stored(prints.groupBy("fingerprint").agg(F.min(id).alias("least")), "fingerprints")
    roots = components(links(distinct, radius, tile))
    named = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    named = stored(named, "roots")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(smallest, "root").select("fingerprint", "component_id")
    return prints.drop("component_id").join(labels, "fingerprint")


def hexadecimal(fingerprint: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
