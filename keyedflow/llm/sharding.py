"""Minimax contiguous sharding of atomic groups, with DataFrame functions only.

Texts that are equal form a group, which is never split. Groups are ordered by the 64-bit hash of their text, which
mixes sources evenly, and cut into `shards` contiguous runs such that the largest run is as small as possible: the
smallest capacity that a greedy filling meets is found by binary search. Greedy filling would leave the last shards small or
empty where one large group sets the capacity; so, within it, the cuts are those nearest to an even share of what is left.

The group sizes never come to the driver. It holds a histogram over ranges of the hash, and refines only the ranges in
which a cut falls, by 4096 each. While a cut still falls inside a range, the search treats it as divisible, which
gives a lower bound; once all cuts fall between groups the bound is met and the result is exact. So each round
brings at most (shards - 1) * 4096 rows to the driver, and there are at most six rounds, at any size of the table.

Null and empty texts have size 1. An empty table gives an empty one. Repeated rows share their text's shard.
Texts whose hashes collide would share one as well. Groups larger than the rest allows make shards uneven, as
they must; the others share the rest evenly. With fewer groups than shards some shards stay empty. Other columns are passed on; `size`, `shard`
and `slot` replace columns of these names.
"""

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import keeps_other_columns, stored

BITS = 12
#: Rows of a shard are numbered in so many independent cells.
CELLS = 1024


@dataclass(frozen=True, order=True)
class Range:
    """Hashes whose first `bits` bits, as a signed number, are `value`; `single`: one group."""

    low: int
    bits: int
    value: int
    size: int
    single: bool


def _fill(starts: list[int], ranges: list[Range], capacity: int, shards: int):
    """Fill greedily up to `capacity`. The places where shards end, as (range, whether inside it),
    or None if `shards` of them do not suffice. starts[i]: total size before range i."""
    total, at, ends = starts[-1], 0, []
    while total - at > capacity:
        if len(ends) == shards - 1:
            return None
        i = bisect_right(starts, at + capacity) - 1
        inside = starts[i] < at + capacity and not ranges[i].single
        end = at + capacity if inside else starts[i]
        if end == at:
            return None
        ends.append((i, inside))
        at = end
    return ends


def _least_capacity(ranges: list[Range], shards: int) -> tuple[int, list[tuple[int, bool]]]:
    starts = [0, *accumulate(r.size for r in ranges)]
    low, high = 0, starts[-1]  # low is too small, high suffices
    while high - low > 1:
        middle = (low + high) // 2
        if _fill(starts, ranges, middle, shards) is None:
            low = middle
        else:
            high = middle
    return high, _fill(starts, ranges, high, shards)


def _level(sizes: list[int], total: int, shards: int) -> float:
    """An even share of the rest for each shard, beside those that one group alone makes larger. sizes: of single groups."""
    level, large = total / shards, []
    while True:
        more = [s for s in sizes if s > level]
        if len(more) == len(large) or len(more) >= shards:
            return level
        large = more
        level = (total - sum(large)) / (shards - len(large))


def _even(starts: list[int], ranges: list[Range], capacity: int, shards: int) -> list[tuple[int, bool]]:
    """Places where shards end, like those of `_fill`, such that none is larger than `capacity`, none is empty if there are
    ranges enough, and each is as near to an even share of what is left as its groups allow."""
    total, n = starts[-1], len(ranges)
    # The least place from which on 0, 1, .. shards hold the rest.
    rest = [total]
    for _ in range(shards - 1):
        place = max(rest[-1] - capacity, 0)
        i = bisect_right(starts, place) - 1
        rest.append(starts[i + 1] if i < n and starts[i] < place and ranges[i].single else place)
    at, ends = 0, []
    for left in range(shards, 1, -1):
        first = bisect_right(starts, at) - 1
        singles = [r.size for r in ranges[first:] if r.single]
        low, high = rest[left - 1], min(at + capacity, total)
        share = _level(singles, total - at, left)
        # What lies before the next group that is larger than that is shared by a whole number of shards, as many as
        # leave one for each larger group and for what lies behind each of them.
        large = [i for i in range(first, n) if ranges[i].single and ranges[i].size > share]
        before = starts[large[0]] - at if large else 0
        if before > 0:
            behind = sum(starts[i + 1] < starts[j] for i, j in zip(large, [*large[1:], n]))
            share = before / max(min(round(before / share), left - len(large) - behind), 1)
        place = min(max(at + share, low), high)
        i = bisect_right(starts, place) - 1
        if i < n and starts[i] < place and not ranges[i].single:
            inside, end = True, place
        else:
            inside = False
            bounds = [b for b in (i, i + 1) if b <= n and low <= starts[b] <= high]
            good = [b for b in bounds if starts[b] > at and (n - b >= left - 1 or n < shards)]
            i = min(good or bounds, key=lambda b: abs(starts[b] - place))
            end = starts[i]
        if end >= total:
            break
        if end > at:
            ends.append((i, inside))
        at = end
    return ends


def _refined(rows: DataFrame, parents: list[tuple[int, int]]) -> list[Range]:
    """The non-empty parts of each range (bits, value), with the sizes of the groups in them."""
    out = []
    for bits in sorted({b for b, _ in parents}):
        deeper = min(bits + BITS, 64)
        part = F.shiftright("_group", 64 - deeper) if deeper < 64 else F.col("_group")
        within = rows
        if bits:
            values = [v for b, v in parents if b == bits]
            within = rows.where(F.shiftright("_group", 64 - bits).isin(values))
        found = within.groupBy(part.alias("value")).agg(
            F.sum("size").alias("size"), (F.min("_group") == F.max("_group")).alias("single")
        )
        out += [
            Range(r["value"] << (64 - deeper), deeper, r["value"], r["size"], r["single"])
            for r in found.collect()  # at most 4096 for each range that is refined
        ]
    return out


def cut_points(rows: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity, and the hash at which each shard but the first begins."""
    ranges = sorted(_refined(rows, [(0, 0)]))
    if not ranges:
        return 0, []
    while True:
        starts = [0, *accumulate(r.size for r in ranges)]
        capacity, fullest = _least_capacity(ranges, shards)
        ends = _even(starts, ranges, capacity, shards)
        open_ranges = {ranges[i] for i, inside in [*fullest, *ends] if inside}
        if len(ranges) < shards:
            open_ranges |= {r for r in ranges if not r.single}
        if not open_ranges:
            return capacity, [ranges[i].low for i, _ in ends]
        finer = _refined(rows, [(r.bits, r.value) for r in open_ranges])
        ranges = sorted([r for r in ranges if r not in open_ranges] + finer)


def _sizes(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumns({
        "size": (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long"),
        "_group": F.xxhash64(F.col(text)),
    })


def _shard(cuts: list[int]) -> Column:
    """How many shards begin at or before the row's group."""
    return sum(((F.col("_group") >= F.lit(c)).cast("int") for c in cuts), F.lit(0))


def numbered(rows: DataFrame, id: str, cells: int = CELLS) -> DataFrame:
    """Adds `slot`, from 0 without gaps in each shard.

    A shard's rows are dealt to cells by hash, numbered there, and shifted by the rows of the cells
    before. So no task holds a whole shard. The counts, (shards * cells) rows, are broadcast.
    """
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(F.col(id), F.col("_group")), F.lit(cells)))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("shard", "_cell").orderBy(F.col(id), F.col("_group"))
    placed = rows.withColumn("_number", F.row_number().over(within))
    placed = placed.join(F.broadcast(offsets), ["shard", "_cell"])
    slot = (F.col("_offset") + F.col("_number") - 1).cast("long")
    columns = [c for c in rows.columns if c != "_cell"]
    return placed.select(*columns, slot.alias("slot"))


@keeps_other_columns("id", "text")
def assign(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without its text, with `size`, `shard` and `slot`. The text is read once."""
    rows = stored(_sizes(docs.drop("shard", "slot"), text).drop(text), "sizes")
    _, cuts = cut_points(rows, shards)
    return numbered(rows.withColumn("shard", _shard(cuts).cast("int")), id).drop("_group")
