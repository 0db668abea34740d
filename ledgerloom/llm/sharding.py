"""Sharding [native]: minimax contiguous partition of ordered atomic groups.

Rows with equal texts form one atomic group; groups are ordered by a 60-bit hash of the text, and a shard is a run of
them. The smallest feasible shard capacity is found by binary search; a greedy pass from left to right checks each
capacity. A group above the capacity is a shard by itself, so one very large group does not excuse other shards:
the largest shard is as small as any contiguous partition allows (it is the largest group, if that is above the
capacity), and so is the largest one of those that hold several groups. The bounds are then cut at that capacity,
each as near an even share of the rest as it allows.

The search never holds the groups. The driver knows prefix sums of hash ranges only ("cells"), 4096 at first.
For a capacity the greedy pass is done twice: once as if a cell could be cut anywhere and its rest could be one
group (nothing smaller than this works), once as if it could not be cut at all (this works). Cells above the first
capacity are split first, at most one a shard. Where the two passes disagree, the cells in which cuts may fall are
split further, by one aggregation over the groups; each round makes cells 256 times finer and needs few of them, as
cut number k moves by at most k cells. When both passes agree, the answer is exact.

Defined results: a null text counts as an empty one (size 8); an empty table gives no rows; repeated rows
share a group, hence a shard, and get different slots; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import materialize, ranked

BITS = 60
FIRST_BITS = 12
STEP_BITS = 8


def text_key(text: Column) -> Column:
    """The first 60 bits of the text's MD5, as a long from 0 to 2**60 - 1."""
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, BITS // 4), 16, 10).cast("long")


class Cells:
    """Sums of sizes over ranges of keys: (low key, bits left, sum, single) in order of the keys."""

    def __init__(self, cells: list[tuple[int, int, int, bool]]):
        self.cells = sorted(cells)
        self.ends = list(accumulate(c[2] for c in self.cells))
        self.total = self.ends[-1] if self.ends else 0

    def reach(self, start: int, capacity: int, whole: bool) -> int:
        """The furthest prefix sum that a shard from ``start`` on may end at; ``start`` where nothing fits."""
        limit = start + capacity
        if limit >= self.total:
            return self.total
        i = bisect_right(self.ends, limit)  # the cell that the limit falls into
        floor = self.ends[i - 1] if i else 0
        single = self.cells[i][3]
        if floor > start:
            return floor if whole or single else limit
        return self.ends[i] if single or not whole else start  # a group above the capacity, or what may be one

    def chain(self, capacity: int, shards: int, whole: bool) -> list[int]:
        cuts = [0]
        for _ in range(shards):
            cuts.append(self.reach(cuts[-1], capacity, whole))
        return cuts

    def feasible(self, capacity: int, shards: int, whole: bool) -> bool:
        return self.chain(capacity, shards, whole)[-1] >= self.total

    def smallest(self, shards: int, whole: bool) -> int:
        low, high = 0, self.total
        while low < high:
            middle = (low + high) // 2
            if self.feasible(middle, shards, whole):
                high = middle
            else:
                low = middle + 1
        return low

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Cuts under ``capacity``, each as near an even share of what is left as the later shards allow."""
        cuts, at = [], 0
        for left in range(shards - 1, 0, -1):
            far = self.reach(at, capacity, True)
            aim = at + (self.total - at) / (left + 1)
            bounds = [at, *self.ends[bisect_right(self.ends, at) : bisect_right(self.ends, far)]]
            i = bisect_right(bounds, aim)
            low = i - 1 if i == len(bounds) or aim - bounds[i - 1] <= bounds[i] - aim else i
            low = min(max(1, low), len(bounds) - 1)  # no shard is empty while there are groups
            high = len(bounds) - 1
            while low < high:  # a later cut never makes the rest harder
                middle = (low + high) // 2
                cut = bounds[middle]
                for _ in range(left):
                    cut = self.reach(cut, capacity, True)
                if cut >= self.total:
                    high = middle
                else:
                    low = middle + 1
            at = bounds[low]
            cuts.append(at)
        return cuts

    def undecided(self, shards: int) -> list[int]:
        """Indices of the cells to split before the smallest capacity is certain."""
        low = self.smallest(shards, False)
        large = [i for i, c in enumerate(self.cells) if c[2] > low and not c[3] and c[1] > 0]
        if large:
            return large
        high = self.smallest(shards, True)
        if low == high:
            return []
        early, late = self.chain(low, shards, True), self.chain(high, shards, False)
        wanted: set[int] = set()
        for a, b in zip(early, late, strict=True):
            first, last = bisect_right(self.ends, min(a, b)), bisect_right(self.ends, max(a, b))
            wanted.update(range(first, min(last, len(self.cells) - 1) + 1))
        return [i for i in wanted if not self.cells[i][3] and self.cells[i][1] > 0]


def _sums(groups: DataFrame, bits_left: int) -> list[tuple[int, int, int, bool]]:
    low = F.shiftleft(F.shiftright("key", bits_left), bits_left)
    rows = groups.groupBy(low.alias("low")).agg(F.sum("size").alias("size"), F.min("key").alias("a"), F.max("key").alias("b")).collect()
    return [(r["low"], bits_left, r["size"], r["a"] == r["b"]) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """First keys of shards 1, 2, ... (contiguous in order of ``key``) and the smallest capacity of shards of several groups.

    ``groups`` has one row a group: key (long), size (long). What the driver collects is bounded: 4096 cells,
    then at most 256 for each of the cells in which one of the cuts may fall.
    """
    cells = Cells(_sums(groups, BITS - FIRST_BITS))
    if not cells.cells:
        return [], 0
    while split := cells.undecided(shards):
        by_bits: dict[int, list[int]] = {}
        for i in split:
            by_bits.setdefault(cells.cells[i][1], []).append(cells.cells[i][0])
        kept = [c for i, c in enumerate(cells.cells) if i not in set(split)]
        for bits, lows in by_bits.items():
            inside = groups.filter(F.shiftleft(F.shiftright("key", bits), bits).isin(lows))
            kept += _sums(inside, max(0, bits - STEP_BITS))
        cells = Cells(kept)
    capacity = cells.smallest(shards, True)
    starts = []
    for cut in cells.even_cuts(capacity, shards):
        i = bisect_right(cells.ends, cut)
        if i < len(cells.cells):
            starts.append(cells.cells[i][0])
    return starts, capacity


def shard_rows(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into one of ``shards`` shards by size; columns as in the module's text.

    The texts are read once; what follows works on (id, size, checksum, key). The shard is an expression of
    the key (at most ``shards`` comparisons), so no join or shuffle assigns it; slots come from ``ranked``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), text_key(text).alias("key")
        )
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    starts, _ = minimax_cuts(groups, shards)
    shard = sum(((F.col("key") >= F.lit(k)).cast("int") for k in starts), F.lit(0))
    placed = rows.withColumn("shard", shard.cast("int"))
    slots = ranked(placed, ["shard"], ["key", id_col], id_col)
    return slots.select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
