"""Sharding by a minimax contiguous partition of atomic groups (law ``bytes``).

Rows with equal texts form one atomic group; groups are ordered by the md5 of their
text. The shards are the contiguous partition of that order whose largest shard is as
small as possible: the smallest feasible capacity is found by binary search, each
candidate being checked greedily (fill a shard until the next group would not fit), and
the greedy cuts of that capacity are taken.

The group sizes stay distributed. The driver works on *cells*, the groups whose md5 starts
with the same hex digits: at most 16**DIGITS cells at first. On cells, a greedy check gives
a capacity that is surely feasible and one below which none is, and the places where
the cuts of a capacity between both can lie. Only the cells there are then resolved by
more digits (one aggregate each round), until both capacities meet and every cut falls
between two cells; the result is the exact optimum over single groups. What the driver
holds is bounded by the cells of a round, whatever the number of groups.

Slots are numbered without a whole shard in one task: rows of a shard are dealt to
buckets by a hash of the id, a bucket's first slot is the count of the buckets before it, and
a window numbers the rows in each bucket. A group of copies is split over the buckets.

Defined results: a null text is the empty one (size 1, crc32 0, group of the empty
texts); empty shards are possible when there are fewer groups than shards, or one group
outweighs the others; repeated rows get a slot each; rows without id share a bucket;
an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import table, text_or_empty
from paysight.session import materialize

SHARDS = 8
#: Hex digits of the first cells, and digits added where a cell is resolved.
DIGITS, MORE_DIGITS = 3, 2
#: Rows for each slot bucket, on average.
BUCKET_ROWS = 4096


@dataclass
class Cells:
    """Consecutive cells in key order: prefix, bytes and number of groups of each."""
    prefix: list[str]
    size: list[int]
    groups: list[int]

    def __post_init__(self):
        self.ends = list(accumulate(self.size))
        self.total = self.ends[-1] if self.ends else 0

    def floor(self, x: int) -> int:
        """The last cell boundary <= x."""
        i = bisect_right(self.ends, x)
        return self.ends[i - 1] if i else 0

    def low_cuts(self, capacity: int, shards: int) -> list[int]:
        """Greedy cuts when cells are atomic: no cut over groups comes earlier."""
        at, out = 0, []
        for _ in range(shards):
            at = self.floor(at + capacity)
            out.append(at)
        return out

    def high_cuts(self, capacity: int, shards: int) -> list[int]:
        """Cuts that no greedy cut over groups can pass: each cell of one group is atomic,
        the others count as divisible at will."""
        at, out = 0, []
        for _ in range(shards):
            at += capacity
            i = bisect_right(self.ends, at)
            if i < len(self.ends) and self.groups[i] == 1:
                at = self.ends[i - 1] if i else 0
            at = min(at, self.total)
            out.append(at)
        return out


def _least(lo: int, hi: int, ok) -> int:
    """The smallest x in [lo, hi] for which the monotone test holds (it holds at hi)."""
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if ok(mid) else (mid + 1, hi)
    return lo


def capacity_bounds(cells: Cells, shards: int, largest: int) -> tuple[int, int]:
    """A capacity below which none is feasible, and one that surely is."""
    start = max(largest, -(-cells.total // shards))
    low = _least(start, max(start, cells.total), lambda c: cells.high_cuts(c, shards)[-1] >= cells.total)
    high = _least(low, max(low, cells.total), lambda c: cells.low_cuts(c, shards)[-1] >= cells.total)
    return low, high


def unresolved(cells: Cells, shards: int, low: int, high: int) -> list[int]:
    """Cells of several groups in which a greedy cut of a capacity in [low, high] can lie."""
    out = set()
    for a, b in zip(cells.low_cuts(low, shards), cells.high_cuts(high, shards), strict=True):
        i = bisect_right(cells.ends, a)
        while i < len(cells.ends) and (cells.ends[i] - cells.size[i] < b or cells.ends[i] - cells.size[i] == a < b):
            if cells.groups[i] > 1:
                out.add(i)
            i += 1
    return sorted(out)


def _cells(groups: DataFrame, digits: int, within: list[str] | None = None) -> list:
    """(prefix, bytes, groups) of the cells; ``within`` limits them to longer prefixes of these."""
    if within is not None:
        width = len(within[0])
        groups = groups.where(F.substring("key", 1, width).isin(within))
    return (groups.groupBy(F.substring("key", 1, digits).alias("p"))
            .agg(F.sum("size").alias("s"), F.count("*").alias("n")).orderBy("p").collect())


def minimax_cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[list[str | None], int]:
    """For each shard but the last the key prefix after which it ends (None: before all
    keys), and the capacity. ``groups`` has key (hex) and size, one row for each group."""
    rows = _cells(groups, DIGITS)
    if not rows:
        return [None] * (shards - 1), 0
    cells = Cells([r.p for r in rows], [r.s for r in rows], [r.n for r in rows])
    largest = groups.agg(F.max("size")).first()[0]
    while True:
        low, high = capacity_bounds(cells, shards, largest)
        todo = unresolved(cells, shards, low, high)
        if not todo:
            break
        by_width: dict[int, list[int]] = {}
        for i in todo:
            by_width.setdefault(len(cells.prefix[i]), []).append(i)
        finer: dict[str, list] = {}
        for width, at in by_width.items():
            for r in _cells(groups, min(32, width + MORE_DIGITS), [cells.prefix[i] for i in at]):
                finer.setdefault(r.p[:width], []).append((r.p, r.s, r.n))
        merged = []
        for i, x in enumerate(zip(cells.prefix, cells.size, cells.groups, strict=True)):
            merged += finer[x[0]] if i in set(todo) else [x]
        cells = Cells(*map(list, zip(*merged, strict=True)))
    cuts = [bisect_right(cells.ends, a) for a in cells.low_cuts(high, shards)[:-1]]
    return [cells.prefix[i - 1] if i else None for i in cuts], high


def shard_of(key: Column, cuts: list[str | None]) -> Column:
    """The number of cuts that lie before the key."""
    out = F.lit(0)
    for cut in cuts:
        out = out + (F.lit(1) if cut is None else (F.substring(key, 1, len(cut)) > cut).cast("int"))
    return out


def with_slots(rows: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """Add ``slot``: gapless from 0 in each ``shard``."""
    n = rows.count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(id_col, *order), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
             .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    place = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy(id_col, *order)) - 1
    return (dealt.withColumn("_place", place).join(first, ["shard", "_bucket"])
            .withColumn("slot", (F.col("_first") + F.col("_place")).cast("long")).drop("_bucket", "_first", "_place"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = text_or_empty()
    rows = materialize(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                                   F.crc32(text.cast("binary")).alias("text_crc32"),
                                   F.md5(text.cast("binary")).alias("key")), "sharding-rows")
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("size")), "sharding-groups")
    cuts, _ = minimax_cuts(groups, shards)
    placed = rows.withColumn("shard", shard_of(F.col("key"), cuts))
    return (with_slots(placed, "doc_id", ["key"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
