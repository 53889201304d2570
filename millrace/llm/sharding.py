"""Shards of near equal size: a minimax contiguous partition of atomic groups.

Rows with equal texts are one group and stay together.  Groups stand in the order of 60 bits of the md5 of their text, so neighbours have
nothing in common, and a shard is a range of that order: a row's shard follows from its own text and the few cuts.  (Texts that
agree in these bits count as one group.)  Rows of a group that weighs more than an even share of what is left get a shard of their
own first, largest group first: no partition can do better for them.  For the others, the smallest capacity with which the groups
fit into the remaining shards is found by binary search, checked greedily from the left; the first shard is cut there, and
the same is done for what remains, so that later shards share the slack that the last ones would be left with.

The groups stay in Spark.  The driver sees sums of ranges of the order, at first 65536 of them.  A greedy check asks for the
last group that ends at or before some place; if that place lies inside a range of several groups, the range is noted and
the check goes on with its beginning.  Noted ranges are split into 64 by one Spark job, and the search is repeated until it
asks for nothing that is not known: then every check was exact, and the cuts are those that all single groups would give.
A search asks at most shards**2 times the steps of a binary search, however many groups there are.

A slot is the place of a row in its shard, in the order of (md5, id): numbered in even slices of the whole order and shifted by the
rows of earlier slices, so neither a large shard nor a hot group is sorted in one task.

Defined results: a null text is empty, so it is in the group of the empty texts; texts count whole; rows with one id have slots of
their own, ties are equal rows and take neighbouring slots; a null id stands first; with fewer groups than shards some shards stay
empty; an empty table gives an empty result; further columns pass through, and a column whose name clashes with one made here is an error.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import durable

#: Bits of the order, of the ranges first looked at, and of the parts that a range is split into.
BITS, FIRST, SPLIT = 60, 16, 6
#: Bytes that every row takes besides its text.
ROW_BYTES = 16
MADE = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
HELD = ("_key", "_place", "_at", "_task", "_shift")


def order_key(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


@dataclass
class Ranges:
    """Known ranges of the order that hold groups: first key, bits of the range, groups in it, and size."""

    first: np.ndarray
    bits: np.ndarray
    groups: np.ndarray
    sizes: np.ndarray
    noted: set[int] = field(default_factory=set)

    def __post_init__(self):
        order = np.argsort(self.first)
        self.first, self.bits, self.groups, self.sizes = (x[order] for x in (self.first, self.bits, self.groups, self.sizes))
        self.ends = np.cumsum(self.sizes)
        self.total = int(self.ends[-1]) if len(self.ends) else 0

    def reach(self, place: int, capacity: int) -> int:
        """The end of the last group that ends within ``capacity`` after ``place``; notes a range that would have to be known better."""
        aim = place + capacity
        at = int(np.searchsorted(self.ends, aim, "right"))
        if at < len(self.ends) and self.groups[at] > 1 and aim > (self.ends[at - 1] if at else 0):
            self.noted.add(at)
        return int(self.ends[at - 1]) if at else 0

    def fits(self, place: int, shards: int, capacity: int) -> bool:
        for _ in range(shards):
            place = max(place, self.reach(place, capacity))
            if place >= self.total:
                return True
        return False

    def capacity(self, place: int, shards: int) -> int:
        """The smallest capacity with which ``shards`` shards hold everything after ``place``."""
        low = -(-(self.total - place) // shards)
        high = low
        while not self.fits(place, shards, high):  # at most an even share and the largest group
            low, high = high + 1, 2 * high
        while low < high:
            middle = (low + high) // 2
            if self.fits(place, shards, middle):
                high = middle
            else:
                low = middle + 1
        return low

    def cuts(self, shards: int) -> list[int]:
        """The places where shards end, each by the smallest capacity for what is left."""
        out, place = [], 0
        for left in range(shards, 0, -1):
            if place < self.total:
                place = max(place, self.reach(place, self.capacity(place, left)))
            out.append(place)
        return out

    def key_after(self, place: int) -> int:
        """The first key that belongs after a place at which a group ends."""
        at = int(np.searchsorted(self.ends, place, "right"))
        return int(self.first[at]) if at < len(self.first) else 1 << BITS


def _ranges(groups: DataFrame, bits: int) -> Ranges:
    part = F.shiftright("key", bits)
    rows = groups.groupBy(part.alias("part")).agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    found = rows.select("part", "n", "size").toArrow()
    part, n, size = (found.column(i).to_numpy() for i in range(3))
    return Ranges(part.astype(np.int64) << bits, np.full(len(part), bits), n.astype(np.int64), size.astype(np.int64))


def _split(groups: DataFrame, ranges: Ranges) -> Ranges:
    """The ranges with every noted one split; one job, whose result has at most 64 rows for each of them."""
    noted = sorted(ranges.noted)
    spark = groups.sparkSession
    finer = [max(0, int(ranges.bits[i]) - SPLIT) for i in noted]
    wanted = spark.createDataFrame([(int(ranges.bits[i]), int(ranges.first[i] >> ranges.bits[i]), b) for i, b in zip(noted, finer)], "bits int, part long, finer int")
    by_bits = []
    for bits in sorted({int(ranges.bits[i]) for i in noted}):
        # As many rows as places asked for: bounded by the number of shards, whatever the number of groups.
        asked = F.broadcast(wanted.filter(F.col("bits") == bits).select("part", "finer"))
        below = max(0, bits - SPLIT)
        inside = groups.withColumn("part", F.shiftright("key", bits)).join(asked, "part")
        by_bits.append(inside.groupBy(F.shiftright("key", below).alias("sub"), "finer").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")))
    rows = by_bits[0]
    for more in by_bits[1:]:
        rows = rows.union(more)
    found = rows.toArrow()
    sub, finer_bits, n, size = (found.column(i).to_numpy().astype(np.int64) for i in range(4))
    rest = np.ones(len(ranges.first), bool)
    rest[noted] = False
    return Ranges(
        np.concatenate([ranges.first[rest], sub << finer_bits]), np.concatenate([ranges.bits[rest], finer_bits]),
        np.concatenate([ranges.groups[rest], n]), np.concatenate([ranges.sizes[rest], size]),
    )


def own_shards(largest: list[tuple[int, int]], total: int, shards: int) -> list[int]:
    """Keys of the groups that get a shard of their own, of (key, size) from the largest group on."""
    out = []
    for key, size in largest:
        if len(out) == shards - 1 or size * (shards - len(out)) <= total:
            break
        out.append(key)
        total -= size
    return out


def plan(groups: DataFrame, shards: int) -> tuple[list[int], list[int]]:
    """Of groups (key, size): the keys with shards of their own, and the first key after each of the other shards."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    largest = groups.orderBy(F.desc("size"), "key").limit(shards).collect()  # one row a shard
    own = own_shards([(r.key, r.size) for r in largest], total, shards)
    others = groups.filter(~F.col("key").isin(own)) if own else groups
    ranges = _ranges(others, BITS - FIRST)
    while True:
        cuts = ranges.cuts(shards - len(own))
        if not ranges.noted:
            return own, [ranges.key_after(place) for place in cuts]
        ranges = _split(others, ranges)


def shard_of(key: Column, own: list[int], after: list[int]) -> Column:
    """The shard of a key: its own one, or the number of cuts at or before it."""
    cuts = F.array(*[F.lit(cut) for cut in after[:-1]]).cast("array<long>")
    ranged = F.size(F.filter(cuts, lambda cut: cut <= key)) + len(own)
    out = F.when(F.lit(False), 0)
    for number, single in enumerate(own):
        out = out.when(key == single, number)
    return out.otherwise(ranged).cast("int")


def _slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with a gapless slot in their shard: rows are ranged over tasks in the whole order, and a task's rows numbered there."""
    ranged = rows.repartitionByRange("shard", *order).sortWithinPartitions("shard", *order)
    # The upper bits are the task, the lower 33 the place in it.
    placed = durable(ranged.withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", 33)
    pieces = placed.groupBy("shard", task.alias("_task")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("shard", "_task", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    # At most one row for each task and one for each shard, whatever the number of rows.
    return placed.withColumn("_task", task).join(F.broadcast(starts), ["shard", "_task"]).withColumn("slot", F.col("_at") + F.col("_shift"))


def sharded(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """``docs`` (only its id unless ``keep``) with size, text_crc32, law, shard, slot and grown_shard (null: sizes decide)."""
    columns = docs.columns if keep else [id_col]
    clash = {c.lower() for c in columns} & {*MADE, *HELD}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made here; rename those of the table")
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    held = docs.select(*columns, size.alias("size"), F.crc32(text).alias("text_crc32"), order_key(text).alias("_key"))
    if not keep:
        held = durable(held)  # a few bytes a row, so that the texts are read once
    groups = durable(held.groupBy(F.col("_key").alias("key")).agg(F.sum("size").alias("size")))
    own, after = plan(groups, shards)
    placed = held.withColumn("shard", shard_of(F.col("_key"), own, after))
    order = ["_key", id_col]
    if not keep:
        # Of a written table, equal rows with one id differ by their place, so that many of them do not end in one task.
        placed, order = placed.withColumn("_place", F.monotonically_increasing_id()), [*order, "_place"]
    out = _slots(placed, order)
    return out.select(*columns, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the rows as a Parquet folder with one part ``shard=<n>`` per shard, in the order of the slots."""
    out = sharded(docs, shards, id_col, text_col).drop("law", "grown_shard")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
