"""Filling fixed-capacity sequences: bounded-space online best fit.

Each task keeps at most ``open_bins`` sequences open, in lists keyed by free space, and a bitset of
the free sizes in use. An item goes to the open sequence with the least room that still takes it (the
lowest set bit at or above its size); if none does, a new one opens, and when that would exceed the
bound the fullest open one closes first. What tasks leave open at the end is packed again by ever
fewer tasks, as whole sequences, until one bounded set is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.storage import materialize

CAPACITY, OPEN_BINS = 2048, 256


class OnlineBestFit:
    """Bins are opaque labels; ``closed`` receives (label, free) when a bin is given up."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.bound = capacity, open_bins
        self.by_free: list[list] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.n = 0

    def _take(self, free: int):
        label = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.n -= 1
        return label

    def put(self, label, free: int):
        """Open (or reopen) a bin; returns the (label, free) that had to close for it, if any."""
        gone = None
        if free == 0:
            return (label, 0)
        if self.n == self.bound:
            least = (self.bits & -self.bits).bit_length() - 1
            gone = (self._take(least), least)
        self.by_free[free].append(label)
        self.bits |= 1 << free
        self.n += 1
        return gone

    def fit(self, size: int):
        """(label, free before) of the open bin with the least sufficient room, taken out; None if none."""
        above = self.bits >> size
        if not above:
            return None
        free = size + (above & -above).bit_length() - 1
        return self._take(free), free

    def rest(self):
        while self.bits:
            free = (self.bits & -self.bits).bit_length() - 1
            yield self._take(free), free


def _packer(capacity: int, open_bins: int, level: int):
    """Pack rows (lane, item, size) in arrival order; rows out: (lane, item, size, bin, bin_free, open).

    ``open`` marks bins that were still open at the end of the task. Rows are buffered per bin only
    while it is open, so memory is bounded by ``open_bins`` bins per lane.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        packs: dict[str, OnlineBestFit] = {}
        inside: dict[str, list] = {}
        out: list[tuple] = []
        made = 0

        def close(label: str, free: int, still: bool):
            lane, items = inside.pop(label)
            out.extend((lane, item, label, free, still) for item in items)

        def flush():
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_())
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["lane", "item", "bin", "free", "still"])
            out.clear()
            return got

        for batch in batches:
            for lane, item, size in zip(batch.column("lane").to_pylist(), batch.column("item").to_pylist(), batch.column("size").to_pylist(), strict=True):
                pack = packs.get(lane)
                if pack is None:
                    pack = packs[lane] = OnlineBestFit(capacity, open_bins)
                got = pack.fit(size)
                if got is None:
                    label, free = f"{level}-{task}-{made}", capacity
                    inside[label] = (lane, [])
                    made += 1
                else:
                    label, free = got
                inside[label][1].append(item)
                gone = pack.put(label, free - size)
                if gone is not None:
                    close(*gone, False)
            if len(out) > 20_000:
                yield flush()
        for pack in packs.values():
            for label, free in pack.rest():
                close(label, free, True)
        yield flush()

    return run


_OUT = "lane string, item string, bin string, free int, still boolean"


def pack_sequences(items: DataFrame, lane: str, item_id: str, size: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, fan_in: int = 16) -> DataFrame:
    """(lane, item_id, part, offset, tokens, sequence_id, sequence_free): every item, placed.

    Items above the capacity are split, into full sequences of their own and one remainder that is
    packed like any other item; no other item is split. Null lanes are packed together as ``unknown``.
    Null or non-positive sizes take no room and get no row. Repeated ids are separate items. A sequence
    never mixes lanes. Items stay in the tasks they come in, so a lane of any size is packed by as many tasks as hold it.
    """
    parts = (
        items.select(F.coalesce(F.col(lane).cast("string"), F.lit("unknown")).alias("lane"), F.col(item_id).cast("long").alias("id"), F.col(size).cast("long").alias("n"))
        .where("n > 0")
        .withColumn("part", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / capacity) - 1).cast("long"))))
        .withColumn("tokens", F.least(F.lit(capacity), F.col("n") - F.col("part") * capacity).cast("int"))
        .withColumn("copy", F.monotonically_increasing_id())
    )
    parts = materialize(parts, "p6-parts")
    whole = parts.where(F.col("tokens") == capacity).select(
        "lane", "id", "part", "tokens", F.concat(F.lit("w-"), F.col("copy").cast("string")).alias("bin"), F.lit(0).alias("free")
    )
    rest = parts.where(F.col("tokens") < capacity)
    width = max(1, rest.rdd.getNumPartitions())
    open_items = rest.select("lane", F.col("copy").cast("string").alias("item"), F.col("tokens").alias("size"))
    # level 0 packs items; every further level packs the sequences that tasks of the level before left open
    maps: list[DataFrame] = []
    level = 0
    while True:
        packed = materialize(open_items.mapInArrow(_packer(capacity, open_bins, level), _OUT), f"p6-level{level}")
        maps.append(packed)
        if width == 1:
            break
        width = max(1, width // fan_in)
        left = packed.where("still").groupBy("lane", "bin").agg(F.first("free").alias("free"))
        open_items = left.select("lane", F.col("bin").alias("item"), (F.lit(capacity) - F.col("free")).cast("int").alias("size")).coalesce(width)
        level += 1
    # a bin left open at one level is an item of the next: follow it to the bin it ended in
    place = maps[0].select("lane", "item", "bin", "free", "still")
    for nxt in maps[1:]:
        up = nxt.select(F.col("item").alias("bin"), F.col("bin").alias("bin2"), F.col("free").alias("free2"), F.col("still").alias("still2"))
        place = place.join(up, "bin", "left").select(
            "lane", "item", F.coalesce("bin2", "bin").alias("bin"), F.coalesce("free2", "free").alias("free"), F.coalesce("still2", "still").alias("still")
        )
    packed = rest.select("id", "part", "tokens", F.col("copy").cast("string").alias("item")).join(place, "item").select("lane", "id", "part", "tokens", "bin", "free")
    return whole.union(packed).select(
        "lane", F.col("id").alias(item_id), "part", (F.col("part") * capacity).alias("offset"), "tokens", F.concat_ws("-", "lane", "bin").alias("sequence_id"), F.col("free").alias("sequence_free")
    )
