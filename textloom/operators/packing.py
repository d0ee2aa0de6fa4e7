"""Best-fit-decreasing packing of token units, sequences with their masks, and shuffled shards.

Best fit decreasing places items longest first, each into the open sequence with the least room that takes it (ties: the
sequence opened first), else into a new one. Items of one size differ in nothing but their order, so the whole
course of the packing follows from how many items there are of each size: at most ``capacity`` numbers a lane. It is
played through on the driver over groups of sequences that have been filled alike; items then find their
sequence by their place among the items of their size.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.minhash import numbered
from textloom.storage import materialize

CAPACITY, SHARD_SEQUENCES = 2048, 500


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(size, first, last, sequence, each): items ``first`` .. ``last`` of a size, in order, go to sequences from ``sequence``
    on, ``each`` to every one.

    ``counts`` tells how many items there are of each size from 1 to ``capacity``. The open sequences are kept as runs of
    neighbouring numbers with equal room, sorted by (room, number); a step uses up a run or an item size, or splits a
    run once, so the plan has at most a few rows for each size, however many items there are.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    runs: list[tuple[int, int, int]] = []  # (room, first number, how many), sorted
    opened = 0
    for size in sorted(counts, reverse=True):
        if not 0 < size <= capacity:
            raise ValueError(f"an item of {size} does not fit into {capacity}")
        placed, left = 0, counts[size]
        while left > 0:
            at = bisect.bisect_left(runs, (size, -1, 0))
            if at < len(runs):
                room, first, many = runs.pop(at)
            else:
                room, first, many = capacity, opened, -(-left // (capacity // size))
                opened += many
            each = room // size  # a sequence just filled has the least room that still fits, until it does not
            full, rest = divmod(left, each)
            use = min(many, full)
            if use:
                plan.append((size, placed, placed + use * each - 1, first, each))
                placed, left = placed + use * each, left - use * each
                if room > each * size:
                    bisect.insort(runs, (room - each * size, first, use))
            if use < many:
                first, many = first + use, many - use
                if left:  # fewer items than one more sequence takes
                    plan.append((size, placed, placed + left - 1, first, left))
                    if room > left * size:
                        bisect.insort(runs, (room - left * size, first, 1))
                    placed, left, first, many = placed + left, 0, first + 1, many - 1
                if many:
                    bisect.insort(runs, (room, first, many))
    return plan


def best_fit_decreasing(units: DataFrame, lane: str, order: list[str], size: str, capacity: int = CAPACITY) -> DataFrame:
    """``units`` plus ``sequence``: the number, within its lane, of the sequence each unit goes to, items of one size taken in
    ``order``. Null lanes are one lane; units without a positive size are left out, larger ones than ``capacity`` are refused.
    """
    spark = units.sparkSession
    rows = units.where(F.col(size) > 0).withColumn("_lane", F.coalesce(F.col(lane).cast("string"), F.lit("")))
    rows = materialize(numbered(rows.withColumn("_size", -F.col(size).cast("long")), ["_lane", "_size", *order]), "bfd-items")
    firsts = materialize(rows.groupBy("_lane", "_size").agg(F.min("_at").alias("_first"), F.count("*").alias("n")), "bfd-sizes")
    by: dict[str, dict[int, int]] = {}
    for r in firsts.collect():  # at most ``capacity`` rows a lane
        by.setdefault(r["_lane"], {})[-r["_size"]] = r.n
    plan = [(name, -s, a, b, seq, each) for name, counts in by.items() for s, a, b, seq, each in best_fit_plan(counts, capacity)]
    steps = spark.createDataFrame(plan, "_lane string, _size long, _a long, _b long, _seq long, _each long")
    placed = rows.join(firsts.drop("n"), ["_lane", "_size"]).withColumn("_rank", F.col("_at") - F.col("_first"))
    hit = placed.join(steps, ["_lane", "_size"]).where(F.col("_rank").between(F.col("_a"), F.col("_b")))
    sequence = F.col("_seq") + F.floor((F.col("_rank") - F.col("_a")) / F.col("_each"))
    return hit.withColumn("sequence", sequence.cast("long")).drop("_lane", "_size", "_at", "_first", "_rank", "_a", "_b", "_seq", "_each")


def shuffled_shards(sequences: DataFrame, lane: str, key: str, size: int = SHARD_SEQUENCES, seed: str = "42") -> DataFrame:
    """``sequences`` plus ``shard_no`` and ``row_no``: the sequences of each lane in the order of a seeded digest, cut into shards."""
    rows = sequences.withColumn("_d", F.md5(F.concat_ws("|", F.col(lane).cast("string"), F.col(key).cast("string"), F.lit(seed))))
    rows = numbered(rows, [lane, "_d", key])
    first = rows.groupBy(F.col(lane).alias("_l")).agg(F.min("_at").alias("_first"))
    rows = rows.join(first, F.col(lane).eqNullSafe(F.col("_l"))).withColumn("_at", F.col("_at") - F.col("_first"))
    return rows.withColumn("shard_no", F.floor(F.col("_at") / size).cast("long")).withColumn("row_no", (F.col("_at") % size).cast("long")).drop("_l", "_first", "_at", "_d")


def segment_arrays(segments: Column, capacity: int, pad: int) -> Column:
    """Token, mask, position and owner arrays of a sequence made of ``segments``, structs of (doc_id, token_id array) in order: mask 1
    on real tokens, positions never reset, owner -1 and token ``pad`` on padding."""
    tokens = F.flatten(F.transform(segments, lambda s: s["token_id"]))
    owners = F.flatten(F.transform(segments, lambda s: F.array_repeat(s["doc_id"], F.size(s["token_id"]))))
    spare = F.lit(capacity) - F.size(tokens)
    return F.struct(
        F.concat(tokens, F.array_repeat(F.lit(pad), spare)).alias("token_id"),
        F.concat(F.array_repeat(F.lit(1), F.size(tokens)), F.array_repeat(F.lit(0), spare)).alias("loss_mask"),
        F.sequence(F.lit(0), F.lit(capacity - 1)).alias("position_id"),
        F.concat(owners, F.array_repeat(F.lit(-1).cast("long"), spare)).alias("doc_id"),
    )
