"""Token units, unpacked sequences, resumable batch schedules with a saved cursor, masked means."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def units(df: DataFrame, key: str, tokens: str, window: int = 2048) -> DataFrame:
    """(key, unit_no, kind, start, length): full windows of a text and its end mark, and the rest if any; a null count has none."""
    return units_of(df, key, tokens, window)


def sequence_arrays(length: Column, key: Column, window: int, pad: int) -> Column:
    """Loss mask, positions and owner of a one-unit sequence: 1 on real tokens, positions never reset, -1 on padding."""
    spare = (F.lit(window) - length).cast("int")
    return F.struct(
        F.concat(F.array_repeat(F.lit(1), length.cast("int")), F.array_repeat(F.lit(0), spare)).alias("loss_mask"),
        F.sequence(F.lit(0), F.lit(window - 1)).alias("position_id"),
        F.concat(F.array_repeat(key.cast("long"), length.cast("int")), F.array_repeat(F.lit(-1).cast("long"), spare)).alias("doc_id"),
        F.lit(pad).alias("pad_id"),
    )


def schedule(df: DataFrame, lane: str, shard: str, rows: str, batch: int, order: list[str]) -> DataFrame:
    """(seq, lane, shard, first_row): whole batches of each shard in shard order, lanes taking turns.

    The k-th batch of every lane comes before the (k+1)-th of any; a shard's rows beyond its last whole
    batch are left out, and no batch crosses a shard. Batches are numbered within their lane from sums over shards, so no task
    holds a lane's rows.
    """
    turn = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(lane))
    shards = df.select(lane, shard, F.floor(F.col(rows) / batch).cast("long").alias("n")).where((F.col("n") > 0) & (turn > 0))
    before = F.coalesce(F.sum("n").over(W.partitionBy(lane).orderBy(shard).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    each = shards.withColumn("before", before).select(lane, shard, "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    each = each.select(lane, shard, (F.col("i") * batch).alias("first_row"), (F.col("before") + F.col("i")).alias("k"), turn.alias("turn"))
    # the place of (k, turn): batches of each lane with a smaller k, plus those of lanes before it with the same k
    totals = {r[0]: r[1] for r in shards.groupBy(lane).agg(F.sum("n")).collect()}  # at most one row for each lane of ``order``
    parts = [F.least(F.lit(totals.get(x, 0)), F.col("k") + F.when(F.col("turn") > i + 1, 1).otherwise(0)) for i, x in enumerate(order)]
    return each.select(sum(parts[1:], parts[0]).alias("seq"), lane, shard, "first_row")


def units_of(df: DataFrame, key: str, tokens: str, window: int = 2048, keep: tuple[str, ...] = ()) -> DataFrame:
    """:func:`units` with the columns of ``keep`` carried along."""
    n = (F.col(tokens) + 1).cast("long")
    rows = df.select(key, *keep, n.alias("_n")).where("_n > 0")
    rows = rows.select(key, *keep, "_n", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("_n") / window) - 1).cast("long"))).alias("unit_no"))
    length = F.least(F.lit(window), F.col("_n") - F.col("unit_no") * window).cast("long")
    return rows.select(key, *keep, "unit_no", F.when(length == window, "full").otherwise("rest").alias("kind"), (F.col("unit_no") * window).alias("start"), length.alias("length"))


def _token_batches(window: int, end: int, vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from textloom.functions.tokens import encoding

        for batch in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for key, text in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist(), strict=True):
                if text is None:
                    continue
                ids = [*(encoding(vocabulary).encode_ordinary(text) if vocabulary else text.encode("utf-8", "replace")), end]
                for i in range(0, len(ids), window):
                    rows[0].append(key), rows[1].append(i // window), rows[2].append(ids[i : i + window])
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], batch.schema.field("k").type), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.list_(pa.int32()))], names=["k", "unit_no", "token_id"])

    return run


def unit_tokens(df: DataFrame, key: str, text: str, window: int = 2048, end: int = 256, vocabulary: str | None = None) -> DataFrame:
    """(key, unit_no, token_id): the token ids of every text and its end mark, in windows; null texts have none. Tokens are UTF-8
    bytes (0-255, ``end`` 256) unless a vocabulary file is named."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(_token_batches(window, end, vocabulary), f"k {kind}, unit_no long, token_id array<int>")
    return rows.withColumnRenamed("k", key)


class Cursor:
    """How far a schedule has been drawn: the number of its last batch. What follows is exactly what is left."""

    def __init__(self, last: int = -1):
        self.last = last

    def to_dict(self) -> dict[str, int]:
        return {"last": self.last}

    @classmethod
    def from_dict(cls, state: dict[str, int]) -> Cursor:
        return cls(int(state["last"]))

    def draw(self, plan: DataFrame, n: int) -> tuple[DataFrame, Cursor]:
        """The next ``n`` batches and the cursor behind them; at the end of the schedule there are fewer or none."""
        return plan.where((F.col("seq") > self.last) & (F.col("seq") <= self.last + n)), Cursor(self.last + n)

    def rest(self, plan: DataFrame) -> DataFrame:
        return plan.where(F.col("seq") > self.last)


def masked_mean(loss: Column, mask: Column) -> Column:
    """Mean of the losses that count; 0 where none does."""
    return F.sum(loss * mask) / F.greatest(F.sum(mask), F.lit(1))


def shifted_masked_mean(losses: Column, mask: Column) -> Column:
    """Mean loss of a sequence: the loss at a place is of predicting the next token, so it counts where the next place is real.
    ``losses`` is one shorter than ``mask``; 0 where no place counts."""
    counts = F.slice(mask, 2, F.greatest(F.size(mask) - 1, F.lit(0)))
    total = F.aggregate(F.zip_with(losses, counts, lambda x, m: x * m), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    return total / F.greatest(F.aggregate(counts, F.lit(0), lambda s, m: s + m), F.lit(1))
