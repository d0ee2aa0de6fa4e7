"""MinHash signatures (vectorised in Arrow batches), banding, exactly verified links, survivors.

A text with single blanks for white space falls into runs of five characters (or, as a choice, of five words). A
run's hash is the polynomial of its code points modulo the prime 2^31 - 1, so a whole batch is hashed by array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.operators.components import connected_components, linked_groups
from textloom.storage import materialize

PRIME, BASE = (1 << 31) - 1, 1_000_003
#: Generators of the coefficients a and b: the i-th pair is their i-th powers modulo PRIME.
GENERATORS = (48271, 69621)


def best_bands(n: int, threshold: float) -> tuple[int, int]:
    """The pair (bands, rows), bands * rows = n, whose inflection (1/b)^(1/r) is nearest the threshold."""
    pairs = [(b, n // b) for b in range(1, n + 1) if n % b == 0]
    return min(pairs, key=lambda p: (abs((1 / p[0]) ** (1 / p[1]) - threshold), p[0]))


def coefficients(n: int) -> list[tuple[int, int]]:
    """n pairs (a, b) for (a x + b) mod PRIME."""
    return [(pow(GENERATORS[0], i, PRIME), pow(GENERATORS[1], i, PRIME)) for i in range(1, n + 1)]


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME for 0 <= x < 2^62, by shifts: PRIME is one less than a power of two."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


def _rolled(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k numbers of an array."""
    h = np.zeros(len(codes) - k + 1, np.int64)
    for j in range(k):
        h = _mod(h * BASE + codes[j : len(codes) - k + 1 + j])
    return h


def shingles(text: str | None, k: int = 5, unit: str = "char") -> np.ndarray:
    """Hashes of the distinct runs of k characters (or words) of a text; of the whole of it if it is shorter; none if it is blank."""
    parts = (text or "").split()
    if not parts:
        return np.zeros(0, np.int64)
    if unit == "word":
        numbers = np.array([int(_rolled(_points(w), len(w))[0]) for w in parts], np.int64)
    else:
        numbers = _points(" ".join(parts))
    return np.unique(_rolled(numbers, min(k, len(numbers))))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def signature(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the runs; long texts are taken in slices."""
    least = np.full(len(a), PRIME, np.int64)
    for at in range(0, len(found), 8192):
        np.minimum(least, _mod(a[:, None] * found[None, at : at + 8192] + b[:, None]).min(1), out=least)
    return least


def _signature_batches(n: int, k: int, unit: str, cap: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (np.array(x, np.int64) for x in zip(*coefficients(n), strict=True))
        for batch in batches:
            rows = [shingles(t, k, unit) for t in batch.column("t").to_pylist()]
            keep = [i for i, r in enumerate(rows) if len(r)]
            sigs = np.array([signature(rows[i] if cap is None else rows[i][:cap], a, b) for i in keep], np.int64).reshape(-1)
            lists = pa.ListArray.from_arrays(np.arange(0, len(sigs) + 1, n, dtype=np.int32), pa.array(sigs))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), lists], names=[batch.schema.names[0], "sig"])

    return run


def signatures(df: DataFrame, key: str, text: str, n: int = 128, k: int = 5, unit: str = "char", cap: int | None = None) -> DataFrame:
    """(key, sig) of every text that is not blank. ``cap``: at most so many runs of a text, those of least hash (the
    reference caps at 20,000); none by default, so that whole texts count."""
    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(_signature_batches(n, k, unit, cap), f"k {kind}, sig array<long>").withColumnRenamed("k", key)


def _bands(rows: int, *more: str):
    """Keys of the bands of ``rows`` values of ``sig``, apart for different values of ``more``."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.size("sig") / rows).cast("int") - 1), lambda i: F.xxhash64(*more, i, F.slice("sig", i * rows + 1, rows)))


def verified_edges(sigs: DataFrame, key: str, n: int = 128, threshold: float = 0.8, track: tuple[str, ...] = ()) -> DataFrame:
    """(head, member): pairs of a bucket's least key and another member whose signatures agree enough: the reference's rule.

    A bucket is compared through its head only, so its work grows with its size, never its square. Band keys travel
    alone; signatures are joined to the candidates.
    """
    buckets = sigs.select(key, F.explode(_bands(best_bands(n, threshold)[1], *track)).alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min(key).alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = materialize(buckets.join(heads, "bucket").where(F.col("head") != F.col(key)).select("head", F.col(key).alias("member")).distinct(), "minhash-pairs")
    a, b = sigs.select(F.col(key).alias("head"), F.col("sig").alias("x")), sigs.select(F.col(key).alias("member"), F.col("sig").alias("y"))
    same = F.aggregate(F.zip_with("x", "y", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v)
    return pairs.join(a, "head").join(b, "member").where(same >= threshold * n).select("head", "member")


def _exact_batches(k: int, unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            sets = {t: shingles(t, k, unit) for t in {*x, *y}}
            sims = []
            for p, q in zip(x, y, strict=True):
                both = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
                sims.append(both / max(1, len(sets[p]) + len(sets[q]) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims, pa.float64())], names=["a", "b", "similarity"])

    return run


def sketch(n: int = 128):
    """The two lowest bits of each of ``n`` values of ``sig``, 32 values a word."""
    word = lambda w: F.aggregate(F.slice("sig", w * 32 + 1, 32), F.lit(0).cast("long"), lambda t, v: F.shiftleft(t, 2).bitwiseOR(v.bitwiseAND(F.lit(3).cast("long"))))
    return F.array(*[word(w) for w in range(n // 32)])


def may_reach(x, y, threshold: float, n: int = 128, sigmas: float = 4.0):
    """Whether two sketches allow for a similarity: values differ in a sketch with probability 3/4 (1 - J), and at the threshold a
    pair has more differences than allowed with probability under 1e-4, none if it is much above."""
    even = F.lit(0x5555555555555555)
    differ = lambda i: F.bit_count(x[i].bitwiseXOR(y[i]).bitwiseOR(F.shiftrightunsigned(x[i].bitwiseXOR(y[i]), 1)).bitwiseAND(even))
    p = 0.75 * (1 - threshold)
    return sum((differ(i) for i in range(1, n // 32)), differ(0)) <= int(n * p + sigmas * (n * p * (1 - p)) ** 0.5 + 1)


def exact_groups(df: DataFrame, sigs: DataFrame, key: str, text: str, threshold: float = 0.8, rows: int = 4, k: int = 5, unit: str = "char", track: tuple[str, ...] = ()) -> DataFrame:
    """(node, component): groups of texts linked by an exact similarity of at least the threshold, of all that meet in a band.

    In bands of ``rows`` = 4 of 128 values all but 5e-8 of the pairs at 0.8 meet; the sketches that keep unlike texts
    of a bucket apart lose under 1e-4 of the pairs at just 0.8. Links are found without all pairs of a bucket, see
    :func:`linked_groups`.
    """

    def linked(pairs: DataFrame) -> DataFrame:
        kind = df.schema[key].dataType.simpleString()
        met = materialize(pairs, "minhash-pairs")
        texts = df.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(met.select(F.explode(F.array("a", "b")).alias("_k")).distinct(), "_k", "left_semi")
        both = met.join(texts.select(F.col("_k").alias("a"), F.col("_t").alias("x")), "a").join(texts.select(F.col("_k").alias("b"), F.col("_t").alias("y")), "b")
        return both.mapInArrow(_exact_batches(k, unit), f"a {kind}, b {kind}, similarity double").where(F.col("similarity") >= threshold)

    entries = sigs.select(F.explode(_bands(rows, *track)).alias("bucket"), F.col(key).alias("node"), "sketch")
    return linked_groups(entries, linked, lambda x, y: may_reach(x, y, threshold))


def survivors(df: DataFrame, key: str, text: str, n: int = 128, threshold: float = 0.8, parity: bool = False, unit: str = "char", track: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, the columns of ``keep``, cluster, keep): every row, its cluster (least key), and whether it is the cluster's longest
    text (ties: least key). Blank and null rows are clusters of their own and stay. With ``track`` rows are compared within
    equal values of that column only. ``parity``: the reference's banding, bucket heads and estimated similarity
    instead of exact links."""
    more = ("_track",) if track else ()
    src = df.select(key, *keep, F.col(text).alias("_text"), *([F.coalesce(F.col(track).cast("string"), F.lit("")).alias("_track")] if track else []))
    sigs = signatures(src, key, "_text", n, unit=unit)
    sigs = materialize((sigs.join(src.select(key, "_track"), key) if track else sigs).withColumn("sketch", sketch(n)), "signatures")
    parts = connected_components(verified_edges(sigs, key, n, threshold, more), "head", "member") if parity else exact_groups(src, sigs, key, "_text", threshold, unit=unit, track=more)
    rows = src.select(key, *keep, F.length(F.coalesce("_text", F.lit(""))).alias("_len")).join(parts.select(F.col("node").alias(key), "component"), key, "left")
    rows = rows.select(key, *keep, "_len", F.coalesce("component", key).alias("cluster"))
    best = rows.groupBy("cluster").agg(F.max(F.struct(F.col("_len"), (-F.col(key)).alias("k"))).alias("b"))
    return rows.join(best, "cluster").select(key, *keep, "cluster", (F.col(key) == -F.col("b.k")).alias("keep"))


#: Rows of one range when rows are numbered in order.
RANGE_ROWS = 200_000


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` plus ``_at``: the place of each row in ``order`` from 0, without one task seeing all rows.

    Rows are ranged first, into as many ranges as their number asks for; the place is a range's offset plus the place
    within it. ``order`` should tell all rows apart; rows that it does not are placed in any order.
    """
    ranges = max(1, -(-df.count() // RANGE_ROWS))
    ranged = materialize(df.repartitionByRange(ranges, *order).withColumn("_p", F.spark_partition_id()), "ranged")
    base = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    base = base.select("_p", F.coalesce(F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))  # a row a range
    place = F.row_number().over(W.partitionBy("_p").orderBy(*order))
    return ranged.join(base, "_p").withColumn("_at", F.col("_base") + place - 1).drop("_p", "_base")


def dense_rank_shards(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """``df`` plus ``shard_no``: rows in ``order`` cut into shards of ``size``."""
    return numbered(df, order).withColumn("shard_no", F.floor(F.col("_at") / size).cast("long")).drop("_at")
