"""Near-duplicate records with small edits: multi-index hashing over fingerprints.

A text (case and white space ignored) becomes a fingerprint of ``SEGMENTS`` x ``SYMBOLS`` one-byte
symbols, each the least hash of its five-character sequences in one bin of one hash round, so that two
texts agree in a symbol with the probability of their similarity. Distances are Hamming distances
counted in symbols. Each segment has its own table; the ball of radius one within a segment is
enumerated by masking one symbol at a time, so two texts meet in a table exactly if their segments
differ in at most one symbol. Matches are verified by the complete distance, then by exact similarity.

Matches that are no pairs grow as the square of a corpus whose texts share sentences, so they are thrown out where they
meet: the entries carry the whole fingerprint, one segment's table at a time. What is left meets the bitmaps of the texts'
sequences, which bound the similarity from above without loss, and only pairs within the bound meet their texts. Each
step runs in as many parts as keep what it moves in proportion to the texts, and drops its shuffle files when done.

With J the similarity, a segment lies within the radius with probability J^7 + 7(1-J)J^6; over ten
segments a pair at 0.70 is met with probability 0.982, at 0.75 with 0.997, at 0.80 with 0.9998.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.kernels import codes_of, gram_hashes, join_texts, mix, spaces
from textloom.operators.components import linked_groups
from textloom.storage import discard, materialize, shuffles_dropped

Q = 5
SEGMENTS, SYMBOLS, ROUNDS = 10, 7, 5
SKETCH = 28  # symbols whose low two bits go into the one-word sketch that travels with every key
#: The sketch's highest byte holds the number of distinct sequences, in so many steps a doubling. Texts of similarity J
#: differ in it by a factor of at most 1 / J, so comparing it first loses no pair.
SIZE_STEPS = 12
#: The complete distances allowed are this many standard deviations beyond the expectation at the threshold.
SIGMAS = 4.0
#: Symbols whose bits stand in one word a bit (``PLANES`` words); the rest of the symbols follow in one word, a byte each.
PLANED, PLANES = 64, 8
#: Pairs a text that meet segments, bitmaps, and texts, at a time; so many pairs at least.
WITHIN_PAIRS, BOUND_PAIRS, EXACT_PAIRS, LEAST_PAIRS = 4.0, 2.0, 0.5, 50_000
#: Ids of paired texts are broadcast up to this number (16 bytes each), joined by shuffle beyond it.
BROADCAST_IDS = 1_000_000


def _stripped(texts: list[str | None]) -> np.ndarray:
    codes = codes_of(join_texts(texts).lower())
    return codes[~(spaces()[codes]) | (codes == 0)]


def _content_keys(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each whole text: equal pairs of them name equal texts."""
    ends = np.concatenate((np.flatnonzero(codes == 0), [len(codes)]))
    starts = np.concatenate(([0], ends[:-1] + 1))
    place = (np.arange(len(codes)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(codes) + 1]))))[: len(codes)]).astype(np.uint64)
    out = []
    for seed in (11, 12):
        words = mix(codes.astype(np.uint64) + (place << np.uint64(21)), seed)
        words[codes == 0] = 0
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words, dtype=np.uint64)))
        out.append((total[ends] - total[starts]).view(np.int64))
    return out[0], out[1]


def _planes(sym: np.ndarray) -> np.ndarray:
    """The symbols (n x 70 bytes) by place of their bits: PLANES words for the first PLANED, one word for the rest."""
    out = np.zeros((len(sym), PLANES + 1), np.uint64)
    for p in range(PLANES):
        out[:, p] = np.ascontiguousarray(np.packbits((sym[:, :PLANED] >> np.uint8(p)) & np.uint8(1), axis=1)).view(np.uint64)[:, 0]
    for j in range(PLANED, sym.shape[1]):
        out[:, PLANES] |= sym[:, j].astype(np.uint64) << np.uint64(8 * (j - PLANED))
    return out


def _bitmaps(grams: np.ndarray, owner: np.ndarray, distinct: np.ndarray) -> list[bytes]:
    """For each text the places that its sequences' hashes have in a bitmap of two to four bits a sequence."""
    width = np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(1, 2 * distinct)))).astype(np.int64)
    ends = np.cumsum(width)
    flags = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
    flags[(ends - width)[owner] + (grams & (width - 1).astype(np.uint64)[owner]).astype(np.int64)] = True
    packed = np.packbits(flags).tobytes()
    return [packed[(e - w) // 8 : e // 8] for e, w in zip(ends.tolist(), width.tolist(), strict=True)]


def fingerprints(texts: list[str | None]) -> dict[str, np.ndarray]:
    """h1, h2 (content), n (characters kept), segs (n x SEGMENTS words of SYMBOLS bytes), planes, sketch, distinct (sequences), bits."""
    codes = _stripped(texts)
    n = len(texts)
    h1, h2 = _content_keys(codes, n)
    grams, owner = gram_hashes(codes, Q)
    k = SEGMENTS * SYMBOLS
    per = k // ROUNDS
    low = np.full((n, k), np.iinfo(np.uint32).max, np.uint32)
    flat = low.reshape(-1)
    for r in range(ROUNDS):
        h = mix(grams, 100 + r)
        bins = ((h >> np.uint64(32)) * np.uint64(per)) >> np.uint64(32)
        np.minimum.at(flat, owner * k + r * per + bins.astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    count = np.bincount(owner, minlength=n)
    empty = low == np.iinfo(np.uint32).max
    for r in range(ROUNDS):  # an empty bin borrows from the next full one of its round
        part, void = low[:, r * per : (r + 1) * per], empty[:, r * per : (r + 1) * per]
        rows = np.flatnonzero(void.any(1) & (count > 0))
        for step in range(1, per):
            if not len(rows):
                break
            src = np.roll(part[rows], -step, 1)
            ok = void[rows] & ~np.roll(empty[rows, r * per : (r + 1) * per], -step, 1)
            fill = part[rows]
            fill[ok] = src[ok] + np.uint32(step * 0x9E3779B1 & 0xFFFFFFFF)
            part[rows] = fill
            void[rows] &= ~ok
            rows = rows[void[rows].any(1)]
    # one byte a symbol; bins of the rounds are dealt out so that each segment mixes all rounds
    order = np.arange(k).reshape(ROUNDS, per).T.reshape(-1)
    sym = (mix(low.astype(np.uint64), 7) >> np.uint64(40)).astype(np.uint8)[:, order]
    segs = np.zeros((n, SEGMENTS), np.uint64)
    for j in range(SYMBOLS):
        segs |= sym[:, j::SYMBOLS][:, :SEGMENTS].astype(np.uint64) << np.uint64(8 * j)
    sketch = np.zeros(n, np.uint64)
    for j in range(SKETCH):
        sketch |= (sym[:, j * 5 // 2].astype(np.uint64) & np.uint64(3)) << np.uint64(2 * j)
    distinct = np.array([len(np.unique(g)) for g in np.split(grams, np.searchsorted(owner, np.arange(1, n)))])
    size = np.minimum(255, np.floor(np.log2(np.maximum(distinct, 1)) * SIZE_STEPS)).astype(np.uint64)
    sketch |= size << np.uint64(56)
    return {
        "h1": h1, "h2": h2, "n": count.astype(np.int64), "segs": segs.view(np.int64), "planes": _planes(sym).view(np.int64), "sketch": sketch.view(np.int64),
        "distinct": distinct.astype(np.int64), "bits": _bitmaps(grams, owner, distinct),
    }


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            f = fingerprints(part.column("txt").to_pylist())
            lists = [pa.ListArray.from_arrays(np.arange(0, f[c].size + 1, f[c].shape[1], dtype=np.int32), pa.array(f[c].reshape(-1))) for c in ("segs", "planes")]
            flat = ["h1", "h2", "n", "sketch", "distinct"]
            columns = [part.column("rid").cast(pa.int64()), *(pa.array(f[c]) for c in flat), *lists, pa.array(f["bits"], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["rid", *flat, "segs", "planes", "bits"])


def _distinct_grams(texts: list[str]) -> list[np.ndarray]:
    codes = _stripped(texts)
    grams, owner = gram_hashes(codes, Q)
    cuts = np.searchsorted(owner, np.arange(1, len(texts)))
    return [np.unique(g) for g in np.split(grams, cuts)]


def _exact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            n = part.num_rows
            texts = part.column("text_a").to_pylist() + part.column("text_b").to_pylist()
            place = {t: i for i, t in enumerate(dict.fromkeys(texts))}
            sets = _distinct_grams(list(place))
            sim = np.zeros(n)
            for i in range(n):
                x, y = sets[place[texts[i]]], sets[place[texts[n + i]]]
                merged = np.concatenate((x, y))
                merged.sort()
                both = int((merged[1:] == merged[:-1]).sum())
                sim[i] = both / max(1, len(merged) - both)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(sim)], names=["a", "b", "similarity"])


def most_shared(bits_a: np.ndarray, bits_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """How many sequences two texts can share at most: each place that only one of them fills holds one that the other lacks.

    ``bits_a`` and ``bits_b`` hold a bitmap a row (words); the wider ones are folded to the width of the others.
    """
    while bits_a.shape[1] != bits_b.shape[1]:
        if bits_a.shape[1] > bits_b.shape[1]:
            half = bits_a.shape[1] // 2
            bits_a = bits_a[:, :half] | bits_a[:, half:]
        else:
            half = bits_b.shape[1] // 2
            bits_b = bits_b[:, :half] | bits_b[:, half:]
    only_a = np.bitwise_count(bits_a & ~bits_b).sum(1, dtype=np.int64)
    only_b = np.bitwise_count(bits_b & ~bits_a).sum(1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def _bound_batches(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = [batch.column(c).to_pylist() for c in ("bits_a", "bits_b")]
            n = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            width = [np.array([len(x) for x in b]) for b in bits]
            kept = np.zeros(batch.num_rows, bool)
            for wa, wb in {*zip(width[0].tolist(), width[1].tolist(), strict=True)}:
                rows = np.flatnonzero((width[0] == wa) & (width[1] == wb))
                words = [np.frombuffer(b"".join([b[i] for i in rows]), np.uint64).reshape(len(rows), -1) for b in bits]
                shared = most_shared(*words, n[0][rows], n[1][rows])
                kept[rows] = shared / np.maximum(1, n[0][rows] + n[1][rows] - shared) >= threshold
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(kept)) for c in ("a", "b")], names=["a", "b"])

    return run


def _mismatches(x, y):
    """Symbols (of two bits each) in which two sketches differ."""
    d = x.bitwiseXOR(y)
    return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x55555555555555)))


def _like_sizes(x, y, threshold: float):
    """Whether two sketches may belong to texts of that similarity by their numbers of sequences."""
    return F.abs(F.shiftrightunsigned(x, 56) - F.shiftrightunsigned(y, 56)) <= _size_steps(threshold)


def _size_steps(threshold: float) -> int:
    return int(SIZE_STEPS * np.log2(1 / threshold) + 1)


def _distance():
    """Symbols in which two fingerprints differ, over all segments."""

    def one(x, y):
        d = x.bitwiseXOR(y)
        for s in (4, 2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, s))
        return F.bit_count(d.bitwiseAND(F.lit(0x01010101010101)))

    return F.aggregate(F.zip_with("segs_a", "segs_b", one), F.lit(0), lambda s, d: s + d)


def _plane_distance():
    """The same distance from the planes of the two entries ``x`` and ``y``."""
    planed = F.lit(0).cast("long")
    for p in range(PLANES):
        planed = planed.bitwiseOR(F.col(f"x.p{p}").bitwiseXOR(F.col(f"y.p{p}")))
    rest = F.col(f"x.p{PLANES}").bitwiseXOR(F.col(f"y.p{PLANES}"))
    for s in (4, 2, 1):
        rest = rest.bitwiseOR(F.shiftrightunsigned(rest, s))
    return F.bit_count(planed) + F.bit_count(rest.bitwiseAND(F.lit(0x01010101010101)))


def _slack(trials: int, p: float) -> int:
    """Misses allowed among ``trials`` when each happens with probability ``p``."""
    return int(trials * p + SIGMAS * (trials * p * (1 - p)) ** 0.5 + 1)


class NearDuplicates:
    """Classes of equal texts, and verified links between different ones.

    ``df[id_col]`` must be unique and not null; ``text_col`` may be null. Case and white space are
    ignored. Texts with fewer than five remaining characters (null and empty ones too) hold no
    five-character sequence and pair with nothing. Further columns of ``df`` are never looked at, so
    their names cannot clash. Equal texts form one class whatever their number; only the least id of a
    class is compared with others. An empty table gives empty results.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, threshold: float = 0.7):
        self.threshold = threshold
        self.source = df.select(F.col(id_col).cast("long").alias("rid"), F.col(text_col).alias("txt"))
        prints = self._written(
            self.source.mapInArrow(_fingerprint_batches, "rid long, h1 long, h2 long, n long, sketch long, distinct long, segs array<long>, planes array<long>, bits binary").where("n > 0"),
            "p5-prints",
        )
        classes = self._written(prints.groupBy("h1", "h2").agg(F.min("rid").alias("rep"), F.count("*").alias("copies")), "p5-classes")
        self.members = self._written(prints.select("rid", "h1", "h2").join(classes, ["h1", "h2"]).select("rid", "rep", "copies"), "p5-members")
        heads = classes.select(F.col("rep").alias("rid"))
        self.reps = self._written(prints.join(heads, "rid", "left_semi").select("rid", "sketch", "distinct", "segs", "planes", "bits"), "p5-reps")
        self.n_reps = self.reps.count()
        discard(prints)
        discard(classes)

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_dropped(df.sparkSession):
            return materialize(df, name)

    def membership(self) -> DataFrame:
        """(rid, rep, copies): the class of every text that holds a five-character sequence."""
        return self.members

    def _entries(self, rows: DataFrame) -> DataFrame:
        """(key, masked, further columns) of rows with a segment's number ``s`` and symbols ``v``: an entry for each masked symbol."""

        def entry(i: int):
            mask = ~(0xFF << 8 * i) & 0xFFFFFFFFFFFFFF
            left = F.col("v").bitwiseAND(F.lit(mask & ((1 << 8 * i) - 1)))
            right = F.shiftrightunsigned(F.col("v").bitwiseAND(F.lit(mask >> 8 * (i + 1) << 8 * (i + 1))), 8)
            key = left.bitwiseOR(right).bitwiseOR(F.shiftleft((F.col("s") * SYMBOLS + i).cast("long"), 48))
            return F.struct(key.alias("key"), F.shiftrightunsigned("v", 8 * i).bitwiseAND(F.lit(0xFF)).alias("masked"))

        rest = [c for c in rows.columns if c not in ("s", "v")]
        return rows.select(F.explode(F.array(*map(entry, range(SYMBOLS)))).alias("e"), *rest).select("e.key", "e.masked", *rest)

    def tables(self) -> DataFrame:
        """(key, rid, sketch): the entries of every different text, one for each segment and masked symbol."""
        return self._entries(self.reps.select("rid", "sketch", F.posexplode("segs").alias("s", "v"))).drop("masked")

    def near(self, x, y):
        """Whether two sketches allow for the similarity."""
        return _like_sizes(x, y, self.threshold) & (_mismatches(x, y) <= _slack(SKETCH, 0.75 * (1 - self.threshold)))

    def _met(self, segment: int) -> DataFrame:
        """(a, b), a < b: different texts that share an entry of the segment's table and are within the complete distance, each pair once."""
        planes = [F.col("planes")[p].alias(f"p{p}") for p in range(PLANES + 1)]
        size = F.shiftrightunsigned("sketch", 56).alias("size")
        entries = self._entries(self.reps.select("rid", size, *planes, F.lit(segment).alias("s"), F.col("segs")[segment].alias("v")))
        x, y = entries.alias("x"), entries.alias("y")
        both = (F.col("x.key") == F.col("y.key")) & (F.col("x.rid") < F.col("y.rid"))
        both &= F.abs(F.col("x.size") - F.col("y.size")) <= _size_steps(self.threshold)
        both &= _plane_distance() <= _slack(SEGMENTS * SYMBOLS, 1 - self.threshold)
        # equal segments meet under every mask; the first is enough
        both &= (F.col("x.masked") != F.col("y.masked")) | (F.shiftrightunsigned(F.col("x.key"), 48) % SYMBOLS == 0)
        # entries are far more than the sizes that Spark expects of an exploded table: never broadcast
        return x.join(y.hint("merge"), both).select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b"))

    def candidates(self) -> DataFrame:
        """(a, b), a < b: different texts that share a table entry and are within the complete distance and the bound, each pair once.

        One table is exchanged at a time; what met is bounded as soon as there are ``BOUND_PAIRS`` a text.
        """
        met, n, parts = [], 0, []
        for segment in range(SEGMENTS):
            met.append(self._written(self._met(segment), "p5-met"))
            n += met[-1].count()
            if segment == SEGMENTS - 1 or n >= max(LEAST_PAIRS, BOUND_PAIRS * self.n_reps):
                once = self._written(reduce(DataFrame.union, met).distinct(), "p5-once")
                for df in met:
                    discard(df)
                parts.append(self._parted(once, BOUND_PAIRS, self._bounded, "p5-bounded"))
                discard(once)
                met, n = [], 0
        return self._written(reduce(DataFrame.union, parts).distinct(), "p5-candidates")

    def _within(self, pairs: DataFrame, mine) -> DataFrame:
        """Of pairs (a, b) those within the complete distance."""
        segs = self.reps.select("rid", "segs")
        return (
            pairs.join(mine(segs).select(F.col("rid").alias("a"), F.col("segs").alias("segs_a")), "a")
            .join(segs.select(F.col("rid").alias("b"), F.col("segs").alias("segs_b")), "b")
            .where(_distance() <= _slack(SEGMENTS * SYMBOLS, 1 - self.threshold))
            .select("a", "b")
        )

    def _parted(self, pairs: DataFrame, share: float, step, name: str) -> DataFrame:
        """``step`` over written pairs, in parts of ``share`` pairs a text (cut by the hash of the first), written one after the other."""
        parts = max(1, int(-(-pairs.count() // max(LEAST_PAIRS, share * self.n_reps))))

        def part(df: DataFrame, c: str, k: int) -> DataFrame:
            return df if parts == 1 else df.where(F.pmod(F.xxhash64(c), F.lit(parts)) == k)

        return reduce(DataFrame.union, [self._written(step(part(pairs, "a", k), lambda df, k=k: part(df, "rid", k)), name) for k in range(parts)])

    def _bounded(self, pairs: DataFrame, mine) -> DataFrame:
        """Of pairs (a, b) those whose bitmaps allow for the similarity: loses none. ``mine`` cuts texts to those that can be an ``a``."""
        bits = self.reps.select("rid", "distinct", "bits")
        full = pairs.join(mine(bits).select(F.col("rid").alias("a"), F.col("distinct").alias("n_a"), F.col("bits").alias("bits_a")), "a").join(
            bits.select(F.col("rid").alias("b"), F.col("distinct").alias("n_b"), F.col("bits").alias("bits_b")), "b"
        )
        return full.mapInArrow(_bound_batches(self.threshold), "a long, b long")

    def _exact(self, pairs: DataFrame, mine) -> DataFrame:
        """(a, b, similarity) of those pairs (a, b) at or above the threshold."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
        if 2 * pairs.count() <= BROADCAST_IDS:  # keeps texts that no pair needs out of the shuffle
            wanted = F.broadcast(wanted)
        texts = self.source.join(wanted, "rid", "left_semi")
        full = pairs.join(mine(texts).select(F.col("rid").alias("a"), F.col("txt").alias("text_a")), "a").join(
            texts.select(F.col("rid").alias("b"), F.col("txt").alias("text_b")), "b"
        )
        checked = full.mapInArrow(_exact_batches, "a long, b long, similarity double")
        return checked.where(F.col("similarity") >= self.threshold)

    def verified(self, met: DataFrame) -> DataFrame:
        """(a, b, similarity): of pairs of different texts those at or above the threshold, by the complete distance, by bitmaps, then exactly."""
        pairs = self._written(met, "p5-met")
        within = self._parted(pairs, WITHIN_PAIRS, self._within, "p5-within")
        discard(pairs)
        bounded = self._parted(within, BOUND_PAIRS, self._bounded, "p5-bounded")
        return self._parted(bounded, EXACT_PAIRS, self._exact, "p5-links")

    def links(self) -> DataFrame:
        """(a, b, similarity): all met pairs of different texts at or above the threshold, verified exactly."""
        return self._parted(self.candidates(), EXACT_PAIRS, self._exact, "p5-links")

    def found(self) -> DataFrame:
        """(row_id_a, row_id_b): every pair of rows, copies expanded; the form TESTDATA.md fixes."""
        links = self.links()
        members = self.membership()
        crowd = members.where("copies > 1").select("rid", "rep")
        same = crowd.alias("x").join(crowd.alias("y"), (F.col("x.rep") == F.col("y.rep")) & (F.col("x.rid") < F.col("y.rid")))
        across = links.join(members.select(F.col("rep").alias("a"), F.col("rid").alias("ra")), "a").join(
            members.select(F.col("rep").alias("b"), F.col("rid").alias("rb")), "b"
        )
        return same.select(F.col("x.rid").alias("row_id_a"), F.col("y.rid").alias("row_id_b")).union(
            across.select(F.least("ra", "rb"), F.greatest("ra", "rb"))
        )

    def groups(self) -> DataFrame:
        """(row_id, class_id, group_id, copies): one row per text that has a copy or a link.

        class_id is the least id with an equal text, group_id the least id of the connected group. Pairs of a crowd
        are not formed: table entries are linked through their least text, and further only between groups.
        """

        entries = self.tables().select(F.col("key").alias("bucket"), F.col("rid").alias("node"), "sketch")
        with shuffles_dropped(self.source.sparkSession):
            parts = linked_groups(entries, self.verified, self.near)
        return (
            self.membership()
            .join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .where("copies > 1 or component is not null")
            .select(F.col("rid").alias("row_id"), F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("group_id"), "copies")
        )
