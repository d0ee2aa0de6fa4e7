"""Passages of held-out items inside corpus texts, by the q-gram lemma.

Both sides are squeezed: markup goes, compatible spellings, cases, digits and look-alike letters are
made one, and only letters, marks and digits stay. A passage is a run of ``words`` consecutive words of
an item (the whole item if that is shorter). A text that holds a passage of w characters within k edits
shares at least w + 1 - q(k + 1) of its q-grams with it, all inside a band of k + 1 diagonals. Shared
q-grams are counted in overlapping bands of twice that width, regions that reach the bound are
aligned in a band around the diagonal, and what lies within the edit budget is reported.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.kernels import codes_of, gram_hashes, join_texts

TAG = re.compile(r"</?[a-zA-Z!][^<>\0]*>")
DROP = np.uint32(0xFFFFFFFF)
# Cyrillic and Greek small letters that look like Latin ones.
LOOKALIKES = dict(zip("аеорсухіјѕԁһոցаοαρνικτ", "aeopcyxijsdhngaoapvikt", strict=True))
#: Items are indexed in blocks of at most this many squeezed characters, each broadcast by itself.
BLOCK_CHARS = 4_000_000
CHUNK_CHARS = 1_500_000

_LUT: np.ndarray | None = None


def _lut() -> np.ndarray:
    global _LUT
    if _LUT is None:
        lut = np.arange(0x110000, dtype=np.uint32)
        for i in range(1, 0x20000):
            c = chr(i)
            digit = unicodedata.digit(c, None)
            if digit is not None:
                lut[i] = ord(str(digit))
            elif unicodedata.category(c)[0] not in "LMN" or 0xFE00 <= i <= 0xFE0F:
                lut[i] = DROP
        lut[0xE0000:0xE01F0] = DROP
        for a, b in LOOKALIKES.items():
            lut[ord(a)] = ord(b)
        _LUT = lut
    return _LUT


def _folded(texts: list[str | None]) -> str:
    big = join_texts(texts)
    if "<" in big:
        big = TAG.sub(" ", big)
    if "&" in big:
        big = html.unescape(big)
        if big.count("\0") != len(texts) - 1:  # an entity stood for U+0000
            return "\0".join(html.unescape(TAG.sub(" ", t or "")).replace("\0", " ") for t in texts)
    return big


def squeeze(texts: list[str | None]) -> np.ndarray:
    """Code points of all texts, squeezed, with a 0 between texts."""
    big = unicodedata.normalize("NFKC", _folded(texts)).casefold()
    codes = _lut()[codes_of(big)]
    return codes[codes != DROP]


class ItemIndex:
    """q-grams and word starts of a bounded block of items."""

    def __init__(self, ids: list[int], texts: list[str | None], words: int, edits: int):
        self.ids, self.edits = np.array(ids, np.int64), edits
        split = [[w for w in _folded([t]).split() if len(squeeze([w]))] for t in texts]
        self.codes = [squeeze([" ".join(w)]) for w in split]
        self.windows: list[tuple[np.ndarray, np.ndarray]] = []
        short = []
        for w in split:
            ends = np.cumsum([len(squeeze([x])) for x in w], dtype=np.int64) if w else np.zeros(0, np.int64)
            starts = np.concatenate((np.zeros(1, np.int64), ends))[: len(w)]
            m = min(words, len(w))
            s, e = (starts[: len(w) - m + 1], ends[m - 1 :]) if m else (ends, ends)
            self.windows.append((s, e))
            short.append(int((e - s).min()) if m else 0)
        # the longest q-grams that the lemma leaves something of; passages under five characters are looked up whole
        k = edits + 1
        plans = [(12, 12 * k + 6, 1 << 60), (8, 8 * k + 2, 12 * k + 6), (5, 5, 8 * k + 2), *[(q, q, q + 1) for q in (4, 3, 2, 1)]]
        self.tables = []
        for q, lo, hi in plans:
            own = [i for i, n in enumerate(short) if lo <= n < hi]
            if own:
                least = np.full(len(split), 1 << 40, np.int64)
                plan = {}
                for i in own:
                    s, e = self.windows[i]
                    room = self._budget(e - s, q)
                    plan[i] = (s, e, room, np.maximum(1, (e - s) + 1 - q * (room + 1)))
                    least[i] = plan[i][3].min()
                self.tables.append((q, plan, least, *self._table(own, q)))

    def _table(self, own: list[int], q: int):
        parts = [(gram_hashes(self.codes[i], q)[0], i) for i in own]
        grams = np.concatenate([g for g, _ in parts])
        item = np.concatenate([np.full(len(g), i, np.int32) for g, i in parts])
        pos = np.concatenate([np.arange(len(g), dtype=np.int32) for g, _ in parts])
        order = np.argsort(grams, kind="stable")
        unique, first, count = np.unique(grams[order], return_index=True, return_counts=True)
        maybe = np.zeros(1 << 22, bool)
        maybe[(unique >> np.uint64(42)).astype(np.int64)] = True
        return unique, first, count, item[order], pos[order], maybe

    def _budget(self, width: np.ndarray, q: int) -> np.ndarray:
        """Edits allowed: the full budget, less where the passage is too short for the lemma to say anything."""
        return np.clip(np.minimum(self.edits, width // q - 1), 0, None)

    def scan(self, texts: list[str | None]) -> list[tuple[int, int, int]]:
        """(text number, item number, edits) of the best aligned passage of each pair."""
        codes = squeeze(texts)
        ends = np.cumsum(codes == 0, dtype=np.int64)
        best: dict[tuple[int, int], int] = {}
        for q, plan, least, unique, first, count, item, ipos, maybe in self.tables:
            grams, owner = gram_hashes(codes, q)
            before = np.concatenate((np.zeros(1, np.int64), ends))
            at = np.flatnonzero(before[q:] == before[: len(codes) - q + 1]) if len(codes) >= q else np.zeros(0, np.int64)
            pick = np.flatnonzero(maybe[(grams >> np.uint64(42)).astype(np.int64)])
            if not len(pick):
                continue
            place = np.minimum(np.searchsorted(unique, grams[pick]), len(unique) - 1)
            ok = unique[place] == grams[pick]
            pick, place = pick[ok], place[ok]
            reps = count[place]
            offset = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            post = np.repeat(first[place], reps) + offset
            doc, dpos = np.repeat(owner[pick], reps), np.repeat(at[pick], reps)
            self._regions(best, codes, q, plan, least, doc, dpos, item[post].astype(np.int64), ipos[post].astype(np.int64))
        return [(d, i, e) for (d, i), e in best.items()]

    def _regions(self, best, codes, q, plan, least, doc, dpos, item, ipos) -> None:
        step = self.edits + 1
        diag = dpos - ipos
        band = diag // step
        band = np.concatenate((band, band - 1))  # overlapping bands, each two steps wide
        doc, item, ipos, diag = np.tile(doc, 2), np.tile(item, 2), np.tile(ipos, 2), np.tile(diag, 2)
        order = np.lexsort((ipos, band, item, doc))
        doc, item, band, ipos, diag = (x[order] for x in (doc, item, band, ipos, diag))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(doc))
        enough = stops - starts >= least[item[starts]]
        jobs = []
        for a, b in zip(starts[enough].tolist(), stops[enough].tolist(), strict=True):
            i = int(item[a])
            s, e, k, need = plan[i]
            hit = np.unique(ipos[a:b])
            shared = np.searchsorted(hit, e - q, "right") - np.searchsorted(hit, s, "left")
            for w in np.flatnonzero(shared >= need).tolist():
                near = int(np.searchsorted(ipos[a:b], s[w], "left"))
                jobs.append((int(doc[a]), i, int(s[w]), int(e[w]), int(k[w]), int(diag[a + min(near, b - a - 1)])))
        for (d, i, *_), edits in zip(jobs, self._align(codes, jobs), strict=True):
            if edits <= _[2]:
                best[(d, i)] = min(int(edits), best.get((d, i), 1 << 30))

    def _align(self, codes: np.ndarray, jobs: list[tuple]) -> np.ndarray:
        """Least edits between each passage and the text around its diagonal; all jobs advance together."""
        n = len(jobs)
        if not n:
            return np.zeros(0, np.int64)
        reach = 2 * (self.edits + 1)
        wide = 2 * reach + 1
        lens = np.array([j[3] - j[2] for j in jobs])
        m = int(lens.max())
        pat = np.zeros((n, m), np.uint32)
        for r, j in enumerate(jobs):
            pat[r, : lens[r]] = self.codes[j[1]][j[2] : j[3]]
        origin = np.array([j[5] + j[2] - reach for j in jobs])
        big = 1 << 20
        cost = np.zeros((n, wide), np.int64)  # the passage may begin anywhere in the band
        out = np.full(n, big)
        for r in range(m):
            at = origin[:, None] + r + np.arange(wide)[None, :]
            text = np.where((at >= 0) & (at < len(codes)), codes[np.clip(at, 0, len(codes) - 1)], 0)
            new = cost + (text != pat[:, r : r + 1])
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
            for c in range(1, wide):
                new[:, c] = np.minimum(new[:, c], new[:, c - 1] + 1)
            cost = new
            done = lens == r + 1
            out[done] = cost[done].min(1)
        return out


def _scanner(blocks, words: int, edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = blocks if isinstance(blocks, ItemIndex) else ItemIndex(*blocks.value, words, edits)
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("txt").to_pylist()
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size < CHUNK_CHARS):
                    size += len(texts[to] or "")
                    to += 1
                rows = [(ids[at + d], int(index.ids[i]), e) for d, i, e in index.scan(texts[at:to])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["id", "item", "edits"])
                at = to

    return run


def find_leaks(
    docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_id: str, item_text: str, words: int = 13, edits: int = 2
) -> DataFrame:
    """(id, item, edits): texts that hold a passage of an item within ``edits`` character edits.

    Null, empty and wordless texts or items never match. Repeated rows give repeated results for equal
    ids only through different ids; a pair appears once per text row. A passage of n characters is allowed at most
    n // 5 - 1 edits (under ten: none), as the lemma says nothing beyond. Items of any number are taken in blocks of
    BLOCK_CHARS characters; each block is one pass over the texts and one broadcast (under 150 MB as an index), so
    it suits items that are few beside the corpus: held-out sets of 300 items are one block. Other columns are not touched.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("txt")).where(F.length("txt") > 0)
    keep = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where(F.length("t") > 0)
    total = keep.agg(F.sum(F.length("t"))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_CHARS))
    found = None
    for b in range(n_blocks):
        block = keep.where(F.pmod(F.xxhash64("i"), F.lit(n_blocks)) == b).collect()  # bounded by BLOCK_CHARS
        shared = spark.sparkContext.broadcast(([r.i for r in block], [r.t for r in block]))
        part = src.mapInArrow(_scanner(shared, words, edits), "id long, item long, edits long")
        found = part if found is None else found.union(part)
    return found
