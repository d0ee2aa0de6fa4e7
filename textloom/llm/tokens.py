"""Token counts of whole texts under an existing byte-level BPE, by way of distinct pieces.

A text falls into chunks (white space and the word after it) that no token crosses. Distinct chunks are
counted over the corpus, ranged by prefix into partitions, and cut into the tokenizer's pieces; the
sorted distinct pieces of a partition are a prefix trie in depth-first order. Along the current path
every byte position keeps the exact state of its prefix: the last token and the number of tokens.
The encoding of a prefix is the encoding of a shorter one plus one token that is compatible with
its last token, so a node's state follows from its ancestors' states and shared prefixes are never
encoded twice. Counts of chunks are then joined to the texts.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.storage import materialize, scratch

#: The vocabulary file if neither the call nor the setting ``textloom.vocabulary`` of the session names one; every
#: executor gets it through the broadcast of its ranks, only the driver reads the file.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# The published pre-tokenisation pattern of these vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = regex.compile(PATTERN.replace(r"\s\p", f"{WHITE}\\p").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))
_ODD = re.compile(f"[{WHITE}] ")
_CUT = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
#: The most frequent chunks, with their counts, are broadcast (at most this many, each at most
#: HOT_BYTES long: under 10 MB in all); every other chunk goes through a shuffled join.
HOT_CHUNKS, HOT_BYTES = 60_000, 96

#: Classes of pieces: words by script, figures, everything else; Latin words that the vocabulary does not hold
#: whole are a class of their own, as it takes many more tokens a character to spell them.
CLASSES = ("latin", "deva", "beng", "taml", "telu", "digit", "other", "spelled")


def chunks(text: str) -> list[str]:
    """White space plus following word, concatenating to the text; no token crosses a cut."""
    if _ODD.search(text):
        return _CUT.split(text)
    parts = text.split(" ")
    return [parts[0], *[" " + p for p in parts[1:]]]


class TriePath:
    """Exact BPE states along the path to the current piece; pieces must come in sorted order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.alone: dict[bytes, bool] = {}
        self.path = b""
        self.last: list[bytes] = [b""]
        self.count: list[int] = [0]

    def merge(self, data: bytes) -> list[bytes]:
        """Plain BPE: join the adjacent parts of least rank until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: bytes, token: bytes) -> bool:
        if not before:
            ok = self.alone.get(token)
            if ok is None:
                ok = self.alone[token] = self.merge(token) == [token]
            return ok
        ok = self.pairs.get((before, token))
        if ok is None:
            ok = self.pairs[(before, token)] = self.merge(before + token) == [before, token]
        return ok

    def tokens(self, piece: bytes) -> int:
        keep, top = 0, min(len(self.path), len(piece))
        while keep < top and self.path[keep] == piece[keep]:
            keep += 1
        del self.last[keep + 1 :], self.count[keep + 1 :]
        ranks, last, count = self.ranks, self.last, self.count
        for end in range(keep + 1, len(piece) + 1):
            for start in range(max(0, end - self.longest), end):
                token = piece[start:end]
                if token in ranks and self.fits(last[start], token):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
        self.path = piece
        return 1 if piece in ranks else count[len(piece)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: Counts by class travel as one integer, so many bits a class.
BITS = 40


def packed(counts: Iterable[int]) -> int:
    return sum(int(n) << BITS * i for i, n in enumerate(counts))


def unpacked(word: int) -> list[int]:
    return [word >> BITS * i & (1 << BITS) - 1 for i in range(len(CLASSES))]


def class_of(piece: str, tokens: int) -> int:
    """Class (in CLASSES) of a piece by its first visible character; pieces of white space are ``other``."""
    kind = min(6, int(_class_lut()[ord(piece[1] if len(piece) > 1 and piece[0] == " " else piece[0])]))
    return 7 if kind == 0 and tokens > 1 else kind


def count_chunks(found: list[str], trie: TriePath) -> list[int]:
    """Tokens of each chunk by class (packed), through the trie of their distinct pieces."""
    pieces = [_PIECES.findall(c) for c in found]
    counted: dict[str, int] = {}
    for data, piece in sorted((p.encode("utf-8", "replace"), p) for p in {p for ps in pieces for p in ps}):
        n = trie.tokens(data)
        counted[piece] = n << BITS * class_of(piece, n)
    return [sum(counted[p] for p in ps) for ps in pieces]


def _vocabulary_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["chunk", "uses"])

    for batch in batches:
        for text in batch.column("txt").to_pylist():
            if text:
                seen.update(chunks(text))
        if len(seen) > 300_000:
            yield out()
            seen.clear()
    if seen:
        yield out()


def _class_lists(words: list[int]) -> pa.ListArray:
    flat = np.array([unpacked(w) for w in words], np.int64).reshape(-1)
    return pa.ListArray.from_arrays(np.arange(0, flat.size + 1, len(CLASSES), dtype=np.int32), pa.array(flat))


def _count_batches(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = TriePath(ranks.value)  # one for the task: its batches come in sorted order
        for batch in batches:
            counts = count_chunks(batch.column("chunk").to_pylist(), trie)
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("uses"), _class_lists(counts)], names=["chunk", "uses", "kinds"])

    return run


def vocabulary(texts: DataFrame, path: str | None = None) -> DataFrame:
    """(chunk, uses, kinds) of every distinct chunk of column ``txt``, ``kinds`` its tokens by class; written once."""
    spark = texts.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(path or spark.conf.get("textloom.vocabulary", VOCABULARY)))
    counted = texts.select("txt").mapInArrow(_vocabulary_batches, "chunk string, uses long")
    distinct = counted.where("chunk <> ''").groupBy("chunk").agg(F.sum("uses").alias("uses"))
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = distinct.repartitionByRange(width, "chunk").sortWithinPartitions("chunk")
    return materialize(ranged.mapInArrow(_count_batches(ranks), "chunk string, uses long, kinds array<long>"), "vocabulary")


_CLASS_LUT: np.ndarray | None = None


def _class_lut() -> np.ndarray:
    """Class of each code point: letters and marks by script, digits, other visible signs; 7 is white space."""
    global _CLASS_LUT
    if _CLASS_LUT is None:
        lut = np.full(0x110000, 6, np.uint8)
        for i in range(0x3001):
            c = chr(i)
            if c.isspace():
                lut[i] = 7
            elif c.isdigit():
                lut[i] = 5
            elif i < 0x250 and c.isalpha():
                lut[i] = 0
            elif 0x900 <= i < 0xD00 and i not in (0x964, 0x965):
                lut[i] = {0x9: 1 if i < 0x980 else 2, 0xB: 3, 0xC: 4}.get(i >> 8, 6) if i < 0xC80 else 6
        lut[0] = 8
        _CLASS_LUT = lut
    return _CLASS_LUT


def _document_batches(hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, int] = hot.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, texts = part.column("id").to_pylist(), part.column("txt").to_pylist()
                owners, found, times, sums, at_sum = [], [], [], [], []
                for i, text in zip(ids, texts, strict=True):
                    total, rare = 0, None
                    for c in chunks(text) if text else ():
                        n = table.get(c)
                        if n is not None:
                            total += n
                        elif c:
                            rare = rare or []
                            rare.append(c)
                    sums.append(total), at_sum.append(len(owners))
                    owners.append(i), found.append(None), times.append(1)
                    for c, n in Counter(rare).items() if rare else ():
                        owners.append(i), found.append(c), times.append(n)
                kinds: list = [None] * len(owners)
                for row, total in zip(at_sum, sums, strict=True):
                    kinds[row] = unpacked(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners, pa.int64()), pa.array(found, pa.string()), pa.array(times, pa.int64()), pa.array(kinds, pa.list_(pa.int64()))],
                    names=["id", "chunk", "n", "kinds"],
                )

    return run


def token_counts(df: DataFrame, id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """(id, tokens, kinds): exact token count of every text, and the same by class of piece.

    One row per row of ``df`` when ids are unique; rows of one id add up. A null or empty text has 0
    tokens. Control tokens are never recognised in a text. Other columns are not looked at.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("txt"))
    with scratch() as tables:
        words = vocabulary(src, path)
        hot_rows = words.where(F.octet_length("chunk") <= HOT_BYTES).orderBy(F.desc("uses"), "chunk").limit(HOT_CHUNKS).select("chunk", "kinds")
        hot = df.sparkSession.sparkContext.broadcast({r.chunk: packed(r.kinds) for r in hot_rows.toLocalIterator()})
        split = materialize(src.mapInArrow(_document_batches(hot), "id long, chunk string, n long, kinds array<long>"), "chunks")
        k = range(len(CLASSES))
        rare = split.where("chunk is not null").select("id", "chunk", "n").join(words.select("chunk", F.col("kinds").alias("each")), "chunk")
        rare = rare.groupBy("id").agg(*[F.sum(F.col("n") * F.col("each")[i]).alias(f"t{i}") for i in k])
        known = split.where("chunk is null").groupBy("id").agg(*[F.sum(F.col("kinds")[i]).alias(f"t{i}") for i in k])
        whole = known.union(rare).groupBy("id").agg(*[F.sum(f"t{i}").alias(f"t{i}") for i in k])
        counts = whole.select("id", sum((F.col(f"t{i}") for i in k), F.lit(0)).alias("tokens"), F.array(*[f"t{i}" for i in k]).alias("kinds"))
        return tables.keep(materialize(counts, "token-counts"))


# Spellings of the corpus languages.
LANGUAGES = {
    "en": ["en", "eng", "english", "en-in", "en_in", "en-us", "en-gb"],
    "hi": ["hi", "hin", "hindi", "hi-in", "hi_in"],
    "bn": ["bn", "ben", "bengali", "bangla", "bn-in", "bn_in"],
    "ta": ["ta", "tam", "tamil", "ta-in", "ta_in"],
    "te": ["te", "tel", "telugu", "te-in", "te_in"],
}


def language(*cols):
    """The language code of the first column with a known spelling; null if none has one."""
    spell = F.create_map(*[F.lit(x) for code, names in LANGUAGES.items() for name in names for x in (name, code)])
    return F.coalesce(*[F.element_at(spell, F.lower(F.trim(c))) for c in cols])


#: Rows count as sound in a fitting round if the given count is within this factor of the expected one.
TRUST, FIT_ROUNDS = 2.2, 6


def fit_rates(rows: DataFrame, given: str) -> list[float]:
    """Tokens of some other tokenizer, whose counts stand in ``given``, for one token of each class.

    Rates start from the median ratio over all rows and are refined by weighted least squares over all
    rows whose given count is within TRUST of the expectation, FIT_ROUNDS times. Null and non-positive
    counts and texts without tokens are never fitted; with no such row every rate is one.
    """
    k = len(CLASSES)
    x = [F.col("kinds")[i].cast("double") for i in range(k)]
    y = F.col(given).cast("double")
    usable = rows.where((F.col(given) > 0) & (F.col("tokens") > 0))
    # a class's start: the median over the texts it makes up most of (at most k rows)
    most = F.array_position("kinds", F.array_max("kinds"))
    starts = {r.most: r.m for r in usable.groupBy(most.alias("most")).agg(F.percentile_approx(y / F.col("tokens"), 0.5, 10_000).alias("m")).collect()}
    if not starts:
        return [1.0] * k
    common = float(np.median(list(starts.values())))
    first = np.array([starts.get(i + 1, common) for i in range(k)], float)
    rates = first
    for _ in range(FIT_ROUNDS):
        sound = usable.where(F.abs(F.log(y) - F.log(expected(rates))) < float(np.log(TRUST)))
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        sums = sound.agg(F.count("*"), *[F.sum(x[i] * x[j] / y) for i, j in pairs], *[F.sum(c) for c in x]).first()
        if not sums[0]:
            break
        gram = np.zeros((k, k))
        for (i, j), v in zip(pairs, sums[1 : 1 + len(pairs)], strict=True):
            gram[i, j] = gram[j, i] = v
        hold = 1e-6 * np.trace(gram) / k  # classes that hardly occur stay where they started
        rates = np.linalg.solve(gram + hold * np.eye(k), np.array(sums[1 + len(pairs) :], float) + hold * first)
    return [float(r) for r in rates]


def expected(rates) -> Column:
    """Tokens of the other tokenizer that a text of ``kinds`` should have; one at least."""
    return F.greatest(F.lit(1.0), sum((F.lit(float(r)) * F.col("kinds")[i] for i, r in enumerate(rates)), F.lit(0.0)))


def expected_counts(rows: DataFrame, given: str) -> DataFrame:
    """``rows`` (tokens, kinds, and a count ``given`` by some other tokenizer) plus ``expected`` and ``script``, the
    language whose script takes up most of the expected tokens (``und`` without letters)."""
    rates = fit_rates(rows, given)
    of = lambda i: F.greatest(F.lit(0.0), F.lit(rates[i]) * F.col("kinds")[i])
    letters = F.array(of(0) + of(7), *[of(i) for i in range(1, 5)])
    script = F.when(F.array_max(letters) > 0, F.element_at(F.array(*[F.lit(c) for c in ("en", "hi", "bn", "ta", "te")]), F.array_position(letters, F.array_max(letters)).cast("int"))).otherwise("und")
    return rows.withColumn("expected", expected(rates)).withColumn("script", script)
