"""Per-document text statistics, and the kind of a text by gradient-boosted trees over them.

Statistics of every row are computed once. Structural rules label a bounded sample of rows as clear
prose, list, table or junk; softmax-boosted trees are trained on those and on one half of the
hand-checked labels (majority of the raters), the class probabilities are calibrated on a quarter of the labels by one
temperature and one offset per class, and the last quarter measures the outcome.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.storage import materialize

KINDS = ("prose", "list", "table", "junk")
#: Bounds of what is collected for training: rows under structural rules, and labelled rows.
WEAK_ROWS, LABELLED_ROWS = 8_000, 20_000
#: Words of each script, by the number of texts that hold them, that count as common; a script is a block of 128 code
#: points, so no language's list depends on how many texts others have.
COMMON_WORDS = 1_000
ROUNDS, DEPTH, RATE, BINS = 40, 4, 0.2, 32

NAMES = (
    "n_chars n_words mean_word_length symbol_ratio digit_ratio letter_ratio upper_ratio n_lines mean_line_length sd_line_length "
    "stop_line_share short_line_share bullet_line_share common_word_share distinct_word_share repeated_line_share delimiter_mode "
    "delimiter_line_share slash_ratio mark_ratio latin1_ratio longest_word number_word_share stops_per_word words_per_line long_word_share cell_width page_line_share "
    "vowel_ratio line_word_sd"
).split()

_WORD = re.compile(r"[^\s]+")
_BULLET = re.compile(r"\s*(?:[-*•▪–—·>]|\(?(?:\d{1,3}|[a-z]|[ivxl]{1,5})[.)])\s+\S", re.I)
_STOP = re.compile(r"[.!?।॥…][\"”')\]]*\s*$")
_PAGE = re.compile(r"(?:\s|\.)(?:p\.?\s*)?\d+\s*$")
_DELIMITERS = (";", "|", "\t", ",", " : ", "=")
_NUMBER = re.compile(r"[\W\d]*\d[\W\d]*$")
EDGES = ".,;:!?।॥\"'()[]“”…"


def _words_of(text: str) -> list[str]:
    return [w.strip(EDGES) for w in text.lower().split()]


def statistics(text: str | None, common: frozenset[str]) -> list[float]:
    """The statistics named by NAMES; all 0 for null and blank texts."""
    if not text or not text.strip():
        return [0.0] * len(NAMES)
    words = text.split()
    bare = [w.strip(EDGES) for w in text.lower().split()]
    n, m = len(text), len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    k = len(lines)
    lens = np.array([len(x) for x in lines], float)
    per = np.array([x.count(" ") + 1 for x in lines], float)
    digits = sum(map(text.count, "0123456789"))
    letters = sum(map(str.isalpha, text))
    spaces = text.count(" ") + text.count("\n") + text.count("\t")
    marks = sum(1 for c in text if "ऀ" <= c <= "෿") - sum(1 for c in text if "ऀ" <= c <= "෿" and c.isalpha())
    best = (0.0, 0.0, 0.0)
    if k > 1:
        for d in _DELIMITERS:
            counts = Counter(x.count(d) for x in lines)
            mode, share = max(((c, v / k) for c, v in counts.items() if c > 0), key=lambda x: x[1], default=(0, 0.0))
            if share > best[1]:
                best = (float(mode), share, float(lens.mean()) / (mode + 1))
    numbers = sum(1 for w in words if _NUMBER.match(w))
    length = [len(w) for w in words]
    vowels = sum(map(text.lower().count, "aeiou"))
    latin = sum(1 for c in text if c.isascii() and c.isalpha()) or 1
    return [
        float(n), float(m), sum(length) / m, max(0.0, (n - letters - digits - spaces - marks)) / n, digits / n, letters / n,
        sum(map(str.isupper, text)) / n, float(k), float(lens.mean()), float(lens.std()),
        sum(1 for x in lines if _STOP.search(x)) / k, float((lens < 60).mean()), sum(1 for x in lines if _BULLET.match(x)) / k,
        sum(w in common for w in bare) / m, len(set(bare)) / m, 1 - len(set(lines)) / k, best[0], best[1],
        text.count(" / ") / m, marks / n, sum(1 for c in text if "\x80" <= c <= "˿" or c in "‹›€™œ") / n, float(max(length)), numbers / m,
        sum(text.count(c) for c in ".!?।") / m, float(per.mean()), sum(x > 18 for x in length) / m, best[2], sum(1 for x in lines if _PAGE.search(x)) / k,
        vowels / latin, float(per.std()),
    ]


def weak_kind(s: np.ndarray) -> int:
    """Structural rule: the index of a clear kind in KINDS, -1 where no rule applies."""
    f = dict(zip(NAMES, s, strict=True))
    if f["n_words"] == 0:
        return -1
    if f["common_word_share"] > 0.6 and f["words_per_line"] > 6 and f["number_word_share"] < 0.1 and f["delimiter_mode"] < 3 and f["slash_ratio"] < 0.05:
        return 0
    if f["n_lines"] >= 3 and f["delimiter_line_share"] >= 0.9 and f["delimiter_mode"] >= 2 and f["stop_line_share"] < 0.2:
        return 2
    if f["n_lines"] >= 4 and f["number_word_share"] > 0.4 and f["words_per_line"] < 9 and f["bullet_line_share"] < 0.5:
        return 2
    if f["n_lines"] >= 4 and f["words_per_line"] < 6.5 and f["stop_line_share"] < 0.2 and f["delimiter_mode"] < 2 and (f["bullet_line_share"] > 0.8 or f["common_word_share"] > 0.3):
        return 1
    if f["slash_ratio"] > 0.15 and f["n_lines"] <= 2:
        return 1
    if f["common_word_share"] < 0.1 and f["n_lines"] and f["delimiter_line_share"] < 0.5:
        return 3
    return -1


class Boosted:
    """Softmax gradient boosting with histogram trees; NumPy only."""

    def __init__(self, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE, bins: int = BINS):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int = len(KINDS)) -> Boosted:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._binned(x)
        prior = np.bincount(y, w, minlength=classes) + 1.0
        self.base = np.log(prior / prior.sum())
        score = np.tile(self.base, (len(y), 1))
        onehot = np.eye(classes)[y]
        for _ in range(self.rounds):
            p = _softmax(score)
            grad, hess = (p - onehot) * w[:, None], np.maximum(p * (1 - p), 1e-6) * w[:, None]
            trees = []
            for c in range(classes):
                tree = self._tree(b, grad[:, c], hess[:, c])
                trees.append(tree)
                score[:, c] += self.rate * _leaf(tree, b, self.depth)
            self.trees.append(trees)
        return self

    def _tree(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = (1 << self.depth) - 1
        feature, cut, value = np.full(inner, -1), np.zeros(inner, int), np.zeros(1 << self.depth)
        node = np.zeros(len(g), int)
        wide = self.bins + 1
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level
            place = node - first
            best, bf, bc = np.full(count, 1e-3), np.full(count, -1), np.zeros(count, int)
            for j in range(b.shape[1]):
                key = place * wide + b[:, j]
                gs = np.bincount(key, g, count * wide).reshape(count, wide).cumsum(1)
                hs = np.bincount(key, h, count * wide).reshape(count, wide).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(hs < 0.5) | (ht - hs < 0.5)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(count), at]
                better = top > best
                best[better], bf[better], bc[better] = top[better], j, at[better]
            feature[first : first + count], cut[first : first + count] = bf, bc
            f = bf[place]
            right = (f >= 0) & (b[np.arange(len(g)), np.maximum(f, 0)] > bc[place])
            node = 2 * node + 1 + right
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, len(value)), np.bincount(leaf, h, len(value))
        return feature, cut, -gs / (hs + 1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        out = np.tile(self.base, (len(x), 1))
        for trees in self.trees:
            for c, tree in enumerate(trees):
                out[:, c] += self.rate * _leaf(tree, b, self.depth)
        return out


def _leaf(tree, b: np.ndarray, depth: int) -> np.ndarray:
    feature, cut, value = tree
    node = np.zeros(len(b), int)
    rows = np.arange(len(b))
    for _ in range(depth):
        f = feature[node]
        node = 2 * node + 1 + ((f >= 0) & (b[rows, np.maximum(f, 0)] > cut[node]))
    return value[node - len(feature)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def calibrate(scores: np.ndarray, y: np.ndarray, steps: int = 300) -> np.ndarray:
    """(temperature, offsets...) by gradient descent on the holdout's log loss, drawn towards (1, 0...)."""
    par = np.zeros(1 + scores.shape[1])
    par[0] = 1.0
    if not len(y):
        return par
    onehot = np.eye(scores.shape[1])[y]
    for _ in range(steps):
        err = _softmax(scores * par[0] + par[1:]) - onehot
        grad = np.concatenate(([(err * scores).sum()], err.sum(0))) + 2.0 * (par - np.eye(1, len(par))[0])
        par -= 0.5 / (len(y) + 10) * grad * np.concatenate(([0.1], np.ones(scores.shape[1])))
        par[0] = min(3.0, max(0.2, par[0]))
    return par


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "texts"])

    for batch in batches:
        for text in batch.column("txt").to_pylist():
            if text:
                seen.update(set(_words_of(text)))
        if len(seen) > 200_000:
            yield out()
            seen.clear()
    if seen:
        yield out()


def _stat_batches(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = frozenset(common.value)
        for batch in batches:
            stats = np.array([statistics(t, words) for t in batch.column("txt").to_pylist()]).reshape(-1, len(NAMES))
            flat = pa.ListArray.from_arrays(np.arange(0, stats.size + 1, len(NAMES), dtype=np.int32), pa.array(stats.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), flat], names=["id", "stats"])

    return run


def text_statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, stats) of every row; ``stats`` in the order of NAMES. Common words are counted over all rows."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("txt"))
    words = src.select("txt").mapInArrow(_word_batches, "word string, texts long").where(F.length("word") > 1).where(~F.col("word").rlike("[0-9]"))
    counts = words.groupBy("word").agg(F.sum("texts").alias("texts")).withColumn("script", F.shiftright(F.ascii("word"), 7)).withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64)))
    best = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy(F.desc("texts"), "word"))
    # the first of each part of a script, then of the script: no task ranks all words of one
    few = counts.withColumn("r", best("script", "part")).where(F.col("r") <= COMMON_WORDS)
    top = few.withColumn("r", best("script")).where(F.col("r") <= COMMON_WORDS).select("word").collect()  # COMMON_WORDS a script
    common = df.sparkSession.sparkContext.broadcast([r.word for r in top])
    return materialize(src.mapInArrow(_stat_batches(common), "id long, stats array<double>"), "p4-stats")


class KindModel:
    """Boosted trees on weak labels and half of the checked ones, calibrated on a quarter; the last quarter, which neither
    has seen, is held out: ``holdout`` has (true kind, found kind) of its rows."""

    def __init__(self, weak: np.ndarray, labelled: np.ndarray, labels: np.ndarray):
        kinds = np.array([weak_kind(s) for s in weak], int) if len(weak) else np.zeros(0, int)
        use = kinds >= 0
        part = np.arange(len(labels)) % 4
        train, tune, held = part % 2 == 0, part == 1, part == 3
        x = np.concatenate((weak[use], labelled[train]))
        y = np.concatenate((kinds[use], labels[train]))
        w = np.concatenate((np.full(use.sum(), 0.5), np.full(train.sum(), 2.0)))
        self.trees = Boosted().fit(x, y, w) if len(y) else None
        scores = self.trees.scores(labelled[tune]) if self.trees and tune.any() else np.zeros((0, len(KINDS)))
        self.par = calibrate(scores, labels[tune] if len(scores) else np.zeros(0, int))
        found = self.probabilities(labelled[held]).argmax(1) if held.any() else np.zeros(0, int)
        self.holdout = list(zip(labels[held].tolist(), found.tolist(), strict=True))

    def _raw(self, scores: np.ndarray) -> np.ndarray:
        return _softmax(scores * self.par[0] + self.par[1:])

    def probabilities(self, stats: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(stats):
            return np.tile(np.array([1.0, 0, 0, 0]), (len(stats), 1))
        return self._raw(self.trees.scores(stats))


def fit_kinds(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> KindModel:
    """Train on bounded samples: WEAK_ROWS rows in hash order, LABELLED_ROWS labelled rows in hash order.

    Of several labels of a row the most frequent counts (ties: the first in the alphabet); labels that
    are null or unknown are left out.
    """
    votes = labels.where(F.col(label_col).isin(*KINDS)).groupBy(F.col(id_col).cast("long").alias("id"), label_col).agg(F.count("*").alias("n"))
    one = votes.groupBy("id").agg(F.max_by(label_col, F.struct(F.col("n"), -F.array_position(F.array(*[F.lit(k) for k in sorted(KINDS)]), F.col(label_col)))).alias("kind"))
    told = stats.join(one, "id").orderBy(F.xxhash64("id"), "id").limit(LABELLED_ROWS).collect()
    weak = stats.orderBy(F.xxhash64("id"), "id").limit(WEAK_ROWS).select("stats").collect()
    k = len(NAMES)
    return KindModel(
        np.array([r.stats for r in weak]).reshape(-1, k), np.array([r.stats for r in told]).reshape(-1, k), np.array([KINDS.index(r.kind) for r in told], int)
    )


def _kind_batches(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.asarray(batch.column("stats").flatten(), float).reshape(-1, len(NAMES))
            p = model.value.probabilities(stats)
            kinds = [KINDS[i] for i in p.argmax(1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("stats"), pa.array(kinds), pa.array(p.max(1))], names=["id", "stats", "kind", "probability"])

    return run


def holdout_report(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, label_id: str, label_col: str) -> DataFrame:
    """(kind, found, n): how many held-out rows with each checked kind were found to be of each kind."""
    model = fit_kinds(text_statistics(df, id_col, text_col), labels, label_id, label_col)
    rows = [(KINDS[a], KINDS[b], n) for (a, b), n in sorted(Counter(model.holdout).items())]
    return df.sparkSession.createDataFrame(rows, "kind string, found string, n long")


def text_kinds(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, label_id: str, label_col: str) -> DataFrame:
    """(id, stats, kind, probability) of every row; null and blank texts are ``junk`` by definition."""
    stats = text_statistics(df, id_col, text_col)
    model = df.sparkSession.sparkContext.broadcast(fit_kinds(stats, labels, label_id, label_col))
    kinds = stats.mapInArrow(_kind_batches(model), "id long, stats array<double>, kind string, probability double")
    blank = F.element_at("stats", 1) == 0
    return kinds.withColumn("kind", F.when(blank, "junk").otherwise(F.col("kind"))).withColumn("probability", F.when(blank, 1.0).otherwise(F.col("probability")))
