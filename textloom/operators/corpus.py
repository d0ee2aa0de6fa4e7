"""Operators over whole text tables: repeated lines, boilerplate, quantiles, keep decision, routing, copies, grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import quality
from textloom.functions.text import SCRIPTS, STRIP, words
from textloom.storage import materialize

# The folder of each target script, and the language code of each folder.
FOLDERS = {"Devanagari": "hindi", "Bengali": "bengali", "Tamil": "tamil", "Telugu": "telugu", "Latin": "english"}
FOLDER_CODES = {"hindi": "hi", "bengali": "bn", "tamil": "ta", "telugu": "te", "english": "en"}
#: Hashes or digests are broadcast up to this number of rows (under 40 MB), joined by shuffle beyond it.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has few enough rows; it should be a written table, as it is counted."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _lines(text: str):
    """The lines of a text that are not blank, stripped."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: F.regexp_replace(p, STRIP, ""))
    return F.filter(parts, lambda p: p != "")


def _frequent(df: DataFrame, text: str, length: int, texts: int) -> DataFrame:
    """(digest, n_docs) of the lines in at least ``texts`` rows: each row's different lines meet by a 128-bit digest, never in full."""
    digests = F.array_distinct(F.transform(F.filter(_lines(text), lambda p: F.length(p) >= length), lambda p: F.unhex(F.md5(p))))
    counts = df.select(F.explode(digests).alias("digest")).groupBy("digest").agg(F.count("*").alias("n_docs"))
    return materialize(counts.where(F.col("n_docs") >= texts), "boilerplate")


def boilerplate_lines(df: DataFrame, key: str, text: str, length: int = 8, texts: int = 3) -> DataFrame:
    """(line, n_docs): lines of ``length`` characters or more in at least ``texts`` different rows; blanks around a line are
    dropped, null texts have no lines."""
    found = small(_frequent(df, text, length, texts))
    line = df.select(F.explode(F.array_distinct(F.filter(_lines(text), lambda p: F.length(p) >= length))).alias("line")).withColumn("digest", F.unhex(F.md5("line")))
    return line.join(found, "digest").groupBy("digest").agg(F.first("line").alias("line"), F.first("n_docs").alias("n_docs")).select("line", "n_docs")


def boilerplate_share(df: DataFrame, key: str, text: str, length: int = 8, texts: int = 3) -> DataFrame:
    """(key, share): share of a text's non-blank lines that are boilerplate; 0 for null and blank texts. One row per key."""
    found = small(_frequent(df, text, length, texts).select("digest"))
    rows = df.select(key, _lines(text).alias("_l"))
    each = rows.select(key, F.size("_l").alias("n"), F.explode(F.transform(F.filter("_l", lambda p: F.length(p) >= length), lambda p: F.unhex(F.md5(p)))).alias("digest"))
    hits = each.join(found, "digest", "left_semi").groupBy(key).agg((F.count("*") / F.first("n")).alias("share"))
    return df.select(key).join(hits, key, "left").select(key, F.coalesce("share", F.lit(0.0)).alias("share"))


def exact_quantiles(df: DataFrame, group: str, value: str, probs: list[float], bins: int = 4096) -> DataFrame:
    """(_g, n, q): of every group (null is one) the exact quantiles, linear between neighbours, without one task that holds a group.

    A histogram of ``bins`` equal steps between a group's ends tells in which step each wanted rank lies; only the values
    of those steps are counted one by one. Null and NaN values are left out; a group without values has null quantiles.
    """
    x = df.select(F.col(group).alias("_g"), F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("v"))
    x = materialize(x, "quantiles")
    ends = x.groupBy("_g").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    step = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins))).otherwise(F.lit(0)).cast("int")
    placed = x.where("v IS NOT NULL").join(ends.select(F.col("_g").alias("_e"), "lo", "hi"), F.col("_g").eqNullSafe(F.col("_e"))).select("_g", "v", step.alias("bin"))
    upto = F.sum("c").over(W.partitionBy("_g").orderBy("bin").rowsBetween(W.unboundedPreceding, -1))
    hist = placed.groupBy("_g", "bin").agg(F.count("*").alias("c")).withColumn("before", F.coalesce(upto, F.lit(0)))  # at most ``bins`` rows a group
    at = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("n") - 1)).alias("at")) for i, p in enumerate(probs)])
    ranks = ends.where("n > 0").select("_g", F.explode(at).alias("w")).select("_g", "w.i", F.explode(F.array_distinct(F.array(F.floor("w.at"), F.ceil("w.at")))).alias("r"), F.col("w.at").alias("at"))
    wanted = ranks.alias("k").join(hist.alias("h"), F.col("k._g").eqNullSafe(F.col("h._g")) & (F.col("k.r") >= F.col("h.before")) & (F.col("k.r") < F.col("h.before") + F.col("h.c")))
    wanted = materialize(wanted.select(F.col("k._g").alias("_g"), "i", "r", "at", "bin", (F.col("r") - F.col("before")).alias("within")), "quantile-steps")
    near = placed.alias("p").join(wanted.select(F.col("_g").alias("_e"), F.col("bin").alias("_b")).distinct().alias("w"), F.col("p._g").eqNullSafe(F.col("w._e")) & (F.col("p.bin") == F.col("w._b")), "left_semi")
    run = F.coalesce(F.sum("c").over(W.partitionBy("_g", "bin").orderBy("v").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    values = near.groupBy("_g", "bin", "v").agg(F.count("*").alias("c")).withColumn("first", run)
    hit = wanted.alias("k").join(values.alias("x"), F.col("k._g").eqNullSafe(F.col("x._g")) & (F.col("k.bin") == F.col("x.bin")) & (F.col("within") >= F.col("first")) & (F.col("within") < F.col("first") + F.col("c")))
    one = hit.groupBy(F.col("k._g").alias("_g"), "i", "at").agg(F.min_by("v", "r").alias("a"), F.max_by("v", "r").alias("b"))
    one = one.select("_g", F.struct("i", (F.col("a") + (F.col("at") - F.floor("at")) * (F.col("b") - F.col("a"))).alias("q")).alias("q"))
    lists = one.groupBy("_g").agg(F.transform(F.array_sort(F.collect_list("q")), lambda s: s["q"]).alias("q"))  # one row a probability
    return ends.select("_g", "n").alias("e").join(lists.alias("l"), F.col("e._g").eqNullSafe(F.col("l._g")), "left").select(F.col("e._g").alias("_g"), "n", "q")


def quantile_band(df: DataFrame, key: str, group: str, value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """(key, group, value, keep): whether a value lies within its group's exact quantiles, ends included; a null value does not."""
    bands = exact_quantiles(df, group, value, [low, high]).select("_g", "q")
    inside = (F.col(value) >= F.col("q")[0]) & (F.col(value) <= F.col("q")[1])
    return df.select(key, group, value).join(bands, F.col(group).eqNullSafe(F.col("_g"))).select(key, group, value, F.coalesce(inside, F.lit(False)).alias("keep"))


def quality_rules(df: DataFrame, key: str, text: str, lang: str, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, the columns of ``keep``, one boolean a rule): whether each text passes each of the eleven metric rules and the rule on
    its source type; a missing value fails its rule. Every rule is judged over all rows, whatever the others say."""
    held = [F.col(c).alias(f"_keep_{c}") for c in keep]
    df = df.select(F.col(key).alias("_k"), F.coalesce(text, F.lit("")).alias("_t"), F.col(lang).alias("_lang"), F.col(kind).alias("_kind"), *held)
    c = F.col("_t")
    own = df.select(
        "_k", "_lang", "_kind", *[f"_keep_{k}" for k in keep], F.size(words(c)).alias("n"), quality.mean_word_length(c).alias("m"), quality.symbol_ratio(c).alias("y"),
        quality.difficulty_ratio(c).alias("d"), quality.reading_ease(c).alias("ease"), quality.repetition("_t").alias("r"),
    )
    rows = materialize(own, "quality")
    rows = rows.join(quantile_band(rows, "_k", "_lang", "ease").select("_k", F.col("keep").alias("band")), "_k").join(boilerplate_share(df, "_k", "_t").withColumnRenamed("share", "boiler"), "_k")
    rules = {
        "words": F.col("n").between(20, 100000), "mean": F.col("m").between(1.5, 20), "symbols": F.col("y") <= 0.1, "top_2gram": F.col("r.top_2gram") <= 0.2,
        "diversity": F.col("r.diversity") >= 10, "ease": F.col("band"), "difficulty": F.col("d") <= 0.6, "term": F.col("r.term") <= 0.15,
        "lines": F.col("r.lines") <= 0.3, "paragraphs": F.col("r.paragraphs") <= 0.3, "boilerplate": F.col("boiler") <= 0.3, "source_type": F.col("_kind").isin("web", "pdf"),
    }
    return rows.select(F.col("_k").alias(key), *[F.col(f"_keep_{k}").alias(k) for k in keep], *[F.coalesce(r, F.lit(False)).alias(k) for k, r in rules.items()])


_NAMES = [*SCRIPTS, "Latin"]
_LUT: np.ndarray | None = None


def _script_lut() -> np.ndarray:
    """For each code point: 0-9 its Brahmic script, 10 an ASCII letter, 11 white space, 12 anything else."""
    global _LUT
    if _LUT is None:
        lut = np.full(0x110000, 12, np.uint8)
        for i, (lo, hi) in enumerate(SCRIPTS.values()):
            lut[lo : hi + 1] = i
        for i in range(0x3001):
            if chr(i).isspace():
                lut[i] = 11
            elif i < 128 and chr(i).isalpha():
                lut[i] = 10
        lut[0] = 11
        _LUT = lut
    return _LUT


def word_scripts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(words of each text, n x 11 words of each script): a word is of the Brahmic script most of its characters are of (ties: the
    first to occur), of Latin if it has none of those but an ASCII letter, else of no script."""
    big = "\0".join((t or "").replace("\0", " ") for t in texts) + "\0"
    codes = np.frombuffer(big.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _script_lut()[codes]
    text_of = np.cumsum(codes == 0) - (codes == 0)
    visible = kind != 11
    begins = visible & np.concatenate(([True], ~visible[:-1]))
    word = np.cumsum(begins) - 1
    n = int(begins.sum())
    owner = text_of[begins]
    seen = visible & (kind < 11)
    slot = word[seen] * 11 + kind[seen]
    counts = np.bincount(slot, minlength=n * 11).reshape(n, 11)
    first = np.full(n * 11, len(codes), np.int64)
    np.minimum.at(first, slot, np.flatnonzero(seen))
    brahmic = counts[:, :10].astype(np.int64) * (len(codes) + 1) + (len(codes) - first.reshape(n, 11)[:, :10])
    best = np.where(counts[:, :10].any(1), brahmic.argmax(1), np.where(counts[:, 10] > 0, 10, 11))
    has = best < 11
    return np.bincount(owner, minlength=len(texts)), np.bincount(owner[has] * 11 + best[has], minlength=len(texts) * 11).reshape(-1, 11)


def _route_batches(key: str):
    targets = [_NAMES.index(s) for s in FOLDERS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, per = word_scripts(batch.column("_t").to_pylist())
            per = per[:, targets]
            top = per.argmax(1) if len(per) else np.zeros(0, int)
            hits = per[np.arange(len(per)), top]
            folders = [list(FOLDERS.values())[i] for i in top]
            rest = [c for c in batch.schema.names if c != "_t"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(folders, pa.string()), pa.array(hits, pa.int64()), pa.array(n, pa.int64())], names=[*rest, "_folder", "_hits", "_n"])

    return run


def route_by_script(df: DataFrame, key: str, text: str, purity: float = 0.8, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, the columns of ``keep``, folder, purity): the folder of the target script that more than ``purity`` of all words are
    in, else null; words of other scripts and of none stay in the denominator. Null and blank texts: null, 0."""
    src = df.select(key, *keep, F.col(text).alias("_t"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_t")
    rows = src.mapInArrow(_route_batches(key), f"{fields}, _folder string, _hits long, _n long")
    share = F.when(F.col("_n") > 0, F.col("_hits") / F.col("_n")).otherwise(0.0)
    return rows.select(key, *keep, F.when(share > purity, F.col("_folder")).alias("folder"), share.alias("purity"))


def language_code(c):
    """The code of a language name or code in any usual spelling; null if unknown."""
    # Names and codes of the corpus languages.
    known = {"en": "en eng english", "hi": "hi hin hindi", "bn": "bn ben bengali bangla", "ta": "ta tam tamil", "te": "te tel telugu"}
    names = F.create_map(*[F.lit(x) for code, spelled in known.items() for name in spelled.split() for x in (name, code)])
    return F.element_at(names, F.regexp_extract(F.lower(F.trim(c)), "^([a-z]+)", 1))


def exact_copies(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, keeper, copies): the least key with an equal text; null texts equal each other. Texts meet by a 128-bit digest."""
    rows = df.select(key, F.coalesce(F.md5(text), F.lit("")).alias("digest"))
    groups = rows.groupBy("digest").agg(F.min(key).alias("keeper"), F.count("*").alias("copies"))
    return rows.join(groups, "digest").select(key, "keeper", "copies")


def seeded_sample(df: DataFrame, key: str, group: str, n: int, seed: str = "42") -> DataFrame:
    """Up to ``n`` rows of each group, by the order of a seeded digest; groups with fewer rows are whole.

    A group's candidates shrink per hash bucket before the group meets, so no task sorts a whole group.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    rows = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, 2))
    near = rows.withColumn("_r", F.row_number().over(W.partitionBy(group, "_bucket").orderBy("_digest", key))).where(F.col("_r") <= n)
    return near.withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy("_digest", key))).where(F.col("_r") <= n).drop("_r", "_digest", "_bucket")


def latest(df: DataFrame, keys: list[str], at: str, values: list[str]) -> DataFrame:
    """One row of each key: its latest values (ties: the greatest); an aggregate, so no key is sorted."""
    return df.groupBy(*keys).agg(F.max(F.struct(at, *values)).alias("m")).select(*keys, "m.*")


def _grams(n: int, of):
    """``of`` applied to every run of n words of column ``w``; to all of them if there are fewer."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - n + 1)), lambda i: of(F.slice("w", i, n)))


def shared_grams(df: DataFrame, key: str, text: str, held: DataFrame, held_text: str, n: int = 13) -> DataFrame:
    """(key): rows of ``df`` with a run of n words that a held-out text has too (a shorter text matches as a whole).

    Runs meet as 64-bit hashes, against the checked broadcast of the held-out ones; what meets is compared in words. Null and
    blank texts have no runs.
    """
    joined = lambda g: F.concat_ws(" ", g)
    told = held.select(words(F.coalesce(held_text, F.lit(""))).alias("w")).where(F.size("w") > 0)
    grams = materialize(told.select(F.explode(_grams(n, joined)).alias("gram")).distinct().withColumn("h", F.xxhash64(F.split("gram", " "))), "held-grams")
    own = df.select(F.col(key).alias("_k"), words(F.coalesce(text, F.lit(""))).alias("w")).where(F.size("w") > 0)
    near = own.select("_k", F.explode(F.array_distinct(_grams(n, F.xxhash64))).alias("h")).join(small(grams.select("h").distinct()), "h", "left_semi")
    near = materialize(near.select("_k").distinct(), "shared-grams")
    met = own.join(small(near), "_k", "left_semi").select("_k", F.explode(_grams(n, joined)).alias("gram"))
    return met.join(small(grams.select("gram")), "gram", "left_semi").select(F.col("_k").alias(key)).distinct()


def token_change(df: DataFrame, before: str, after: str, *by: str) -> DataFrame:
    """(by, n, before, after, dropped, pct): sums of two counts for each group, pct of the tokens lost (0 without any before)."""
    sums = df.groupBy(*by).agg(F.count("*").alias("n"), F.sum(before).alias("before"), F.coalesce(F.sum(after), F.lit(0)).alias("after"))
    return sums.withColumn("dropped", F.col("before") - F.col("after")).withColumn("pct", F.when(F.col("before") == 0, 0.0).otherwise(100.0 * (F.col("before") - F.col("after")) / F.col("before")))
