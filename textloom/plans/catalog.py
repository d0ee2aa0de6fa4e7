"""All queries of the core library, each over its whole tables; :mod:`textloom.plans.oracles` states the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import code, pii, quality
from textloom.functions import text as tx
from textloom.functions.tokens import count_tokens, token_report
from textloom.operators import audits, corpus, minhash, packing, sequences
from textloom.plans.oracles import SQL
from textloom.sources import tables
from textloom.storage import materialize, table

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}
#: A public vocabulary for exact byte-pair counts; the session's ``textloom.vocabulary`` names another.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


def add(name: str):
    def put(f: Query) -> Query:
        CATALOG[name] = f
        return f

    return put


def docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents")


def prose(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "prose_cleaned")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- text scalars -----------------------------------------------------------------------------------------------
for _name, _build in {
    "t1_strip_html": tx.strip_html, "t2_strip_urls": tx.strip_urls, "t3_strip_emails": tx.strip_emails, "t4_collapse_stops": tx.collapse_stops,
    "t5_collapse_elongation": tx.collapse_elongation, "t6_collapse_white": tx.collapse_white, "t7_clean_text": tx.clean_text, "t8_strip_format": tx.strip_format,
    "t9_nfc": tx.nfc, "t10_t11_nuktas": tx.normalize_nuktas, "t12_strip_joiners": tx.strip_joiners, "t13_fold_digits": tx.fold_digits,
    "t14_normalize_text": tx.normalize_text, "t15_dedup_key": tx.dedup_key, "t16_preprocess": tx.preprocess, "t17_brahmic_script": tx.brahmic_script, "t20_clean_code": tx.strip_format,
}.items():
    CATALOG[_name] = lambda s, d, build=_build: docs(s, d).select("doc_id", build(F.col("text")).alias("result"))


def _report(rows: DataFrame) -> DataFrame:
    """Sums for each language and in all."""
    sums = rows.rollup("lang").agg(*[F.sum(c).alias(c) for c in ("pre", "post", "pre_chars", "post_chars")], F.grouping("lang").alias("g"))
    told = token_report(F.col("pre"), F.col("post"))
    return sums.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("lang")).alias("lang"), "pre", "post", told["delta"].alias("delta"), F.round(told["pct"], 6).alias("pct"), "pre_chars", "post_chars")


def _pre_post(s: SparkSession, d: str, vocabulary: str | None) -> DataFrame:
    chars = lambda c: F.length(c).cast("long")
    return prose(s, d).select(F.coalesce("lang_code", F.lit("unknown")).alias("lang"), count_tokens(F.col("text"), vocabulary).alias("pre"), count_tokens(F.col("cleaned"), vocabulary).alias("post"), chars("text").alias("pre_chars"), chars("cleaned").alias("post_chars"))


@add("t18_t19_a1_a2_byte_report")
def byte_report(s, d):
    return _report(_pre_post(s, d, None))


@add("t18_t19_a1_a2_token_report")
def bpe_report(s, d):
    return _report(_pre_post(s, d, s.conf.get("textloom.vocabulary", VOCABULARY)))


# ---- quality ----------------------------------------------------------------------------------------------------
@add("q1_q2_q3_q10_word_stats")
def word_stats(s, d):
    c = F.col("text")
    return docs(s, d).select("doc_id", F.size(tx.words(c)).cast("long").alias("n_words"), F.round(quality.mean_word_length(c), 6).alias("mean_len"), F.round(quality.symbol_ratio(c), 6).alias("symbols"), quality.sentences(c).cast("long").alias("sentences"))


for _name, _metric in {
    "q4_top_2gram": lambda c: quality.top_gram_share(c, 2), "q5_term_frequency": lambda c: quality.top_gram_share(c, 1),
    "q11_duplicate_lines": lambda c: quality.repeated_share(c, "\n"), "q12_duplicate_paragraphs": lambda c: quality.repeated_share(c, "\n\n"),
}.items():
    CATALOG[_name] = lambda s, d, metric=_metric: docs(s, d).select("doc_id", F.round(metric(F.col("text")), 6).alias("share"))


@add("q6_lexical_diversity")
def lexical(s, d):
    return docs(s, d).select("doc_id", F.round(quality.lexical_diversity("text"), 6).alias("diversity"))


@add("q7_q8_q9_readability")
def readability(s, d):
    return docs(s, d).select("doc_id", F.round(quality.difficulty_ratio(F.col("text")), 6).alias("difficulty"), F.round(quality.reading_ease(F.col("text")), 4).alias("ease"))


@add("q13_boilerplate_lines")
def boilerplate(s, d):
    return corpus.boilerplate_lines(docs(s, d), "doc_id", "text")


@add("q14_boilerplate_share")
def boilerplate_share(s, d):
    return rounded(corpus.boilerplate_share(docs(s, d), "doc_id", "text"), 6, "share")


@add("w1_length_band")
def length_band(s, d):
    return corpus.quantile_band(docs(s, d), "doc_id", "lang", "n_chars")


@add("q15_w1_quantile_band")
def band(s, d):
    rows = materialize(docs(s, d).select("doc_id", "lang", quality.reading_ease(F.coalesce("text", F.lit(""))).alias("ease")), "ease")
    return rounded(corpus.quantile_band(rows, "doc_id", "lang", "ease"), 4, "ease")


@add("q16_part_three_rule_drops")
def three_rule_drops(s, d):
    c = F.col("text")
    rows = docs(s, d).select("lane", F.size(tx.words(c)).alias("n"), quality.mean_word_length(c).alias("m"), quality.symbol_ratio(c).alias("y"))
    rules = {"drop_words": F.col("n").between(20, 100000), "drop_mean": F.col("m").between(1.5, 20), "drop_symbols": F.col("y") <= 0.1}
    return rows.groupBy("lane").agg(F.count("*").alias("total"), *[F.count_if(~r).alias(k) for k, r in rules.items()], F.count_if(rules["drop_words"] & rules["drop_mean"] & rules["drop_symbols"]).alias("kept"))


@add("q16_p4_p5_p7_rule_drops")
def rule_drops(s, d):
    passed = corpus.quality_rules(docs(s, d), "doc_id", "text", "lang", "doc_type", keep=("lane",))
    rules = [k for k in passed.columns if k not in ("doc_id", "lane")]
    keep = F.forall(F.array(*rules), lambda r: r)
    return passed.groupBy("lane").agg(F.count("*").alias("total"), *[F.count_if(~F.col(k)).alias(f"drop_{k}") for k in rules], F.count_if(keep).alias("kept"))


@add("q16_p6_source_type")
def source_type(s, d):
    return docs(s, d).groupBy("lane").agg(F.count("*").alias("n"), F.count_if(F.col("doc_type").isin("web", "pdf")).alias("passed"))


@add("c1_c2_p9_code_lines")
def code_lines(s, d):
    rows = docs(s, d).where("lane = 'code'").select("doc_id", code.line_counts(F.col("text"), F.lower("lang")).alias("n"))
    return rows.select("doc_id", "n.*", (F.col("n.code_lines") >= code.LEAST_LINES).alias("keep"))


# ---- routing, redaction -----------------------------------------------------------------------------------------
@add("r1_r2_r3_route")
def route(s, d):
    return rounded(corpus.route_by_script(docs(s, d), "doc_id", "text"), 6, "purity")


@add("r4_r5_p11_route_report")
def route_report(s, d):
    routed = corpus.route_by_script(docs(s, d), "doc_id", "text", keep=("lang",))
    codes = F.create_map(*[F.lit(x) for pair in corpus.FOLDER_CODES.items() for x in pair])
    agree = F.when(F.element_at(codes, F.col("folder")) == corpus.language_code(F.col("lang")), 1).otherwise(0)
    return routed.groupBy(F.coalesce("folder", F.lit("discarded")).alias("folder")).agg(F.count("*").alias("n"), F.round(F.avg("purity"), 6).alias("purity"), F.round(F.avg(agree), 6).alias("agree"))


@add("r6_tokens_by_folder")
def routed_tokens(s, d):
    rows = docs(s, d).select("doc_id", "text", F.coalesce("lang", F.lit("und")).alias("lang"), count_tokens(F.col("text")).alias("tokens"))
    routed = corpus.route_by_script(rows, "doc_id", "text", keep=("lang", "tokens"))
    return rounded(corpus.token_change(routed.withColumn("kept", F.when(F.col("folder").isNotNull(), F.col("tokens"))), "tokens", "kept", "lang"), 6, "pct")


@add("r7_code_folders")
def code_folders(s, d):
    return docs(s, d).where("lane = 'code'").groupBy(F.coalesce("lang", F.lit("und")).alias("folder")).agg(F.count("*").alias("n"))


@add("i1_i2_i3_redact")
def redact_plain(s, d):
    c = F.col("text")
    for label, pattern in pii.RULES[:4]:
        c = F.regexp_replace(c, pattern, f"[{label}]")
    return docs(s, d).select("doc_id", c.alias("result"))


@add("i4_i8_redact_all")
def redact_all(s, d):
    return pii.redact_counted(docs(s, d).select("doc_id", "text"), "text").select("doc_id", F.col("redacted").alias("result"), F.aggregate(F.map_values("counts"), F.lit(0), lambda t, n: t + n).alias("n"))


@add("i9_redactions")
def redactions(s, d):
    """Replacements of each label, and rows scanned and touched, for each lane, language and in all."""
    rows = pii.redact_counted(docs(s, d).select("lane", F.coalesce("lang", F.lit("und")).alias("lang"), "text"), "text")
    touched = F.exists(F.map_values("counts"), lambda n: n > 0)
    sums = rows.rollup("lane", "lang").agg(F.count("*").alias("scanned"), F.count_if(touched).alias("touched"), *[F.sum(F.col("counts")[label]).alias(label.lower()) for label in pii.LABELS])
    return sums.select(F.coalesce("lane", F.lit("TOTAL")).alias("lane"), F.coalesce("lang", F.lit("TOTAL")).alias("lang"), "scanned", "touched", *[label.lower() for label in pii.LABELS])


@add("s13_rewritten")
def rewritten(s, d):
    c = F.col("text")
    for label, pattern in pii.RULES[:4]:
        c = F.regexp_replace(c, pattern, f"[{label}]")
    return tables.rewritten(docs(s, d).select("text", c.alias("new")), "text", "new").agg(F.count("*").alias("n"), F.count_if("touched").alias("touched"))


# ---- copies and near copies -------------------------------------------------------------------------------------
@add("m0_exact_copies")
def copies(s, d):
    return corpus.exact_copies(docs(s, d), "doc_id", "text")


@add("m3_best_bands")
def bands(s, d):
    return s.createDataFrame([(n, t, *minhash.best_bands(n, t)) for n, t in ((128, 0.8), (64, 0.5), (128, 0.5))], "n int, threshold double, bands int, n_rows int")


@add("m1_m4_signatures")
def signatures(s, d):
    return minhash.signatures(docs(s, d), "doc_id", "text").select("doc_id", F.md5(F.concat_ws(",", "sig")).alias("sig"))


@add("m5_m8_survivors")
def survivors(s, d):
    """Runs of five characters within each lane, linked by exact similarity."""
    return minhash.survivors(docs(s, d), "doc_id", "text", track="lane")


@add("m5_m8_parity_survivors")
def parity_survivors(s, d):
    """The reference's rule: 8 x 16 bands, bucket heads, estimated similarity."""
    return minhash.survivors(docs(s, d), "doc_id", "text", track="lane", parity=True)


@add("m5_m8_word_survivors")
def word_survivors(s, d):
    """The same over runs of five words."""
    return minhash.survivors(docs(s, d), "doc_id", "text", unit="word")


@add("m9_dedup_report")
def dedup_report(s, d):
    rows = docs(s, d).select("doc_id", "text", "lane", F.coalesce("lang", F.lit("und")).alias("lang"), count_tokens(F.col("text")).alias("tokens"))
    kept = minhash.survivors(rows, "doc_id", "text", track="lane", keep=("lane", "lang", "tokens"))
    return kept.groupBy("lane", "lang").agg(
        F.count("*").alias("total"), F.count_if("keep").alias("kept"), F.count_if(~F.col("keep")).alias("removed"), F.sum("tokens").alias("before"),
        F.coalesce(F.sum(F.when(F.col("keep"), F.col("tokens"))), F.lit(0)).alias("after"), F.countDistinct("cluster").alias("clusters"),
    )


@add("m10_r7_code_lane")
def code_lane(s, d):
    """The code lane in one go: format controls, enough lines of code, near copies, folders; files and tokens of each folder."""
    rows = docs(s, d).where("lane = 'code'").select("doc_id", tx.strip_format(F.col("text")).alias("text"), F.coalesce("lang", F.lit("und")).alias("folder"))
    rows = rows.withColumn("n", code.line_counts(F.col("text"), F.lower("folder"))).where(F.col("n.code_lines") >= code.LEAST_LINES)
    rows = materialize(rows.select("doc_id", "text", "folder", count_tokens(F.col("text")).alias("tokens")), "code-lane")
    return minhash.survivors(rows, "doc_id", "text", keep=("folder", "tokens")).where("keep").groupBy("folder").agg(F.count("*").alias("files"), F.sum("tokens").alias("tokens"))


# ---- aggregates, windows, sets ----------------------------------------------------------------------------------
@add("a3_pivot")
def pivot(s, d):
    kinds = ["web", "pdf", "speech", "code"]
    kind = F.when(F.col("doc_type").isin(kinds), F.col("doc_type")).otherwise("other")
    return docs(s, d).withColumn("kind", kind).groupBy("lane").pivot("kind", [*kinds, "other"]).count().fillna(0)


@add("a4_a5_a7_sources")
def sources(s, d):
    return docs(s, d).groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.countDistinct("lang").alias("n_langs"), F.count_if(F.col("license_class").isNull()).alias("no_license"))


@add("a6_profile")
def profile(s, d):
    plain = docs(s, d).groupBy("lane").agg(F.count("n_chars").alias("n"), F.round(F.avg("n_chars"), 4).alias("mean"), F.round(F.stddev_samp("n_chars"), 4).alias("sd"), F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"))
    at = (5, 25, 50, 75, 95)
    q = corpus.exact_quantiles(docs(s, d), "lane", "n_chars", [p / 100 for p in at]).select(F.col("_g").alias("lane"), "q")
    return plain.join(q, "lane").select("lane", "n", "mean", "sd", "lo", *[F.round(F.col("q")[i], 4).alias(f"p{p:02d}") for i, p in enumerate(at)], "hi")


@add("a9_token_change")
def token_change(s, d):
    rows = prose(s, d).select(F.coalesce("lang_code", F.lit("unknown")).alias("lang"), count_tokens(F.col("text")).alias("a"), count_tokens(F.col("cleaned")).alias("b"))
    return rounded(corpus.token_change(rows, "a", "b", "lang"), 6, "pct")


@add("w3_a9_i11_waterfall")
def waterfall(s, d):
    """Tokens after each of the six stages, the change from the stage before and from the first."""
    raw = docs(s, d).where("lane <> 'code'").select("doc_id", "lane", "lang", "doc_type", "text")
    stages = _stages(s, raw)
    part = lambda i, n, df: df.agg(F.coalesce(F.sum(count_tokens(F.col("text"))), F.lit(0)).alias("tokens")).select(F.lit(i).alias("step"), F.lit(n).alias("stage"), "tokens")
    parts = [part(i, n, df) for i, (n, df) in enumerate(stages.items(), 1)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    w = W.partitionBy(F.lit(0)).orderBy("step")  # a row of each stage
    before, first = F.lag("tokens").over(w), F.first("tokens").over(w)
    change = lambda a: F.round(F.when(a > 0, 100.0 * (F.col("tokens") - a) / a).otherwise(0.0), 6)
    return rows.select("step", "stage", "tokens", change(before).alias("step_pct"), change(first).alias("total_pct"))


def _stages(s: SparkSession, raw: DataFrame) -> dict[str, DataFrame]:
    """The prose lanes after each stage, columns carried along; cleaned texts are written once."""
    cols = ("lane", "lang", "doc_type", "text")
    cleaned = materialize(raw.withColumn("text", tx.preprocess(F.col("text"))), "cleaned")
    passed = corpus.quality_rules(cleaned, "doc_id", "text", "lang", "doc_type", keep=cols)
    rules = [k for k in passed.columns if k not in ("doc_id", *cols)]
    good = materialize(passed.where(F.forall(F.array(*rules), lambda r: r)).select("doc_id", *cols), "filtered")
    single = materialize(minhash.survivors(good, "doc_id", "text", track="lane", keep=cols).where("keep").select("doc_id", *cols), "single")
    routed = materialize(corpus.route_by_script(single, "doc_id", "text", keep=cols).where("folder IS NOT NULL").drop("purity"), "routed")
    scrubbed = pii.redact_counted(routed, "text").withColumn("text", F.col("redacted")).drop("redacted")
    return {"raw": raw, "cleaned": cleaned, "filtered": good, "deduplicated": single, "routed": routed, "scrubbed": scrubbed}


#: Shares of the lanes that the corpus aims at, in percent.
MIXTURE = {"web": 50.0, "indic": 25.0, "code": 25.0}


@add("a10_v4_mixture")
def mixture(s, d):
    return audits.mixture_within(docs(s, d), "lane", "n_chars", MIXTURE)


@add("a11_language_shares")
def language_shares(s, d):
    n = docs(s, d).groupBy("source", F.coalesce("lang", F.lit("und")).alias("lang")).agg(F.count("*").alias("n"))
    return n.select("source", "lang", F.bround(100.0 * F.col("n") / F.sum("n").over(W.partitionBy("source")), 0).cast("long").alias("pct"))


@add("a11_s6_manifest")
def manifest(s, d):
    """A row of each shard of 200 documents: rows, tokens, language shares with the most frequent first, digest of the rows."""
    rows = docs(s, d).select("doc_id", "text", "lang", count_tokens(F.col("text")).alias("tokens"))
    told = tables.shard_manifest(minhash.dense_rank_shards(rows, ["doc_id"], 200), "tokens", "lang")
    return told.withColumn("lang_distribution", F.to_json("lang_distribution"))


@add("a12_collapsed_values")
def collapsed(s, d):
    return docs(s, d).where("license_class IS NOT NULL").groupBy("source").agg(F.concat_ws("; ", F.array_sort(F.collect_set("license_class"))).alias("licenses"))


@add("a13_k10_digests")
def digests(s, d):
    return docs(s, d).select("doc_id", F.sha2("text", 256).alias("digest"), F.concat(F.lit("sha256_"), F.substring(F.sha2("text", 256), 1, 12)).alias("short"))


@add("s6_w4_shards")
def shards(s, d):
    rows = minhash.dense_rank_shards(docs(s, d).select("doc_id", "n_chars"), ["doc_id"], 200)
    return rows.groupBy("shard_no").agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@add("s17_o3_latest_counts")
def latest_counts(s, d):
    return corpus.latest(table(s, d, "doc_manifest"), ["doc_id"], "loaded_at", ["token_count"]).select("doc_id", "token_count")


@add("s1_s4_s5_p1_p2_tagged")
def tagged(s, d):
    return tables.tag(tables.with_text(docs(s, d).where("lane = 'web'").select("doc_id", F.col("text").alias("content"))), track="web")


@add("s17_upsert")
def upserted(s, d):
    """A ledger whose old rows are older for one half of the keys and newer for the other."""
    rows = docs(s, d).groupBy("source").agg(F.max("n_chars").alias("n_chars"))
    old = rows.select("source", F.lit(-1).cast("long").alias("n_chars"), F.when(F.col("n_chars") % 2 == 0, 1).otherwise(3).alias("at"))
    return tables.upsert(old, rows.select("source", "n_chars", F.lit(2).alias("at")), "source", "at").select("source", "at", "n_chars")


@add("s19_s20_held_out")
def held_out(s, d):
    return tables.held_out(table(s, d, "eval_items"), "item_id", "text", "bench").agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("long").alias("n_chars"))


@add("u1_u2_union_distinct")
def union_distinct(s, d):
    return docs(s, d).select("lang").unionByName(prose(s, d).select(F.col("lang_code").alias("lang"))).distinct()


@add("u3_same_rows")
def same_rows(s, d):
    ids = docs(s, d).select("doc_id")
    logged = table(s, d, "doc_manifest").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return audits.same_rows("kept_ids", ids, ids).unionByName(audits.resolves("other_ids", logged, "doc_id", docs(s, d).where("lane = 'web'"), "doc_id"))


@add("u4_repeated_batches")
def repeated_batches(s, d):
    keyed = table(s, d, "training_log").groupBy("lane", "shard_id", F.concat_ws(",", "row_idx").alias("row_idx"))
    return keyed.agg(F.count("*").alias("n")).where("n > 1")


@add("x1_sample")
def sample(s, d):
    return corpus.seeded_sample(docs(s, d).select("doc_id", "lang"), "doc_id", "lang", 20)


@add("x2_shuffle")
def shuffle(s, d):
    """Every row's place in a seeded permutation."""
    rows = docs(s, d).select("doc_id", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("42"))).alias("digest"))
    return minhash.numbered(rows, ["digest", "doc_id"]).select("doc_id", F.col("_at").alias("place"))


# ---- joins ------------------------------------------------------------------------------------------------------
def _shared(s: SparkSession, d: str) -> DataFrame:
    return corpus.shared_grams(docs(s, d), "doc_id", "text", table(s, d, "eval_items"), "text")


def _sharded(s: SparkSession, d: str) -> DataFrame:
    return minhash.dense_rank_shards(docs(s, d).select("doc_id"), ["doc_id"], 200)


@add("j1_k6_k7_shared_grams")
def shared_grams(s, d):
    return _shared(s, d)


@add("k8_contaminated_shards")
def contaminated(s, d):
    hits = _shared(s, d).withColumn("hit", F.lit(True))
    return _sharded(s, d).join(hits, "doc_id", "left").groupBy("shard_no").agg(F.bool_or(F.coalesce("hit", F.lit(False))).alias("contaminated"))


@add("j5_shard_documents")
def shard_documents(s, d):
    paths = table(s, d, "doc_manifest").select(F.col("doc_id").cast("long").alias("doc_id"), "source_path").distinct()
    return _sharded(s, d).join(paths, "doc_id").groupBy("shard_no").agg(F.count("*").alias("n"), F.min("source_path").alias("first_path"))


@add("j6_dangling_references")
def dangling(s, d):
    """References to documents outside the code lane, one of them planted beyond all ids."""
    beyond = docs(s, d).agg((F.max("doc_id") + 7).alias("doc_id"))
    told = table(s, d, "doc_manifest").select(F.col("doc_id").cast("long").alias("doc_id")).unionByName(beyond)
    return told.distinct().join(docs(s, d).where("lane <> 'code'").select("doc_id"), "doc_id", "left_anti")


# The tier of each licence class.
TIERS = {"CC-BY-4.0": "safe", "OTHER-PERMISSIVE": "safe"}


@add("j7_license_tiers")
def tiers(s, d):
    known = F.create_map(*[F.lit(x) for pair in TIERS.items() for x in pair])
    return docs(s, d).groupBy("lane", F.coalesce(F.element_at(known, F.col("license_class")), F.lit("unknown")).alias("tier")).agg(F.count("*").alias("n"))


@add("v6_parents_resolved")
def parents(s, d):
    p = table(s, d, "registry_manifest").select("shard_id", F.explode("parent_manifest_ids").alias("parent")).distinct()
    known = table(s, d, "shard_manifest").select(F.col("shard_id").alias("parent"), F.lit(True).alias("known")).distinct()
    return p.join(known, "parent", "left").select("shard_id", "parent", F.coalesce("known", F.lit(False)).alias("known"))


# ---- units, sequences, schedules, losses ------------------------------------------------------------------------
def _units(s: SparkSession, d: str) -> DataFrame:
    rows = docs(s, d).select("doc_id", "lane", count_tokens(F.col("text")).alias("n_tokens"))
    return sequences.units_of(rows, "doc_id", "n_tokens", keep=("lane",))


@add("k1_units")
def token_units(s, d):
    return sequences.units(docs(s, d).select("doc_id", count_tokens(F.col("text")).alias("n_tokens")), "doc_id", "n_tokens")


@add("k3_k4_k11_sequences")
def unpacked(s, d):
    """Every unit a sequence of its own, as in the code lane."""
    seq = _units(s, d).select("lane", sequences.sequence_arrays(F.col("length"), F.col("doc_id"), 2048, 256).alias("a"))
    real = F.aggregate("a.loss_mask", F.lit(0), lambda t, x: t + x)
    sums = seq.groupBy("lane").agg(F.count("*").alias("n_sequences"), F.sum(real.cast("long")).alias("real_tokens"))
    return sums.withColumn("fill", F.round(F.col("real_tokens") / (F.col("n_sequences") * 2048), 6))


def _packed(s: SparkSession, d: str) -> DataFrame:
    """(doc_id, lane, unit_no, length, sequence): full windows alone, the rests of prose packed, those of code alone too."""
    units = materialize(_units(s, d), "units")
    alone = (F.col("kind") == "full") | (F.col("lane") == "code")
    rests = packing.best_fit_decreasing(units.where(~alone), "lane", ["doc_id", "unit_no"], "length").withColumn("sequence", F.concat(F.lit("p"), F.col("sequence").cast("string")))
    single = units.where(alone).withColumn("sequence", F.concat_ws("-", F.lit("d"), "doc_id", "unit_no"))
    return materialize(single.unionByName(rests), "packed")


@add("k2_k11_packed")
def packed(s, d):
    """Which sequence each unit goes to, by best fit decreasing."""
    return _packed(s, d).select("doc_id", "lane", "unit_no", "length", "sequence")


@add("k2_k5_k9_registry")
def registry(s, d):
    """Packed sequences in shuffled shards of 500: sequences, real tokens and a digest of each shard."""
    bins = _packed(s, d).groupBy("lane", "sequence").agg(F.sum("length").alias("real"), F.array_sort(F.collect_list(F.concat_ws(":", "doc_id", "unit_no"))).alias("units"))
    rows = packing.shuffled_shards(bins, "lane", "sequence")
    content = F.sha2(F.concat_ws("|", F.transform(F.array_sort(F.collect_list(F.struct("row_no", "units"))), lambda r: F.concat_ws(",", r["units"]))), 256)  # 500 rows a shard
    return rows.groupBy("lane", "shard_no").agg(F.count("*").alias("n_sequences"), F.sum("real").alias("token_count"), F.concat(F.lit("sha256_"), F.substring(content, 1, 12)).alias("content_hash"))


@add("k4_packed_arrays")
def packed_arrays(s, d):
    """Tokens, masks, positions and owners of the packed sequences: sizes, real tokens, a digest of the token ids."""
    ids = sequences.unit_tokens(docs(s, d), "doc_id", "text")
    segments = _packed(s, d).join(ids, ["doc_id", "unit_no"]).groupBy("lane", "sequence").agg(F.array_sort(F.collect_list(F.struct("doc_id", "unit_no", "token_id"))).alias("g"))
    rows = segments.select("lane", "sequence", packing.segment_arrays(F.col("g"), 2048, 256).alias("a"))
    return rows.select("lane", "sequence", F.size("a.token_id").alias("n"), F.aggregate("a.loss_mask", F.lit(0), lambda t, x: t + x).alias("real"), F.size(F.array_distinct("a.doc_id")).alias("owners"), F.md5(F.concat_ws(",", "a.token_id")).alias("digest"))


@add("k5_shuffled_shards")
def shuffled(s, d):
    rows = packing.shuffled_shards(_units(s, d).withColumn("unit", F.col("doc_id") * 100 + F.col("unit_no")), "lane", "unit")
    return rows.groupBy("lane", "shard_no").agg(F.count("*").alias("n"), F.min("unit").alias("least_unit"), F.max("unit").alias("greatest_unit"))


@add("n12_real_tokens")
def real_tokens(s, d):
    """Real tokens of all sequences are the texts' tokens and one end mark a document."""
    told = docs(s, d).groupBy("lane").agg(F.count("*").alias("n_docs"), F.sum(count_tokens(F.col("text"))).alias("tokens"))
    return told.join(_packed(s, d).groupBy("lane").agg(F.sum("length").alias("real_tokens")), "lane")


def _batches(s, d):
    shards = docs(s, d).groupBy("lane", "source").agg(F.count("*").alias("n"))
    return sequences.schedule(shards, "lane", "source", "n", 4, ["indic", "web", "code"])


@add("l1_l2_schedule")
def schedule(s, d):
    return _batches(s, d)


@add("l3_resume")
def resume(s, d):
    """What is left after a third of the schedule, from a saved cursor."""
    plan = materialize(_batches(s, d), "schedule")
    cursor = sequences.Cursor().draw(plan, plan.count() // 3)[1]
    return sequences.Cursor.from_dict(cursor.to_dict()).rest(plan)


@add("l4_masked_loss")
def masked_loss(s, d):
    mask = F.col("loss").isNotNull().cast("int")
    return table(s, d, "training_log").groupBy("run_id", "lane").agg(F.round(sequences.masked_mean(F.coalesce("loss", F.lit(0.0)), mask), 6).alias("mean_loss"))


@add("l6_o3_latest_checkpoint")
def latest_checkpoint(s, d):
    """The checkpoint of the greatest step of each run (ties: the last saved, then the greatest id)."""
    last = F.max(F.struct("global_step", "saved_at", "checkpoint_id")).alias("m")
    return table(s, d, "checkpoint_manifest").groupBy("run_id").agg(last).select("run_id", "m.global_step", "m.checkpoint_id")


# ---- audits -----------------------------------------------------------------------------------------------------
# The fields that a registry record must have.
REGISTRY_FIELDS = ["shard_id", "capability_lane", "token_count", "tokenizer_hash", "content_hash", "cleaning_pipeline_hash", "dedup_status", "pii_screen_status", "eval_overlap_status", "license_tier", "parent_manifest_ids", "admission"]


@add("v2_manifest")
def manifest_checks(s, d):
    r = table(s, d, "registry_manifest")
    parts = [audits.has_fields("fields", r, REGISTRY_FIELDS), audits.has_fields("missing_fields", r, ["no_such_field"]), audits.check("one_tokenizer", r, F.countDistinct("tokenizer_hash") <= 1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@add("v3_poison")
def poison(s, d):
    return audits.firewall_works("poison_flagged", docs(s, d), "doc_id", "text", table(s, d, "eval_items"), "text")


@add("v5_structure")
def structure(s, d):
    seq = _units(s, d).select(F.col("length"), sequences.sequence_arrays(F.col("length"), F.col("doc_id"), 2048, 256).alias("a"))
    even = F.forall(F.array(F.size("a.loss_mask"), F.size("a.position_id"), F.size("a.doc_id")), lambda n: n == 2048)
    owners = F.size(F.array_distinct(F.filter("a.doc_id", lambda i: i >= 0)))
    return audits.no_rows("whole_windows", seq.where(~even)).unionByName(audits.no_rows("one_owner", seq.where(owners != 1)))


@add("v7_replay")
def replay(s, d):
    """Drawing a part of the schedule twice from one saved cursor gives the same batches, another cursor others."""
    plan = materialize(_batches(s, d), "schedule")
    at = sequences.Cursor(plan.count() // 2)
    first, _ = at.draw(plan, 8)
    again, _ = sequences.Cursor.from_dict(at.to_dict()).draw(plan, 8)
    fork, _ = sequences.Cursor(at.last + 1).draw(plan, 8)
    return audits.same_rows("replay_same", first, again).unionByName(audits.same_rows("fork_same", first, fork))


@add("v8_trace")
def trace(s, d):
    return audits.resolves("logged_shards_known", table(s, d, "training_log"), "shard_id", table(s, d, "registry_manifest"), "shard_id")


@add("v1_v10_checks")
def checks(s, d):
    t = docs(s, d)
    return audits.overall(
        audits.check("lanes_not_empty", t, F.countDistinct("lane") == 3),
        audits.check("unique_keys", t, F.count("*") == F.countDistinct("doc_id")),
        audits.check("positive_counts", table(s, d, "doc_manifest"), F.every(F.col("token_count") > 0)),
        audits.check("counts_follow_text", t, F.every(F.col("n_chars") == F.length("text"))),
    )


@add("flagship")
def flagship(s: SparkSession, d: str) -> DataFrame:
    """Clean, score, drop near copies, route, redact: what is left of every lane and folder."""
    last = _stages(s, docs(s, d).select("doc_id", "lane", "lang", "doc_type", "text"))["scrubbed"]
    n = F.aggregate(F.map_values("counts"), F.lit(0), lambda t, x: t + x)
    return last.groupBy("lane", "folder").agg(F.count("*").alias("n_docs"), F.sum(n.cast("long")).alias("n_redactions"))


def queries() -> dict[str, Query]:
    return dict(CATALOG)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
