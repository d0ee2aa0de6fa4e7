"""The queries of the training-data problems, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.leaks import find_leaks
from textloom.llm.mixing import mixture_report, mixture_uses
from textloom.llm.neardup import NearDuplicates
from textloom.llm.packing import CAPACITY, pack_sequences
from textloom.llm.pii import find_personal_data, redact_personal_data
from textloom.llm.quality import NAMES, holdout_report, text_kinds
from textloom.llm.tokens import expected_counts, language, token_counts
from textloom.llm.truncation import cut_texts
from textloom.storage import materialize, scratch, table


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target, reached and seen shares of each plan and lane."""
    return mixture_report(table(spark, d, "registry_manifest"), table(spark, d, "mixture_targets"), table(spark, d, "checkpoint_manifest"))


def p1_uses(spark: SparkSession, d: str) -> DataFrame:
    """How often each shard is used under each plan."""
    return mixture_uses(table(spark, d, "registry_manifest"), table(spark, d, "mixture_targets"))


def p1_one_temperature(spark: SparkSession, d: str) -> DataFrame:
    """The same lanes mixed at a single temperature, that of 1.5 bits of entropy, within the repetition limits."""
    return mixture_report(table(spark, d, "registry_manifest"), table(spark, d, "mixture_targets"), table(spark, d, "checkpoint_manifest"), bits=1.5)


def _prose_counts(spark: SparkSession, d: str) -> DataFrame:
    """Every row of prose_cleaned with its exact token count and the count its post_tokens should be near."""
    prose = table(spark, d, "prose_cleaned")
    counts = token_counts(prose, "row_id", "cleaned")
    tags = prose.select(F.col("row_id").alias("id"), "post_tokens", "source_url", "lang", "lang_code", "doc_type")
    return expected_counts(materialize(tags.join(counts, "id"), "p2"), "post_tokens")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    ratio = F.col("post_tokens") / F.col("expected")
    bad = F.col("post_tokens").isNull() | (F.col("post_tokens") <= 0) | (ratio >= 3) | (ratio <= F.lit(1) / 3)
    return _prose_counts(spark, d).where(bad).select(F.col("id").alias("row_id"))


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """A sound count for every row: exact tokens of the public tokenizer, and post_tokens or what it should be near."""
    ratio = F.col("post_tokens") / F.col("expected")
    sound = (F.col("post_tokens") > 0) & (ratio < 3) & (ratio > F.lit(1) / 3)
    return _prose_counts(spark, d).select(
        F.col("id").alias("row_id"),
        F.coalesce(language(F.col("lang"), F.col("lang_code")), F.col("script")).alias("language"),
        "tokens",
        F.when(sound, F.col("post_tokens")).otherwise(F.round("expected").cast("long")).alias("sound_post_tokens"),
        F.coalesce(sound, F.lit(False)).alias("post_tokens_usable"),
    )


def p2_totals(spark: SparkSession, d: str) -> DataFrame:
    """Rows and tokens of each source, language and document type."""
    return (
        _prose_counts(spark, d)
        .groupBy(
            F.coalesce("source_url", F.lit("unknown")).alias("source_url"),
            F.coalesce(language(F.col("lang"), F.col("lang_code")), F.col("script")).alias("language"),
            F.coalesce(F.lower(F.trim("doc_type")), F.lit("unknown")).alias("doc_type"),
        )
        .agg(F.count("*").alias("n_rows"), F.sum("tokens").alias("tokens"), F.sum(F.round("expected").cast("long")).alias("expected_tokens"))
    )


#: The tables with free text, and their keys.
FREE_TEXT = (("documents", "doc_id"), ("prose_cleaned", "row_id"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "name_lexicon")
    parts = [find_personal_data(table(spark, d, t), key, "text", names).select(F.lit(t).alias("table_name"), F.col("id").alias("row_key"), "label") for t, key in FREE_TEXT]
    return parts[0].union(parts[1])


def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every text, readable, with typed placeholders."""
    names = table(spark, d, "name_lexicon")
    parts = [
        redact_personal_data(table(spark, d, t), key, "text", names).select(F.lit(t).alias("table_name"), F.col("id").alias("row_key"), F.col("txt").alias("text"), "labels", "spans")
        for t, key in FREE_TEXT
    ]
    return parts[0].union(parts[1])


def _kinds(spark: SparkSession, d: str) -> DataFrame:
    return text_kinds(table(spark, d, "prose_cleaned"), "row_id", "cleaned", table(spark, d, "quality_labels"), "row_id", "label_kind")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _kinds(spark, d).where("kind <> 'prose'").select(F.col("id").alias("row_id"), "kind")


def p4_stats(spark: SparkSession, d: str) -> DataFrame:
    """The statistics, kind and calibrated probability of every row."""
    stats = [F.round(F.element_at("stats", i + 1), 6).alias(n) for i, n in enumerate(NAMES)]
    return _kinds(spark, d).select(F.col("id").alias("row_id"), "kind", F.round("probability", 6).alias("probability"), *stats)


def p4_holdout(spark: SparkSession, d: str) -> DataFrame:
    """Checked against found kinds of the labelled rows that neither training nor calibration has seen."""
    return holdout_report(table(spark, d, "prose_cleaned"), "row_id", "cleaned", table(spark, d, "quality_labels"), "row_id", "label_kind")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    with scratch() as tables:
        return tables.keep(materialize(NearDuplicates(table(spark, d, "prose_cleaned"), "row_id", "cleaned").found(), "p5-found"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    with scratch() as tables:
        return tables.keep(materialize(NearDuplicates(table(spark, d, "prose_cleaned"), "row_id", "cleaned").groups(), "p5-groups"))


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").where(F.col("lane").isin("web", "indic"))
    with scratch() as tables:
        counts = token_counts(docs, "doc_id", "text")
        sized = tables.keep(materialize(counts.join(docs.select(F.col("doc_id").alias("id"), "lane"), "id").select("lane", F.col("id").alias("doc_id"), "tokens"), "p6-sized"))
        return sized, tables.keep(materialize(pack_sequences(sized, "lane", "doc_id", "tokens"), "p6-packed"))


def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    """Where every token of every web and indic text stands."""
    return _packed(spark, d)[1]


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    """Sequences, tokens and fill of each lane, beside the token counts of the manifest (latest row of each document)."""
    sized, packed = _packed(spark, d)
    last = F.max_by("token_count", F.struct("loaded_at", "token_count"))
    manifest = table(spark, d, "doc_manifest").where("token_count is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(last.alias("m"))
    told = sized.join(manifest, "doc_id", "left").groupBy("lane").agg(F.count("*").alias("n_docs"), F.sum("m").cast("long").alias("manifest_tokens"))
    bins = packed.groupBy("lane", "sequence_id").agg(F.sum("tokens").alias("t"))
    fill = bins.groupBy("lane").agg(F.count("*").alias("n_sequences"), F.sum("t").alias("tokens"))
    return fill.join(told, "lane").withColumn("fill", F.round(F.col("tokens") / (F.col("n_sequences") * CAPACITY), 4))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    near = find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")
    return near.where("edits = 0").select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"))


def p7_near(spark: SparkSession, d: str) -> DataFrame:
    """Also passages within two character edits, with the least number of edits."""
    near = find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")
    return near.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "edits")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    cut = cut_texts(table(spark, d, "documents"), "doc_id", "text", "lane")
    return cut.where("cut").select(F.col("id").alias("doc_id"))


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts its texts."""
    docs = table(spark, d, "documents")
    cut = cut_texts(docs, "doc_id", "text", "lane").select(F.col("id").alias("doc_id"), "cut")
    hits = F.sum(F.coalesce(F.col("cut"), F.lit(False)).cast("long"))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("unknown")).alias("source")).join(cut, "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("n_docs"), hits.alias("n_cut")).withColumn("cut_share", F.round(F.col("n_cut") / F.col("n_docs"), 4))


#: What the benchmark times.
HEADLINE = ("p1_shares", "p2_found", "p3_found", "p4_found", "p5_found", "p6_packed", "p7_found", "p8_found")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1].isdigit()}
