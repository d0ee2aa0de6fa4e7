"""Readers and writers: parquet, JSON lines, whole text files, sharded tables, an upserted ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.corpus import seeded_sample
from textloom.operators.minhash import dense_rank_shards

TEXT_COLUMNS = ("text", "content", "raw_content")


def text_column(df: DataFrame) -> str:
    """The first of the known names that the table has."""
    for name in TEXT_COLUMNS:
        if name in df.columns:
            return name
    raise KeyError(f"none of {TEXT_COLUMNS} among {df.columns}")


def with_text(df: DataFrame) -> DataFrame:
    name = text_column(df)
    return df if name == "text" else df.withColumnRenamed(name, "text")


def read_sample(spark: SparkSession, path: str, key: str, n: int | None = None, seed: str = "42", **constants: str) -> DataFrame:
    """A parquet table with its text column as ``text`` and constant columns; with ``n`` a seeded sample of at most so many rows,
    all of them if there are fewer."""
    rows = tag(with_text(spark.read.parquet(path)), **constants)
    return rows if n is None else seeded_sample(rows.withColumn("_all", F.lit(0)), key, "_all", n, seed).drop("_all")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards that :func:`write_shards` left under a folder; an error if there are none."""
    rows = spark.read.parquet(path)
    if rows.limit(1).count() == 0:
        raise FileNotFoundError(f"no shards under {path}")
    return rows


def purge_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file of a stage that has been consumed; whether there was one."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)  # noqa: SLF001


def scan_targets(spark: SparkSession, path: str, track: str | None = None) -> DataFrame:
    """(track, folder, path, text): text files under ``path/track/folder``, folders found as they are; ``track`` prunes the scan."""
    files = read_text_files(spark, f"{path}/{track}" if track else path)
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -3).alias("track"), F.element_at(parts, -2).alias("folder"), "path", "text")


def held_out(df: DataFrame, key: str, *fields: str) -> DataFrame:
    """(key, text): every field that is neither null nor empty as a held-out text of its own."""
    pairs = F.array(*[F.col(f) for f in fields])
    return df.select(key, F.explode(F.filter(pairs, lambda t: F.length(t) > 0)).alias("text"))


def prompt_and_solution(df: DataFrame, key: str, prompt: str, solution: str) -> DataFrame:
    """(key, text): a prompt and its solution as one held-out text, a line break between them; a null part is empty."""
    return df.select(key, F.concat(F.coalesce(prompt, F.lit("")), F.lit("\n"), F.coalesce(solution, F.lit(""))).alias("text"))


def rewritten(df: DataFrame, text: str, new: str) -> DataFrame:
    """``df`` with ``new`` in place of ``text`` and ``touched``, whether they differ."""
    return df.withColumn("touched", ~F.col(text).eqNullSafe(F.col(new))).withColumn(text, F.col(new)).drop(new)


def read_jsonl(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.json(path).select(*columns)


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): every ``.txt`` file under a folder, whole."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def tag(df: DataFrame, **constants: str) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def shard_manifest(rows: DataFrame, tokens: str, lang: str) -> DataFrame:
    """(shard_no, n_rows, token_count, lang_distribution, digest) of rows with a ``shard_no``: the digest is over the digests of the
    rows, sorted, so it does not depend on how they are stored; language shares are whole percents, null is ``und``."""
    row = F.sha2(F.to_json(F.struct(*sorted(c for c in rows.columns if c != "shard_no"))), 256)
    per = rows.groupBy("shard_no").agg(F.count("*").alias("n_rows"), F.sum(F.col(tokens).cast("long")).alias("token_count"), F.sha2(F.concat_ws("", F.array_sort(F.collect_list(row))), 256).alias("digest"))
    shares = rows.groupBy("shard_no", F.coalesce(lang, F.lit("und")).alias("l")).agg(F.count("*").alias("c"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("c"), "l")))
    shares = shares.groupBy("shard_no").agg(ordered.alias("s"), F.sum("c").alias("_n"))
    shares = shares.select("shard_no", F.map_from_entries(F.transform("s", lambda x: F.struct(x["l"], F.bround(-100.0 * x["c"] / F.col("_n")).cast("int")))).alias("lang_distribution"))
    return per.join(shares, "shard_no").select("shard_no", "n_rows", "token_count", "lang_distribution", "digest")


def write_shards(df: DataFrame, path: str, order: list[str], size: int = 2000) -> DataFrame:
    """Write ``df`` in shards of ``size`` rows: ``shard_no`` is a column, a file holds whole shards in order and several of them, so
    the number of files follows the bytes, not the shards. Returns a row of each shard: (shard_no, n_rows, digest)."""
    rows = dense_rank_shards(df, order, size)
    rows.sortWithinPartitions("shard_no", *order).write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    row = F.sha2(F.to_json(F.struct(*sorted(c for c in back.columns if c != "shard_no"))), 256)
    return back.groupBy("shard_no").agg(F.count("*").alias("n_rows"), F.sha2(F.concat_ws("", F.array_sort(F.collect_list(row))), 256).alias("digest"))


def write_routed(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_routed_texts(df: DataFrame, path: str, text: str, *by: str) -> None:
    """Texts alone, one JSON string a line, in a folder for each value of ``by``."""
    df.select(*by, F.to_json(F.struct(F.col(text).alias("text"))).alias("value")).write.mode("overwrite").partitionBy(*by).text(path)


def export_arrays(shards: DataFrame, path: str, lane: str, columns: list[str]) -> DataFrame:
    """(lane, shard_no, file, n): an ``.npz`` file of equally long integer arrays for each shard of sequences, rows in ``row_no`` order. For a
    folder that all executors mount; a shard is bounded by its number of sequences."""

    def one(key, rows):
        import os

        import numpy as np
        import pandas as pd

        rows = rows.sort_values("row_no")
        os.makedirs(path, exist_ok=True)
        file = os.path.join(path, f"{key[0]}_shard_{int(key[1]):03d}.npz")
        np.savez(file, **{c: np.stack(rows[c].to_numpy()).astype(np.int32) for c in columns})
        return pd.DataFrame([(key[0], int(key[1]), file, len(rows))], columns=["lane", "shard_no", "file", "n"])

    return shards.groupBy(lane, "shard_no").applyInPandas(one, "lane string, shard_no long, file string, n long")


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def overwrite_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def upsert(ledger: DataFrame, news: DataFrame, key: str, at: str) -> DataFrame:
    """The latest row of each key of both tables."""
    both = ledger.unionByName(news)
    rest = [c for c in both.columns if c not in (key, at)]
    return both.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("m")).select(key, "m.*")
