"""Audit predicates over tables: each gives rows (check_name, passed), violations being counted, never collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.corpus import shared_grams


def check(name: str, df: DataFrame, passed: Column) -> DataFrame:
    """One row: whether an aggregate over ``df`` holds; an empty table passes unless the aggregate says otherwise."""
    return df.agg(F.coalesce(passed, F.lit(True)).alias("passed")).select(F.lit(name).alias("check_name"), "passed")


def no_rows(name: str, violations: DataFrame) -> DataFrame:
    return check(name, violations, F.count("*") == 0)


def has_fields(name: str, df: DataFrame, fields: list[str]) -> DataFrame:
    """Whether a table has all of the required columns (others do not matter)."""
    missing = sorted(set(fields) - set(df.columns))
    return df.sparkSession.createDataFrame([(name, not missing)], "check_name string, passed boolean")


def same_rows(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Whether two tables hold the same rows, repetitions and nulls included."""
    return no_rows(name, a.exceptAll(b).unionByName(b.exceptAll(a)))


def resolves(name: str, df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Whether every value of a column that is not null is known elsewhere."""
    return no_rows(name, df.select(F.col(key).alias("_v")).where("_v IS NOT NULL").distinct().join(known.select(F.col(known_key).alias("_v")).distinct(), "_v", "left_anti"))


def firewall_works(name: str, docs: DataFrame, key: str, text: str, held: DataFrame, held_text: str) -> DataFrame:
    """Whether a held-out text put among the texts is flagged: the firewall's own test."""
    poison = held.where(F.length(F.trim(held_text)) > 0).orderBy(F.length(held_text).desc(), held_text).limit(1)
    rows = docs.limit(0).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).unionByName(poison.select(F.lit("poison").alias("k"), F.col(held_text).alias("t")))
    return check(name, shared_grams(rows, "k", "t", held, held_text), F.count("*") > 0)


def overall(*checks: DataFrame) -> DataFrame:
    """All rows and one more, ``overall``, that passes if they all do."""
    rows = reduce(DataFrame.unionByName, checks)
    return rows.unionByName(rows.agg(F.bool_and("passed").alias("passed")).select(F.lit("overall").alias("check_name"), "passed"))


def mixture_within(df: DataFrame, lane: str, size: str, targets: dict[str, float], tolerance: float = 10.0) -> DataFrame:
    """(lane, n, pct, target, within): the lanes' shares in percent, rounded to a tenth, and whether they are near their targets; a
    lane without a row has no share and fails, a lane without a target passes."""
    spark = df.sparkSession
    told = spark.createDataFrame(sorted(targets.items()), "_l string, target double")
    sums = df.groupBy(F.col(lane).alias("lane")).agg(F.sum(size).alias("n"))
    whole = sums.agg(F.sum("n").alias("_whole"))
    shares = sums.withColumn("_one", F.lit(1)).join(whole.withColumn("_one", F.lit(1)), "_one")
    rows = shares.select("lane", "n", F.round(F.when(F.col("_whole") > 0, 100.0 * F.col("n") / F.col("_whole")).otherwise(0.0), 1).alias("pct"))
    rows = rows.join(told, F.col("lane") == F.col("_l"), "full_outer").select(F.coalesce("lane", "_l").alias("lane"), "n", "pct", "target")
    return rows.withColumn("within", F.when(F.col("target").isNull(), True).otherwise(F.coalesce(F.abs(F.col("pct") - F.col("target")) <= tolerance, F.lit(False))))
