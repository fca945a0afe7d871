"""Temporal context of observations: neighbours within a few frames, by grid buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def neighbours(probe: DataFrame, rows: DataFrame, reach: int) -> DataFrame:
    """(id, n_rows, same): how many rows of the file stand within ``reach`` frames of the
    probe but not on its frame, and how many of them have its linked_id.

    rows are counted per (file, frame, linked_id) first; each probe looks into the two
    buckets its reach touches.
    """
    counts = rows.where("frame IS NOT NULL").groupBy(F.col("file_id").alias("f"), F.col("frame").alias("n"), F.col("linked_id").alias("l")).agg(F.count("*").alias("c"))
    width = 2 * reach + 1
    counts = counts.withColumn("b", F.floor(F.col("n") / width).cast("long"))
    low = F.greatest(F.lit(0), F.col("frame") - reach)
    p = probe.where("frame IS NOT NULL").select("id", "file_id", "frame", "linked_id", F.explode(F.array_distinct(F.array(F.floor(low / width).cast("long"), F.floor((F.col("frame") + reach) / width).cast("long")))).alias("pb"))
    hit = p.join(counts, (F.col("file_id") == F.col("f")) & (F.col("pb") == F.col("b")) & F.col("n").between(F.greatest(F.lit(0), F.col("frame") - reach), F.col("frame") + reach) & (F.col("n") != F.col("frame")), "left")
    return hit.groupBy("id").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(F.col("l") == F.col("linked_id"), F.col("c"))), F.lit(0)).alias("same"))


def consensus(probe: DataFrame, rows: DataFrame, reach: int, least: int) -> DataFrame:
    """(id, linked_id, votes): the most frequent linked_id within ``reach`` frames, if it
    has ``least`` votes; ties go to the one seen first."""
    counts = rows.where("frame IS NOT NULL AND linked_id IS NOT NULL").groupBy(F.col("file_id").alias("f"), F.col("frame").alias("n"), F.col("linked_id").alias("l")).agg(F.count("*").alias("c"), F.min("id").alias("first"))
    width = 2 * reach + 1
    counts = counts.withColumn("b", F.floor(F.col("n") / width).cast("long"))
    low = F.greatest(F.lit(0), F.col("frame") - reach)
    p = probe.where("frame IS NOT NULL").select("id", "file_id", "frame", F.explode(F.array_distinct(F.array(F.floor(low / width).cast("long"), F.floor((F.col("frame") + reach) / width).cast("long")))).alias("pb"))
    hit = p.join(counts, (F.col("file_id") == F.col("f")) & (F.col("pb") == F.col("b")) & F.col("n").between(F.greatest(F.lit(0), F.col("frame") - reach), F.col("frame") + reach) & (F.col("n") != F.col("frame")))
    votes = hit.groupBy("id", "l").agg(F.sum("c").alias("votes"), F.min(F.struct("n", "first")).alias("seen"))
    best = votes.groupBy("id").agg(F.min(F.struct((-F.col("votes")).alias("v"), "seen", "l")).alias("m"))
    return best.select("id", F.col("m.l").alias("linked_id"), (-F.col("m.v")).alias("votes")).where(F.col("votes") >= least)


def majority(rows: DataFrame, key: list[str], value: str, least: int = 3, share: float = 0.8) -> DataFrame:
    """(key, value, votes, total): the value of at least ``share`` of a key's rows, of ``least`` or more."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("votes"))
    top = counts.groupBy(*key).agg(F.sum("votes").alias("total"), F.min(F.struct((-F.col("votes")).alias("n"), F.col(value).alias("v"))).alias("m"))
    return top.select(*key, F.col("m.v").alias(value), (-F.col("m.n")).alias("votes"), "total").where((F.col("total") >= least) & (F.col("votes") >= share * F.col("total")))


def latest_start(rows: DataFrame, spans: DataFrame, row_key: str, day: str, span_key: str, start: str, end: str, out: str) -> DataFrame:
    """rows with ``out``: of the spans open on the row's day the one that began last
    (highest key of equal starts); NULL if none. spans are a small dimension."""
    s = spans.select(F.col(span_key).alias("_k"), F.col(start).alias("_a"), F.col(end).alias("_b"))
    days = rows.select(F.col(day).alias("_d")).distinct().join(s, (F.col("_d") >= F.col("_a")) & (F.col("_b").isNull() | (F.col("_d") <= F.col("_b"))))
    best = days.groupBy("_d").agg(F.max(F.struct("_a", "_k")).alias("m")).select("_d", F.col("m._k").alias(out))
    return rows.join(best, F.col(day) == F.col("_d"), "left").drop("_d")


def survivors(rows: DataFrame, key: list[str], score: list, keep: int = 1) -> DataFrame:
    """The ``keep`` best rows of each key by the score columns, highest first."""
    w = W.partitionBy(*key).orderBy(*score)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep).drop("_r")
