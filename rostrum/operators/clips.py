"""Clips and segments: gaps-and-islands over the observation stream.

All windows run over chunks (rostrum.operators.sequences), so that one file or entity
may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.operators import sequences

GAP, PAD, SHORT, FUZZ = 30, 10, 20, 15


def reduce_to_clips(rows: DataFrame, keys: list[str], time: str, tie: str, gap: int = GAP, pad: int = PAD, short: int = SHORT, fuzz: int = FUZZ) -> DataFrame:
    """(keys, start, end, rows, first): rows at most ``gap`` seconds apart are one clip,
    padded; clips no longer than ``short`` are widened about their middle.

    first is the tie-break column of the clip's first row. NULL times make no clip.
    """
    order = ["_t", "_i"]
    flat = sequences.chunk(rows.where(F.col(time).isNotNull()).select(*keys, F.col(time).cast("long").alias("_t"), F.col(tie).alias("_i")), keys, order, "clips")
    flat = sequences.previous(flat, keys, order, ["_t"])
    new = F.col("_prev__t").isNull() | (F.col("_t") - F.col("_prev__t") > gap)
    pieces = {"a": F.min("_t"), "b": F.max("_t"), "n": F.count("*")}
    clips = sequences.islands(flat, keys, order, new, pieces, {"a": F.min("a"), "b": F.max("b"), "n": F.sum("n")}, "clip-pieces").withColumn("first", F.col("_at._i"))
    clips = clips.withColumn("a", F.greatest(F.lit(0), F.col("a") - pad)).withColumn("b", F.col("b") + pad)
    mid = (F.col("a") + F.col("b")) / 2
    tight = F.col("b") - F.col("a") <= short
    return clips.select(
        *keys,
        F.when(tight, F.greatest(F.lit(0), (mid - fuzz).cast("long"))).otherwise(F.col("a")).alias("start_s"),
        F.when(tight, (mid + fuzz).cast("long")).otherwise(F.col("b")).alias("end_s"),
        F.col("n").alias("n_rows"),
        "first",
    )


def run_segments(rows: DataFrame, keys: list[str], time: str, tie: str, value: Column, least: int = 3) -> DataFrame:
    """(keys, value, start, end, n): runs of equal values; NULL values are skipped and
    don't break a run; runs shorter than ``least`` seconds are left out."""
    order = ["_t", "_i"]
    flat = rows.select(*keys, F.col(time).cast("long").alias("_t"), F.col(tie).alias("_i"), value.alias("value")).where("value IS NOT NULL AND _t IS NOT NULL")
    flat = sequences.chunk(flat, keys, order, "segments")
    flat = sequences.previous(flat, keys, order, ["value"])
    pieces = {"value": F.min("value"), "start_s": F.min("_t"), "end_s": F.max("_t"), "n_rows": F.count("*")}
    merge = {"value": F.min("value"), "start_s": F.min("start_s"), "end_s": F.max("end_s"), "n_rows": F.sum("n_rows")}
    runs = sequences.islands(flat, keys, order, ~F.col("_prev_value").eqNullSafe(F.col("value")), pieces, merge, "segment-pieces")
    return runs.where(F.col("end_s") - F.col("start_s") + 1 >= least).drop("_chunk", "_at")


def nearest(probe: DataFrame, items: DataFrame, key: str, time: str, tie: str, item_tie: str) -> DataFrame:
    """probe rows (key, time, tie) with ``item``: the tie-break of the key's item nearest
    in time; of equally near ones the earlier, then the lower. One pass over both sides
    in order, forward and backward, instead of a range join."""
    p = probe.select(F.col(key).alias("k"), F.col(time).cast("long").alias("t"), F.lit(1).alias("side"), F.col(tie).cast("long").alias("i"))
    # of the items at one second only the lowest can be chosen
    q = items.groupBy(F.col(key).alias("k"), F.col(time).cast("long").alias("t")).agg(F.min(F.col(item_tie).cast("long")).alias("i")).select("k", "t", F.lit(0).alias("side"), "i")
    both = sequences.chunk(p.unionByName(q).where("t IS NOT NULL"), ["k"], ["t", "side", "i"], "nearest")
    mark = F.when(F.col("side") == 0, F.struct("t", "i"))
    got = sequences.forward(both, ["k"], ["t", "side", "i"], upto={"before": mark}, after={"after": mark}).where("side = 1")
    pick = F.when(F.col("after").isNull() | (F.col("t") - F.col("before.t") <= F.col("after.t") - F.col("t")), F.col("before.i")).otherwise(F.col("after.i"))
    return got.select(F.col("k").alias(key), F.col("i").alias(tie), F.when(F.col("before").isNull(), F.col("after.i")).otherwise(pick).alias("item"))
