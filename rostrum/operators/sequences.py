"""Window building blocks for ordered sequences in which one key may hold any share of
all rows.

A plain window over a key puts the key's rows into one task. Here rows are range
partitioned by key and order first, which splits a hot key into several chunks; windows
run within (chunk, key). As chunks are consecutive, only the first key of a chunk can have
begun in a chunk before: what crosses edges is one row a chunk, so it is broadcast,
and the rows themselves are shuffled once for all windows of a pass. Chunks are written
to the shared folder, so all passes see the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rostrum.session import input_bytes, materialize

CHUNK_BYTES = 32 << 20


def chunk(df: DataFrame, keys: list[str], order: list[str], label: str = "chunks", parts: int | None = None, heavy: bool = False) -> DataFrame:
    """df with ``_chunk``: chunks are consecutive in (keys, order), about CHUNK_BYTES of
    input each, but one a core at least; spark.sql.shuffle.partitions of them where the
    optimizer knows no size. A heavy df is written first, as range partitioning reads it
    twice, once for the ranges."""
    size = input_bytes(df)
    by_size = -(-size // CHUNK_BYTES) if size < 1 << 60 else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or max(df.sparkSession.sparkContext.defaultParallelism, by_size)
    df = materialize(df, label + "-rows") if heavy else df
    return materialize(df.repartitionByRange(parts, *keys, *order).withColumn("_chunk", F.spark_partition_id()), label)


def _before_chunk():
    """All chunks before one. The table it runs over has one row a chunk."""
    return W.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)


def _carried(df: DataFrame, keys: list[str], order: list[str], ahead: dict[str, Column], back: dict[str, Column]) -> DataFrame:
    """(_chunk, _first, _last, _c_name...): of each chunk the first and last key, and the
    nearest non-NULL values which the first key has in the chunks before (ahead) and the
    last key in the chunks after (back)."""
    k = F.struct(*keys)
    at = F.struct(*keys, *order)
    pick = [f(F.struct(k.alias("k"), c.alias("v")), F.when(c.isNotNull(), at)).alias(n) for f, cols in ((F.max_by, ahead), (F.min_by, back)) for n, c in cols.items()]
    edge = df.groupBy("_chunk").agg(F.min(k).alias("_first"), F.max(k).alias("_last"), *pick)
    later = W.orderBy(F.desc("_chunk")).rowsBetween(W.unboundedPreceding, -1)
    edge = edge.select("_chunk", "_first", "_last", *(F.last(n, ignorenulls=True).over(_before_chunk()).alias(n) for n in ahead), *(F.last(n, ignorenulls=True).over(later).alias(n) for n in back))
    of = lambda n, end: F.when(F.col(n)["k"].eqNullSafe(F.col(end)), F.col(n)["v"]).alias("_c_" + n)
    return edge.select(F.col("_chunk").alias("_ec"), "_first", "_last", *(of(n, "_first") for n in ahead), *(of(n, "_last") for n in back))


def forward(df: DataFrame, keys: list[str], order: list[str], before: dict[str, Column] | None = None, upto: dict[str, Column] | None = None, after: dict[str, Column] | None = None) -> DataFrame:
    """df with the nearest non-NULL value of each column among the key's rows: before this
    row (``before``), up to and with it (``upto``), or from it on (``after``). All columns
    share one shuffle; df should be a chunked table with cheap expressions, as it is read
    twice."""
    before, upto, after = before or {}, upto or {}, after or {}
    w = W.partitionBy("_chunk", *keys).orderBy(*order)
    r = W.partitionBy("_chunk", *keys).orderBy(*(F.desc(o) for o in order))
    frames = [(before, w.rowsBetween(W.unboundedPreceding, -1)), (upto, w.rowsBetween(W.unboundedPreceding, 0)), (after, r.rowsBetween(W.unboundedPreceding, 0))]
    got = df.withColumns({n: F.last(c, ignorenulls=True).over(over) for cols, over in frames for n, c in cols.items()})
    got = got.join(F.broadcast(_carried(df, keys, order, before | upto, after)), F.col("_chunk") == F.col("_ec"), "left")  # a row a chunk
    mine = {n: F.struct(*keys).eqNullSafe(F.col("_last" if n in after else "_first")) for n in before | upto | after}
    return got.select(*df.columns, *(F.coalesce(n, F.when(m, F.col("_c_" + n))).alias(n) for n, m in mine.items()))


def previous(df: DataFrame, keys: list[str], order: list[str], columns: list[str], prefix: str = "_prev_") -> DataFrame:
    """df with the columns' values of the row before in (keys, order); NULL for a key's first."""
    got = forward(df, keys, order, before={"_lag": F.struct(*columns)})
    return got.select(*df.columns, *(F.col("_lag")[c].alias(prefix + c) for c in columns))


def fill_forward(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """df with the columns' NULLs replaced by the key's last value before them."""
    got = forward(df, keys, order, upto={"_f_" + c: F.col(c) for c in columns})
    return got.select(*(F.col("_f_" + c).alias(c) if c in columns else F.col(c) for c in df.columns))


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """df with ``out``: the sum of value over the key's rows up to and with this one."""
    k = F.struct(*keys)
    df = df.withColumn("_v", value)
    ends = df.groupBy("_chunk").agg(F.min(k).alias("_first"), F.max(k).alias("_last"))
    # the sum of each chunk's last key, the only one that can go on
    sums = df.join(F.broadcast(ends), "_chunk").groupBy("_chunk").agg(F.first("_first").alias("_first"), F.first("_last").alias("_last"), F.sum(F.when(k.eqNullSafe(F.col("_last")), F.col("_v"))).alias("_s"))
    held = F.collect_list(F.struct("_last", "_s")).over(_before_chunk())
    carry = F.aggregate(F.filter(held, lambda x: x["_last"].eqNullSafe(F.col("_first"))), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["_s"].cast("long"), F.lit(0)))
    edges = sums.select(F.col("_chunk").alias("_ec"), "_first", carry.alias("_carry"))
    local = F.sum("_v").over(W.partitionBy("_chunk", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    got = df.withColumn("_local", local).join(F.broadcast(edges), F.col("_chunk") == F.col("_ec"), "left")  # a row a chunk
    return got.select(*df.columns, (F.col("_local") + F.when(k.eqNullSafe(F.col("_first")), F.col("_carry")).otherwise(0)).alias(out)).drop("_v")


def islands(df: DataFrame, keys: list[str], order: list[str], new: Column, pieces: dict[str, Column], merge: dict[str, Column], label: str = "islands") -> DataFrame:
    """(keys, _chunk, _at, merged columns) of every island. ``new`` tells where one begins
    and must be true of a key's first row; it may hold windows over (_chunk, keys).

    pieces: the aggregates of an island's rows in one chunk; merge: the aggregates that
    put the pieces of one island together, over the pieces' columns.
    """
    w = W.partitionBy("_chunk", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    got = df.withColumn("_isl", F.sum(new.cast("int")).over(w)).groupBy("_chunk", *keys, "_isl")
    got = got.agg(F.min(F.struct(*order)).alias("_at"), *(c.alias(n) for n, c in pieces.items()))
    return stitch(materialize(got.withColumn("_lead", F.col("_isl") == 0).drop("_isl"), label), keys, merge)


def stitch(pieces: DataFrame, keys: list[str], merge: dict[str, Column]) -> DataFrame:
    """Puts the pieces of islands that cross chunks together. A piece has _chunk, _at (the
    order of its first row) and _lead: it goes on an island of a chunk before. Only pieces
    at chunk edges, two a chunk at most, are grouped anew. pieces is a written table."""
    k = F.struct(*keys)
    ends = pieces.groupBy("_chunk").agg(F.max_by(F.struct(k.alias("k"), F.col("_at").alias("at"), F.col("_lead").alias("lead")), F.struct(k.alias("k"), F.col("_at").alias("at"))).alias("e"), F.max("_lead").alias("led"))
    mine = F.when(~F.col("e.lead"), F.struct(F.col("_chunk").alias("chunk"), F.col("e.at").alias("at")))
    ends = ends.withColumn("own", F.last(mine, ignorenulls=True).over(_before_chunk()))
    goes_on = ends.where("led").select(F.col("own.chunk").alias("_gc")).distinct()
    edges = ends.join(F.broadcast(goes_on), F.col("_chunk") == F.col("_gc"), "left")  # a row a chunk
    edges = edges.select(F.col("_chunk").alias("_ec"), F.col("own").alias("_own"), F.when(F.col("_gc").isNotNull(), F.col("e.k")).alias("_ek"), F.col("e.at").alias("_eat"))
    got = pieces.join(F.broadcast(edges), F.col("_chunk") == F.col("_ec"))
    owner = F.when(F.col("_lead"), F.col("_own")).otherwise(F.struct(F.col("_chunk").alias("chunk"), F.col("_at").alias("at")))
    split = F.col("_lead") | (F.col("_ek").isNotNull() & k.eqNullSafe(F.col("_ek")) & (F.col("_at") == F.col("_eat")))
    whole = got.where(~split).select("_chunk", *keys, "_at", *merge)
    edge = got.where(split).groupBy(owner.alias("_o"), *keys).agg(*(c.alias(n) for n, c in merge.items()))
    edge = edge.select(F.col("_o.chunk").alias("_chunk"), *keys, F.col("_o.at").alias("_at"), *merge)
    return whole.unionByName(edge)
