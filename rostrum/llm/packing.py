"""Filling fixed-capacity containers: best fit planned over the length histogram.

The plan is made from counts, not documents: lengths are taken from the longest
to the shortest and every length fills the tightest groups of equal containers
first, whole groups at a time. A plan has a few slots per length, whatever the
corpus, so its size is bounded by the capacity. Documents then take the planned
slots by joining on their rank within their length.

Ranks are made without a task that holds all documents of one length: a length with
more than RANKED rows is cut into as many salts as it needs, rows are numbered within
(length, salt) and shifted by the counts of the salts before.

Defined results: a document longer than the capacity is cut into full containers
and one remainder; NULL and empty texts have length 0, use no space and are
spread over the containers (container 0 if there is no other). Repeated rows are
packed each for itself.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rostrum.llm.tokenize import DEFAULT_VOCABULARY, count_column
from rostrum.session import materialize, spread

CAPACITY = 2048
#: Rows numbered in one group; the offsets table has at most capacity + rows / RANKED rows.
RANKED = 500_000


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Best-fit decreasing over counts. Returns the slots (length, first rank,
    first container, items a container) and the number of containers."""
    spaces: list[int] = []
    groups: dict[int, list[tuple[int, int]]] = {}
    slots: list[tuple[int, int, int, int]] = []
    opened = 0

    def put(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in groups:
                groups[space] = []
                insort(spaces, space)
            groups[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if length <= 0:
            continue
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = groups[space].pop()
                if not groups[space]:
                    del groups[space], spaces[at]
            else:
                space, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = space // length
            whole = min(n, left // each)
            if whole:
                slots.append((length, rank, first, each))
                rank, left = rank + whole * each, left - whole * each
                put(space - each * length, first, whole)
            if whole < n and left:  # fewer than a container's share remain
                slots.append((length, rank, first + whole, left))
                put(space - left * length, first + whole, 1)
                put(space, first + whole + 1, n - whole - 1)
                rank, left = rank + left, 0
            elif whole < n:
                put(space, first + whole, n - whole)
    return slots, opened


def _slot_table(sizes: DataFrame, slots: list[tuple[int, int, int, int]], histogram: dict[int, int]) -> DataFrame:
    """(length, start, stop, first, each): the plan as a table, some slots a length."""
    rows, stop = [], {}
    for length, start, first, each in sorted(slots, reverse=True):
        rows.append((length, start, stop.get(length, histogram[length]), first, each))
        stop[length] = start
    return sizes.sparkSession.createDataFrame(rows, "_length int, _start long, _stop long, _first long, _each long")


def pack(sizes: DataFrame, id_col: str, size_col: str, capacity: int = CAPACITY, ranked: int = RANKED) -> DataFrame:
    """(id, part, first_unit, n_units, container_id): every item of sizes placed once.

    sizes should be a written or otherwise cheap table: it is read three times.
    """
    n = F.greatest(F.coalesce(F.col(size_col), F.lit(0)).cast("long"), F.lit(0))
    items = (
        sizes.select(F.col(id_col), n.alias("_n"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_n") / capacity), F.lit(1)).cast("int") - 1)))
        .withColumn("first_unit", F.col("part") * F.lit(capacity).cast("long"))
        .withColumn("n_units", F.least(F.col("_n") - F.col("first_unit"), F.lit(capacity)).cast("int"))
    )
    histogram = {r["n_units"]: r["n"] for r in items.groupBy("n_units").agg(F.count("*").alias("n")).collect()}  # at most capacity + 1 rows
    hot = [(k, -(-n // ranked)) for k, n in histogram.items() if n > ranked]
    salts = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in hot for x in kv)), F.col("n_units")), F.lit(1)) if hot else F.lit(1)
    items = items.withColumn("_salt", F.pmod(F.xxhash64(F.col(id_col).cast("string"), "part"), salts).cast("int"))
    counts = items.groupBy("n_units", "_salt").agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(W.partitionBy("n_units").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("n_units").alias("_l"), F.col("_salt").alias("_s"), before.alias("_before"))
    slots, opened = plan(histogram, capacity)
    local = F.row_number().over(W.partitionBy("n_units", "_salt").orderBy(F.col(id_col), "part")) - 1
    rank = items.withColumn("_r", local)
    if hot:
        rank = rank.join(F.broadcast(offsets), (F.col("n_units") == F.col("_l")) & (F.col("_salt") == F.col("_s")))  # at most capacity + rows / ranked rows
        rank = rank.withColumn("_r", F.col("_r") + F.col("_before"))
    placed = rank.join(F.broadcast(_slot_table(sizes, slots, histogram)), (F.col("n_units") == F.col("_length")) & (F.col("_r") >= F.col("_start")) & (F.col("_r") < F.col("_stop")), "left")  # the plan, bounded by the capacity
    container = F.when(F.col("n_units") > 0, F.col("_first") + F.floor((F.col("_r") - F.col("_start")) / F.col("_each"))).otherwise(F.pmod("_r", F.lit(max(opened, 1))))
    return placed.select(id_col, "part", "first_unit", "n_units", container.cast("long").alias("container_id"))


def pack_corpus(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Documents packed by their number of tokens."""
    sizes = materialize(spread(documents.select(id_col, text_col)).select(F.col(id_col), count_column(F.col(text_col), path).alias("_tokens")), "packing-sizes")
    return pack(sizes, id_col, "_tokens", capacity)


def report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, fill and unused space; containers over capacity must be 0."""
    per = packed.groupBy("container_id").agg(F.sum("n_units").alias("used"), F.count("*").alias("items"))
    return per.agg(
        F.count("*").alias("containers"),
        F.sum("used").alias("units"),
        F.sum("items").alias("pieces"),
        F.max("used").alias("fullest"),
        F.count_if(F.col("used") > capacity).alias("over_capacity"),
        (1 - F.sum("used") / (F.count("*") * F.lit(capacity))).alias("unused_share"),
    )
