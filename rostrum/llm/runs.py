"""Runs of identical or near-identical consecutive events in sequences.

Captions of a file and type are ordered by second and id. Each caption is compared
with the one before; a chain of misreadings is canonicalised to the text of its first
reading. That value says nothing of the place: a caption shown again later has it again.
On the canonicalised events a run is a constant difference of two row numbers, the one
within the entity and the one within entity and value, which parts the stretches of one
value; runs are aggregated to their count and duration.

A file of any size is split over chunks (rostrum.operators.sequences): rows are numbered
within a chunk, and the runs at a chunk's edges, three a chunk at most, are put together.

Defined results: rows of ignored 'y' are left out; exact copies under one id count
once; a time that is no HH:MM:SS is replaced by screenshot - 1, and by 0 if that is
no number either; NULL and blank texts read the same among themselves.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from rostrum.llm.bodies import distance, fold
from rostrum.operators import sequences
from rostrum.session import materialize

# Letters that are misread for digits, and digits for letters.
TO_DIGIT = str.maketrans("OoQDIl|iZzASsGTBg", "00001111224556789")
TO_LETTER = str.maketrans("850160", "BSOIGO")

_BILL = re.compile(r"^[^A-Za-z0-9]*(?:L\s+(?=[HS]))?(HOUSE|SENATE|[HS5])\W*(?:(JOINT\s*RESOLUTION|J\W*R|J|RESOLUTION|R|BILL|B|8))\W*#?\W*([A-Z0-9|]+)")


def second(time: Column, screenshot: Column) -> Column:
    """Seconds of a caption: from HH:MM:SS, else screenshot - 1, else 0."""
    p = r"^(\d{1,3}):(\d{2}):(\d{2})$"
    part = lambda i: F.regexp_extract(F.trim(time), p, i).try_cast("int")
    return F.coalesce(part(1) * 3600 + part(2) * 60 + part(3), F.trim(screenshot).try_cast("int") - 1, F.lit(0))


def bill_key(text: str) -> str | None:
    """Chamber, kind and number of a bill caption, misreadings undone; None if it is none."""
    m = _BILL.match(fold(text).upper().strip())
    if not m:
        return None
    chamber = "S" if m[1][0] in "S5" else "H"
    kind = re.sub(r"[^A-Z8]", "", m[2])
    kind = {"JOINTRESOLUTION": "JR", "J": "JR", "RESOLUTION": "R", "BILL": "B", "8": "B"}.get(kind, kind)
    number = m[3].translate(TO_DIGIT)
    number = re.sub(r"\D+$", "", number)
    return f"{chamber}{kind}{int(number)}" if number.isdigit() else None


def reading(text: str | None) -> list[str]:
    """Words of a caption without marks, case and accents."""
    text = re.sub(r"(?<=[\w,.])\s+\.(?=\s|$)", " q.", re.sub(r"[|~_]", " ", fold(text or "").strip()))  # a lost initial
    words = re.sub(r"[^a-z0-9\s]", "", text).split()
    return words[1:] if len(words) > 2 and words[0] == "l" else words


def _edits(n: int) -> int:
    return 1 if n < 7 else 2 if n < 18 else 3


def same_caption(a: str | None, b: str | None, kind: str | None = None) -> bool:
    """Whether two readings show one caption: equal but for misreadings."""
    if a == b:
        return True
    if kind == "bill":
        x, y = bill_key(a or ""), bill_key(b or "")
        if x is not None and y is not None:
            return x == y
    x, y = reading(a), reading(b)
    if x == y:
        return True
    p, q = "".join(x), "".join(y)
    if not p or not q:
        return p == q
    if kind == "bill":
        p, q = p.translate(TO_DIGIT), q.translate(TO_DIGIT)
        return p == q
    if abs(len(x) - len(y)) == 1 and p != q:
        longer = x if len(x) > len(y) else y
        shorter = y if longer is x else x
        lone = [w for w in longer if len(w) == 1]
        if len(lone) > len([w for w in shorter if len(w) == 1]) and distance(p, q, 1) <= 1:
            return False  # an initial more is another form
    most = _edits(min(len(p), len(q)))
    return distance(p, q, most) <= most


def _same(a: Column, b: Column, kind: Column) -> Column:
    @F.arrow_udf(T.BooleanType())
    def same(x: pa.Array, y: pa.Array, k: pa.Array) -> pa.Array:
        memo: dict = {}
        out = []
        for key in zip(x.to_pylist(), y.to_pylist(), k.to_pylist()):
            if key not in memo:
                memo[key] = same_caption(*key)
            out.append(memo[key])
        return pa.array(out, pa.bool_())

    return same(a, b, kind)


def caption_runs(video_index: DataFrame, least: int = 1) -> DataFrame:
    """(file_id, type, caption, first_id, last_id, n, start_second, duration_s) of every
    run of at least ``least`` rows."""
    keys, order = ["file_id", "type"], ["second", "id"]
    rows = (
        video_index.where("coalesce(ignored, 'n') <> 'y' AND id IS NOT NULL")
        .select("id", "file_id", "type", "raw_text", second(F.col("time"), F.col("screenshot")).alias("second"))
        .withColumns({"file_id": F.coalesce("file_id", F.lit(0)), "type": F.coalesce("type", F.lit(""))})
    )
    rows = sequences.chunk(rows, keys, order, "captions")
    rows = sequences.previous(rows, keys, order, ["id", "raw_text"])
    copy = F.col("_prev_id").eqNullSafe(F.col("id"))  # delivered twice: same order, so next to each other
    # only pairs that plain expressions can't decide go to Python: equal but for marks and
    # case is the same, too many edits are another caption
    bare = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    a, b = F.col("_prev_raw_text"), F.col("raw_text")
    lost = r"\s\.(?:\s|$)"
    count = lambda c: F.size(F.regexp_extract_all(c, F.lit(r"[^\s|~_]*[\p{L}\d][^\s|~_]*"), 0))
    shorter = F.least(F.length(bare(a)), F.length(bare(b)))
    most = F.when(shorter < 7, 1).when(shorter < 18, 2).otherwise(3)
    lev = F.levenshtein(bare(a), bare(b), 10)
    quick = (
        F.when(F.col("_prev_id").isNull(), True)
        .when(a.eqNullSafe(b), False)
        .when((bare(a) == bare(b)) & (bare(a) != "") & ~a.rlike(lost) & ~b.rlike(lost), False)
        .when((F.col("type") == "legislator") & (lev == -1), True)
        # the same number of words within the edits forgiven; swapped letters cost two here and are left
        .when((F.col("type") == "legislator") & (bare(a) != "") & (bare(b) != "") & (count(a) == count(b)) & ~a.rlike(lost) & ~b.rlike(lost) & (lev <= most), False)
    )
    differs = rows.withColumn("_new", F.when(copy, False).otherwise(quick))
    checked = differs.withColumn("_a", F.when(F.col("_new").isNull(), a)).withColumn("_b", F.when(F.col("_new").isNull(), b))
    checked = checked.withColumn("_new", F.coalesce("_new", ~_same(F.col("_a"), F.col("_b"), F.col("type"))))
    return _runs(checked.withColumn("_copy", copy), keys, order).where(F.col("n") >= least).select(*keys, F.col("_canon.caption").alias("caption"), "first_id", "last_id", "n", "start_second", (F.col("end_second") - F.col("start_second")).alias("duration_s"))


def _runs(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The runs of rows with _new (another caption than before) and _copy, by the
    difference of row numbers."""
    w = W.partitionBy("_chunk", *keys).orderBy(*order)
    # a chain that goes on from the chunk before has no first reading here: NULL
    named = rows.withColumn("_canon", F.last(F.when(F.col("_new"), F.struct(F.col("raw_text").alias("caption"))), ignorenulls=True).over(w)).withColumns({"_rn": F.row_number().over(w), "_chain": F.sum(F.col("_new").cast("int")).over(w)})
    ranked = named.withColumn("_rv", F.row_number().over(W.partitionBy("_chunk", *keys, "_canon").orderBy(*order)))
    runs = ranked.groupBy("_chunk", *keys, "_canon", (F.col("_rn") - F.col("_rv")).alias("_run")).agg(
        F.min(F.struct(*order)).alias("_at"),
        F.max(F.struct(*order)).alias("_to"),
        F.count_if(~F.col("_copy")).alias("n"),
        F.min("_chain").alias("_chain"),
    )
    runs = materialize(runs.drop("_run"), "runs")
    k = F.struct(*keys)
    ends = runs.groupBy("_chunk").agg(F.min(k).alias("_first"), F.max(F.struct(k.alias("k"), F.col("_at").alias("at"))).alias("_last")).withColumnRenamed("_chunk", "_ec")
    tied = runs.join(F.broadcast(ends), F.col("_chunk") == F.col("_ec"))  # a row a chunk
    leads = k.eqNullSafe(F.col("_first")) & (F.col("_chain") <= 1)
    edge = leads | F.struct(k, F.col("_at")).eqNullSafe(F.col("_last"))
    columns = [*keys, "_canon", "_at", "_to", "n"]
    e = W.partitionBy(*keys).orderBy("_chunk", "_at")  # three rows a chunk at most
    at_edge = tied.where(edge).withColumn("_canon", F.last("_canon", ignorenulls=True).over(e.rowsBetween(W.unboundedPreceding, 0)))
    goes_on = leads & F.col("_canon").eqNullSafe(F.lag("_canon").over(e))
    at_edge = at_edge.withColumn("_isl", F.when(goes_on, 0).otherwise(1)).withColumn("_isl", F.sum("_isl").over(e))
    joined = at_edge.groupBy(*keys, "_isl").agg(F.min_by("_canon", "_at").alias("_canon"), F.min("_at").alias("_at"), F.max("_to").alias("_to"), F.sum("n").alias("n"))
    return tied.where(~edge).select(columns).unionByName(joined.select(columns)).select(
        *keys, "_canon", F.col("_at.id").alias("first_id"), F.col("_to.id").alias("last_id"), "n", F.col("_at.second").alias("start_second"), F.col("_to.second").alias("end_second")
    )


def found(video_index: DataFrame) -> DataFrame:
    """(file_id, first_id, last_id) of the runs of two or more rows; first_id is the smaller."""
    return caption_runs(video_index, 2).select("file_id", F.least("first_id", "last_id").alias("first_id"), F.greatest("first_id", "last_id").alias("last_id"))
