"""Attributes as known at event time, by bitemporal rectangles.

Every version of an entity is valid from its start and known from its recording day.
The plane (valid time x recorded time) of an entity is split into disjoint regions in
each of which one version is current: a version that becomes known closes, from that
day on, the part of its predecessor's region that it takes over. n versions make fewer
than 3n rectangles. Rectangles are indexed by grid cells of valid and recorded time;
an event point looks up its one cell and is inside at most one rectangle.

The versions of one entity are swept in one group; versions are a dimension of bounded
size (a person's terms, the sessions), while events, of which one entity may hold any
share, are spread over the grid cells and deduplicated before the join.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = dt.date(1970, 1, 1)
FAR = 2**31 - 1
#: Days of a grid cell in either direction.
CELL = 1461


def sweep(rows: list[tuple]) -> list[tuple]:
    """rows: (start, end or None, known, order, id) with days as ints. Returns the
    rectangles (valid_from, valid_to, known_from, known_to, id), half-open, disjoint;
    id is 0 where the current version has ended."""
    starts: list[int] = []
    current: list[list] = []  # [known_from, row] by start
    out: list[tuple] = []

    def close(at: int, until: int) -> None:
        since, row = current[at]
        if since >= until:
            return
        upto = starts[at + 1] if at + 1 < len(starts) else FAR
        ends = FAR if row[1] is None else max(row[1] + 1, row[0])
        if row[0] < min(ends, upto):
            out.append((row[0], min(ends, upto), since, until, row[4]))
        if ends < upto:
            out.append((ends, upto, since, until, 0))

    for row in sorted(rows, key=lambda r: (r[2], r[0], r[3], r[4])):
        start, known = row[0], row[2]
        at = bisect_left(starts, start)
        if at < len(starts) and starts[at] == start:
            if (row[3], row[4]) > (current[at][1][3], current[at][1][4]):
                close(at, known)
                current[at] = [known, row]
            continue
        before = bisect_right(starts, start) - 1
        if before >= 0:
            close(before, known)
            current[before][0] = max(current[before][0], known)
        starts.insert(at, start)
        current.insert(at, [known, row])
    for at in range(len(starts)):
        close(at, FAR)
    return out


def _day(c: Column) -> Column:
    return F.datediff(c.cast("date"), F.lit(EPOCH))


def rectangles(versions: DataFrame, key: str, id_col: str, start: str, end: str, known: str, created: str) -> DataFrame:
    """(key, valid_from, valid_to, known_from, known_to, version_id) for all entities.

    Versions of NULL key, start or known day are never in force. Of equal starts the
    later ``created``, then the higher id wins; rows repeated under one id are equal.
    """
    flat = versions.select(
        F.col(key).cast("long").alias("_k"),
        _day(F.col(start)).alias("_s"),
        _day(F.col(end)).alias("_e"),
        _day(F.col(known)).alias("_t"),
        F.unix_micros(F.col(created).cast("timestamp")).alias("_o"),
        F.col(id_col).cast("long").alias("_i"),
    ).where("_k IS NOT NULL AND _s IS NOT NULL AND _t IS NOT NULL AND _i IS NOT NULL")

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(int(s), None if pd.isna(e) else int(e), int(t), int(o), int(i)) for s, e, t, o, i in zip(pdf["_s"], pdf["_e"], pdf["_t"], pdf["_o"], pdf["_i"])]
        got = pd.DataFrame(sweep(rows), columns=["valid_from", "valid_to", "known_from", "known_to", "version_id"])
        got.insert(0, "_k", pdf["_k"].iloc[0])
        return got

    return (
        flat.withColumn("_o", F.coalesce("_o", F.lit(-(1 << 62))))
        .groupBy("_k")
        .applyInPandas(split, "_k long, valid_from int, valid_to int, known_from int, known_to int, version_id long")
        .withColumnRenamed("_k", key)
    )


def locate(points: DataFrame, rects: DataFrame, key: str, valid_day: str, known_day: str, out: str, cell: int = CELL) -> DataFrame:
    """points with the column ``out``: the version current at (valid_day, known_day),
    both DATE columns; 0 if none is. Points of NULL key or day get 0.

    points must be distinct in (key, days). The join is on key and grid cell, so a hot
    entity is spread over its cells; only cells that hold points are indexed.
    """
    p = points.withColumn("_v", _day(F.col(valid_day))).withColumn("_r", _day(F.col(known_day)))
    p = p.withColumn("_cv", F.floor(F.col("_v") / cell).cast("int")).withColumn("_cr", F.floor(F.col("_r") / cell).cast("int"))
    span = points.agg(F.min(_day(F.col(valid_day))).alias("v0"), F.max(_day(F.col(valid_day))).alias("v1"), F.min(_day(F.col(known_day))).alias("r0"), F.max(_day(F.col(known_day))).alias("r1"))
    r = rects.join(F.broadcast(span), F.lit(True))  # span is one row
    r = r.where("valid_from <= v1 AND valid_to > v0 AND known_from <= r1 AND known_to > r0")
    cells = lambda a, b, lo, hi: F.explode(F.sequence(F.floor(F.greatest(a, lo) / cell).cast("int"), F.floor((F.least(b, F.col(hi).cast("long") + 1) - 1) / cell).cast("int")))
    r = r.withColumn("_cv", cells("valid_from", "valid_to", "v0", "v1")).withColumn("_cr", cells("known_from", "known_to", "r0", "r1"))
    r = r.select(F.col(key).alias("_key"), F.col("_cv").alias("_gv"), F.col("_cr").alias("_gr"), "valid_from", "valid_to", "known_from", "known_to", "version_id")
    inside = (
        (F.col(key) == F.col("_key"))
        & (F.col("_cv") == F.col("_gv"))
        & (F.col("_cr") == F.col("_gr"))
        & F.col("_v").between(F.col("valid_from"), F.col("valid_to") - 1)
        & F.col("_r").between(F.col("known_from"), F.col("known_to") - 1)
    )
    return p.join(r, inside, "left").select(*points.columns, F.coalesce("version_id", F.lit(0)).alias(out))


def members_in_force(video_index: DataFrame, files: DataFrame, terms: DataFrame, sessions: DataFrame) -> DataFrame:
    """(file_id, person_id, term_id, session_id) of every member shown in a file, with
    the term and session in force on the file's date as far as known on that date.

    Files without a row or date have no term and no session (0).
    """
    shown = (
        video_index.where("type = 'legislator' AND linked_id IS NOT NULL AND coalesce(ignored, 'n') <> 'y' AND file_id IS NOT NULL")
        .select("file_id", F.col("linked_id").cast("long").alias("person_id"))
        .distinct()
    )
    dates = files.select(F.col("id").alias("file_id"), F.col("date").alias("day")).where("file_id IS NOT NULL").groupBy("file_id").agg(F.min("day").alias("day"))
    dated = shown.join(dates, "file_id", "left")
    points = dated.select("person_id", "day").distinct()
    term_rects = rectangles(terms, "person_id", "id", "date_started", "date_ended", "date_created", "date_created")
    with_term = locate(points, term_rects, "person_id", "day", "day", "term_id")
    all_known = sessions.select(F.lit(0).alias("one"), "id", "date_started", "date_ended", F.lit(dt.date(1000, 1, 1)).alias("known"), F.lit(None).cast("timestamp").alias("created"))
    session_rects = rectangles(all_known, "one", "id", "date_started", "date_ended", "known", "created")
    days = dates.select(F.lit(0).cast("long").alias("one"), "day").distinct()
    with_session = locate(days, session_rects, "one", "day", "day", "session_id").select("day", "session_id")
    return (
        dated.join(with_term.select(F.col("person_id").alias("_p"), F.col("day").alias("_pd"), "term_id"), (F.col("person_id") == F.col("_p")) & F.col("day").eqNullSafe(F.col("_pd")), "left")
        .select("file_id", "person_id", "day", "term_id")
        .join(with_session.withColumnRenamed("day", "_d"), F.col("day").eqNullSafe(F.col("_d")), "left")
        .select("file_id", "person_id", F.coalesce("term_id", F.lit(0)).cast("int").alias("term_id"), F.coalesce("session_id", F.lit(0)).cast("int").alias("session_id"))
    )
