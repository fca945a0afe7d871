"""JSON inside catalog rows: agendas, speakers, caption feeds, video listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.functions import bills, times

_ITEM = "ARRAY<MAP<STRING, STRING>>"


def agenda_rows(files: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, pos, text, start, bill) of agenda items that have text and start; the first bill of each."""
    items = files.select(id_col, F.posexplode(F.from_json(F.get_json_object(json_col, "$.agenda"), _ITEM)).alias("pos", "m"))
    text, start = F.col("m")["text"], F.coalesce(F.col("m")["start_time"], F.col("m")["startTime"])
    got = items.select(id_col, "pos", text.alias("text"), start.alias("start"), F.get(bills.tokens(text), F.lit(0)).alias("bill"))
    return got.where("text IS NOT NULL AND text <> '' AND start IS NOT NULL")


def speaker_rows(files: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, pos, name, seconds) of the speakers list under either spelling of its keys;
    seconds count from the file's first speaker, titles before names go once."""
    raw = F.coalesce(F.get_json_object(json_col, "$.speakers"), F.get_json_object(json_col, "$.Speakers"))
    items = files.select(id_col, F.posexplode(F.from_json(raw, _ITEM)).alias("pos", "m"))
    name = F.trim(F.regexp_replace(F.coalesce(F.col("m")["name"], F.col("m")["text"]), r"(?i)^\s*(?:delegate\s+)?(?:senator\s+)?(?:chair\s+)?", ""))
    at = F.coalesce(F.col("m")["start_time"], F.col("m")["startTime"])
    ts = F.when(times.is_iso(at), F.unix_timestamp(at.try_cast("timestamp")).cast("double")).otherwise(times.seconds_padded(at).cast("double"))
    got = items.select(id_col, "pos", name.alias("name"), ts.alias("ts")).where("name <> '' AND ts IS NOT NULL")
    first = got.groupBy(F.col(id_col).alias("_id")).agg(F.min("ts").alias("t0"))
    return got.join(first, F.col(id_col) == F.col("_id")).select(id_col, "pos", "name", F.greatest(F.lit(0.0), F.col("ts") - F.col("t0")).alias("seconds"))


def caption_feed(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, pos, start_s, end_s, text) of a caption feed of Begin, End and Content, given
    as an array or as an object of one array; times count from the first Begin."""
    j = F.col(json_col)
    arr = F.from_json(F.when(j.startswith("{"), F.regexp_replace(j, r"(?s)^\{[^\[]*|\}\s*$", "")).otherwise(j), _ITEM)
    items = df.select(id_col, F.posexplode(arr).alias("pos", "m")).select(id_col, "pos", F.col("m")["Begin"].try_cast("timestamp").alias("b"), F.col("m")["End"].try_cast("timestamp").alias("e"), F.col("m")["Content"].alias("text"))
    items = items.where("b IS NOT NULL AND e IS NOT NULL AND text IS NOT NULL")
    first = items.groupBy(F.col(id_col).alias("_id")).agg(F.min_by("b", "pos").alias("b0"))
    since = lambda c: (F.unix_micros(c) - F.unix_micros("b0")) / 1_000_000
    return items.join(first, F.col(id_col) == F.col("_id")).select(id_col, "pos", since("b").alias("start_s"), since("e").alias("end_s"), "text")


def listed_videos(search: DataFrame, details: DataFrame, most: int = 50) -> DataFrame:
    """The details of the listed videos in the listing's order: search (pos, id), details (id, ...)."""
    return search.join(details, "id").orderBy("pos").limit(most)


def feed_webvtt(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, text) WebVTT of caption feeds; milliseconds are rounded. Feeds without a readable
    entry have no row."""
    ms = lambda c: F.format_string(".%03d", F.round((F.col(c) - F.floor(c)) * 1000).cast("int"))
    at = lambda c: F.concat(times.clock(F.floor(c)), ms(c))
    cue = F.concat(at("start_s"), F.lit(" --> "), at("end_s"), F.lit("\n"), "text", F.lit("\n"))
    rows = caption_feed(df, id_col, json_col).groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", cue.alias("_p")))).alias("_l"))
    return rows.select(id_col, F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform("_l", lambda x: x["_p"]), "\n")).alias("text"))


def listing_payload(spark, path: str) -> DataFrame:
    """(payload) of landed listings, a JSON text a file."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")
