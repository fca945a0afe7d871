"""Caption files: WebVTT and SRT to segments and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions import times


def without_markup(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]*>", "")


_STAMP = r"(\d{1,2}:\d{2}:\d{2}[.,]\d{3})"


def _segments(rows: DataFrame, id_col: str) -> DataFrame:
    """rows (id, pos, a, b, body) as segments: markup and line ends out, empty ones dropped."""
    text = F.trim(F.regexp_replace(without_markup(F.col("body")), r"\s*\n\s*", " "))
    got = rows.select(id_col, "pos", times.timecode(F.col("a")).alias("start_s"), times.timecode(F.col("b")).alias("end_s"), text.alias("text"))
    return got.where("start_s IS NOT NULL AND text <> ''")


def _clean(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "^\ufeff", ""), "\r", "")


def parse_webvtt(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, start_s, end_s, text) of every cue; markup goes. A cue runs to the next
    blank line after its first letter, so that an empty one takes in the cue that follows."""
    cue = rf"(?s){_STAMP} --> {_STAMP}.*?\n(.+?)(?=\n\n|$)"
    rows = df.select(id_col, F.posexplode(F.regexp_extract_all(_clean(F.col(text_col)), F.lit(cue), 0)).alias("pos", "c"))
    at = lambda i: F.regexp_extract("c", rf"(?s)^{_STAMP} --> {_STAMP}.*?\n(.+)$", i)
    return _segments(rows.select(id_col, "pos", at(1).alias("a"), at(2).alias("b"), at(3).alias("body")), id_col)


def parse_srt(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The same of SRT: blocks between blank lines, a number before the times, commas in them."""
    blocks = F.filter(F.split(_clean(F.col(text_col)), r"\n\n+"), lambda b: b.contains(" --> "))
    rows = df.select(id_col, F.posexplode(blocks).alias("pos", "c"))
    at = lambda i: F.regexp_extract("c", rf"{_STAMP} --> {_STAMP}", i)
    body = F.regexp_replace("c", rf"(?s)^.*?{_STAMP} --> {_STAMP}[^\n]*\n?", "")
    return _segments(rows.select(id_col, "pos", at(1).alias("a"), at(2).alias("b"), body.alias("body")), id_col)


def _joined(df: DataFrame, id_col: str, order: list[str], piece: Column, sep: str) -> DataFrame:
    rows = df.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(*order, piece.alias("_p")))).alias("_l"))
    return rows.select(id_col, F.array_join(F.transform("_l", lambda x: x["_p"]), sep).alias("text"))


def plain_text(df: DataFrame, id_col: str, order: list[str], text: str) -> DataFrame:
    """(id, text): a file's segments in order, joined by spaces. The result is one text a file."""
    return _joined(df.where(F.trim(text) != ""), id_col, order, F.trim(text), " ")


def write_webvtt(df: DataFrame, id_col: str, order: list[str], start: str, end: str, text: str) -> DataFrame:
    cue = F.concat(times.vtt_clock(F.col(start)), F.lit(" --> "), times.vtt_clock(F.col(end)), F.lit("\n"), F.trim(F.col(text)))
    got = _joined(df, id_col, order, cue, "\n\n")
    return got.select(id_col, F.concat(F.lit("WEBVTT\n\n"), "text", F.lit("\n")).alias("text"))


def write_srt(df: DataFrame, id_col: str, order: list[str], start: str, end: str, text: str) -> DataFrame:
    clock = lambda c: F.replace(times.vtt_clock(F.col(c)), F.lit("."), F.lit(","))
    rows = df.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(*order, F.concat(clock(start), F.lit(" --> "), clock(end), F.lit("\n"), F.trim(F.col(text))).alias("_p")))).alias("_l"))
    return rows.select(id_col, F.array_join(F.transform("_l", lambda x, i: F.concat((i + 1).cast("string"), F.lit("\n"), x["_p"])), "\n\n").alias("text"))
