"""Scalar time functions (Column -> Column). Offsets are INT seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _n(c: Column) -> Column:
    return F.coalesce(F.trim(c).try_cast("int"), F.lit(0))


def seconds(text: Column) -> Column:
    """HH:MM:SS as seconds; anything not of three parts is 0."""
    p = F.split(text, ":")
    return F.when(F.size(p) == 3, _n(F.get(p, F.lit(0))) * 3600 + _n(F.get(p, F.lit(1))) * 60 + _n(F.get(p, F.lit(2)))).otherwise(0)


def seconds_padded(text: Column) -> Column:
    """Hours, minutes and seconds from the left, missing parts 0."""
    p = F.split(text, ":")
    at = lambda i: _n(F.coalesce(F.get(p, F.lit(i)), F.lit("0")))
    return at(0) * 3600 + at(1) * 60 + at(2)


def seconds_anywhere(text: Column) -> Column:
    """The first dd:dd:dd inside the text as DOUBLE seconds, else 0.0."""
    at = lambda i: _n(F.regexp_extract(text, r"(\d{2}):(\d{2}):(\d{2})", i))
    return F.coalesce((at(1) * 3600 + at(2) * 60 + at(3)).cast("double"), F.lit(0.0))


def clock(secs: Column) -> Column:
    """Seconds as HH:MM:SS; fractions are cut, negatives are 0."""
    s = F.greatest(secs.cast("long"), F.lit(0))
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def vtt_clock(secs: Column) -> Column:
    """DOUBLE seconds as HH:MM:SS.mmm; milliseconds are cut."""
    return F.concat(clock(F.floor(secs)), F.format_string(".%03d", ((secs - F.floor(secs)) * 1000).cast("int")))


def timecode(text: Column) -> Column:
    """HH:MM:SS.mmm (or with a comma) as DOUBLE seconds."""
    p = F.split(F.regexp_replace(text, ",", "."), ":")
    d = lambda i: F.get(p, F.lit(i)).try_cast("double")
    return d(0) * 3600 + d(1) * 60 + d(2)


def caption_seconds(text: Column) -> Column:
    """[HH:]MM:SS with . or , before the fraction as DOUBLE seconds; NULL if unreadable."""
    p = r"^\s*(?:(\d+):)?(\d{1,2}):(\d{1,2})(?:[.,](\d{1,3}))?\s*$"
    part = lambda i: F.regexp_extract(text, p, i)
    whole = (_n(part(1)) * 3600 + _n(part(2)) * 60).cast("double")
    return F.when(text.rlike(p), whole + F.concat(part(3), F.lit("."), part(4), F.lit("0")).try_cast("double"))


def iso_duration(text: Column) -> Column:
    """PT#H#M#S as seconds; NULL for other texts."""
    part = lambda u: F.coalesce(F.regexp_extract(text, rf"(\d+){u}", 1).try_cast("int"), F.lit(0))
    return F.when(text.rlike(r"^PT(?=\d)(?:\d+H)?(?:\d+M)?(?:\d+S)?$"), part("H") * 3600 + part("M") * 60 + part("S"))


def spoken_duration(text: Column) -> Column:
    """'1h 2m 3s' at the start of the text as seconds; 0 and other texts are NULL."""
    t = F.regexp_extract(text, r"^\s*((?:\d+\s*h\w*\s*)?(?:\d+\s*m\w*\s*)?(?:\d+\s*s\w*)?)", 1)
    part = lambda u: F.coalesce(F.regexp_extract(t, rf"(\d+)\s*{u}", 1).try_cast("int"), F.lit(0))
    return F.nullif(part("h") * 3600 + part("m") * 60 + part("s"), F.lit(0))


def is_iso(text: Column) -> Column:
    return text.contains("T") | text.rlike(r"\d{4}-\d{2}-\d{2}")


def relative(ts: Column, baseline: Column) -> Column:
    """Seconds since the baseline, never negative."""
    return F.greatest(F.lit(0), (F.unix_micros(ts) - F.unix_micros(baseline)) / 1_000_000)


def title_date(text: Column) -> Column:
    """The date in a title: Month D, YYYY, else M/D/YY(YY), else YYYY-MM-DD."""
    long = F.regexp_extract(text, r"((?:January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}, \d{4})", 1)
    slash = F.regexp_extract(text, r"\b(\d{1,2}/\d{1,2}/\d{4})\b", 1)
    short = F.regexp_extract(text, r"\b(\d{1,2}/\d{1,2}/\d{2})\b", 1)
    iso = F.regexp_extract(text, r"\b(\d{4}-\d{2}-\d{2})\b", 1)
    return F.coalesce(F.try_to_date(F.nullif(long, F.lit("")), "MMMM d, yyyy"), F.try_to_date(F.nullif(slash, F.lit("")), "M/d/yyyy"), F.try_to_date(F.nullif(short, F.lit("")), "M/d/yy"), F.try_to_date(F.nullif(iso, F.lit("")), "yyyy-MM-dd"))


def screenshot_number(secs: Column) -> Column:
    """Eight digits of the frame that shows a second: the second + 1."""
    return F.format_string("%08d", F.greatest(F.lit(1), F.round(secs).cast("int") + 1))


def frame_rate(ratio: Column) -> Column:
    """num/den as a rate of three places; NULL without a denominator."""
    p = F.split(ratio, "/")
    return F.round(F.get(p, F.lit(0)).try_cast("double") / F.nullif(F.get(p, F.lit(1)).try_cast("double"), F.lit(0.0)), 3)
