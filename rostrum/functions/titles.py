"""Titles, listing cells and frame texts read into event type and body (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is no body in a part of a title, and what says nothing in a frame.
DATE = r"^[A-Za-z]+\s+\d{1,2},\s+\d{4}$"
CLOCK = r"(?i)^\d{1,2}:\d{2}\s*(?:am|pm)$"
ROOM = r"(?i)^SR\b"
GENERIC = r"(?i)^(?:Meeting|Hearing|Session|Budget Hearing)$"
BOILERPLATE = ["the meeting will begin shortly", "house of delegates", "virginia", "commonwealth"]
FLOOR_TITLE = r"(?i)\b(?:House|Floor|Veto|Joint|Reconvened)\s+Session\b"
FLOOR_TEXT = r"(?i)\b(?:Regular|Special|Veto|Reconvened)\s+Session\b"
FLOOR_SENATE = r"(?i)\b(?:Senate|Floor|Veto|Joint|Reconvened)\s+Session\b"


def _collapsed(title: Column) -> Column:
    return F.regexp_replace(F.trim(title), r"\s+", " ")


def _bodies(parts: Column) -> Column:
    return F.struct(F.get(parts, F.lit(0)).alias("committee"), F.get(parts, F.lit(1)).alias("subcommittee"))


def _split(text: Column, sep: str) -> Column:
    return F.filter(F.transform(F.split(text, sep), lambda x: F.trim(x)), lambda x: x != "")


def listing_bodies(title: Column) -> Column:
    """STRUCT<committee, subcommittee> of a dash-separated listing title: a date in front,
    clock times and rooms are left out."""
    kept = F.filter(_split(_collapsed(title), " - "), lambda x, i: ~((i == 0) & x.rlike(DATE)) & ~x.rlike(CLOCK) & ~x.rlike(ROOM))
    return _bodies(kept)


def channel_bodies(title: Column) -> Column:
    """STRUCT<committee, subcommittee> of a channel's title: 'Senate of X: A: B on DATE [Tag]',
    else the dash form, which also leaves out numeric dates and generic words."""
    t = _collapsed(title)
    lead = r"(?i)^.*?Senate\s+of\s+[A-Za-z]+\s*:\s*(?=.)"
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, r"\s*\[\w+\]\s*$", ""), r"(?i)\s+on\s+\d{4}-\d{2}-\d{2}\s*$", "")
    named = _split(F.trim(bare(F.regexp_replace(t, lead, ""))), ":")
    colon = F.struct(F.get(named, F.lit(0)).alias("committee"), F.nullif(F.array_join(F.slice(named, F.lit(2), F.greatest(F.size(named), F.lit(1))), ": "), F.lit("")).alias("subcommittee"))
    kept = F.filter(_split(bare(t), " - "), lambda x: ~(x.rlike(DATE) | x.rlike(r"^\d{1,2}/\d{1,2}/\d{2,4}$") | x.rlike(CLOCK) | x.rlike(ROOM) | x.rlike(GENERIC)))
    return F.when(t.rlike(lead), colon).otherwise(_bodies(kept))


def listing_event(title: Column) -> Column:
    """STRUCT<event_type, committee_name> of a listing title."""
    b = listing_bodies(title)
    name = F.coalesce(b["subcommittee"], b["committee"])
    floor = F.coalesce(name.rlike(FLOOR_SENATE), F.lit(False))
    kind = F.when(floor, "floor").when(b["subcommittee"].isNotNull(), "subcommittee").when(name.isNotNull(), "committee").otherwise("floor")
    return F.struct(kind.alias("event_type"), F.when(~floor, name).alias("committee_name"))


def session_event(title: Column, description: Column) -> Column:
    """STRUCT<event_type, committee_name> where only sessions named as such are of the floor
    and any other title is a body's name."""
    t = F.trim(F.coalesce(title, F.lit("")))
    floor = t.rlike(FLOOR_TITLE) | F.coalesce(description, F.lit("")).rlike(FLOOR_TEXT)
    name = F.nullif(t, F.lit(""))
    kind = F.when(floor, "floor").when(F.lower(name).contains("subcommittee"), "subcommittee").otherwise("committee")
    return F.struct(kind.alias("event_type"), F.when(~floor, name).alias("committee_name"))


def frame_event(text: Column) -> Column:
    """STRUCT<event_type, committee_name> of a title card's text: of its lines without
    boilerplate, dates and times the first with 'committee', else the longest (first of
    equals); NULL name without such a line."""
    lines = _split(text, r"\r?\n")
    low = F.lower
    said = lambda x: F.forall(F.array(*(F.lit(b) for b in BOILERPLATE)), lambda b: ~F.contains(low(x), b))
    kept = F.filter(lines, lambda x: said(x) & ~x.rlike(r"^\w+day,?\s+\w+\s+\d{1,2}") & ~x.rlike(r"(?i)^\d{1,2}:\d{2}\s*(?:a\.?m\.?|p\.?m\.?)?$") & (F.octet_length(x) >= 4))
    named = F.get(F.filter(kept, lambda x: low(x).contains("committee")), F.lit(0))
    longest = F.aggregate(kept, F.lit(""), lambda best, x: F.when(F.octet_length(x) > F.octet_length(best), x).otherwise(best))
    pick = F.coalesce(named, F.nullif(longest, F.lit("")))
    clean = F.trim(F.regexp_replace(F.regexp_replace(pick, r"(?i)^\s*House\s+", ""), r"(?i)^(?:Sub)?Committee\s+on\s+", ""))
    return F.struct(F.when(low(text).contains("subcommittee"), "subcommittee").otherwise("committee").alias("event_type"), clean.alias("committee_name"))


def cell_day(span: Column, text: Column) -> Column:
    """The day of a listing's cell: seconds since 1970 in its span (session time zone), else
    Month D, YYYY in its text."""
    epoch = F.when(F.trim(span).rlike(r"^-?\d+(\.\d+)?$"), F.timestamp_seconds(F.trim(span).try_cast("double")).cast("date"))
    return F.coalesce(epoch, F.try_to_date(F.nullif(F.regexp_extract(text, r"([A-Za-z]+\s+\d{1,2},\s+\d{4})", 1), F.lit("")), "MMMM d, yyyy"))


def is_floor(event_type: Column, committee: Column, cached_type: Column) -> Column:
    """Whether a recording is of the floor: by its event type if given, else if it has no
    committee and its cached record says so."""
    return F.when(F.coalesce(event_type, F.lit("")) != "", event_type == "floor").otherwise((F.coalesce(committee, F.lit("")) == "") & F.coalesce(cached_type == "floor", F.lit(False)))
