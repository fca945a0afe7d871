"""Scraped payloads: nested listings, manifests, and HTML pages."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions import times, titles

LISTING = "STRUCT<Weeks ARRAY<STRUCT<WeekStart STRING, ContentEntityDatas ARRAY<STRUCT<Id BIGINT, Title STRING, Description STRING, ScheduledStart STRING, CommitteeId INT>>>>>"
MANIFEST = "ARRAY<STRUCT<timestamp INT, `full` STRING, thumb STRING>>"


def flatten_weeks(payload: DataFrame, json_col: str) -> DataFrame:
    """The entries of a listing's weeks that have an Id."""
    weeks = payload.select(F.explode(F.from_json(json_col, LISTING)["Weeks"]).alias("w"))
    return weeks.select(F.col("w.WeekStart").alias("week_start"), F.explode("w.ContentEntityDatas").alias("e")).select("week_start", "e.*").where("Id IS NOT NULL")


def manifest_rows(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, pos, timestamp, full) of a screenshot manifest; defaults 0 and ''."""
    rows = df.select(id_col, F.posexplode(F.from_json(json_col, MANIFEST)).alias("pos", "m"))
    return rows.select(id_col, "pos", F.coalesce("m.timestamp", F.lit(0)).alias("timestamp"), F.coalesce(F.col("m.full"), F.lit("")).alias("full"))


def balanced_json(html: str | None, key: str) -> str | None:
    """The JSON object or array assigned to key in a page, brackets balanced outside strings."""
    m = re.search(rf"{re.escape(key)}\s*[=:]\s*(?=[\[{{])", html or "")
    if not m:
        return None
    try:
        return json.dumps(json.JSONDecoder().raw_decode(html, m.end())[0])  # type: ignore[arg-type]
    except ValueError:
        return None


class _Rows(HTMLParser):
    """Cells and first link of the rows of one table."""

    def __init__(self, table_id: str):
        super().__init__()
        self.table_id, self.depth, self.cell, self.in_span = table_id, 0, None, False
        self.rows: list[dict] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table" and (self.depth or a.get("id") == self.table_id):
            self.depth += 1
        elif self.depth and tag == "tr":
            self.rows.append({"cells": [], "link": None, "mp4": None, "span": None})
        elif self.depth and tag == "td" and self.rows:
            self.cell = []
        elif self.depth and tag == "span":
            self.in_span = True
        elif self.depth and tag == "a" and self.rows:
            href = a.get("href") or ""
            self.rows[-1]["link"] = self.rows[-1]["link"] or href or None
            if href.lower().split("?")[0].endswith(".mp4"):
                self.rows[-1]["mp4"] = self.rows[-1]["mp4"] or href

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif tag == "span":
            self.in_span = False
        elif tag == "td" and self.cell is not None:
            self.rows[-1]["cells"].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)
            if self.in_span and self.rows and self.rows[-1]["span"] is None:
                self.rows[-1]["span"] = data.strip()


def table_rows(html: str | None, table_id: str = "archive") -> list[dict]:
    p = _Rows(table_id)
    p.feed(html or "")
    return [r for r in p.rows if r["cells"]]


def scan_table(pages: DataFrame, id_col: str, html_col: str, table_id: str = "archive") -> DataFrame:
    """(id, pos, cells, link, mp4, span) of the rows of the pages' table: the cells' texts, the
    first link, the first link to an MP4, and the text of the first span."""

    def read(batches):
        for pdf in batches:
            out = [(i, k, r["cells"], r["link"], r["mp4"], r["span"]) for i, h in zip(pdf[id_col], pdf[html_col]) for k, r in enumerate(table_rows(h, table_id))]
            yield pd.DataFrame(out, columns=[id_col, "pos", "cells", "link", "mp4", "span"])

    kind = dict(pages.dtypes)[id_col]
    return pages.select(id_col, html_col).mapInPandas(read, f"{id_col} {kind}, pos int, cells array<string>, link string, mp4 string, span string")


def meta_content(html: Column, name: str) -> Column:
    """content of the meta tag of a name or property; NULL if absent."""
    return F.nullif(F.regexp_extract(html, rf"""(?i)<meta[^>]*(?:name|property)=["']{name}["'][^>]*content=["']([^"']*)["']""", 1), F.lit(""))


def listing_rows(pages: DataFrame, id_col: str, html_col: str, table_id: str = "archive") -> DataFrame:
    """(id, pos, clip_id, title, day, duration_s, video_url, event_type, committee_name) of a
    listing's rows of two cells or more that have a clip's number in their link."""
    rows = scan_table(pages, id_col, html_col, table_id).where("size(cells) >= 2")
    cell = lambda i: F.get("cells", F.lit(i))
    clip = F.nullif(F.regexp_extract("link", r"(?i)(?:clip_id=|/clip/)(\w+)", 1), F.lit(""))
    got = rows.select(id_col, "pos", clip.alias("clip_id"), cell(0).alias("title"), titles.cell_day(F.col("span"), cell(1)).alias("day"), times.spoken_duration(F.replace(cell(2), F.lit("\u00a0"), F.lit(" "))).alias("duration_s"), F.col("mp4").alias("video_url"), titles.listing_event(cell(0)).alias("e"))
    return got.where("clip_id IS NOT NULL").select("*", "e.*").drop("e")


def video_link(html: Column) -> Column:
    """The address of a detail page's video: the first of its downloadLinks, else its VideoUrl."""
    first = F.get_json_object(F.regexp_extract(html, r"(?i)downloadLinks\s*=\s*(\[[^;]+\])", 1), "$[0][0]")
    other = F.nullif(F.regexp_extract(html, r'(?i)"VideoUrl"\s*:\s*"([^"]+)"', 1), F.lit(""))
    return F.replace(F.coalesce(F.nullif(first, F.lit("")), other), F.lit("\\/"), F.lit("/"))


def json_block(html: Column, key: str) -> Column:
    """The JSON that a page assigns to key, as text; NULL if none is."""

    @F.arrow_udf("string")
    def block(pages: pa.Array) -> pa.Array:
        return pa.array([balanced_json(p, key) for p in pages.to_pylist()], pa.string())

    return block(html)


def detail_records(pages: DataFrame, event: str, html: str) -> DataFrame:
    """pages with the record of each detail page: ``event`` is the listing's entry as JSON,
    whose fields come before those of the page's own state. Captions are WebVTT."""
    got = pages.withColumns({"_s": json_block(F.col(html), "rootClone"), "_m": json_block(F.col(html), "downloadMediaUrls"), "_a": json_block(F.col(html), "AgendaTree"), "_p": json_block(F.col(html), "Speakers"), "_c": json_block(F.col(html), "ccItems")})
    of = lambda name, state: F.coalesce(F.get_json_object(event, f"$.{name}"), F.get_json_object("_s", f"$.set_{state}"))
    title, text = F.coalesce(of("Title", "title"), F.lit("")), F.coalesce(of("Description", "description"), F.lit(""))
    media = F.from_json("_m", "array<map<string,string>>")
    agenda, people = (F.from_json(c, "array<map<string,string>>") for c in ("_a", "_p"))
    event_of = titles.session_event(title, text)
    return got.select(
        *pages.columns,
        F.get_json_object(event, "$.Id").try_cast("long").alias("content_id"),
        title.alias("title"), text.alias("description"), event_of["event_type"].alias("event_type"), event_of["committee_name"].alias("committee_name"),
        of("Location", "location").alias("location"), of("ScheduledStart", "scheduledStart").alias("scheduled_start"), of("ScheduledEnd", "scheduledEnd").alias("scheduled_end"),
        of("ActualStart", "actualStart").alias("actual_start"), of("ActualEnd", "actualEnd").alias("actual_end"),
        F.get_json_object("_s", "$.mediaDuration").try_cast("double").alias("duration_seconds"),
        F.get(media, F.lit(0))["Url"].alias("video_url"),
        F.transform(media, lambda m: F.struct(F.coalesce(m["Name"], m["NAME"]).alias("name"), m["Url"].alias("url"), F.coalesce(m["AudioOnly"] == "true", F.lit(False)).alias("audio_only"))).alias("media_urls"),
        F.transform(agenda, lambda m: F.struct(m["key"].alias("key"), m["text"].alias("text"), m["startTime"].alias("start_time"))).alias("agenda"),
        F.transform(people, lambda m: F.struct(m["text"].alias("name"), m["startTime"].alias("start_time"), m["parentKey"].alias("agenda_key"))).alias("speakers"),
        F.col("_c").alias("captions_json"),
    )
