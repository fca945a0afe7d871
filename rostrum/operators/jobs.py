"""Detection jobs over the tables that outside tools leave behind: frames with their texts,
transcribed speech, media probes. Each job is a DataFrame step; what needs a tool (reading
a picture, telling voices apart) is a Python callable given by the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rostrum.functions import bills, titles, times
from rostrum.operators import clips
from rostrum.sources import captions

# A title card is dark in half of its sampled points; frames tried for a verdict.
DARK, DARK_SHARE, FRAMES = 50, 0.5, 3

# Parts of the picture (left, top, width, height) where captions stand, by
# detection, era and place.
REGIONS = [
    ("bill", "default", "2020-01-01", "senate_floor", [0.75, 0.11, 0.14, 0.05]),
    ("bill", "default", "2020-01-01", "senate_committee", [0.75, 0.11, 0.14, 0.06]),
    ("bill", "default", "2020-01-01", "house_floor", [0.74, 0.11, 0.15, 0.08]),
    ("bill", "default", "2020-01-01", "house_committee", [0.00, 0.00, 0.2, 0.08]),
    ("speaker", "default", "2020-01-01", "house_floor", [0.3, 0.77, 0.55, 0.12]),
    ("speaker", "default", "2020-01-01", "house_committee", [0.0, 0.05, 0.15, 0.1]),
    ("speaker", "default", "2020-01-01", "senate_floor", [0.14, 0.82, 1.0, 0.08]),
    ("speaker", "default", "2020-01-01", "senate_committee", [0.14, 0.82, 0.86, 0.08]),
]


def crop_regions(spark) -> DataFrame:
    """The dimension of caption regions (detection, era, min_date, place, box)."""
    return spark.createDataFrame(REGIONS, "detection string, era string, min_date string, place string, box array<double>")


def region_asof(files: DataFrame, regions: DataFrame) -> DataFrame:
    """(id, detection, box) for files (id, chamber, event_type, date) and every detection:
    of the eras begun on the file's day the latest, else the one named default; in it the
    file's place, else the chamber's committee; NULL where neither is, or where the box has
    not four numbers. Regions are a dimension of a few rows; an era is looked up once a
    distinct (chamber, event type, day)."""
    kind = F.when(F.lower("event_type") == "subcommittee", "committee").otherwise(F.lower("event_type"))
    place = F.concat_ws("_", F.lower("chamber"), kind)
    eras = regions.groupBy("detection", "era").agg(F.min("min_date").alias("min_date"), F.map_from_entries(F.collect_list(F.struct("place", "box"))).alias("boxes"))
    points = files.select("chamber", "event_type", "date").distinct()
    by_day = points.join(F.broadcast(eras.limit(1000)), F.lit(True))  # a few eras
    on = F.col("date").cast("string") >= F.col("min_date")
    default = F.when(F.col("era") == "default", F.col("boxes"))
    best = by_day.groupBy("chamber", "event_type", "date", "detection").agg(F.coalesce(F.max_by("boxes", F.when(on, F.struct("min_date", "era"))), F.max_by("boxes", default.isNotNull())).alias("boxes"), F.max(default.isNotNull() | on).alias("any"))
    box = F.coalesce(F.try_element_at("boxes", place), F.try_element_at("boxes", F.concat(F.lower("chamber"), F.lit("_committee"))))
    found = best.select(F.col("chamber").alias("_c"), F.col("event_type").alias("_e"), F.col("date").alias("_d"), "detection", F.when(F.col("any") & (F.size(box) == 4), box).alias("box"))
    return files.select("id", "chamber", "event_type", "date").join(found, F.col("chamber").eqNullSafe(F.col("_c")) & F.col("event_type").eqNullSafe(F.col("_e")) & F.col("date").eqNullSafe(F.col("_d"))).select("id", "detection", "box")


def read_frames(frames: DataFrame, read: Callable[[bytes], str], picture: str = "content") -> DataFrame:
    """frames with ``text``, what ``read`` (an OCR engine) makes of the picture, and
    ``failed``, whether it raised. The callable must be shippable to the workers."""

    def run(batches):
        for pdf in batches:
            got = []
            for p in pdf[picture]:
                try:
                    got.append((read(bytes(p)) if p is not None else None, p is None))
                except Exception:  # noqa: BLE001  # any failure of the engine is the frame's
                    got.append((None, True))
            yield pdf.drop(columns=picture).assign(text=[g[0] for g in got], failed=[g[1] for g in got])

    kept = "".join(f"`{n}` {t}, " for n, t in frames.drop(picture).dtypes)
    return frames.mapInPandas(run, f"{kept}text string, failed boolean")


def is_title_card(frames: DataFrame, key: str) -> DataFrame:
    """(key, title_card) of sampled points (key, r, g, b): half of a frame's are dark."""
    dark = (F.col("r") + F.col("g") + F.col("b")) / 3 < DARK
    return frames.groupBy(key).agg((F.count_if(dark) >= DARK_SHARE * F.count("*")).alias("title_card"))


def detect_bills(frames: DataFrame, agenda: DataFrame) -> DataFrame:
    """(file_id, time, screenshot, raw_text, type, ignored) of the bills in read frames
    (file_id, t, frame, text, failed); where a frame shows none, the bill of the agenda item
    (file_id, t, pos, bill) nearest in time. A file without any bill gets the row that says so,
    unless a frame failed: then it gets none and its claim stays."""
    seen = frames.select("file_id", F.col("t").cast("long").alias("t"), "frame", bills.tokens("text").alias("found"), "failed")
    bare = seen.where("NOT failed AND size(found) = 0 OR found IS NULL AND NOT failed").select("file_id", "t").distinct()
    near = clips.nearest(bare.withColumn("i", F.col("t")), agenda, "file_id", "t", "i", "pos").join(agenda.select("file_id", F.col("pos").alias("item"), "bill"), ["file_id", "item"]).select("file_id", F.col("i").alias("t"), "bill")
    of = seen.where("NOT failed").join(near, ["file_id", "t"], "left")
    shown = F.when(F.coalesce(F.size("found"), F.lit(0)) > 0, F.col("found")).otherwise(F.array_compact(F.array("bill")))
    rows = of.select("file_id", "t", "frame", F.explode(shown).alias("raw_text"))
    state = frames.groupBy("file_id").agg(F.max("failed").alias("any_failed"))
    none = state.where("NOT any_failed").join(rows.select("file_id").distinct(), "file_id", "left_anti")
    number = F.format_string("%08d", F.col("frame").cast("int"))
    return rows.select("file_id", times.clock(F.col("t")).alias("time"), number.alias("screenshot"), "raw_text", F.lit("bill").alias("type"), F.lit("n").alias("ignored")).unionByName(_none(none, "bill"))


def _none(files: DataFrame, kind: str) -> DataFrame:
    return files.select("file_id", F.lit("00:00:00").alias("time"), F.lit("00000000").alias("screenshot"), F.lit("/none").alias("raw_text"), F.lit(kind).alias("type"), F.lit("y").alias("ignored"))


def detect_speakers(files: DataFrame, listed: DataFrame, read: DataFrame, heard: DataFrame, failed: DataFrame) -> DataFrame:
    """Speaker rows of each file (file_id, is_floor) from the first source that has any: the
    listed speakers, the caption segments read from frames, the voices told apart, which
    count for floor recordings only. Sources have (file_id, name, start). A file with none
    gets the row that says so; files in ``failed`` get none and keep their claim."""
    floor = files.where("is_floor").select("file_id")
    ranked = listed.select("file_id", "name", "start", F.lit(0).alias("rank")).unionByName(read.select("file_id", "name", "start", F.lit(1).alias("rank"))).unionByName(heard.join(floor, "file_id", "left_semi").select("file_id", "name", "start", F.lit(2).alias("rank")))
    ranked = ranked.join(files.select("file_id"), "file_id", "left_semi").where("name IS NOT NULL")
    first = ranked.groupBy("file_id").agg(F.min("rank").alias("rank"))
    rows = ranked.join(first, ["file_id", "rank"])
    none = files.select("file_id").join(first, "file_id", "left_anti").join(failed.select("file_id"), "file_id", "left_anti")
    start = F.round("start").cast("long")
    return rows.select("file_id", times.clock(start).alias("time"), times.screenshot_number(F.col("start")).alias("screenshot"), F.col("name").alias("raw_text"), F.lit("legislator").alias("type"), F.lit("n").alias("ignored")).unionByName(_none(none, "legislator"))


def frame_verdict(frames: DataFrame) -> DataFrame:
    """(file_id, event_type, committee_name) of title cards among read frames (file_id,
    pos, text, title_card): of the first FRAMES the first that tells something. A frame that
    is no title card says floor; an empty text says nothing."""
    early = frames.withColumn("_r", F.row_number().over(W.partitionBy("file_id").orderBy("pos"))).where(F.col("_r") <= FRAMES)
    said = F.when(~F.col("title_card"), F.struct(F.lit("floor").alias("event_type"), F.lit(None).cast("string").alias("committee_name"))).when(F.trim("text") != "", titles.frame_event(F.col("text")))
    got = early.withColumn("v", said).where("v IS NOT NULL")
    return got.groupBy("file_id").agg(F.min_by("v", "pos").alias("v")).select("file_id", "v.*")


def verify_classification(files: DataFrame, verdict: DataFrame, match) -> DataFrame:
    """(id, action, event_type, committee_id, title) for files (id, chamber, event_type):
    confirm where the frames say nothing or the same, correct to floor, correct to the
    committee that ``match`` (label, chamber, kind -> committee_id, committee) finds, else
    confirm as it is. Both mark the record verified."""
    j = files.select("id", "chamber", F.col("event_type").alias("old")).join(verdict.select(F.col("file_id").alias("id"), "event_type", "committee_name"), "id", "left")
    named = match(j.withColumns({"label": F.col("committee_name"), "kind": F.col("event_type")}))
    other = F.coalesce(F.col("event_type") != F.col("old"), F.col("event_type").isNotNull())
    floor = other & (F.col("event_type") == "floor")
    body = other & ~floor & F.col("committee_id").isNotNull()
    name = F.initcap(F.lower("chamber"))
    return named.select(
        "id",
        F.when(floor | body, "correct").otherwise("confirm").alias("action"),
        F.when(floor | body, F.col("event_type")).otherwise(F.col("old")).alias("event_type"),
        F.when(body, F.col("committee_id")).alias("committee_id"),
        F.when(floor, F.concat_ws(" ", name, F.lit("Session"))).when(body, F.concat_ws(" ", name, F.col("committee"))).alias("title"),
    )


def caption_cascade(files: DataFrame) -> DataFrame:
    """(id, source, text) of files (id, webvtt, srt): where captions come from. A file with
    WebVTT is read from it alone; one without from its SRT; where that gives no cue, the
    source is 'speech' and the text NULL: the file has to be transcribed."""
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    tried = files.select("id", F.when(has("webvtt"), "webvtt").when(has("srt"), "srt").alias("source"), F.when(has("webvtt"), F.col("webvtt")).otherwise(F.col("srt")).alias("text"))
    cues = captions.parse_webvtt(tried.where("source = 'webvtt'"), "id", "text").select("id").unionByName(captions.parse_srt(tried.where("source = 'srt'"), "id", "text").select("id")).distinct().withColumn("_ok", F.lit(True))
    got = tried.join(cues, "id", "left")
    return got.select("id", F.when(F.col("_ok"), F.col("source")).otherwise("speech").alias("source"), F.when(F.col("_ok"), F.col("text")).alias("text"))


def job_payload(kind: str, file_id: Column, fields: dict[str, Column], leave_out: tuple[str, ...] = ()) -> Column:
    """The JSON of a job; NULL fields and those in ``leave_out`` (long texts) are not sent."""
    context = F.struct(*(c.alias(n) for n, c in fields.items() if n not in leave_out))
    return F.to_json(F.struct(F.lit(kind).alias("type"), file_id.cast("long").alias("file_id"), context.alias("context")))


def read_payloads(df: DataFrame, payload: str, fields: str) -> tuple[DataFrame, DataFrame]:
    """Jobs (type, file_id, fields...) and the rows whose payload is none: type and file_id
    are required."""
    got = df.withColumn("_p", F.from_json(payload, f"type string, file_id long, context struct<{fields}>"))
    ok = F.coalesce((F.col("_p.type") != "") & F.col("_p.file_id").isNotNull(), F.lit(False))
    return got.where(ok).select("_p.type", "_p.file_id", "_p.context.*"), got.where(~ok).drop("_p")


def frame_listing(objects: DataFrame, path: str, key: str) -> DataFrame:
    """(key, number, path) of the frames in a listing of stored objects: eight digits, .jpg."""
    n = F.regexp_extract(path, r"/(\d{8})\.jpg$", 1)
    return objects.select(key, F.nullif(n, F.lit("")).cast("int").alias("number"), path).where("number IS NOT NULL")


def build_manifests(frames: DataFrame, key: str, number: str, path: str) -> DataFrame:
    """(key, manifest) JSON of each capture's frames in order, timestamp = place from 0. A
    manifest is one text; its frames are seconds of one recording."""
    rows = frames.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(number, path))).alias("_l"))
    thumb = lambda p: F.regexp_replace(p, r"(\d{8})\.jpg$", "$1-thumbnail.jpg")
    items = F.transform("_l", lambda x, i: F.struct(i.alias("timestamp"), x[path].alias("full"), thumb(x[path]).alias("thumb")))
    return rows.select(key, F.to_json(items).alias("manifest"))


def media_probe(text: Column) -> Column:
    """STRUCT<duration_s, width, height, fps> of a probe's JSON: the first video stream."""
    p = F.from_json(text, "streams array<struct<codec_type string, width int, height int, r_frame_rate string>>, format struct<duration string>")
    v = F.get(F.filter(p["streams"], lambda s: s["codec_type"] == "video"), F.lit(0))
    return F.struct(p["format"]["duration"].try_cast("double").cast("int").alias("duration_s"), v["width"].alias("width"), v["height"].alias("height"), times.frame_rate(v["r_frame_rate"]).alias("fps"))


def agenda_bills(text: Column) -> Column:
    """ARRAY<INT>: bill numbers in a record's agenda, given as strings or as items with text."""
    a = F.get_json_object(text, "$.agenda")
    plain = F.from_json(a, "array<string>")
    numbers = F.flatten(F.transform(plain, lambda x: F.regexp_extract_all(x, F.lit(r"(?i)\b[HS][BJR]R?\s*(\d+)"), 1)))
    return F.array_distinct(F.transform(F.coalesce(numbers, F.array().cast("array<string>")), lambda x: x.try_cast("int")))


def listed_people(text: Column) -> Column:
    """ARRAY<BIGINT>: the person ids in a record's speakers list."""
    s = F.from_json(F.get_json_object(text, "$.speakers"), "array<struct<person_id bigint>>")
    return F.array_distinct(F.array_compact(F.coalesce(F.transform(s, lambda x: x["person_id"]), F.array().cast("array<bigint>"))))
