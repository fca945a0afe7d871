"""Ingest: record normalising, keyed upsert, deduplicating import, claims and rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rostrum.functions import text, times


def upsert(cached: DataFrame, new: DataFrame, key: Column, version: str = "_pos") -> DataFrame:
    """Cached rows overwritten by new rows of the same key; NULL keys never collide."""
    both = cached.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True).withColumn("_key", key)
    keyed = both.where("_key IS NOT NULL")
    w = W.partitionBy("_key").orderBy(F.desc("_new"), F.desc(version))
    kept = keyed.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return kept.unionByName(both.where("_key IS NULL")).drop("_key", "_new")


def normalize(records: DataFrame) -> DataFrame:
    """records (id, raw_metadata JSON) with the day of meeting and the duration in seconds."""
    at = lambda k: F.get_json_object("raw_metadata", f"$.{k}")
    day = F.coalesce(*(F.try_to_date(F.substring(at(k), 1, 10), "yyyy-MM-dd") for k in ("meeting_date", "scheduled_start", "actual_start", "date")))

    def length(k: str) -> Column:
        n = at(k).try_cast("double").cast("int")
        return F.coalesce(F.when(n > 0, n), F.when(at(k).rlike(r"^\d+:\d+:\d+$"), times.seconds(at(k))))

    return records.select("id", day.alias("day"), F.coalesce(*(length(k) for k in ("duration_seconds", "duration", "length"))).alias("duration_s"))


def import_key(chamber: Column, day: Column, committee: Column, title: Column, path: Column) -> Column:
    """What identifies a recording at import: a known committee and day, else the
    title for floor recordings, else the file's path."""
    return F.when(committee.isNull(), F.concat_ws("|", F.lit("floor"), chamber, day.cast("string"), title)).when(committee == 0, F.concat_ws("|", F.lit("path"), path)).otherwise(
        F.concat_ws("|", F.lit("committee"), chamber, day.cast("string"), committee.cast("string"))
    )


def insert_absent(existing: DataFrame, batch: DataFrame, key: str, order: list) -> DataFrame:
    """Rows of the batch whose key is neither in existing nor earlier in the batch."""
    first = batch.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")
    return first.join(existing.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def replace_rows(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """existing with the rows of new's keys replaced by those of new."""
    return existing.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def with_sentinels(results: DataFrame, jobs: DataFrame) -> DataFrame:
    """results and, for each job (file_id, type) without any, the row that says none was found."""
    empty = jobs.join(results.select("file_id", "type").distinct(), ["file_id", "type"], "left_anti")
    none = empty.select("file_id", "type", F.lit("00:00:00").alias("time"), F.lit("00000000").alias("screenshot"), F.lit("/none").alias("raw_text"), F.lit("y").alias("ignored"))
    return results.select("file_id", "type", "time", "screenshot", "raw_text", "ignored").unionByName(none)


def stale_claims(rows: DataFrame, modified: str, now: Column, hours: int = 3) -> Column:
    """Whether a claim's row is older than ``hours`` at ``now`` or has no time."""
    return F.col(modified).isNull() | (F.unix_micros(F.col(modified).cast("timestamp")) < F.unix_micros(now) - hours * 3_600_000_000)


def patch_json(value: Column, patch: dict[str, Column]) -> Column:
    """A JSON object with some keys set and the others kept as they are, nested values
    included. patch: key -> JSON text. What is no object counts as an empty one."""
    kind = "map<string,variant>"
    m = F.coalesce(F.from_json(value, kind), F.create_map().cast(kind))
    kept = F.map_filter(m, lambda k, _: ~k.isin(*patch))
    new = F.map_from_arrays(F.array(*(F.lit(k) for k in patch)), F.array(*(F.parse_json(v) for v in patch.values())))
    return F.to_json(F.map_concat(kept, new))


def record_key(chamber: Column, record: Column) -> Column:
    """chamber|id of a scraped JSON record, by content_id, clip_id or video_id; NULL without one."""
    ids = (F.nullif(F.get_json_object(record, f"$.{k}"), F.lit("")) for k in ("content_id", "clip_id", "video_id"))
    return F.concat(F.lower(F.coalesce(chamber, F.lit(""))), F.lit("|"), F.coalesce(*ids))


def snapshot(cached: DataFrame, scraped: DataFrame, key: str, pos: str) -> DataFrame:
    """The snapshot after a scrape: of a key the last new record, else the last cached one,
    at the place where the key was first seen (place); records of NULL key are all kept."""
    both = cached.withColumn("_new", F.lit(0)).unionByName(scraped.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    whole = F.struct(*(c for c in both.columns if c != "_new"))
    order = F.struct("_new", pos)
    # records without a key are keyed by their own place
    own = F.coalesce(F.col(key), F.concat_ws("\x01", F.lit(""), F.col("_new").cast("string"), F.col(pos).cast("string")))
    kept = both.groupBy(own.alias("_k")).agg(F.max_by(whole, order).alias("r"), F.min(order).alias("place"))
    return kept.select("r.*", F.col("place._new").alias("place_new"), F.col(f"place.{pos}").alias("place"))


def write_snapshot(records: DataFrame, path: str, generated_at: str) -> None:
    """{generated_at, record_count, records} as JSON: the head in ``head``, the records, one a
    line, beside it, so that no task holds them all."""
    records.write.mode("overwrite").json(f"{path}/records")
    n = records.sparkSession.read.schema(records.schema).json(f"{path}/records").count()
    records.sparkSession.createDataFrame([(generated_at, n)], "generated_at string, record_count long").coalesce(1).write.mode("overwrite").json(f"{path}/head")


def apply_links(video_index: DataFrame, resolved: DataFrame) -> DataFrame:
    """video_index with the linked_id of ``resolved`` (id, linked_id) put in."""
    new = resolved.select(F.col("id").alias("_i"), F.col("linked_id").cast(dict(video_index.dtypes)["linked_id"]).alias("_l"))
    got = video_index.join(new, F.col("id") == F.col("_i"), "left")
    return got.select(*(F.coalesce("_l", "linked_id").alias(c) if c == "linked_id" else F.col(c) for c in video_index.columns))


def claims(jobs: DataFrame, kind: str, now: Column) -> DataFrame:
    """The placeholder rows by which a worker claims jobs (id) of a kind of detection."""
    return jobs.select(F.col("id").alias("file_id"), F.lit(kind).alias("type"), F.lit("00:00:00").alias("time"), F.lit("00000000").alias("screenshot"), F.lit("/pending").alias("raw_text"), F.lit("y").alias("ignored"), now.alias("date_created"))


def release_claims(files: DataFrame, video_index: DataFrame, now: Column, hours: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """files and video_index without the claims older than ``hours``, and the two counts in
    one row. A file's claim without a time counts as old, a placeholder without one as new."""
    old = lambda c: F.unix_micros(F.col(c).cast("timestamp")) < F.unix_micros(now) - hours * 3_600_000_000
    stale = F.coalesce(F.col("capture_directory") == "/pending", F.lit(False)) & (F.col("date_modified").isNull() | old("date_modified"))
    free = files.withColumns({c: F.when(~stale, F.col(c)) for c in ("capture_directory", "capture_rate")})
    dead = F.coalesce((F.col("raw_text") == "/pending") & (F.col("ignored") == "y") & F.col("type").isin("bill", "legislator") & old("date_created"), F.lit(False))
    counts = files.where(stale).agg(F.count("*").alias("screenshot_claims")).join(video_index.where(dead).agg(F.count("*").alias("index_placeholders")))
    return free, video_index.where(~dead), counts


def import_records(records: DataFrame, existing: DataFrame, match) -> DataFrame:
    """Rows of files for the scraped records that are not there yet.

    records (pos, chamber, title, day, duration_s, video_url, event_type, committee_name):
    those without chamber, day or address are no recordings. ``match`` maps a DataFrame with
    (label, chamber, kind) to one with committee_id. Titles are rewritten to chamber and
    committee, or chamber and Session. A record is there if existing has its chamber, day and
    known committee; its path where the committee is unknown (0); its chamber, day and title
    where it is of the floor (NULL). Of equal records of a batch the first is taken.
    """
    c = F.col
    ok = records.where("coalesce(chamber, '') <> '' AND day IS NOT NULL AND coalesce(video_url, '') <> ''").withColumn("chamber", F.lower("chamber"))
    event = F.lower(F.coalesce("event_type", F.lit("floor")))
    named = match(ok.withColumns({"label": F.nullif(c("committee_name"), F.lit("")), "kind": F.when(event == "subcommittee", "subcommittee").otherwise("committee")}))
    committee = F.coalesce("committee_id", F.when(event != "floor", 0)).cast("int")
    title = F.concat_ws(" ", F.initcap("chamber"), F.coalesce("label", F.lit("Session")))
    rows = named.select("pos", "chamber", committee.alias("committee_id"), title.alias("title"), "day", times.clock(c("duration_s")).alias("length"), c("video_url").alias("path"))
    key = import_key(c("chamber"), c("day"), c("committee_id"), c("title"), c("path"))
    old = existing.select(F.lower("chamber").alias("chamber"), "committee_id", "title", c("date").alias("day"), "path")
    keys = old.select(F.explode(F.array(import_key(c("chamber"), c("day"), c("committee_id"), c("title"), c("path")), F.concat_ws("|", F.lit("path"), "path"))).alias("key"))
    return insert_absent(keys, rows.withColumn("key", key), "key", ["pos"]).drop("key")


def link_uploads(uploads: DataFrame, files: DataFrame, held: str = "/video/") -> DataFrame:
    """uploads (youtube_id) with file_id, the lowest file whose cached record has that video
    and which is not stored yet; NULL if none."""
    open_ = files.where(f"path IS NULL OR NOT startswith(path, '{held}')")
    known = open_.select(F.col("id"), text.any_youtube_id(F.col("video_index_cache")).alias("_y")).where("_y IS NOT NULL").groupBy("_y").agg(F.min("id").alias("file_id"))
    return uploads.join(known, F.col("youtube_id") == F.col("_y"), "left").drop("_y")


def upload_manifest(files: DataFrame, held: str = "/video/") -> DataFrame:
    """(file_id, youtube_id, youtube_url, title, date, event_type) of recordings to fetch,
    floor first, then committee, subcommittee and others, the newest first of each."""
    at = lambda k: F.nullif(F.get_json_object("video_index_cache", f"$.{k}"), F.lit(""))
    todo = files.where(f"(path IS NULL OR NOT startswith(path, '{held}')) AND coalesce(html, '') = ''")
    rows = todo.select(F.col("id").alias("file_id"), at("youtube_id").alias("youtube_id"), F.coalesce(at("youtube_url"), at("video_url")).alias("youtube_url"), "title", "date", F.coalesce(at("event_type"), F.lit("committee")).alias("event_type"))
    rank = F.when(F.col("event_type") == "floor", 0).when(F.col("event_type") == "committee", 1).when(F.col("event_type") == "subcommittee", 2).otherwise(3)
    return rows.where("youtube_id IS NOT NULL AND youtube_url IS NOT NULL").orderBy(rank, F.desc("date"), "file_id")


def changed(rows: DataFrame, key: str, new: dict[str, Column]) -> DataFrame:
    """A repair's changes: (key, old and new values) of the rows that recomputed columns alter."""
    differs = F.lit(False)
    for name, value in new.items():
        differs = differs | ~value.eqNullSafe(F.col(name))
    return rows.where(differs).select(key, *(F.col(n).alias("old_" + n) for n in new), *(v.alias("new_" + n) for n, v in new.items()))
