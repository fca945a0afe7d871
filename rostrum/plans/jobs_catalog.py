"""Queries of jobs, imports, repairs and scraped payloads, with the SQL that gives the same
rows. What outside tools deliver (frames, probes, feeds) is built from the tables' own rows.
Importing this module adds them to the catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import text, times, titles
from rostrum.operators import committees, ingest, jobs, quality
from rostrum.plans.catalog import FILES_SQL, MAJORITY_SQL, OBS_SQL, STAGE_SQL, files, historical_majority, observations, query
from rostrum.session import table
from rostrum.sources import captions, feeds, pages

VIDEOS_SQL = "y AS (SELECT id, fetched_at, snippet.title AS t FROM youtube_videos)"


def videos(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "youtube_videos").select("id", "fetched_at", F.col("snippet.title").alias("t"))


def _typed(f: DataFrame) -> DataFrame:
    """files with an event type: floor without committee, else by the file's number."""
    return f.withColumn("event_type", F.when(F.col("committee_id").isNull(), "floor").when(F.col("id") % 2 == 0, "committee").otherwise("subcommittee"))


TYPED_SQL = "e AS (SELECT *, CASE WHEN committee_id IS NULL THEN 'floor' WHEN id % 2 = 0 THEN 'committee' ELSE 'subcommittee' END AS event_type FROM f)"


# -- titles and regions ------------------------------------------------------------------


@query(f"""WITH {FILES_SQL}, {TYPED_SQL}, r(detection, place, box) AS (VALUES ('bill', 'senate_floor', '0.75,0.11,0.14,0.05'), ('bill', 'senate_committee', '0.75,0.11,0.14,0.06'), ('bill', 'house_floor', '0.74,0.11,0.15,0.08'),
  ('bill', 'house_committee', '0.0,0.0,0.2,0.08'), ('speaker', 'house_floor', '0.3,0.77,0.55,0.12'), ('speaker', 'house_committee', '0.0,0.05,0.15,0.1'), ('speaker', 'senate_floor', '0.14,0.82,1.0,0.08'), ('speaker', 'senate_committee', '0.14,0.82,0.86,0.08')),
d AS (SELECT e.id, e.chamber, e.event_type, x.detection FROM e, (VALUES ('bill'), ('speaker')) x(detection))
SELECT d.id, d.detection, r.box FROM d LEFT JOIN r ON r.detection = d.detection AND r.place = lower(d.chamber) || '_' || CASE d.event_type WHEN 'floor' THEN 'floor' ELSE 'committee' END""")
def region_asof(spark: SparkSession, sf: str) -> DataFrame:
    got = jobs.region_asof(_typed(files(spark, sf)), jobs.crop_regions(spark))
    return got.select("id", "detection", F.array_join(F.transform("box", lambda x: x.cast("string")), ",").alias("box"))


DROP = "regexp_matches(x, '^[A-Za-z]+\\s+[0-9]{1,2},\\s+[0-9]{4}$')"
KEEP = "NOT regexp_matches(x, '^[0-9]{1,2}:[0-9]{2}\\s*(?:am|pm)$', 'i') AND NOT regexp_matches(x, '^SR\\b', 'i')"
TAIL = "regexp_replace(regexp_replace({0}, '\\s*\\[\\w+\\]\\s*$', ''), '\\s+on\\s+[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\s*$', '', 'i')"
PARTS = "list_filter(list_transform(string_split({0}, '{1}'), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""WITH {VIDEOS_SQL}, c AS (SELECT id, fetched_at, regexp_replace(trim(t), '\\s+', ' ', 'g') AS t FROM y WHERE t IS NOT NULL),
l AS (SELECT *, {PARTS.format("t", " - ")} AS a, {PARTS.format(TAIL.format("t"), " - ")} AS b, regexp_matches(t, 'Senate\\s+of\\s+[A-Za-z]+\\s*:\\s*.', 'i') AS colon,
  {PARTS.format("trim(" + TAIL.format("regexp_replace(t, '^.*?Senate\\s+of\\s+[A-Za-z]+\\s*:\\s*', '', 'i')") + ")", ":")} AS n FROM c),
k AS (SELECT *, list_filter(a, lambda x, i: NOT (i = 1 AND {DROP}) AND {KEEP}) AS p, list_filter(b, lambda x: NOT {DROP} AND {KEEP} AND NOT regexp_matches(x, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}}$') AND NOT regexp_matches(x, '^(?:Meeting|Hearing|Session|Budget Hearing)$', 'i')) AS q FROM l)
SELECT id, fetched_at, p[1] AS committee, p[2] AS subcommittee, CASE WHEN colon THEN n[1] ELSE q[1] END AS channel_committee, CASE WHEN colon THEN nullif(array_to_string(n[2:], ': '), '') ELSE q[2] END AS channel_subcommittee,
CASE WHEN coalesce(regexp_matches(coalesce(p[2], p[1]), '\\b(?:Senate|Floor|Veto|Joint|Reconvened)\\s+Session\\b', 'i'), false) THEN 'floor' WHEN p[2] IS NOT NULL THEN 'subcommittee' WHEN p[1] IS NOT NULL THEN 'committee' ELSE 'floor' END AS event_type FROM k""")
def title_bodies(spark: SparkSession, sf: str) -> DataFrame:
    y, t = videos(spark, sf).where("t IS NOT NULL"), F.col("t")
    a, b = titles.listing_bodies(t), titles.channel_bodies(t)
    return y.select("id", "fetched_at", a["committee"].alias("committee"), a["subcommittee"].alias("subcommittee"), b["committee"].alias("channel_committee"), b["subcommittee"].alias("channel_subcommittee"), titles.listing_event(t)["event_type"].alias("event_type"))


LINES = "list_filter(list_transform(regexp_split_to_array(x, '\\r?\\n'), lambda l: trim(l)), lambda l: l <> '')"
GOOD = "NOT regexp_matches(lower(l), 'the meeting will begin shortly|house of delegates|virginia|commonwealth') AND NOT regexp_matches(l, '^\\w+day,?\\s+\\w+\\s+[0-9]{1,2}') AND NOT regexp_matches(l, '^[0-9]{1,2}:[0-9]{2}\\s*(a\\.?m\\.?|p\\.?m\\.?)?$', 'i') AND strlen(l) >= 4"
# a card's text from a title: its parts as lines, with a greeting in front
CARD_SQL = "concat('House of Delegates', chr(10), regexp_replace(t, '\\s*[:,/|-]\\s+', chr(10), 'g'))"
FRAME_SQL = f"""g AS (SELECT *, list_filter({LINES}, lambda l: {GOOD}) AS k FROM c), m AS (SELECT *, coalesce(list_filter(k, lambda l: contains(lower(l), 'committee'))[1], list_filter(k, lambda l: strlen(l) = list_max(list_transform(k, lambda z: strlen(z))))[1]) AS pick FROM g)"""
CLEAN = "trim(regexp_replace(regexp_replace(pick, '^\\s*House\\s+', '', 'i'), '^(Sub)?Committee\\s+on\\s+', '', 'i'))"


def _card(t):
    return F.concat(F.lit("House of Delegates\n"), F.regexp_replace(t, r"\s*[:,/|-]\s+", "\n"))


@query(f"""WITH {VIDEOS_SQL}, c AS (SELECT id, fetched_at, {CARD_SQL} AS x FROM y WHERE t IS NOT NULL), {FRAME_SQL}
SELECT id, fetched_at, CASE WHEN contains(lower(x), 'subcommittee') THEN 'subcommittee' ELSE 'committee' END AS event_type, {CLEAN} AS committee_name FROM m""")
def frame_texts(spark: SparkSession, sf: str) -> DataFrame:
    y = videos(spark, sf).where("t IS NOT NULL")
    return y.select("id", "fetched_at", titles.frame_event(_card(F.col("t"))).alias("e")).select("id", "fetched_at", "e.*")


@query(f"""WITH {FILES_SQL}, m AS (SELECT id, ['Sign in to confirm you are human', 'ERROR: Video unavailable', 'This video is private', 'HTTP Error 403: Forbidden', 'HTTP Error 404', 'read timeout', 'Connection refused', 'SSL: wrong version', 'certificate expired', 'HTTP 503', 'file is too small', 'Could not resolve host', 'was removed'][id % 13 + 1] || ' ' || coalesce(title, '') AS m FROM f)
SELECT id, CASE WHEN regexp_matches(lower(m), 'sign in to confirm|video unavailable|this video is private|this video has been removed|http error 403|http error 404|this video is no longer available|file is too small') THEN 'permanent'
  WHEN regexp_matches(lower(m), 'timeout|timed out|connection refused|connection reset|network is unreachable|could not resolve host|ssl|certificate') THEN 'transient' ELSE 'permanent' END AS kind,
CASE WHEN contains(lower(m), 'sign in to confirm') THEN 'Bot detection' WHEN contains(lower(m), 'video unavailable') OR contains(lower(m), 'removed') THEN 'Video unavailable' WHEN contains(lower(m), 'private') THEN 'Private video'
  WHEN contains(m, '403') THEN 'Access forbidden' WHEN contains(m, '404') THEN 'Video not found' WHEN contains(lower(m), 'too small') THEN 'Invalid download' ELSE 'Download failed' END AS reason FROM m""")
def failure_kinds(spark: SparkSession, sf: str) -> DataFrame:
    said = ["Sign in to confirm you are human", "ERROR: Video unavailable", "This video is private", "HTTP Error 403: Forbidden", "HTTP Error 404", "read timeout", "Connection refused", "SSL: wrong version", "certificate expired", "HTTP 503", "file is too small", "Could not resolve host", "was removed"]
    m = F.concat_ws(" ", F.element_at(F.array(*(F.lit(x) for x in said)), F.col("id") % 13 + 1), F.coalesce("title", F.lit("")))
    return files(spark, sf).select("id", text.failure_kind(m).alias("kind"), text.failure_reason(m).alias("reason"))


@query(f"""WITH {FILES_SQL} SELECT id, coalesce(trim(title), '') AS title, CASE WHEN regexp_matches(coalesce(title, ''), '\\b(?:House|Floor|Veto|Joint|Reconvened)\\s+Session\\b', 'i') OR regexp_matches(coalesce(description, ''), '\\b(?:Regular|Special|Veto|Reconvened)\\s+Session\\b', 'i') THEN 'floor' WHEN contains(lower(title), 'subcommittee') THEN 'subcommittee' ELSE 'committee' END AS event_type,
CASE WHEN 'floor' = event THEN true ELSE event = '' AND committee_id IS NULL AND id % 3 = 0 END AS is_floor FROM (SELECT *, CASE WHEN id % 5 = 0 THEN 'floor' WHEN id % 5 = 1 THEN 'committee' ELSE '' END AS event FROM f)""")
def event_types(spark: SparkSession, sf: str) -> DataFrame:
    event = F.when(F.col("id") % 5 == 0, "floor").when(F.col("id") % 5 == 1, "committee").otherwise("")
    cached = F.when(F.col("id") % 3 == 0, "floor").otherwise("committee")
    return files(spark, sf).select("id", F.coalesce(F.trim("title"), F.lit("")).alias("title"), titles.session_event(F.col("title"), F.col("description"))["event_type"].alias("event_type"), titles.is_floor(event, F.col("committee_id").cast("string"), cached).alias("is_floor"))


@query(f"""{OBS_SQL}, v AS (SELECT id, raw_text, time, t FROM o)
SELECT id, CASE WHEN len(regexp_replace(n, '[^A-Za-z]', '', 'g')) >= 3 THEN n END AS name, CAST(coalesce(TRY_CAST(regexp_extract(time, '([0-9]{{2}}):([0-9]{{2}}):([0-9]{{2}})', 1) AS INT) * 3600 + TRY_CAST(regexp_extract(time, '([0-9]{{2}}):([0-9]{{2}}):([0-9]{{2}})', 2) AS INT) * 60 + TRY_CAST(regexp_extract(time, '([0-9]{{2}}):([0-9]{{2}}):([0-9]{{2}})', 3) AS INT), 0) AS DOUBLE) AS anywhere,
regexp_matches(coalesce(time, ''), 'T|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS iso, CASE WHEN t > 0 THEN t END AS spoken, CAST(greatest(0, t - 100) AS DOUBLE) AS since, 'k/' || id || '.jpg' AS key
FROM (SELECT *, trim(regexp_replace(regexp_replace(translate(regexp_replace(raw_text, '[^A-Za-z0-9 .''-]', ' ', 'g'), '01', 'OI'), '\\s+', ' ', 'g'), '^\\s*((delegate|del\\.?|senator|sen\\.?|chair|rep\\.?)\\s+)+', '', 'i')) AS n FROM v) WHERE t IS NOT NULL""")
def scalar_texts(spark: SparkSession, sf: str) -> DataFrame:
    o, c = observations(spark, sf).where("t IS NOT NULL"), F.col("time")
    t = F.greatest("t", F.lit(0))
    said = F.format_string("%dh %dm %ds", F.floor(t / 3600), F.floor(t % 3600 / 60), t % 60)
    return o.select(
        "id", text.speaker_name(F.col("raw_text")).alias("name"), times.seconds_anywhere(c).alias("anywhere"), F.coalesce(times.is_iso(c), F.lit(False)).alias("iso"), times.spoken_duration(said).cast("long").alias("spoken"),
        times.relative(F.timestamp_seconds("t"), F.timestamp_seconds(F.lit(100))).cast("double").alias("since"), text.video_key(F.concat(F.lit("https://host.example/k/"), F.col("id").cast("string"), F.lit(".jpg"))).alias("key"),
    )


@query(f"""WITH {FILES_SQL} SELECT id, 'yt' || lpad(CAST(id AS VARCHAR), 9, '0') AS video, CASE id % 3 WHEN 0 THEN 'youtube' WHEN 1 THEN 'hls' ELSE 'direct' END AS kind, 'item-' || id AS page, 'https://a.example/download/item-' || id || '/part/a%20b.mp4' AS download,
printf('%.1f%%', round(100.0 * (id % 7) / 7, 1)) AS share, concat_ws('; ', upper(chamber[1]) || lower(substr(chamber, 2)), 'Floor session') AS subject FROM f""")
def address_parts(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf)
    i = F.col("id").cast("string")
    v = F.concat(F.lit("yt"), F.lpad(i, 9, "0"))
    url = F.when(F.col("id") % 3 == 0, F.concat(F.lit("https://www.youtube.com/watch?v="), v)).when(F.col("id") % 3 == 1, F.lit("https://x.example/a.m3u8")).otherwise("https://x.example/a.mp4")
    record = F.when(F.col("id") % 2 == 0, F.to_json(F.struct(v.alias("youtube_id")))).otherwise(F.to_json(F.struct(F.concat(F.lit("https://youtu.be/"), v).alias("video_url"))))
    page = text.archive_page_id(F.concat(F.lit("https://a.example/details/item-"), i, F.lit("?x=1")))
    return f.select("id", text.any_youtube_id(record).alias("video"), text.url_kind(url).alias("kind"), page.alias("page"), text.archive_download("https://a.example", page, F.lit("part/a b.mp4")).alias("download"), text.percentage(F.col("id") % 7, F.lit(7)).alias("share"), text.archive_details(F.col("chamber"), F.lit(None).cast("string"), F.col("title"), F.col("date"))["subject"].alias("subject"))


# -- import, snapshot, claims, links -----------------------------------------------------


@query(f"""WITH {FILES_SQL}, r AS (SELECT id, raw_metadata AS m, lower(coalesce(chamber, '')) || '|' || coalesce(m ->> '$.content_id', m ->> '$.clip_id', m ->> '$.video_id') AS k, CASE WHEN id % 2 = 0 THEN 1 ELSE 0 END AS new FROM f WHERE raw_metadata IS NOT NULL),
g AS (SELECT *, CASE WHEN k IS NULL THEN 'own' || id ELSE k END AS kk FROM r) SELECT arg_max(id, (new, id)) AS id, arg_min(id, (new, id)) AS place, count(*) = 1 AS alone FROM g GROUP BY kk""")
def snapshot_upsert(spark: SparkSession, sf: str) -> DataFrame:
    r = files(spark, sf).where("raw_metadata IS NOT NULL").select("id", "chamber", "raw_metadata").withColumn("key", ingest.record_key(F.col("chamber"), F.col("raw_metadata")))
    got = ingest.snapshot(r.where("id % 2 = 1"), r.where("id % 2 = 0"), "key", "id")
    n = r.groupBy("key").agg(F.count("*").alias("n"))
    return got.join(n, got["key"].eqNullSafe(n["key"]), "left").select("id", "place", F.coalesce((F.col("n") == 1) | got["key"].isNull(), F.lit(True)).alias("alone"))


def _by_name(spark: SparkSession, sf: str):
    """Matches labels to committees of the chamber by equal name, the lowest id."""
    c = table(spark, sf, "committees").groupBy(F.lower("name").alias("_n"), F.lower("chamber").alias("_c"), F.when(F.col("parent_id").isNull(), "committee").otherwise("subcommittee").alias("_k")).agg(F.min("id").alias("committee_id"), F.min("name").alias("committee"))
    return lambda df: df.join(c, (F.lower("label") == F.col("_n")) & (F.lower("chamber") == F.col("_c")) & (F.col("kind") == F.col("_k")), "left").drop("_n", "_c", "_k")


BY_NAME_SQL = "n AS (SELECT lower(name) AS n, lower(chamber) AS c, CASE WHEN parent_id IS NULL THEN 'committee' ELSE 'subcommittee' END AS k, min(id) AS id, min(name) AS name FROM committees GROUP BY ALL)"
RECORDS_SQL = """r AS (SELECT id AS pos, lower(chamber) AS chamber, date AS day, CASE WHEN id % 11 = 0 THEN NULL ELSE path END AS path, CASE WHEN committee_id IS NULL THEN 'floor' WHEN id % 2 = 0 THEN 'committee' ELSE 'subcommittee' END AS event_type, CASE WHEN committee_id IS NULL THEN NULL ELSE trim(string_split(title, ':')[1]) END AS label FROM f)"""


@query(f"""WITH {FILES_SQL}, {RECORDS_SQL}, {BY_NAME_SQL},
p AS (SELECT r.*, coalesce(n.id, CASE WHEN event_type <> 'floor' THEN 0 END) AS cid, concat_ws(' ', upper(chamber[1]) || substr(chamber, 2), coalesce(nullif(label, ''), 'Session')) AS t FROM r LEFT JOIN n ON n.n = lower(label) AND n.c = chamber AND n.k = CASE event_type WHEN 'subcommittee' THEN 'subcommittee' ELSE 'committee' END
  WHERE coalesce(chamber, '') <> '' AND day IS NOT NULL AND coalesce(path, '') <> ''),
k AS (SELECT *, CASE WHEN cid IS NULL THEN concat_ws('|', 'floor', chamber, day::VARCHAR, t) WHEN cid = 0 THEN concat_ws('|', 'path', path) ELSE concat_ws('|', 'committee', chamber, day::VARCHAR, cid::VARCHAR) END AS key FROM p),
o AS (SELECT concat_ws('|', 'path', path) AS key FROM f WHERE id % 4 = 0 UNION SELECT CASE WHEN committee_id IS NULL THEN concat_ws('|', 'floor', lower(chamber), date::VARCHAR, title) WHEN committee_id = 0 THEN concat_ws('|', 'path', path) ELSE concat_ws('|', 'committee', lower(chamber), date::VARCHAR, committee_id::VARCHAR) END FROM f WHERE id % 4 = 0)
SELECT pos, chamber, cid AS committee_id, t AS title, day FROM k WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.key = k.key) QUALIFY row_number() OVER (PARTITION BY key ORDER BY pos) = 1""")
def import_records(spark: SparkSession, sf: str) -> DataFrame:
    f = _typed(files(spark, sf))
    r = f.select(F.col("id").alias("pos"), "chamber", "title", F.col("date").alias("day"), F.lit(60).alias("duration_s"), F.when(F.col("id") % 11 != 0, F.col("path")).alias("video_url"), "event_type", F.when(F.col("committee_id").isNotNull(), F.trim(F.get(F.split("title", ":"), F.lit(0)))).alias("committee_name"))
    return ingest.import_records(r, f.where("id % 4 = 0"), _by_name(spark, sf)).select("pos", "chamber", "committee_id", "title", "day")


@query(f"""WITH h AS ({MAJORITY_SQL}) SELECT v.id, coalesce(CASE WHEN v.linked_id IS NULL THEN h.linked_id END, v.linked_id) AS linked_id FROM (SELECT DISTINCT ON (id) id, raw_text, type, linked_id FROM video_index) v LEFT JOIN h ON h.raw_text = v.raw_text AND h.type = v.type""")
def apply_links(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).select("id", "raw_text", "type", "linked_id")
    new = o.where("linked_id IS NULL").drop("linked_id").join(historical_majority(spark, sf), ["raw_text", "type"]).select("id", "linked_id")
    return ingest.apply_links(o, new).select("id", "linked_id")


@query(f"SELECT id AS file_id, 'bill' AS type, '/pending' AS raw_text, 'y' AS ignored FROM ({STAGE_SQL}) WHERE stage = 'bills'")
def claims_made(spark: SparkSession, sf: str) -> DataFrame:
    todo = quality.pending(*(table(spark, sf, t) for t in ("files", "video_index", "video_transcript")), "bills")
    return ingest.claims(todo, "bill", F.lit("2026-01-01 00:00:00").cast("timestamp")).select("file_id", "type", "raw_text", "ignored")


@query(f"""WITH {FILES_SQL}, o AS (SELECT DISTINCT ON (id) * FROM video_index), s AS (SELECT *, coalesce(capture_directory = '/pending', false) AND (date_modified IS NULL OR date_modified < TIMESTAMP '2016-06-01 09:00:00') AS stale FROM f),
d AS (SELECT *, coalesce(raw_text = '/pending' AND ignored = 'y' AND type IN ('bill', 'legislator') AND date_created < TIMESTAMP '2016-06-01 09:00:00', false) AS dead FROM o)
SELECT 'file' AS kind, CAST(id AS BIGINT) AS id, CASE WHEN NOT stale THEN capture_directory END AS directory FROM s UNION ALL SELECT 'row', id, NULL FROM d WHERE NOT dead AND raw_text = '/pending' UNION ALL SELECT 'screenshot_claims', count(*), NULL FROM s WHERE stale UNION ALL SELECT 'index_placeholders', count(*), NULL FROM d WHERE dead""")
def claims_released(spark: SparkSession, sf: str) -> DataFrame:
    f, rows, n = ingest.release_claims(files(spark, sf), observations(spark, sf), F.lit("2016-06-01 12:00:00").cast("timestamp"))
    none = F.lit(None).cast("string").alias("directory")
    got = f.select(F.lit("file").alias("kind"), F.col("id").cast("long").alias("id"), F.col("capture_directory").alias("directory")).unionByName(rows.where("raw_text = '/pending'").select(F.lit("row").alias("kind"), "id", none))
    return got.unionByName(n.unpivot([], ["screenshot_claims", "index_placeholders"], "kind", "id").select("kind", "id", none))


def _cached(f: DataFrame) -> DataFrame:
    """files with a cached record as channels give it, some without address or id."""
    c = F.struct(F.when(F.col("id") % 6 != 0, F.concat(F.lit("v"), F.col("id").cast("string"))).alias("youtube_id"), F.when(F.col("id") % 7 != 0, F.lit("https://y.example")).alias("video_url"), F.element_at(F.array(F.lit("floor"), F.lit("committee"), F.lit("subcommittee"), F.lit("other")), F.col("id") % 4 + 1).alias("event_type"))
    return f.withColumns({"video_index_cache": F.to_json(c), "path": F.when(F.col("id") % 5 != 0, F.concat(F.lit("https://y.example/"), F.col("id").cast("string"))).otherwise(F.col("path"))})


CACHED_SQL = "c AS (SELECT id, title, date, html, CASE WHEN id % 6 <> 0 THEN 'v' || id END AS yid, CASE WHEN id % 7 <> 0 THEN 'https://y.example' END AS url, ['floor', 'committee', 'subcommittee', 'other'][id % 4 + 1] AS event_type, CASE WHEN id % 5 <> 0 THEN 'x' ELSE path END AS path FROM f)"


@query(f"""WITH {FILES_SQL}, {CACHED_SQL} SELECT id AS file_id, yid AS youtube_id, url AS youtube_url, title, date, event_type FROM c WHERE (path IS NULL OR NOT starts_with(path, '/video/')) AND coalesce(html, '') = '' AND yid IS NOT NULL AND url IS NOT NULL""")
def upload_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.upload_manifest(_cached(files(spark, sf)))


@query(f"""WITH {FILES_SQL}, {CACHED_SQL}, k AS (SELECT yid, min(id) AS file_id FROM c WHERE path IS NULL OR NOT starts_with(path, '/video/') GROUP BY yid) SELECT u.youtube_id, k.file_id FROM (SELECT 'v' || id AS youtube_id FROM f WHERE id % 2 = 0) u LEFT JOIN k ON k.yid = u.youtube_id""")
def upload_links(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf)
    return ingest.link_uploads(f.where("id % 2 = 0").select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("youtube_id")), _cached(f))


@query(f"""WITH {FILES_SQL}, {TYPED_SQL}, n AS (SELECT id, event_type AS o, CASE WHEN regexp_matches(coalesce(title, ''), '\\b(?:House|Floor|Veto|Joint|Reconvened)\\s+Session\\b', 'i') OR regexp_matches(coalesce(description, ''), '\\b(?:Regular|Special|Veto|Reconvened)\\s+Session\\b', 'i') THEN 'floor' WHEN contains(lower(title), 'subcommittee') THEN 'subcommittee' ELSE 'committee' END AS n FROM e)
SELECT id, o AS old_event_type, n AS new_event_type FROM n WHERE o IS DISTINCT FROM n""")
def reclassified(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.changed(_typed(files(spark, sf)), "id", {"event_type": titles.session_event(F.col("title"), F.col("description"))["event_type"]})


@query(f"""WITH {FILES_SQL}, m AS (SELECT id, date AS d, length AS l FROM f) SELECT id, CASE WHEN id % 5 < 4 THEN d END AS day, CASE WHEN NOT regexp_matches(l, '^[0-9]+:[0-9]+:[0-9]+$') THEN CASE WHEN id % 3 = 0 THEN 90 END WHEN id % 3 = 0 THEN 90
  ELSE CAST(string_split(l, ':')[1] AS INT) * 3600 + CAST(string_split(l, ':')[2] AS INT) * 60 + CAST(string_split(l, ':')[3] AS INT) END AS duration_s FROM m WHERE l IS NOT NULL""")
def record_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Days and lengths under each key that a record may have them under."""
    f, c = files(spark, sf).where("length IS NOT NULL"), F.col
    day = lambda k, i: F.when(c("id") % 5 == i, c("date").cast("string")).alias(k)
    record = F.struct(*(day(k, i) for i, k in enumerate(("meeting_date", "scheduled_start", "actual_start", "date", "other"))), F.when(c("id") % 3 == 0, F.lit(90.7)).otherwise(0).alias("duration_seconds"), F.when(c("id") % 3 == 1, c("length")).alias("duration"), c("length"))
    return ingest.normalize(f.select("id", F.to_json(record).alias("raw_metadata")))


# -- detection jobs ----------------------------------------------------------------------


def _frames(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("type = 'bill' AND coalesce(ignored, 'n') <> 'y' AND t IS NOT NULL AND file_id IS NOT NULL")
    return o.groupBy("file_id", "t", "frame").agg(F.min("raw_text").alias("text"), F.lit(False).alias("_"), (F.min("id") % 9 == 0).alias("failed")).drop("_")


TOKEN = "regexp_replace(regexp_extract(upper(raw_text), '\\b([HS]B\\s*[0-9]{1,4})\\b', 1), '\\s+', '', 'g')"
FRAMES_SQL = f"""{OBS_SQL}, fr AS (SELECT file_id, t, min(raw_text) AS x, min(id) % 9 = 0 AS failed FROM o WHERE type = 'bill' AND coalesce(ignored, 'n') <> 'y' AND t IS NOT NULL AND file_id IS NOT NULL GROUP BY file_id, t),
ag AS (SELECT file_id, t, min(id) AS pos, arg_min({TOKEN}, id) AS bill FROM o WHERE type = 'bill' AND id % 5 = 0 AND t IS NOT NULL AND file_id IS NOT NULL AND {TOKEN} <> '' GROUP BY file_id, t),
tk AS (SELECT *, list_distinct(list_transform(regexp_extract_all(upper(x), '\\b([HS]B\\s*[0-9]{{1,4}})\\b', 1), lambda z: regexp_replace(z, '\\s+', '', 'g'))) AS l FROM fr WHERE NOT failed),
w AS (SELECT file_id, t, unnest(l) AS b FROM tk UNION ALL SELECT file_id, t, (SELECT arg_min(ag.bill, (abs(ag.t - tk.t), ag.t)) FROM ag WHERE ag.file_id = tk.file_id) FROM tk WHERE coalesce(len(l), 0) = 0)"""


@query(f"""{FRAMES_SQL} SELECT file_id, printf('%02d:%02d:%02d', greatest(t, 0) // 3600, greatest(t, 0) % 3600 // 60, greatest(t, 0) % 60) AS time, b AS raw_text, 'n' AS ignored FROM w WHERE b IS NOT NULL UNION ALL
SELECT file_id, '00:00:00', '/none', 'y' FROM fr GROUP BY file_id HAVING NOT bool_or(failed) AND file_id NOT IN (SELECT file_id FROM w WHERE b IS NOT NULL)""")
def bill_frames(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("type = 'bill' AND id % 5 = 0 AND t IS NOT NULL AND file_id IS NOT NULL")
    bill = F.regexp_replace(F.regexp_extract(F.upper("raw_text"), r"\b([HS]B\s*\d{1,4})\b", 1), r"\s+", "")
    agenda = o.withColumn("bill", bill).where("bill <> ''").groupBy("file_id", "t").agg(F.min("id").alias("pos"), F.min_by("bill", "id").alias("bill"))
    return jobs.detect_bills(_frames(spark, sf), agenda).select("file_id", "time", "raw_text", "ignored")


@query(f"""{OBS_SQL}, n AS (SELECT DISTINCT ON (id) id AS file_id, committee_id IS NULL AS is_floor FROM files), s AS (SELECT file_id, raw_text AS name, t AS start, file_id % 5 AS src FROM o WHERE type = 'legislator' AND raw_text IS NOT NULL AND t >= 0 AND coalesce(ignored, 'n') <> 'y'),
a AS (SELECT file_id, name, start, CASE WHEN src = 0 THEN 0 WHEN src IN (1, 2) THEN 1 ELSE 2 END AS k FROM s WHERE file_id % 7 <> 0), b AS (SELECT a.* FROM a JOIN n ON n.file_id = a.file_id WHERE k < 2 OR n.is_floor)
SELECT file_id, printf('%02d:%02d:%02d', start // 3600, start % 3600 // 60, start % 60) AS time, printf('%08d', start + 1) AS screenshot, name AS raw_text FROM b UNION ALL SELECT file_id, '00:00:00', '00000000', '/none' FROM n WHERE file_id NOT IN (SELECT file_id FROM b) AND file_id % 11 <> 0""")
def speaker_cascade(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf).select(F.col("id").alias("file_id"), F.col("committee_id").isNull().alias("is_floor"))
    s = observations(spark, sf).where("type = 'legislator' AND raw_text IS NOT NULL AND t >= 0 AND coalesce(ignored, 'n') <> 'y' AND file_id % 7 <> 0").select("file_id", F.col("raw_text").alias("name"), F.col("t").cast("double").alias("start"))
    got = jobs.detect_speakers(f, s.where("file_id % 5 = 0"), s.where("file_id % 5 IN (1, 2)"), s.where("file_id % 5 > 2"), f.where("file_id % 11 = 0"))
    return got.select("file_id", "time", "screenshot", "raw_text")


@query(f"""WITH {FILES_SQL}, {TYPED_SQL}, {BY_NAME_SQL}, c AS (SELECT id, chamber, event_type AS old, {CARD_SQL.replace("(t,", "(title,")} AS x FROM e), {FRAME_SQL}, v AS (SELECT id, chamber, old, CASE WHEN id % 4 = 3 THEN NULL WHEN id % 4 = 2 THEN 'floor' WHEN title_null THEN NULL WHEN contains(lower(x), 'subcommittee') THEN 'subcommittee' ELSE 'committee' END AS et, CASE WHEN id % 4 < 2 THEN {CLEAN} END AS label FROM (SELECT *, x IS NULL AS title_null FROM m)),
w AS (SELECT v.*, n.id AS cid, n.name, et IS NOT NULL AND et IS DISTINCT FROM old AS other FROM v LEFT JOIN n ON n.n = lower(v.label) AND n.c = lower(v.chamber) AND n.k = v.et)
SELECT id, CASE WHEN other AND (et = 'floor' OR cid IS NOT NULL) THEN 'correct' ELSE 'confirm' END AS action, CASE WHEN other AND (et = 'floor' OR cid IS NOT NULL) THEN et ELSE old END AS event_type, CASE WHEN other AND et <> 'floor' THEN cid END AS committee_id FROM w""")
def frame_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Four frames a file: the first two tell nothing or something, the others come too late."""
    f = _typed(files(spark, sf))
    card = F.when(F.col("id") % 4 < 2, _card(F.col("title")))
    frame = lambda pos, t, shown: F.struct(F.lit(pos).alias("pos"), t.alias("text"), shown.alias("title_card"))
    blank = F.lit("  ")
    rows = f.select(F.col("id").alias("file_id"), F.explode(F.array(frame(0, blank, F.lit(True)), frame(1, F.coalesce(card, blank), F.col("id") % 4 != 2), frame(2, blank, F.lit(True)), frame(3, blank, F.lit(False)))).alias("r")).select("file_id", "r.*")
    return jobs.verify_classification(f, jobs.frame_verdict(rows), _by_name(spark, sf)).select("id", "action", "event_type", "committee_id")


@query("""SELECT c_nationkey AS frame, count(CASE WHEN (c_custkey % 256 + c_custkey % 200 + c_custkey % 50) / 3.0 < 50 THEN 1 END) >= 0.5 * count(*) AS title_card FROM customer GROUP BY c_nationkey""")
def title_cards(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return jobs.is_title_card(table(spark, sf, "customer").select(F.col("c_nationkey").alias("frame"), (k % 256).alias("r"), (k % 200).alias("g"), (k % 50).alias("b")), "frame")


@query(f"""{OBS_SQL}, d AS (SELECT DISTINCT file_id, frame FROM o WHERE frame > 0 AND file_id IS NOT NULL) SELECT file_id, CAST(row_number() OVER (PARTITION BY file_id ORDER BY frame) - 1 AS INT) AS timestamp, printf('/c/%d/%08d.jpg', file_id, frame) AS "full" FROM d""")
def manifest_build(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("file_id IS NOT NULL").select("file_id", F.format_string("/c/%d/%08d.jpg", "file_id", "frame").alias("p"), "frame")
    stored = o.where("frame > 0").drop("frame").distinct().unionByName(o.select("file_id", F.lit("/c/readme.txt").alias("p")))
    built = jobs.build_manifests(jobs.frame_listing(stored, "p", "file_id"), "file_id", "number", "p")
    return pages.manifest_rows(built, "file_id", "manifest").select("file_id", "timestamp", "full")


@query(f"""WITH {FILES_SQL} SELECT id, CASE WHEN title IS NULL OR trim(title) = '' OR id % 4 = 3 THEN 'speech' WHEN id % 4 = 0 THEN 'webvtt' WHEN id % 4 = 1 THEN 'srt' ELSE 'speech' END AS source FROM f""")
def caption_source(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf)
    cues = f.select("id", F.lit(1.0).cast("double").alias("a"), F.lit(2.5).cast("double").alias("b"), F.coalesce("title", F.lit("")).alias("t"))
    vtt = captions.write_webvtt(cues.where("id % 4 = 0"), "id", ["a"], "a", "b", "t").withColumnRenamed("text", "webvtt")
    srt = captions.write_srt(cues.where("id % 4 IN (1, 2)"), "id", ["a"], "a", "b", "t").withColumnRenamed("text", "srt")
    both = f.select("id").join(vtt, "id", "left").join(srt, "id", "left")
    # captions that parse to nothing are not replaced by another source
    return jobs.caption_cascade(both.withColumn("webvtt", F.when(F.col("id") % 4 == 2, "WEBVTT\n\n").otherwise(F.col("webvtt")))).select("id", "source")


@query(f"""WITH {FILES_SQL} SELECT 'ok' AS state, CAST(id AS BIGINT) AS file_id, chamber, title FROM f WHERE id % 7 <> 0 UNION ALL SELECT 'bad', CAST(id AS BIGINT), NULL, NULL FROM f WHERE id % 7 = 0""")
def job_payloads(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf)
    p = jobs.job_payload("transcript", F.when(F.col("id") % 7 != 0, F.col("id")), {"chamber": F.col("chamber"), "title": F.col("title"), "captions": F.col("webvtt")}, ("captions",))
    ok, bad = jobs.read_payloads(f.select(F.col("id").cast("long").alias("row_id"), p.alias("p")), "p", "chamber string, title string")
    none = F.lit(None).cast("string")
    return ok.select(F.lit("ok").alias("state"), "file_id", "chamber", "title").unionByName(bad.select(F.lit("bad").alias("state"), F.col("row_id").alias("file_id"), none.alias("chamber"), none.alias("title")))


@query(f"""WITH {FILES_SQL} SELECT id, CAST(id % 5000 AS INT) AS duration_s, width, height, CASE WHEN id % 3 = 0 THEN 29.97 WHEN id % 3 = 1 THEN 25.0 END AS fps FROM f""")
def media_probes(spark: SparkSession, sf: str) -> DataFrame:
    rate = F.when(F.col("id") % 3 == 0, "30000/1001").when(F.col("id") % 3 == 1, "25/1").otherwise("0/0")
    none = F.lit(None).cast("int")
    stream = lambda kind, w, h, r: F.struct(F.lit(kind).alias("codec_type"), w.alias("width"), h.alias("height"), r.alias("r_frame_rate"))
    p = F.struct(F.array(stream("audio", none, none, F.lit("0/0")), stream("video", F.col("width"), F.col("height"), rate)).alias("streams"), F.struct(F.concat((F.col("id") % 5000).cast("string"), F.lit(".5")).alias("duration")).alias("format"))
    return files(spark, sf).select("id", jobs.media_probe(F.to_json(p)).alias("m")).select("id", "m.*")


@query(f"""{OBS_SQL}, b AS (SELECT file_id, list(raw_text ORDER BY id) AS l FROM o WHERE type = 'bill' AND raw_text IS NOT NULL AND file_id IS NOT NULL GROUP BY file_id), n AS (SELECT file_id, flatten(list_transform(l, lambda x: regexp_extract_all(x, '(?i)\\b[HS][BJR]R?\\s*([0-9]+)', 1))) AS n FROM b)
SELECT file_id, coalesce(array_to_string(list_sort(list_distinct(list_transform(n, lambda x: TRY_CAST(x AS INT)))), ' '), '') AS numbers FROM n""")
def agenda_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Bill numbers of agendas in both forms, here the captions of a file in turn as items."""
    o = observations(spark, sf).where("type = 'bill' AND raw_text IS NOT NULL AND file_id IS NOT NULL")
    a = o.groupBy("file_id").agg(F.collect_list("raw_text").alias("l"))
    items = F.to_json(F.struct(F.transform("l", lambda x: F.struct(x.alias("text"))).alias("agenda")))
    j = F.when(F.col("file_id") % 2 == 0, items).otherwise(F.to_json(F.struct(F.col("l").alias("agenda"))))
    n = F.array_sort(F.array_compact(jobs.agenda_bills(j)))
    return a.select("file_id", F.array_join(F.transform(n, lambda x: x.cast("string")), " ").alias("numbers"))


# -- pages and feeds ---------------------------------------------------------------------


@query(f"""WITH {FILES_SQL} SELECT CAST(id AS BIGINT) AS content_id, coalesce(title, 'Page ' || id) AS title, CASE WHEN regexp_matches(coalesce(title, 'Page ' || id), '\\b(?:House|Floor|Veto|Joint|Reconvened)\\s+Session\\b', 'i') OR id % 9 = 0 THEN 'floor' WHEN contains(lower(coalesce(title, '')), 'subcommittee') THEN 'subcommittee' ELSE 'committee' END AS event_type,
'https://m.example/' || id || '.mp4' AS video_url, CAST(id AS DOUBLE) AS duration_seconds, 'HB ' || id AS item, 'Ann ' || id AS speaker FROM f""")
def detail_pages(spark: SparkSession, sf: str) -> DataFrame:
    f, i = files(spark, sf), F.col("id").cast("string")
    state = F.to_json(F.struct(F.concat(F.lit("Page "), i).alias("set_title"), F.when(F.col("id") % 9 == 0, "Regular Session; \"daily\" {a}").otherwise("").alias("set_description"), F.col("id").alias("mediaDuration")))
    media = F.to_json(F.array(F.struct(F.concat(F.lit("https://m.example/"), i, F.lit(".mp4")).alias("Url"), F.lit("hd]").alias("Name"), F.lit(False).alias("AudioOnly"))))
    agenda = F.to_json(F.array(F.struct(F.lit("k").alias("key"), F.concat(F.lit("HB "), i).alias("text"), F.lit("0:10").alias("startTime"))))
    people = F.to_json(F.array(F.struct(F.concat(F.lit("Ann "), i).alias("text"), F.lit("0:10").alias("startTime"), F.lit("k").alias("parentKey"))))
    html = F.concat(F.lit("<script>var rootClone = "), state, F.lit("; downloadMediaUrls = "), media, F.lit("; x = {AgendaTree: "), agenda, F.lit(", Speakers: "), people, F.lit("};</script>"))
    event = F.to_json(F.struct(F.col("id").alias("Id"), F.col("title").alias("Title")))
    got = pages.detail_records(f.select(event.alias("event"), html.alias("html")), "event", "html")
    return got.select("content_id", "title", "event_type", "video_url", "duration_seconds", F.get("agenda", F.lit(0))["text"].alias("item"), F.get("speakers", F.lit(0))["name"].alias("speaker"))


@query(f"""WITH {FILES_SQL} SELECT CAST(id AS VARCHAR) AS clip_id, date AS day, CAST(id % 3600 + 1 AS BIGINT) AS duration_s, CASE WHEN id % 2 = 0 THEN 'https://m.example/' || id || '.mp4' END AS video_url, CASE WHEN id % 2 = 1 THEN 'https://d.example/' || id || '.mp4' ELSE 'https://m.example/a/' || id END AS detail_url, 'text ' || id AS description FROM f""")
def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    f, i = files(spark, sf), F.col("id").cast("string")
    s = F.col("id") % 3600 + 1
    day = F.when(F.col("id") % 2 == 0, F.concat(F.lit("<span>"), (F.unix_date("date").cast("long") * 86400 + 3600).cast("string"), F.lit("</span> x"))).otherwise(F.date_format("date", "MMMM d, yyyy"))
    mp4 = F.when(F.col("id") % 2 == 0, F.concat(F.lit("<a href='https://m.example/"), i, F.lit(".mp4'>mp4</a>"))).otherwise("")
    html = F.concat(F.lit("<table id='archive'><tr><th>h</th></tr><tr><td><a href='/p?clip_id="), i, F.lit("'>A body</a></td><td>"), day, F.lit("</td><td>"), F.format_string("%dh %dm %ds", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60), F.lit("</td><td>"), mp4, F.lit("</td></tr></table>"))
    page = F.when(F.col("id") % 2 == 1, F.concat(F.lit("<script>downloadLinks = [[\"https:\\/\\/d.example\\/"), i, F.lit(".mp4\"]];</script>"))).otherwise(F.concat(F.lit("{\"VideoUrl\":\"https:\\/\\/m.example\\/a\\/"), i, F.lit("\"}")))
    page = F.concat(page, F.lit("<meta name=\"description\" content=\"text "), i, F.lit("\">"))
    rows = pages.listing_rows(f.select(F.struct("id", page.alias("page")).alias("k"), html.alias("h")).select(F.to_json("k").alias("k"), "h"), "k", "h")
    p = F.get_json_object("k", "$.page")
    return rows.select("clip_id", "day", F.col("duration_s").cast("long").alias("duration_s"), "video_url", pages.video_link(p).alias("detail_url"), pages.meta_content(p, "description").alias("description"))


@query(f"""WITH {FILES_SQL} SELECT id, concat('WEBVTT', chr(10), chr(10), '00:00:00.000 --> 00:00:02.000', chr(10), 'first', chr(10), chr(10), '00:00:02.500 --> 00:00:03.250', chr(10), 'no. ', id, chr(10)) AS text FROM f""")
def caption_feeds(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf)
    e = lambda b, x, t: F.struct(F.lit(b).alias("Begin"), F.lit(x).alias("End"), t.alias("Content"))
    arr = F.array(e(None, "2024-01-01T00:00:01", F.lit("no time")), e("2024-01-01T10:00:05", "2024-01-01T10:00:07", F.lit("first")), e("2024-01-01T10:00:07.500", "2024-01-01T10:00:08.250", F.concat(F.lit("no. "), F.col("id").cast("string"))))
    j = F.when(F.col("id") % 2 == 0, F.to_json(arr)).otherwise(F.to_json(F.struct(arr.alias("en"))))
    return feeds.feed_webvtt(f.select("id", j.alias("j")), "id", "j")


@query("""WITH y AS (SELECT DISTINCT ON (id) id, snippet.title AS t FROM youtube_videos ORDER BY id, fetched_at DESC, t), s AS (SELECT id, row_number() OVER (ORDER BY id DESC) AS pos FROM y) SELECT s.pos, y.id, y.t AS title FROM s JOIN y ON y.id = s.id WHERE pos <= 50""")
def listed_videos(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 last ids as a search would list them, with their latest details."""
    y = videos(spark, sf)
    d = y.groupBy("id").agg(F.max_by("t", F.struct("fetched_at")).alias("a"), F.max("fetched_at").alias("f"))
    d = d.join(y.withColumnRenamed("fetched_at", "g"), "id").where("f = g").groupBy("id").agg(F.min("t").alias("title"))
    last = y.select("id").distinct().orderBy(F.desc("id")).limit(50).agg(F.collect_list("id").alias("l")).select(F.posexplode(F.reverse(F.array_sort("l"))).alias("p", "id"))
    return feeds.listed_videos(last.select((F.col("p") + 1).cast("long").alias("pos"), "id"), d).select("pos", "id", "title")


@query(f"""WITH {FILES_SQL}, o AS (SELECT DISTINCT file_id FROM video_index WHERE type = 'bill'), s AS ({STAGE_SQL}) SELECT 'pending_' || stage AS name, count(*) AS n FROM s GROUP BY stage UNION ALL SELECT 'archived', count(CASE WHEN path LIKE '%archive.org%' THEN 1 END) FROM f UNION ALL SELECT 'no_title', count(CASE WHEN coalesce(title, '') = '' THEN 1 END) FROM f
UNION ALL SELECT 'no_date', count(CASE WHEN date IS NULL THEN 1 END) FROM f UNION ALL SELECT 'no_length', count(CASE WHEN coalesce(length, '') = '' THEN 1 END) FROM f UNION ALL SELECT 'no_chamber', count(CASE WHEN coalesce(chamber, '') = '' THEN 1 END) FROM f UNION ALL SELECT 'no_size', count(CASE WHEN width IS NULL OR height IS NULL THEN 1 END) FROM f""")
def status_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of what each stage still has to do and of what the catalog lacks."""
    args = [table(spark, sf, t) for t in ("files", "video_index", "video_transcript")]
    stages = None
    for s in quality.stage_predicates():
        one = quality.pending(*args, s)
        stages = one if stages is None else stages.unionByName(one)
    empty = lambda c: F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "")
    one = files(spark, sf).agg(F.count_if(F.col("path").contains("archive.org")).alias("archived"), empty("title").alias("no_title"), empty("date").alias("no_date"), empty("length").alias("no_length"), empty("chamber").alias("no_chamber"), F.count_if(F.col("width").isNull() | F.col("height").isNull()).alias("no_size"))
    return stages.groupBy(F.concat(F.lit("pending_"), "stage").alias("name")).agg(F.count("*").alias("n")).unionByName(one.unpivot([], one.columns, "name", "n"))


@query()
def people_match(spark: SparkSession, sf: str) -> DataFrame:
    """Captions by the likest name of the list, each spelling looked up once."""
    o = observations(spark, sf).where("type = 'legislator' AND coalesce(ignored, 'n') <> 'y'").select("id", text.speaker_name(F.col("raw_text")).alias("label"))
    return committees.match_people(o, table(spark, sf, "people")).select("id", "person_id")
