"""Queries of the core operators, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import bills, similarity, text, times
from rostrum.operators import bitemporal, clips, committees, context, ingest, quality, resolve
from rostrum.session import table
from rostrum.sources import captions, feeds, pages
from rostrum.streaming import clips as stream_clips

TODAY = "2026-01-01"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "clip_reduction"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# Each row once, with second and frame; shared by several queries and their SQL.
OBS_SQL = """WITH o AS (SELECT DISTINCT ON (id) id, file_id, type, linked_id, raw_text, ignored, time,
  CAST(screenshot AS BIGINT) AS frame, CAST(screenshot AS BIGINT) - 1 AS t FROM video_index)"""
FILES_SQL = "f AS (SELECT DISTINCT ON (id) * FROM files)"


def observations(spark: SparkSession, sf: str) -> DataFrame:
    frame = F.col("screenshot").try_cast("long")
    return table(spark, sf, "video_index").dropDuplicates(["id"]).withColumns({"frame": frame, "t": frame - 1})


def files(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "files").dropDuplicates(["id"])


@query("""
WITH s AS (SELECT DISTINCT v.file_id, v.linked_id AS person_id, f.date AS d
           FROM video_index v LEFT JOIN (SELECT id, min(date) AS date FROM files GROUP BY id) f ON f.id = v.file_id
           WHERE v.type = 'legislator' AND v.linked_id IS NOT NULL AND coalesce(v.ignored, 'n') <> 'y' AND v.file_id IS NOT NULL),
t AS (SELECT s.file_id, s.person_id, t.id, t.date_ended,
             row_number() OVER (PARTITION BY s.file_id, s.person_id ORDER BY t.date_started DESC, t.date_created DESC, t.id DESC) AS r, s.d
      FROM s JOIN terms t ON t.person_id = s.person_id AND CAST(t.date_created AS DATE) <= s.d AND t.date_started <= s.d),
e AS (SELECT s.file_id, s.person_id, e.id, e.date_ended,
             row_number() OVER (PARTITION BY s.file_id, s.person_id ORDER BY e.date_started DESC, e.id DESC) AS r
      FROM s JOIN sessions e ON e.date_started <= s.d)
SELECT s.file_id, s.person_id,
       CAST(CASE WHEN t.id IS NOT NULL AND (t.date_ended IS NULL OR t.date_ended >= s.d) THEN t.id ELSE 0 END AS INT) AS term_id,
       CAST(CASE WHEN e.id IS NOT NULL AND (e.date_ended IS NULL OR e.date_ended >= s.d) THEN e.id ELSE 0 END AS INT) AS session_id
FROM s LEFT JOIN t ON t.file_id = s.file_id AND t.person_id = s.person_id AND t.r = 1
       LEFT JOIN e ON e.file_id = s.file_id AND e.person_id = s.person_id AND e.r = 1""")
def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return bitemporal.members_in_force(*(table(spark, sf, t) for t in ("video_index", "files", "terms", "sessions")))


# -- clips and sequences -----------------------------------------------------------------


def _clip_sql(keys: str) -> str:
    return f"""{OBS_SQL}, m AS (SELECT *, CASE WHEN t - lag(t) OVER w <= 30 THEN 0 ELSE 1 END AS b FROM o
  WHERE linked_id IS NOT NULL AND coalesce(ignored, 'n') <> 'y' WINDOW w AS (PARTITION BY {keys} ORDER BY t, id)),
c AS (SELECT *, sum(b) OVER (PARTITION BY {keys} ORDER BY t, id) AS k FROM m),
g AS (SELECT {keys}, k, greatest(0, min(t) - 10) AS a, max(t) + 10 AS e, count(*) AS n_rows, arg_min(id, t * 100000000 + id) AS first FROM c GROUP BY {keys}, k)
SELECT {keys}, CAST(CASE WHEN e - a <= 20 THEN greatest(0, trunc((a + e) / 2.0 - 15)) ELSE a END AS BIGINT) AS start_s,
  CAST(CASE WHEN e - a <= 20 THEN trunc((a + e) / 2.0 + 15) ELSE e END AS BIGINT) AS end_s, n_rows, first FROM g"""


def _shown(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).where("linked_id IS NOT NULL AND coalesce(ignored, 'n') <> 'y'")


@query(_clip_sql("file_id, type, linked_id"))
def clip_reduction(spark: SparkSession, sf: str) -> DataFrame:
    return clips.reduce_to_clips(_shown(spark, sf), ["file_id", "type", "linked_id"], "t", "id")


@query(f"""SELECT x.type, x.linked_id, f.chamber, x.n_clips, x.seconds FROM (SELECT type, linked_id, min(file_id) AS first_file, count(*) AS n_clips, CAST(sum(end_s - start_s) AS BIGINT) AS seconds
  FROM ({_clip_sql("file_id, type, linked_id")}) GROUP BY type, linked_id) x JOIN (SELECT DISTINCT ON (id) id, chamber FROM files) f ON f.id = x.first_file""")
def clips_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    c = clip_reduction(spark, sf).groupBy("type", "linked_id").agg(F.min("file_id").alias("first_file"), F.count("*").alias("n_clips"), F.sum(F.col("end_s") - F.col("start_s")).alias("seconds"))
    return c.join(files(spark, sf).select("id", "chamber"), F.col("id") == F.col("first_file")).select("type", "linked_id", "chamber", "n_clips", "seconds")


@query(f"""{OBS_SQL}, r AS (SELECT file_id, t, id, lower(trim(regexp_replace(raw_text, '\\s+', ' ', 'g'))) AS value FROM o WHERE type = 'legislator' AND coalesce(ignored, 'n') <> 'y' AND raw_text IS NOT NULL),
m AS (SELECT *, CASE WHEN value = lag(value) OVER (PARTITION BY file_id ORDER BY t, id) THEN 0 ELSE 1 END AS b FROM r),
c AS (SELECT *, sum(b) OVER (PARTITION BY file_id ORDER BY t, id) AS k FROM m)
SELECT file_id, min(value) AS value, min(t) AS start_s, max(t) AS end_s, count(*) AS n_rows FROM c GROUP BY file_id, k HAVING max(t) - min(t) + 1 >= 3""")
def run_segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations(spark, sf).where("type = 'legislator' AND coalesce(ignored, 'n') <> 'y'")
    return clips.run_segments(rows, ["file_id"], "t", "id", F.lower(F.trim(F.regexp_replace("raw_text", r"\s+", " "))))


@query(f"""{OBS_SQL}, p AS (SELECT * FROM o WHERE type = 'legislator' AND coalesce(ignored, 'n') <> 'y')
SELECT p.file_id, p.id, (SELECT arg_min(q.id, (abs(q.t - p.t), q.t, q.id)) FROM o q WHERE q.file_id = p.file_id AND q.type = 'bill' AND coalesce(q.ignored, 'n') <> 'y') AS item FROM p""")
def nearest_item(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("coalesce(ignored, 'n') <> 'y'")
    return clips.nearest(o.where("type = 'legislator'"), o.where("type = 'bill'"), "file_id", "t", "id", "id")


@query(f"""{OBS_SQL} SELECT p.id, count(q.id) AS n_rows, count(CASE WHEN q.linked_id = p.linked_id THEN 1 END) AS same
FROM (SELECT * FROM o WHERE type = 'legislator') p LEFT JOIN o q ON q.file_id = p.file_id AND q.frame BETWEEN greatest(0, p.frame - 5) AND p.frame + 5 AND q.frame <> p.frame GROUP BY p.id""")
def temporal_context(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf)
    return context.neighbours(o.where("type = 'legislator'"), o, 5)


def _consensus_sql(kind: str, reach: int, least: int) -> str:
    return f"""{OBS_SQL}, v AS (SELECT p.id, q.linked_id, count(*) AS votes, min(q.frame * 100000000 + q.id) AS seen FROM o p JOIN o q ON q.file_id = p.file_id AND q.frame BETWEEN greatest(0, p.frame - {reach}) AND p.frame + {reach}
  AND q.frame <> p.frame AND q.linked_id IS NOT NULL WHERE p.type = '{kind}' AND p.linked_id IS NULL GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, seen) AS r FROM v)
SELECT id, linked_id, votes FROM b WHERE r = 1 AND votes >= {least}"""


@query(_consensus_sql("legislator", 5, 3))
def context_consensus(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf)
    return context.consensus(o.where("type = 'legislator' AND linked_id IS NULL"), o, 5, 3)


@query(_consensus_sql("bill", 10, 5))
def bill_consensus(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf)
    return context.consensus(o.where("type = 'bill' AND linked_id IS NULL"), o, 10, 5)


MAJORITY_SQL = f"""{OBS_SQL}, c AS (SELECT raw_text, type, linked_id, count(*) AS votes FROM o WHERE linked_id IS NOT NULL AND coalesce(ignored, 'n') <> 'y' GROUP BY ALL),
m AS (SELECT *, sum(votes) OVER (PARTITION BY raw_text, type) AS total, row_number() OVER (PARTITION BY raw_text, type ORDER BY votes DESC, linked_id) AS r FROM c)
SELECT raw_text, type, linked_id, votes, CAST(total AS BIGINT) AS total FROM m WHERE r = 1 AND total >= 3 AND votes >= 0.8 * total"""


@query(MAJORITY_SQL)
def historical_majority(spark: SparkSession, sf: str) -> DataFrame:
    return context.majority(_shown(spark, sf), ["raw_text", "type"], "linked_id")


@query(f"""WITH h AS ({MAJORITY_SQL}) SELECT h.raw_text, h.linked_id, e.id AS session_id FROM h JOIN sessions e ON EXISTS (SELECT 1 FROM terms t
  WHERE t.person_id = h.linked_id AND t.date_started <= e.date_started AND (t.date_ended IS NULL OR t.date_ended >= e.date_started)) WHERE h.type = 'legislator'""")
def majority_in_office(spark: SparkSession, sf: str) -> DataFrame:
    h = historical_majority(spark, sf).where("type = 'legislator'").select("raw_text", "linked_id")
    e = table(spark, sf, "sessions").select(F.col("id").alias("session_id"), F.col("date_started").alias("e0"))
    t = table(spark, sf, "terms").join(F.broadcast(e), (F.col("date_started") <= F.col("e0")) & (F.col("date_ended").isNull() | (F.col("date_ended") >= F.col("e0"))))  # fixed tables
    return h.join(t.select("person_id", "session_id").distinct(), F.col("person_id") == F.col("linked_id")).select("raw_text", "linked_id", "session_id")


@query(f"""WITH {FILES_SQL}, j AS (SELECT f.id, s.id AS session_id, row_number() OVER (PARTITION BY f.id ORDER BY s.date_started DESC, s.id DESC) AS r FROM f JOIN sessions s
  ON f.date >= s.date_started AND (s.date_ended IS NULL OR f.date <= s.date_ended)) SELECT f.id, j.session_id FROM f LEFT JOIN j ON j.id = f.id AND j.r = 1""")
def session_asof(spark: SparkSession, sf: str) -> DataFrame:
    return context.latest_start(files(spark, sf).select("id", "date"), table(spark, sf, "sessions"), "id", "date", "id", "date_started", "date_ended", "session_id").select("id", "session_id")


@query(f"""SELECT DISTINCT s.id AS session_id, p.id AS person_id, t.party, t.district_id FROM people p JOIN terms t ON t.person_id = p.id JOIN sessions s
  ON t.date_started <= coalesce(s.date_ended, DATE '{TODAY}') AND (t.date_ended IS NULL OR t.date_ended >= s.date_started)""")
def interval_overlap(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "sessions").select(F.col("id").alias("session_id"), F.col("date_started").alias("a"), F.coalesce("date_ended", F.lit(TODAY).cast("date")).alias("b"))
    t = table(spark, sf, "terms").select("person_id", "party", "district_id", "date_started", "date_ended")
    members = t.join(table(spark, sf, "people").select(F.col("id").alias("p")), F.col("p") == F.col("person_id"), "left_semi")
    return members.join(F.broadcast(s), (F.col("date_started") <= F.col("b")) & (F.col("date_ended").isNull() | (F.col("date_ended") >= F.col("a")))).select("session_id", "person_id", "party", "district_id").distinct()  # fixed table


# -- eligibility, quality, dedup ---------------------------------------------------------


STAGE_SQL = """WITH {files}, h AS (SELECT *, coalesce(path LIKE '/video/%', false) AS held, coalesce(capture_directory, '') AS dir, coalesce(date >= DATE '2020-01-01', false) AS recent FROM f)
SELECT 'download' AS stage, id, date FROM h WHERE NOT held AND coalesce(html, '') = '' UNION ALL
SELECT 'screenshots', id, date FROM h WHERE held AND (dir = '' OR capture_rate IS NULL) UNION ALL
SELECT 'transcripts', id, date FROM h WHERE held AND NOT EXISTS (SELECT 1 FROM video_transcript t WHERE t.file_id = h.id) UNION ALL
SELECT 'bills', id, date FROM h WHERE dir NOT IN ('', '/pending') AND recent AND NOT EXISTS (SELECT 1 FROM video_index v WHERE v.file_id = h.id AND v.type = 'bill') UNION ALL
SELECT 'speakers', id, date FROM h WHERE held AND recent AND dir <> '/pending' AND NOT EXISTS (SELECT 1 FROM video_index v WHERE v.file_id = h.id AND v.type = 'legislator') UNION ALL
SELECT 'archive', id, date FROM h WHERE held AND (coalesce(webvtt, '') <> '' OR coalesce(transcript, '') <> '') AND dir NOT IN ('', '/pending') UNION ALL
SELECT 'classify', id, date FROM h WHERE lower(chamber) = 'house' AND dir NOT IN ('', '/pending') AND recent AND NOT contains(coalesce(video_index_cache, ''), 'classification_verified')""".replace("{files}", FILES_SQL)


@query(STAGE_SQL)
def pending_stages(spark: SparkSession, sf: str) -> DataFrame:
    args = [table(spark, sf, t) for t in ("files", "video_index", "video_transcript")]
    return reduce(DataFrame.unionByName, (quality.pending(*args, s) for s in quality.stage_predicates()))


@query(f"SELECT stage, id, date FROM ({STAGE_SQL}) WHERE stage = 'transcripts' ORDER BY date DESC, id DESC LIMIT 5")
def queue_topn(spark: SparkSession, sf: str) -> DataFrame:
    return quality.pending(*(table(spark, sf, t) for t in ("files", "video_index", "video_transcript")), "transcripts").orderBy(F.desc("date"), F.desc("id")).limit(5)


ISSUE_SQL = f"""WITH {FILES_SQL}, t AS (SELECT file_id, count(*) AS n, count(CASE WHEN text IS NULL OR text = '' THEN 1 END) AS blank, count(CASE WHEN time_start IS NULL OR time_end IS NULL THEN 1 END) AS untimed FROM video_transcript GROUP BY file_id),
v AS (SELECT file_id, count(*) AS n, count(CASE WHEN linked_id IS NULL AND coalesce(raw_text, '') <> '' AND coalesce(ignored, 'n') <> 'y' THEN 1 END) AS open FROM video_index GROUP BY file_id),
j AS (SELECT f.id AS file_id, f.chamber, coalesce(f.capture_directory, '') AS d, f.webvtt, f.transcript, coalesce(t.n, 0) AS seg, coalesce(blank, 0) AS blank, coalesce(untimed, 0) AS untimed, coalesce(v.n, 0) AS obs, coalesce(open, 0) AS open
  FROM f LEFT JOIN t ON t.file_id = f.id LEFT JOIN v ON v.file_id = f.id)
SELECT file_id, 'warning' AS level, 'MISSING_CAPTIONS' AS code FROM j WHERE coalesce(webvtt, '') = '' AND coalesce(transcript, '') = '' UNION ALL
SELECT file_id, 'warning', 'NO_TRANSCRIPT_SEGMENTS' FROM j WHERE seg = 0 UNION ALL
SELECT file_id, 'warning', 'EMPTY_TRANSCRIPT_TEXT' FROM j WHERE blank > 0 UNION ALL
SELECT file_id, 'error', 'NULL_TRANSCRIPT_TIMES' FROM j WHERE untimed > 0 UNION ALL
SELECT file_id, 'info', 'NO_VIDEO_INDEX' FROM j WHERE obs = 0 UNION ALL
SELECT file_id, 'warning', 'UNRESOLVED_RAW_TEXT' FROM j WHERE open > 0 UNION ALL
SELECT file_id, 'info', 'NO_CAPTURE_DIRECTORY' FROM j WHERE d = '' UNION ALL
SELECT file_id, 'error', 'ABSOLUTE_CAPTURE_DIRECTORY' FROM j WHERE d LIKE 'http://%' OR d LIKE 'https://%' UNION ALL
SELECT file_id, 'error', 'BAD_CAPTURE_DIRECTORY_PREFIX' FROM j WHERE d LIKE '/screenshots/%' OR d LIKE '/video/%' UNION ALL
SELECT file_id, 'error', 'MISSING_CHAMBER' FROM j WHERE coalesce(chamber, '') = '' UNION ALL
SELECT file_id, 'error', 'INVALID_CHAMBER' FROM j WHERE coalesce(chamber, '') <> '' AND chamber NOT IN ('house', 'senate')"""


@query(ISSUE_SQL)
def contract_issues(spark: SparkSession, sf: str) -> DataFrame:
    return quality.contract_issues(*(table(spark, sf, t) for t in ("files", "video_index", "video_transcript")))


@query(f"SELECT level, code, count(*) AS n FROM ({ISSUE_SQL}) WHERE level IN ('warning', 'error') GROUP BY level, code")
def issue_levels(spark: SparkSession, sf: str) -> DataFrame:
    return quality.at_least(contract_issues(spark, sf), "warning").groupBy("level", "code").agg(F.count("*").alias("n"))


@query(f"""{OBS_SQL} SELECT coalesce(type, 'all') AS type, count(*) AS total, count(linked_id) AS resolved, count(*) - count(linked_id) AS open, count(DISTINCT frame) AS frames FROM o GROUP BY ROLLUP(type)""")
def resolution_stats(spark: SparkSession, sf: str) -> DataFrame:
    got = observations(spark, sf).rollup("type").agg(F.count("*").alias("total"), F.count("linked_id").alias("resolved"), F.countDistinct("frame").alias("frames"))
    return got.select(F.coalesce("type", F.lit("all")).alias("type"), "total", "resolved", (F.col("total") - F.col("resolved")).alias("open"), "frames")


@query(f"""WITH {FILES_SQL} SELECT 'total' AS name, count(*) AS n FROM f UNION ALL SELECT 'held', count(CASE WHEN path LIKE '/video/%' THEN 1 END) FROM f UNION ALL
SELECT 'captured', count(CASE WHEN coalesce(capture_directory, '') NOT IN ('', '/pending') THEN 1 END) FROM f UNION ALL SELECT 'floor', count(CASE WHEN committee_id IS NULL THEN 1 END) FROM f UNION ALL
SELECT 'unresolved', count(CASE WHEN committee_id = 0 THEN 1 END) FROM f""")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    one = files(spark, sf).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("path").startswith("/video/")).alias("held"),
        F.count_if(~F.coalesce("capture_directory", F.lit("")).isin("", "/pending")).alias("captured"),
        F.count_if(F.col("committee_id").isNull()).alias("floor"),
        F.count_if(F.col("committee_id") == 0).alias("unresolved"),
    )
    return one.unpivot([], ["total", "held", "captured", "floor", "unresolved"], "name", "n")


@query(f"WITH {FILES_SQL} SELECT lower(chamber) AS chamber, date, committee_id, count(*) AS n, count(*) - 1 AS surplus FROM f GROUP BY ALL HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return files(spark, sf).groupBy(F.lower("chamber").alias("chamber"), "date", "committee_id").agg(F.count("*").alias("n"), (F.count("*") - 1).alias("surplus")).where("n > 1")


@query(f"""WITH {FILES_SQL}, t AS (SELECT file_id, count(*) AS n FROM video_transcript GROUP BY file_id), v AS (SELECT file_id, count(*) AS n FROM video_index GROUP BY file_id),
s AS (SELECT f.*, CASE WHEN f.path LIKE '/video/%' THEN 10 ELSE 0 END + CASE WHEN coalesce(f.capture_directory, '') <> '' THEN 5 ELSE 0 END + CASE WHEN coalesce(f.length, '') <> '' THEN 2 ELSE 0 END
  + CASE WHEN width IS NOT NULL AND height IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN coalesce(f.transcript, '') <> '' OR coalesce(f.webvtt, '') <> '' THEN 3 ELSE 0 END + coalesce(t.n, 0) + coalesce(v.n, 0) AS score
  FROM f LEFT JOIN t ON t.file_id = f.id LEFT JOIN v ON v.file_id = f.id),
r AS (SELECT *, row_number() OVER (PARTITION BY lower(chamber), date, committee_id ORDER BY score DESC, date_modified DESC NULLS LAST, id) AS r FROM s WHERE committee_id > 0)
SELECT id, CAST(score AS BIGINT) AS score FROM r WHERE r = 1""")
def duplicate_survivor(spark: SparkSession, sf: str) -> DataFrame:
    scored = quality.completeness(*(table(spark, sf, t) for t in ("files", "video_index", "video_transcript"))).where("committee_id > 0").withColumn("_c", F.lower("chamber"))
    return context.survivors(scored, ["_c", "date", "committee_id"], [F.desc("score"), F.desc_nulls_last("date_modified"), "id"]).select("id", F.col("score").cast("long").alias("score"))


@query(f"""WITH {FILES_SQL}, k AS (SELECT DISTINCT lower(chamber) AS c, date AS d, length AS l FROM f WHERE path LIKE '/video/%' AND regexp_matches(length, '^\\d+:\\d+:\\d+$'))
SELECT id FROM f WHERE NOT coalesce(path LIKE '/video/%', false) AND NOT EXISTS (SELECT 1 FROM k WHERE k.c = lower(f.chamber) AND k.d = f.date AND k.l = f.length)""")
def missing_videos(spark: SparkSession, sf: str) -> DataFrame:
    f, held = files(spark, sf), F.coalesce(F.col("path").startswith("/video/"), F.lit(False))
    key = [F.lower("chamber").alias("c"), F.col("date").alias("d"), F.col("length").alias("l")]
    there = f.where(held & F.col("length").rlike(r"^\d+:\d+:\d+$")).select(*key).distinct()
    return f.where(~held).select("id", *key).join(there, ["c", "d", "l"], "left_anti").select("id")


@query(f"""WITH {FILES_SQL} SELECT f.id, c.name AS committee, CASE WHEN c.id IS NULL THEN NULL WHEN c.parent_id IS NULL THEN 'committee' ELSE 'subcommittee' END AS kind
FROM f LEFT JOIN committees c ON c.id = f.committee_id""")
def file_committees(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "committees").select(F.col("id").alias("cid"), F.col("name").alias("committee"), F.when(F.col("parent_id").isNull(), "committee").otherwise("subcommittee").alias("kind"))
    return files(spark, sf).select("id", "committee_id").join(F.broadcast(c), F.col("cid") == F.col("committee_id"), "left").select("id", "committee", "kind")  # fixed table


@query("""WITH f AS (SELECT DISTINCT ON (id) id, path, title FROM files), a AS (SELECT id, path, title FROM f WHERE id % 3 <> 0), b AS (SELECT id, path, upper(title) AS title FROM f WHERE id % 2 = 0)
SELECT id, title FROM b UNION ALL SELECT id, title FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id = a.id)""")
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf).select("id", "title").withColumn("_pos", F.col("id"))
    return ingest.upsert(f.where("id % 3 <> 0"), f.where("id % 2 = 0").withColumn("title", F.upper("title")), F.col("id").cast("string")).select("id", "title")


@query(f"""WITH {FILES_SQL}, k AS (SELECT id, date_created, CASE WHEN committee_id IS NULL THEN concat_ws('|', 'floor', lower(chamber), CAST(date AS VARCHAR), title) WHEN committee_id = 0 THEN concat_ws('|', 'path', path)
  ELSE concat_ws('|', 'committee', lower(chamber), CAST(date AS VARCHAR), CAST(committee_id AS VARCHAR)) END AS key FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY id) AS r FROM k WHERE date_created >= TIMESTAMP '2015-01-01')
SELECT id, key FROM n WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM k WHERE k.date_created < TIMESTAMP '2015-01-01' AND k.key = n.key)""")
def batch_insert(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf).withColumn("key", ingest.import_key(F.lower("chamber"), F.col("date"), F.col("committee_id"), F.col("title"), F.col("path")))
    cut = F.lit("2015-01-01").cast("timestamp_ntz")
    return ingest.insert_absent(f.where(F.col("date_created") < cut), f.where(F.col("date_created") >= cut), "key", ["id"]).select("id", "key")


@query("""WITH f AS (SELECT DISTINCT ON (id) id, raw_metadata AS m FROM files)
SELECT id, TRY_CAST(substr(m ->> '$.scheduled_start', 1, 10) AS DATE) AS day, TRY_CAST(TRY_CAST(m ->> '$.duration_seconds' AS DOUBLE) AS INT) AS duration_s FROM f WHERE m IS NOT NULL""")
def record_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.normalize(files(spark, sf).where("raw_metadata IS NOT NULL"))


@query(f"""{OBS_SQL}, n AS (SELECT DISTINCT ON (id) id AS file_id FROM files), e AS (SELECT n.file_id, x.type FROM n, (VALUES ('bill'), ('legislator')) x(type) WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.file_id = n.file_id AND o.type = x.type))
SELECT file_id, type, count(*) AS n_rows, count(CASE WHEN raw_text = '/none' THEN 1 END) AS n_none FROM (SELECT file_id, type, raw_text FROM o UNION ALL SELECT file_id, type, '/none' FROM e) GROUP BY file_id, type""")
def result_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    jobs = files(spark, sf).select(F.col("id").alias("file_id"), F.explode(F.array(F.lit("bill"), F.lit("legislator"))).alias("type"))
    return ingest.with_sentinels(observations(spark, sf), jobs).groupBy("file_id", "type").agg(F.count("*").alias("n_rows"), F.count_if(F.col("raw_text") == "/none").alias("n_none"))


@query(f"""{OBS_SQL}, x AS (SELECT o.id, o.file_id, o.type, o.raw_text FROM o WHERE NOT (type = 'bill' AND file_id % 2 = 0)) SELECT file_id, type, count(*) AS n FROM (SELECT file_id, type, raw_text FROM x UNION ALL
SELECT DISTINCT file_id, type, 'replaced' FROM o WHERE type = 'bill' AND file_id % 2 = 0) GROUP BY file_id, type""")
def replace_partition(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).select("file_id", "type", "raw_text")
    new = o.where("type = 'bill' AND file_id % 2 = 0").select("file_id", "type").distinct().withColumn("raw_text", F.lit("replaced"))
    return ingest.replace_rows(o, new, ["file_id", "type"]).groupBy("file_id", "type").agg(F.count("*").alias("n"))


@query(f"""WITH {FILES_SQL} SELECT id FROM f WHERE date_modified IS NULL OR date_modified < TIMESTAMP '2016-06-01 09:00:00'""")
def stale_claims(spark: SparkSession, sf: str) -> DataFrame:
    return files(spark, sf).where(ingest.stale_claims(None, "date_modified", F.lit("2016-06-01 12:00:00").cast("timestamp"), 3)).select("id")


@query("""WITH f AS (SELECT DISTINCT ON (id) id, video_index_cache AS c FROM files UNION ALL SELECT DISTINCT ON (id) -id, raw_metadata FROM files)
SELECT id, CAST(json_merge_patch(coalesce(c, '{}')::JSON, '{"event_type":"floor","classification_verified":true}'::JSON) AS VARCHAR) AS patched FROM f""")
def json_patch(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf)
    both = f.select("id", F.col("video_index_cache").alias("c")).unionByName(f.select((-F.col("id")).alias("id"), F.col("raw_metadata").alias("c")))
    return both.select("id", ingest.patch_json(F.col("c"), {"event_type": F.lit('"floor"'), "classification_verified": F.lit("true")}).alias("patched"))


@query(f"""{OBS_SQL} SELECT file_id, count(*) AS n, min(time) AS first FROM o WHERE regexp_matches(time, '^\\d+:\\d+:\\d+$') AND CAST(split_part(time, ':', 1) AS INT) * 3600 + CAST(split_part(time, ':', 2) AS INT) * 60 + CAST(split_part(time, ':', 3) AS INT) >= 18000 GROUP BY file_id""")
def suspicious_times(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).where(F.col("time").rlike(r"^\d+:\d+:\d+$") & (times.seconds(F.col("time")) >= 18000)).groupBy("file_id").agg(F.count("*").alias("n"), F.min("time").alias("first"))


@query(f"""{OBS_SQL} SELECT coalesce(CAST(linked_id AS VARCHAR), 'unresolved') AS entity, type, count(*) AS n, count(DISTINCT file_id) AS files FROM o WHERE coalesce(ignored, 'n') <> 'y' GROUP BY ALL""")
def index_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("coalesce(ignored, 'n') <> 'y'")
    return o.groupBy(F.coalesce(F.col("linked_id").cast("string"), F.lit("unresolved")).alias("entity"), "type").agg(F.count("*").alias("n"), F.countDistinct("file_id").alias("files"))


# -- scalars -----------------------------------------------------------------------------


@query(f"""{OBS_SQL} SELECT id, CASE WHEN len(string_split(time, ':')) = 3 THEN TRY_CAST(string_split(time, ':')[1] AS INT) * 3600 + TRY_CAST(string_split(time, ':')[2] AS INT) * 60 + TRY_CAST(string_split(time, ':')[3] AS INT) ELSE 0 END AS strict_s,
  CASE WHEN time IS NULL THEN NULL ELSE coalesce(TRY_CAST(string_split(time, ':')[1] AS INT), 0) * 3600 + coalesce(TRY_CAST(string_split(time, ':')[2] AS INT), 0) * 60 + coalesce(TRY_CAST(string_split(time, ':')[3] AS INT), 0) END AS padded_s,
  printf('%02d:%02d:%02d', g // 3600, g % 3600 // 60, g % 60) AS clock, printf('%08d', greatest(1, t + 1)) AS frame_name FROM (SELECT *, greatest(0, t) AS g FROM o)""")
def time_parse(spark: SparkSession, sf: str) -> DataFrame:
    o, c = observations(spark, sf), F.col("time")
    return o.select("id", times.seconds(c).alias("strict_s"), F.when(c.isNotNull(), times.seconds_padded(c)).alias("padded_s"), times.clock(F.col("t")).alias("clock"), times.screenshot_number(F.col("t")).alias("frame_name"))


@query("""SELECT id, fetched_at, CASE WHEN regexp_matches(d, '^PT([0-9]+H)?([0-9]+M)?([0-9]+S)?$') AND d <> 'PT' THEN coalesce(TRY_CAST(regexp_extract(d, '([0-9]+)H', 1) AS INT), 0) * 3600 + coalesce(TRY_CAST(regexp_extract(d, '([0-9]+)M', 1) AS INT), 0) * 60
  + coalesce(TRY_CAST(regexp_extract(d, '([0-9]+)S', 1) AS INT), 0) END AS seconds FROM (SELECT id, fetched_at, contentdetails.duration AS d FROM youtube_videos)""")
def iso_duration(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "youtube_videos").select("id", "fetched_at", times.iso_duration(F.col("contentdetails.duration")).alias("seconds"))


@query("""WITH y AS (SELECT id, fetched_at, snippet.title AS s FROM youtube_videos WHERE snippet.title IS NOT NULL) SELECT id, fetched_at, coalesce(
  TRY_CAST(try_strptime(nullif(regexp_extract(s, '((?:January|February|March|April|May|June|July|August|September|October|November|December) [0-9]{1,2}, [0-9]{4})', 1), ''), '%B %-d, %Y') AS DATE),
  TRY_CAST(try_strptime(nullif(regexp_extract(s, '\\b([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})\\b', 1), ''), '%-m/%-d/%Y') AS DATE), TRY_CAST(try_strptime(nullif(regexp_extract(s, '\\b([0-9]{1,2}/[0-9]{1,2}/[0-9]{2})\\b', 1), ''), '%-m/%-d/%y') AS DATE),
  TRY_CAST(nullif(regexp_extract(s, '\\b([0-9]{4}-[0-9]{2}-[0-9]{2})\\b', 1), '') AS DATE)) AS day FROM y""")
def title_date(spark: SparkSession, sf: str) -> DataFrame:
    y = table(spark, sf, "youtube_videos").where("snippet.title IS NOT NULL")
    return y.select("id", "fetched_at", times.title_date(F.col("snippet.title")).alias("day"))


@query("""SELECT id, fetched_at, t = '' OR NOT regexp_matches(lower(t), 'commission|board|authority|jlarc|vrs|civic education|manufacturing development|recurrent flooding|public hearing') OR regexp_matches(lower(t), 'session|floor') AS keep,
CASE WHEN regexp_matches(lower(t), 'sub-?committee|subcmte|\\bsub\\b') THEN 'subcommittee' WHEN regexp_matches(lower(t), '\\b(session|floor|chamber)\\b') THEN 'floor' WHEN contains(lower(t), 'committee') THEN 'committee' ELSE 'floor' END AS event_type
FROM (SELECT id, fetched_at, coalesce(snippet.title, '') AS t FROM youtube_videos)""")
def title_filter(spark: SparkSession, sf: str) -> DataFrame:
    t = F.coalesce("snippet.title", F.lit(""))
    return table(spark, sf, "youtube_videos").select("id", "fetched_at", text.keep_title(t).alias("keep"), text.event_type(t).alias("event_type"))


@query("""WITH p AS (SELECT id, fetched_at, t, list_filter(list_transform(regexp_split_to_array(t, '\\s*-\\s*'), lambda x: trim(x)), lambda x: x <> '') AS l FROM (SELECT id, fetched_at, snippet.title AS t FROM youtube_videos WHERE snippet.title IS NOT NULL)),
q AS (SELECT *, CASE WHEN regexp_matches(l[1], '^[A-Za-z]+\\s+[0-9]{1,2},\\s+[0-9]{4}$') THEN l[2:] ELSE l END AS m FROM p)
SELECT id, fetched_at, coalesce(list_filter(m, lambda x: NOT regexp_matches(lower(x), '\\b[0-9]{1,2}:[0-9]{2}\\s*(am|pm|m)|\\b[0-9]{1,2}:[0-9]{2}\\s*m\\.?') AND NOT contains(lower(x), 'adjournment') AND NOT regexp_matches(lower(x), '^sr\\s+[a-z]\\b|^sr\\s*[0-9]'))[1], trim(t)) AS title FROM q""")
def title_normalize(spark: SparkSession, sf: str) -> DataFrame:
    y = table(spark, sf, "youtube_videos").where("snippet.title IS NOT NULL")
    return y.select("id", "fetched_at", text.normalize_title(F.col("snippet.title")).alias("title"))


@query(f"""WITH {FILES_SQL} SELECT id, concat_ws('/', 'https://video.example.org', trim(d, '/'), '00000102.jpg') AS frame,
CASE WHEN d LIKE 'https://%' THEN regexp_replace(regexp_replace(d, '/+$', ''), '/full$', '') || '/manifest.json' ELSE 'https://video.example.org' || regexp_replace(regexp_replace(regexp_replace(d, '/+$', ''), '/full$', ''), '^/video/', '/') || '/manifest.json' END AS manifest,
concat_ws('/', lower(chamber), CASE WHEN committee_id IS NULL THEN 'floor' ELSE concat('committee/', CAST(committee_id AS VARCHAR)) END, strftime(date, '%Y%m%d')) || '.mp4' AS key
FROM (SELECT *, capture_directory AS d FROM f UNION ALL SELECT *, '/video' || coalesce(capture_directory, '/x/') || 'full/' FROM f UNION ALL SELECT *, 'https://elsewhere.example' || capture_directory FROM f)""")
def media_urls(spark: SparkSession, sf: str) -> DataFrame:
    f, d = files(spark, sf), F.col("capture_directory")
    forms = F.explode(F.array(d, F.concat(F.lit("/video"), F.coalesce(d, F.lit("/x/")), F.lit("full/")), F.concat(F.lit("https://elsewhere.example"), d)))
    f = f.withColumn("d", forms)
    return f.select("id", text.screenshot_url(F.col("d"), F.lit("00000102")).alias("frame"), text.manifest_url(F.col("d")).alias("manifest"), text.storage_key(F.lower("chamber"), F.col("committee_id").cast("string"), F.col("date")).alias("key"))


@query(f"""WITH {FILES_SQL} SELECT id, regexp_replace(substr(concat_ws('-', 'rs', lower(chamber), CAST(date AS VARCHAR), regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')), 1, 80), '-+$', '') AS identifier,
(upper(chamber[1]) || lower(substr(chamber, 2))) || ': ' || title || ', ' || strftime(date, '%B %-d, %Y') AS heading FROM f""")
def archive_metadata(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf)
    return f.select("id", text.archive_identifier(F.col("chamber"), F.col("date"), F.col("title")).alias("identifier"), text.archive_title(F.col("chamber"), F.col("title"), F.col("date")).alias("heading"))


@query(f"""{OBS_SQL} SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') AS tokens FROM (SELECT id, list_transform(regexp_extract_all(upper(raw_text), '\\b([HS]B\\s*[0-9]{{1,4}})\\b', 1), lambda x: regexp_replace(x, '\\s+', '', 'g')) AS l FROM o WHERE raw_text IS NOT NULL)""")
def bill_tokens(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("raw_text IS NOT NULL")
    return o.select("id", F.array_join(bills.tokens(F.col("raw_text")), " ").alias("tokens"))


# the corrections one after the other, then the forms in order, as text of their own
BILL_FIXES = [
    ("\\b[HL1I]\\s*8\\s*([0-9])", "HB \\1"), ("\\b[HL1I]\\s*3\\s*([0-9])", "HB \\1"), ("\\b[HL1I]\\s*E\\s*([0-9])", "HB \\1"), ("\\b[5S]\\s*8\\s*([0-9])", "SB \\1"), ("\\b[5S]\\s*E\\s*([0-9])", "SB \\1"),
    ("\\b[L1I]\\s*H\\s*B\\s*([0-9])", "HB \\1"), ("\\b[L1I]\\s*S\\s*B\\s*([0-9])", "SB \\1"), ("\\b([HS])\\s*J\\s*[8R]\\s*([0-9])", "\\1JR \\2"),
]
BILL_FORMS = [
    ("HB", "HB|H\\.B\\.|House\\s+Bill"), ("SB", "SB|S\\.B\\.|Senate\\s+Bill"), ("HJR", "HJR|HJ|H\\.J\\.R\\.|House\\s+Joint\\s+Resolution"),
    ("SJR", "SJR|SJ|S\\.J\\.R\\.|Senate\\s+Joint\\s+Resolution"), ("HR", "HR|H\\.R\\.|House\\s+Resolution"), ("SR", "SR|S\\.R\\.|Senate\\s+Resolution"),
]


def _bill_sql() -> str:
    t = "raw_text"
    for pattern, to in BILL_FIXES:
        t = f"regexp_replace({t}, '{pattern}', '{to}', 'gi')"
    whens = " ".join(f"WHEN regexp_matches(t, '\\b(?:{form})\\s*[0-9]{{1,4}}\\b', 'i') THEN concat('{short}', CAST(CAST(regexp_extract(t, '\\b(?:{form})\\s*([0-9]{{1,4}})\\b', 1, 'i') AS INT) AS VARCHAR))" for short, form in BILL_FORMS)
    return f"{OBS_SQL} SELECT id, label FROM (SELECT id, CASE {whens} END AS label FROM (SELECT id, {t} AS t FROM o WHERE type = 'bill')) WHERE label IS NOT NULL"


@query(_bill_sql())
def bill_parse(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("type = 'bill'")
    return o.select("id", bills.parse(F.col("raw_text"))["label"].alias("label")).where("label IS NOT NULL")


@query("""WITH n AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS number FROM customer), p AS (SELECT number, unnest(range(1, len(number) + 1)) AS i FROM n),
m AS (SELECT number, i, k, concat(substr(number, 1, i - 1), r, substr(number, i + 1)) AS v FROM p JOIN (VALUES ('0', '8', 1), ('1', '7', 1), ('5', '6', 1), ('8', '0', 1), ('8', '3', 2)) s(d, r, k) ON s.d = substr(number, i, 1))
SELECT number, count(*) + 1 AS n, coalesce(string_agg(v, ' ' ORDER BY i, k), '') AS others FROM (SELECT n.number, m.v, m.i, m.k FROM n JOIN m ON m.number = n.number) GROUP BY number""")
def number_variations(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("number")).distinct()
    v = bills.variations(F.col("number"))
    got = n.select("number", F.size(v).cast("long").alias("n"), F.array_join(F.slice(v, 2, F.size(v)), " ").alias("others"))
    return got.where("n > 1")


@query("""SELECT id, round(CASE WHEN greatest(strlen(a), strlen(b)) = 0 THEN 1.0 ELSE 1 - levenshtein(a, b) / greatest(strlen(a), strlen(b)) END, 4) AS edit, round(len(list_intersect(list_distinct(string_split(a, ' ')), list_distinct(string_split(b, ' ')))) /
  len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' ')))), 4) AS words FROM (SELECT id, lower(name) AS a, lower(name_formal) AS b FROM people WHERE name_formal IS NOT NULL AND name IS NOT NULL)""")
def name_similarity(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "people").where("name_formal IS NOT NULL AND name IS NOT NULL")
    a, b = F.col("name"), F.col("name_formal")
    return p.select("id", F.round(similarity.levenshtein_similarity(a, b), 4).alias("edit"), F.round(similarity.token_set(a, b), 4).alias("words"))


@query()
def jaro_winkler(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "people").where("name_formal IS NOT NULL AND name IS NOT NULL")
    a, b = F.col("name"), F.col("name_formal")
    return p.select("id", similarity.jaro_winkler(a, b).alias("jw"), similarity.combined(a, b).alias("combined"), similarity.similar_text(a, b).alias("similar"), similarity.same_sound(a, b).alias("sound"))


# -- captions and payloads ---------------------------------------------------------------


VTT = "concat(printf('%02d:%02d:%02d', CAST(floor({x}) AS INT) // 3600, CAST(floor({x}) AS INT) % 3600 // 60, CAST(floor({x}) AS INT) % 60), printf('.%03d', CAST(trunc(({x} - floor({x})) * 1000) AS INT)))"


# All segments with their own times.
TIME = r"'^\s*(?:(\d+):)?(\d{1,2}):(\d{1,2})(?:[.,](\d{1,3}))?\s*$'"


def _seconds_sql(c: str) -> str:
    at = lambda i: f"regexp_extract({c}, {TIME}, {i})"
    return f"CASE WHEN regexp_matches({c}, {TIME}) THEN CAST(coalesce(TRY_CAST({at(1)} AS BIGINT), 0) * 3600 + CAST({at(2)} AS BIGINT) * 60 AS DOUBLE) + CAST(concat({at(3)}, '.', {at(4)}, '0') AS DOUBLE) END"


ALL_SQL = f"""WITH s AS (SELECT id, file_id, trim(text) AS text, trim(regexp_replace(text, '<[^>]*>', '', 'g')) AS plain, {_seconds_sql("time_start")} AS a, {_seconds_sql("time_end")} AS b
  FROM (SELECT DISTINCT ON (id) * FROM video_transcript) WHERE trim(text) <> ''), c AS (SELECT * FROM s WHERE a IS NOT NULL AND b IS NOT NULL)"""


def _all_segments(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "video_transcript").dropDuplicates(["id"]).where("trim(text) <> ''")
    return s.select("id", "file_id", "text", times.caption_seconds(F.col("time_start")).alias("a"), times.caption_seconds(F.col("time_end")).alias("b"))


def _cues(spark: SparkSession, sf: str) -> DataFrame:
    return _all_segments(spark, sf).where("a IS NOT NULL AND b IS NOT NULL")


@query(f"{ALL_SQL} SELECT file_id, string_agg(plain, ' ' ORDER BY a NULLS LAST, id) AS text FROM s WHERE plain <> '' GROUP BY file_id")
def transcript_text(spark: SparkSession, sf: str) -> DataFrame:
    s = _all_segments(spark, sf).withColumns({"text": captions.without_markup(F.col("text")), "untimed": F.col("a").isNull()})
    return captions.plain_text(s, "file_id", ["untimed", "a", "id"], "text")


@query(f"{ALL_SQL} SELECT file_id, concat('WEBVTT\n\n', string_agg(concat({VTT.format(x='a')}, ' --> ', {VTT.format(x='b')}, '\n', text), '\n\n' ORDER BY a, id), '\n') AS text FROM c GROUP BY file_id")
def webvtt_write(spark: SparkSession, sf: str) -> DataFrame:
    return captions.write_webvtt(_cues(spark, sf), "file_id", ["a", "id"], "a", "b", "text")


# a written time has its milliseconds cut
CUT = "(floor({x}) + trunc(({x} - floor({x})) * 1000) / 1000)"
ALL_PARSED_SQL = f"{ALL_SQL} SELECT file_id, {CUT.format(x='a')} AS start_s, {CUT.format(x='b')} AS end_s, plain AS text FROM c WHERE plain <> ''"


@query(ALL_PARSED_SQL)
def webvtt_parse(spark: SparkSession, sf: str) -> DataFrame:
    return captions.parse_webvtt(webvtt_write(spark, sf), "file_id", "text").drop("pos")


@query(ALL_PARSED_SQL)
def srt_parse(spark: SparkSession, sf: str) -> DataFrame:
    return captions.parse_srt(captions.write_srt(_cues(spark, sf), "file_id", ["a", "id"], "a", "b", "text"), "file_id", "text").drop("pos")


@query(f"WITH {FILES_SQL} SELECT CAST(CAST(date_trunc('week', date) AS DATE) AS VARCHAR) AS week_start, CAST(id AS BIGINT) AS id, title, committee_id FROM f WHERE date IS NOT NULL")
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf).where("date IS NOT NULL")
    e = F.struct(F.col("id").cast("long").alias("Id"), F.col("title").alias("Title"), F.col("committee_id").alias("CommitteeId"))
    weeks = f.groupBy(F.date_trunc("week", "date").cast("date").cast("string").alias("WeekStart")).agg(F.collect_list(e).alias("ContentEntityDatas"))
    payload = weeks.select(F.to_json(F.struct(F.array(F.struct("WeekStart", "ContentEntityDatas")).alias("Weeks"))).alias("j"))
    return pages.flatten_weeks(payload, "j").select("week_start", F.col("Id").alias("id"), F.col("Title").alias("title"), F.col("CommitteeId").alias("committee_id"))


@query(f"{OBS_SQL} SELECT file_id, count(*) AS n, CAST(sum(t) AS BIGINT) AS total FROM (SELECT DISTINCT file_id, t FROM o WHERE t >= 0) GROUP BY file_id")
def manifest_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("t >= 0").select("file_id", F.col("t").cast("int").alias("timestamp"), F.format_string("%08d.jpg", "frame").alias("full")).distinct()
    j = o.groupBy("file_id").agg(F.to_json(F.collect_list(F.struct("timestamp", "full"))).alias("j"))
    return pages.manifest_rows(j, "file_id", "j").groupBy("file_id").agg(F.count("*").alias("n"), F.sum("timestamp").alias("total"))


@query("""SELECT id, fetched_at, trim(regexp_replace(replace(replace(snippet.title, '&amp;', '&'), '–', '-'), '\\s+', ' ', 'g')) AS cell, concat('/clip/', id) AS link FROM youtube_videos WHERE trim(regexp_replace(snippet.title, '\\s+', ' ', 'g')) <> ''""")
def html_table(spark: SparkSession, sf: str) -> DataFrame:
    y = table(spark, sf, "youtube_videos").where("trim(regexp_replace(snippet.title, '\\\\s+', ' ')) <> ''")
    html = F.concat(F.lit("<table id='archive'><tr><td><a href='/clip/"), "id", F.lit("'>"), F.replace("snippet.title", F.lit("–"), F.lit("-")), F.lit("</a></td></tr></table>"))
    keyed = y.select(F.concat_ws("\x01", "id", F.col("fetched_at").cast("string")).alias("k"), html.alias("h"))
    got = pages.scan_table(keyed, "k", "h")
    return got.select(F.split_part("k", F.lit("\x01"), F.lit(1)).alias("id"), F.split_part("k", F.lit("\x01"), F.lit(2)).cast("timestamp_ntz").alias("fetched_at"), F.get("cells", F.lit(0)).alias("cell"), "link")


@query("""WITH e AS (SELECT user_id, event_id, ts, CASE WHEN epoch(ts) - epoch(lag(ts) OVER w) < 21600 THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
c AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e) SELECT user_id, CAST(min(ts) AS TIMESTAMP) AS start, CAST(max(ts) + INTERVAL 6 HOUR AS TIMESTAMP) AS "end", count(*) AS n_rows FROM c GROUP BY user_id, k""")
def session_clips(spark: SparkSession, sf: str) -> DataFrame:
    return stream_clips.session_clips(table(spark, sf, "events"), "ts", ["user_id"], "6 hours")


# -- resolution --------------------------------------------------------------------------


@query("""WITH a AS (SELECT id, raw_text, regexp_replace(trim(regexp_replace(raw_text, '\\s+', ' ', 'g')), '^(?:sen\\.|del\\.|delegate|senator|vice chair|chair|rep\\.|representative)\\s+', '', 'i') AS t FROM (SELECT DISTINCT ON (id) * FROM video_index) WHERE type = 'legislator' AND raw_text IS NOT NULL),
b AS (SELECT *, trim(regexp_replace(t, '^.*?\\(([A-Za-z][A-Za-z\\s\\-]+)\\)\\s*', '\\1 ')) AS n FROM a),
h AS (SELECT *, string_split(trim(regexp_replace(regexp_replace(n, '\\([RDI][0-9]+\\)', '', 'gi'), '\\s+', ' ', 'g')), ' ') AS w FROM b),
c AS (SELECT *, CASE WHEN regexp_matches(n, '\\([RDI][0-9]+\\)', 'i') AND NOT regexp_matches(n, '\\([RDI]-[0-9]+\\)', 'i') THEN array_to_string(CASE WHEN len(w) > 3 THEN w[:len(w) - 2] ELSE w END, ' ') ELSE n END AS m FROM h)
SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(m, '\\([RDI](?:-?[0-9]+)?\\)|district\\s+[0-9]+|\\s*\\([0-9]+\\)', '', 'gi'), '\\s+of\\s+[A-Z][a-z]+', '', 'gi'), '\\s+-\\s*[A-Z][a-z]+$', '', 'i'), '[,()]+', ' ', 'g'), '\\s+', ' ', 'g')) AS cleaned,
nullif(upper(regexp_extract(raw_text, '\\(([RDI])(?:-?[0-9]+)?\\)', 1, 'i')), '') AS party FROM c""")
def name_extract(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).where("type = 'legislator' AND raw_text IS NOT NULL")
    return o.select("id", resolve.clean_name(F.col("raw_text")).alias("cleaned"), resolve.party(F.col("raw_text")).alias("party"))


@query()
def resolve_members(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve_members(*(table(spark, sf, t) for t in ("video_index", "files", "people", "terms", "sessions")), F.lit(TODAY).cast("date"))


def bill_list(spark: SparkSession, sf: str) -> DataFrame:
    """(id, session_id, chamber, number) of the bills that linked captions name: the reading
    and session most of a bill's captions have."""
    o = observations(spark, sf).where("type = 'bill' AND linked_id IS NOT NULL").select("file_id", "linked_id", bills.parse(F.col("raw_text")).alias("p")).where("p IS NOT NULL")
    d = session_asof(spark, sf).where("session_id IS NOT NULL").select(F.col("id").alias("file_id"), "session_id")
    votes = o.join(d, "file_id").groupBy("linked_id", "session_id", "p.chamber", "p.number").agg(F.count("*").alias("n"))
    best = votes.groupBy("linked_id").agg(F.max(F.struct("n", "session_id", "chamber", "number")).alias("b"))
    return best.select(F.col("linked_id").alias("id"), "b.session_id", "b.chamber", "b.number")


@query()
def resolve_bills(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve_bills(*(table(spark, sf, t) for t in ("video_index", "files", "sessions")), bill_list(spark, sf))


@query()
def resolve_captions(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve_captions(*(table(spark, sf, t) for t in ("video_index", "files", "people", "terms", "sessions")), bill_list(spark, sf), F.lit(TODAY).cast("date"))


@query()
def committee_match(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf).where("title IS NOT NULL")
    label = text.normalize_title(F.regexp_replace("title", r"(?i)^(house|senate)\s+", ""))
    return committees.match_committees(f.select("id", label.alias("label"), "chamber", F.when(label.contains(":"), "subcommittee").otherwise("committee").alias("kind")), table(spark, sf, "committees"))


@query(f"""WITH {FILES_SQL} SELECT p.p_brand, p.p_name AS picked FROM (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_name DESC) AS r FROM part) p WHERE r = 1""")
def media_pick(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_brand", F.concat("p_name", F.lit(".mp4")).alias("name"), "p_size", F.lit("none").alias("want"))
    return committees.largest_media(p, "p_brand", "name", "p_size", "want").select("p_brand", F.regexp_replace("picked", r"\.mp4$", "").alias("picked"))


@query()
def decay_sample(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf).select("id", F.datediff(F.lit(TODAY).cast("date"), "date").alias("age"))
    return committees.decay_sample(f, "id", "age", "run-1")


@query(f"""WITH {FILES_SQL}, p AS (SELECT t.file_id, arg_min(t.id, (t.time_start, t.id)) AS first_segment, count(*) AS n FROM (SELECT DISTINCT ON (id) * FROM video_transcript) t GROUP BY t.file_id)
SELECT f.id, p.first_segment, coalesce(p.n, 0) AS n_segments FROM f LEFT JOIN p ON p.file_id = f.id""")
def transcript_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "video_transcript").dropDuplicates(["id"]).groupBy("file_id").agg(F.min_by("id", F.struct("time_start", "id")).alias("first_segment"), F.count("*").alias("n"))
    return files(spark, sf).select("id").join(t, F.col("id") == F.col("file_id"), "left").select("id", "first_segment", F.coalesce("n", F.lit(0)).alias("n_segments"))


@query(f"""WITH {FILES_SQL} SELECT id, 'Delegate Speaker ' || CAST(id AS VARCHAR) AS raw, 'Speaker ' || CAST(id AS VARCHAR) AS name, CAST(0 AS DOUBLE) AS seconds FROM f UNION ALL
SELECT id, 'Senator Other', 'Other', CAST(id % 600 AS DOUBLE) FROM f""")
def speaker_feed(spark: SparkSession, sf: str) -> DataFrame:
    f = files(spark, sf)
    entry = lambda n, s: F.struct(n.alias("name"), times.clock(s).alias("startTime"))
    j = F.to_json(F.struct(F.array(entry(F.concat(F.lit("Delegate Speaker "), F.col("id").cast("string")), F.lit(60)), entry(F.lit("Senator Other"), F.col("id") % 600 + 60)).alias("Speakers")))
    got = feeds.speaker_rows(f.select("id", j.alias("j")), "id", "j")
    raw = F.when(F.col("pos") == 0, F.concat(F.lit("Delegate Speaker "), F.col("id").cast("string"))).otherwise("Senator Other")
    return got.select("id", raw.alias("raw"), "name", "seconds")
