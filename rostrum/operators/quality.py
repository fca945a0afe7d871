"""Stage eligibility, contract validation and catalog counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANK = {"info": 0, "warning": 1, "error": 2}
PLACE = "/video/"


def stage_predicates() -> dict:
    """stage -> (condition on files, table and type that must have no rows for the file)."""
    c = F.col
    empty = lambda x: c(x).isNull() | (c(x) == "")
    held = c("path").startswith(PLACE)
    recent = c("date") >= F.lit("2020-01-01").cast("date")
    captured = ~empty("capture_directory") & (c("capture_directory") != "/pending")
    return {
        "download": ((empty("path") | ~held) & empty("html"), None),
        "screenshots": (held & (empty("capture_directory") | c("capture_rate").isNull()), None),
        "transcripts": (held, "transcript"),
        "bills": (captured & recent, "bill"),
        "speakers": (held & recent & (F.coalesce("capture_directory", F.lit("")) != "/pending"), "legislator"),
        "archive": (held & (~empty("webvtt") | ~empty("transcript")) & captured, None),
        "classify": ((F.lower("chamber") == "house") & captured & recent & ~F.coalesce("video_index_cache", F.lit("")).contains("classification_verified"), None),
    }


def pending(files: DataFrame, video_index: DataFrame, transcript: DataFrame, stage: str) -> DataFrame:
    """(stage, id, date) of the files a stage still has to work on."""
    condition, lacks = stage_predicates()[stage]
    todo = files.where(condition).select("id", "date").dropDuplicates(["id"])
    if lacks == "transcript":
        todo = todo.join(transcript.select(F.col("file_id").alias("id")).distinct(), "id", "left_anti")
    elif lacks:
        todo = todo.join(video_index.where(F.col("type") == lacks).select(F.col("file_id").alias("id")).distinct(), "id", "left_anti")
    return todo.select(F.lit(stage).alias("stage"), "id", "date")


def contract_issues(files: DataFrame, video_index: DataFrame, transcript: DataFrame) -> DataFrame:
    """(file_id, level, code) of every broken rule; one pre-aggregated join a table."""
    seg = transcript.groupBy("file_id").agg(
        F.count("*").alias("segments"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("blank"), F.count_if(F.col("time_start").isNull() | F.col("time_end").isNull()).alias("untimed")
    )
    obs = video_index.groupBy("file_id").agg(
        F.count("*").alias("observations"), F.count_if(F.col("linked_id").isNull() & (F.coalesce("raw_text", F.lit("")) != "") & (F.coalesce("ignored", F.lit("n")) != "y")).alias("unresolved")
    )
    f = files.dropDuplicates(["id"]).select(F.col("id").alias("file_id"), "chamber", "capture_directory", "webvtt", "transcript").join(seg, "file_id", "left").join(obs, "file_id", "left")
    c, empty = F.col, lambda x: F.coalesce(x, F.lit("")) == ""
    n = lambda x: F.coalesce(x, F.lit(0))
    d = F.coalesce("capture_directory", F.lit(""))
    rules = [
        ("warning", "MISSING_CAPTIONS", empty("webvtt") & empty("transcript")),
        ("warning", "NO_TRANSCRIPT_SEGMENTS", n("segments") == 0),
        ("warning", "EMPTY_TRANSCRIPT_TEXT", n("blank") > 0),
        ("error", "NULL_TRANSCRIPT_TIMES", n("untimed") > 0),
        ("info", "NO_VIDEO_INDEX", n("observations") == 0),
        ("warning", "UNRESOLVED_RAW_TEXT", n("unresolved") > 0),
        ("info", "NO_CAPTURE_DIRECTORY", d == ""),
        ("error", "ABSOLUTE_CAPTURE_DIRECTORY", d.startswith("http://") | d.startswith("https://")),
        ("error", "BAD_CAPTURE_DIRECTORY_PREFIX", d.startswith("/screenshots/") | d.startswith("/video/")),
        ("error", "MISSING_CHAMBER", empty("chamber")),
        ("error", "INVALID_CHAMBER", ~empty("chamber") & ~c("chamber").isin("house", "senate")),
    ]
    issue = F.array_compact(F.array(*(F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"))) for level, code, cond in rules)))
    return f.select("file_id", F.explode(issue).alias("i")).select("file_id", "i.level", "i.code")


def at_least(issues: DataFrame, level: str) -> DataFrame:
    return issues.where(F.col("level").isin([k for k, v in RANK.items() if v >= RANK[level]]))


def completeness(files: DataFrame, video_index: DataFrame, transcript: DataFrame) -> DataFrame:
    """files with the score by which the fullest of duplicates is kept."""
    c = F.col
    t = transcript.groupBy(c("file_id").alias("id")).agg(F.count("*").alias("_t"))
    v = video_index.groupBy(c("file_id").alias("id")).agg(F.count("*").alias("_v"))
    full = lambda x: F.coalesce(x, F.lit("")) != ""
    score = (
        F.when(F.coalesce("path", F.lit("")).startswith(PLACE), 10).otherwise(0)
        + F.when(full("capture_directory"), 5).otherwise(0)
        + F.when(full("length"), 2).otherwise(0)
        + F.when(c("width").isNotNull() & c("height").isNotNull(), 2).otherwise(0)
        + F.when(full("transcript") | full("webvtt"), 3).otherwise(0)
    )
    one = files.dropDuplicates(["id"])
    return one.join(t, "id", "left").join(v, "id", "left").withColumn("score", score + F.coalesce("_t", F.lit(0)) + F.coalesce("_v", F.lit(0))).drop("_t", "_v")
