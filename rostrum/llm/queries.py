"""Queries of the training-data operators, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostrum.llm import bodies, packing, persons, recordings, runs, subjects, tokenize, turns
from rostrum.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return bodies.map_titles(table(spark, sf, "youtube_videos"), table(spark, sf, "committees"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return persons.found(table(spark, sf, "people"), table(spark, sf, "video_index"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return runs.found(table(spark, sf, "video_index"))


def p3_events(spark: SparkSession, sf: str) -> DataFrame:
    return runs.caption_runs(table(spark, sf, "video_index"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return turns.found(table(spark, sf, "video_transcript"), table(spark, sf, "people"))


def p4_turns(spark: SparkSession, sf: str) -> DataFrame:
    return turns.speaker_turns(table(spark, sf, "video_transcript"), table(spark, sf, "people"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return recordings.find_repeats(table(spark, sf, "files"), table(spark, sf, "committees"))


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokenize.encode_corpus(table(spark, sf, "documents"))


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_corpus(table(spark, sf, "documents").select("doc_id", "text"))


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    return packing.report(p8_containers(spark, sf))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.found(*(table(spark, sf, t) for t in ("documents", "subject_areas", "subject_labels")))


def p9_composition(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.composition(p9_found(spark, sf), table(spark, sf, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_events": p3_events,
    "p4_found": p4_found,
    "p4_turns": p4_turns,
    "p6_found": p6_found,
    "p7_ids": p7_ids,
    "p8_containers": p8_containers,
    "p8_report": p8_report,
    "p9_found": p9_found,
    "p9_composition": p9_composition,
}
ORACLE_SQL: dict[str, str] = {}
