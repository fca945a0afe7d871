from pyspark.sql import functions as F

from rostrum.functions import bills, similarity, text, times
from rostrum.sources import captions, pages


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_times(spark):
    got = {t: one(spark, times.seconds(F.lit(t))) for t in ("00:01:01", "01:01:01", "invalid", "00:00")}
    assert got == {"00:01:01": 61, "01:01:01": 3661, "invalid": 0, "00:00": 0}
    assert one(spark, times.clock(F.lit(3300))) == "00:55:00"
    assert one(spark, times.vtt_clock(F.lit(10.706))) == "00:00:10.705"  # milliseconds are cut
    assert one(spark, times.iso_duration(F.lit("PT1H23M45S"))) == 5025
    assert one(spark, times.iso_duration(F.lit("PT"))) is None
    assert one(spark, times.spoken_duration(F.lit("1h 2m 3s"))) == 3723
    assert one(spark, times.spoken_duration(F.lit("about 1h"))) is None
    assert one(spark, times.screenshot_number(F.lit(630))) == "00000631"
    assert one(spark, times.frame_rate(F.lit("30000/1001"))) == 29.97


def test_bills(spark):
    cases = {"H8 2067": "HB2067", "L H8 2067": "HB2067", "S8 456": "SB456", "1HB 1234": "HB1234", "HJ8 42": "HJR42", "House Bill 7": "HB7", "none": None, "S.J.R. 12": "SJR12"}
    for raw, label in cases.items():
        got = one(spark, bills.parse(F.lit(raw)))
        assert (got["label"] if got else None) == label, raw
    assert one(spark, bills.tokens(F.lit("hb 12 and SB 7, HB12"))) == ["HB12", "SB7"]
    assert one(spark, bills.variations(F.lit("18"))) == ["18", "78", "10", "13"]


def test_titles_and_urls(spark):
    assert one(spark, text.normalize_title(F.lit("January 23, 2025 - SFAC: Health - SR 1300 - 7:30 am"))) == "SFAC: Health"
    assert one(spark, text.keep_title(F.lit("State Crime Commission"))) is False
    assert one(spark, text.keep_title(F.lit(None).cast("string"))) is True
    assert one(spark, text.screenshot_url(F.lit("/house/floor/20250110/"), F.lit("00000102"))).endswith("/house/floor/20250110/00000102.jpg")
    assert one(spark, text.youtube_id(F.lit("https://youtu.be/abcdefghijk?t=3"))) == "abcdefghijk"
    assert one(spark, text.speaker_name(F.lit("Sen. J0HN  SMITH!"))) == "JOHN SMITH"
    assert one(spark, text.sanitize(F.lit("a\U0001f600b"))) == "ab"
    kinds = {"HTTP Error 404: gone": "permanent", "Connection refused by host": "transient", "SSL handshake": "transient", "HTTP 503": "permanent", "Could not resolve host": "transient", None: "permanent"}
    assert {m: one(spark, text.failure_kind(F.lit(m).cast("string"))) for m in kinds} == kinds
    for title, want in {"January 23, 2025-SFAC: Health-SR1300": "SFAC: Health", "Roads - 7:30 am": "Roads", "March 3, 2020": "March 3, 2020", "9:00 am - sr b": "9:00 am - sr b"}.items():
        assert one(spark, text.normalize_title(F.lit(title))) == want
    for title, keep in {"Rail Authority": False, "JLARC": False, "Public Hearing": False, "Press conference": True, "Board of Rails - Floor": True}.items():
        assert one(spark, text.keep_title(F.lit(title))) is keep
    assert one(spark, text.is_role(F.lit("Town Attorney"))) and one(spark, text.is_role(F.lit("Director"))) and not one(spark, text.is_role(F.lit("Ann Tarn")))
    assert one(spark, text.archive_download("https://a.example", F.lit("x-1"), F.lit("d/a b+c.mp4"))) == "https://a.example/download/x-1/d/a%20b%2Bc.mp4"
    assert one(spark, text.percentage(F.lit(1), F.lit(3))) == "33.3%" and one(spark, text.percentage(F.lit(0), F.lit(0))) == "0.0%"


def test_similarity(spark):
    jw = similarity.jaro_winkler_value
    assert jw("abc", "abc") == 1.0 and jw("", "a") == 0.0 and jw("abc", "xyz") == 0.0
    assert abs(jw("martha", "marhta") - 0.9611) < 1e-4
    assert jw("abcdxxxxx", "abcdyyyyyzz") > 0.6027  # the prefix counts at any height
    assert one(spark, similarity.levenshtein_similarity(F.lit(""), F.lit(""))) == 1.0
    assert one(spark, similarity.levenshtein_similarity(F.lit("é"), F.lit("e"))) == 0.0  # bytes
    assert one(spark, similarity.token_set(F.lit("Bob Smith"), F.lit("smith bob"))) == 1.0
    assert round(one(spark, similarity.similar_text(F.lit("WORLD"), F.lit("WORD"))), 1) == 88.9


def test_captions_round_trip(spark):
    rows = [(1, 0, 0.5, 2.0, "first line"), (1, 1, 2.0, 3.25, "second"), (2, 0, 3600.0, 3601.0, "x")]
    df = spark.createDataFrame(rows, "file_id int, pos int, a double, b double, text string")
    want = sorted((f, a, b, t) for f, _, a, b, t in rows)
    for write, parse in ((captions.write_webvtt, captions.parse_webvtt), (captions.write_srt, captions.parse_srt)):
        got = parse(write(df, "file_id", ["pos"], "a", "b", "text"), "file_id", "text")
        assert sorted((r.file_id, r.start_s, r.end_s, r.text) for r in got.collect()) == want
    odd = spark.createDataFrame([(1, "﻿WEBVTT\r\n\r\n00:00:01.000 --> 00:00:02.000 align:start\r\n<v A>two\r\nlines\r\n\r\n00:00:03.000 --> 00:00:04.000\r\n\r\n"), (2, None), (3, "")], "file_id int, text string")
    assert [(r.file_id, r.text) for r in captions.parse_webvtt(odd, "file_id", "text").collect()] == [(1, "two lines")]
    # an empty cue takes in the next one, its times included
    gap = spark.createDataFrame([(1, "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n\n00:00:03.000 --> 00:00:04.000\nfirst\n\n00:00:05.000 --> 00:00:06.000\nsecond")], "file_id int, text string")
    assert [(r.start_s, r.text) for r in captions.parse_webvtt(gap, "file_id", "text").collect()] == [(1.0, "00:00:03.000 --> 00:00:04.000 first"), (5.0, "second")]


def test_pages(spark):
    assert pages.balanced_json('var downloadLinks = [{"a": "]}"}];', "downloadLinks") == '[{"a": "]}"}]'
    assert pages.balanced_json("nothing", "x") is None and pages.balanced_json(None, "x") is None
    html = "<table id='other'><tr><td>no</td></tr></table><table id='archive'><tr><td><a href='/c/7'>A  B</a></td><td>1h</td></tr></table>"
    df = spark.createDataFrame([(1, html), (2, None)], "id int, h string")
    assert [tuple(r) for r in pages.scan_table(df, "id", "h").collect()] == [(1, 0, ["A B", "1h"], "/c/7", None, None)]
    assert one(spark, pages.meta_content(F.lit("<meta property='og:title' content='T'>"), "og:title")) == "T"


def test_segments_with_markup_keep_words_and_times(spark, tmp_path):
    from rostrum.plans import catalog

    rows = [(2, 1, "<i>second  ", "00:00:20,50", "00:00:21,25"), (1, 1, " third", "00:01:00.5", "00:01:02.00"), (3, 1, "first", "00:07.25", "00:08.50"), (4, 1, "<i></i>", "00:02:00.00", "00:02:01.00"), (5, 1, "untimed", None, None)]
    spark.createDataFrame(rows, "id long, file_id int, text string, time_start string, time_end string").write.parquet(str(tmp_path / "video_transcript.parquet"))
    q = {n: catalog.QUERIES[n](spark, str(tmp_path)).collect() for n in ("transcript_text", "webvtt_write", "webvtt_parse", "srt_parse")}
    assert [r.text for r in q["transcript_text"]] == ["first second third untimed"]
    assert q["webvtt_write"][0].text.startswith("WEBVTT\n\n00:00:07.250 --> 00:00:08.500\nfirst\n\n00:00:20.500 --> 00:00:21.250\n<i>second\n\n00:01:00.500")
    want = [(7.25, 8.5, "first"), (20.5, 21.25, "second"), (60.5, 62.0, "third")]
    assert [[(r.start_s, r.end_s, r.text) for r in q[n]] for n in ("webvtt_parse", "srt_parse")] == [want, want]
