"""Speech transcripts into clean, ordered speaker turns.

SQL expressions take labels, speaker marks, times, markup and sound annotations out of
each caption segment and split it where a speaker changes inside. The pieces, in order,
open a tentative turn at each sign of a change (mark, label, flag, another legislator
id); what is known of the speaker is spread over the tentative turn; neighbouring turns
of one known speaker are joined; gaps-and-islands numbers aggregate the rest.

Files of any length are split over chunks (rostrum.operators.sequences).

Defined results: rows repeated under one id count once, captions repeated under a new id
with the same start and words count once, by the lowest id; segments without spoken
words (NULL, empty, annotations only) belong to no turn and end none, but a label that
stands alone names the next words' speaker; segments of no readable start come last.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.llm.bodies import fold
from rostrum.llm.persons import index_of, profile_rows, resolve_people
from rostrum.operators import sequences
from rostrum.session import materialize

# Sound annotations, and fillers that are no words of a turn.
SOUNDS = r"laughter|laughs?|applause|music(?:\s+playing)?|gavel|bell(?:\s+rings)?|no\s+audio|inaudible|indiscernible|pause|cough(?:ing|s)?|crosstalk|silence|cheering|blank_audio|noise|recess"
FILLERS = r"you know|i mean|sort of|okay so|um+|uh+|er+|hm+|like"
_TITLE = r"(?:(?i:delegate|senator|del|sen|chairman|chairwoman|chair|rep|ms|mrs|mr|dr|mayor)\.?)"
_WORD = r"(?:" + _TITLE + r"|\p{Lu}\.|A(?=\s)|\p{Lu}[\p{L}\d.,'`’-]*[\p{L}\d])"
_LABEL = rf"{_WORD}(?:\s+(?:{_WORD}|of|the)){{0,5}}(?:\s+(?:Jr|Sr|JR|SR|II|III)\.?)?(?:\s+\d)?"
LAST = 1 << 40  # the start of segments whose own is unreadable
ORDER = ["start", "id", "piece"]
_CUT = "\x01"  # before a piece
_NAME = "\x02"  # around a label


def milliseconds(time: Column) -> Column:
    """A caption time as ms: [HH:]MM:SS with . or , before the fraction; NULL if unreadable."""
    p = r"^\s*(?:(\d+):)?(\d{1,2}):(\d{1,2})(?:[.,](\d{1,3}))?\s*$"
    part = lambda i: F.regexp_extract(time, p, i)
    n = lambda c: F.coalesce(c.try_cast("long"), F.lit(0))
    return F.when(time.rlike(p), (n(part(1)) * 3600 + n(part(2)) * 60 + n(part(3))) * 1000 + n(F.rpad(part(4), 3, "0")))


def marked(text: Column) -> Column:
    """The text without markup, times and sounds, with a cut before each piece and
    each label between name signs."""
    label = f" {_CUT}{_NAME}$2{_NAME} "
    stages = (
        # (what a text must hold for the stage to apply, patterns)
        (
            r"[<>&\x00-\x1f\u00a0]",
            ((r"[\x00-\x08\x0b-\x1f]", " "), (r"<[^<>]{0,40}>", " "), (r"&nbsp;|&#160;|\u00a0", " "), (r"&gt;", ">"), (r"&amp;", "&")),
        ),
        (r"[\[(*♪]", ((rf"(?i)[\[(*]+\s*(?:{SOUNDS})\s*[\])*]+", " "), (r"♪+", " "), (r"\*[^*]{0,40}\*", " "))),
        (r"\d:\d\d", ((r"\[\s*\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?\s*\]|\(\s*\d{1,2}:\d{2}(?::\d{2})?\s*\)|(?<![\d:])\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?(?![\d:])", " "),)),
        (r"[>\-–—]", ((r">>+", f" {_CUT}>> "), (r"^\s*[-–—]+\s+", f"{_CUT}>> "))),
        # labels: in brackets, of a colon or dash at a piece's start, then inside
        (r"[\[(]", ((r"[\[(]\s*(\p{Lu}[^\])\[(\x01\x02]{1,50}?)\s*[\])]\s*:?", f" {_CUT}{_NAME}$1{_NAME} "),)),
        (r":(?:\s|$)", ((rf"(^\s*|{_CUT}>>\s*)({_LABEL})\s*:\s+", "$1" + label),)),
        (r"\s[-–—]\s", ((rf"(^\s*|{_CUT}>>\s*)({_TITLE}\s+{_LABEL})\s+[-–—]\s+", "$1" + label),)),
        (
            r":(?:\s|$)",
            ((rf"(?<=[.?!,\p{{Ll}}\d])\s+((?:(?:A|THE|The)\s+)?{_LABEL})\s*:\s+", f" {_CUT}{_NAME}$1{_NAME} "), (rf"(^\s*|{_CUT}>>\s*)({_LABEL})\s*:\s*$", "$1" + label)),
        ),
    )
    t = F.coalesce(text, F.lit(""))
    for needs, patterns in stages:
        t = F.get(F.transform(F.array(t), _stage(needs, patterns)), F.lit(0))  # binds the text once
    return t


def _stage(needs: str, patterns: tuple):
    def replace(x: Column) -> Column:
        got = x
        for pattern, put in patterns:
            got = F.regexp_replace(got, pattern, put)
        return F.when(x.rlike(needs), got).otherwise(x)

    return replace


def spoken(text: Column) -> Column:
    """What is said: without signs, fillers, stutters and stray spaces."""
    t = F.regexp_replace(text, rf"{_NAME}[^{_NAME}]*{_NAME}|{_CUT}|>>+|[\[\]*]", " ")
    t = F.regexp_replace(t, r"^[\s\-–—:.,]+", "")
    t = F.regexp_replace(t, rf"(?i)(?<![\p{{L}}'])(?:{FILLERS})(?:,|(?=\s*[.?!]?\s*$)|(?<=um|uh|er|hmm|hm)(?=\s))", " ")
    t = F.regexp_replace(t, r"(?i)\b(\p{L}+)--\s+(?=\1\b)", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"\s+([.,?!])", "$1")
    return F.trim(t)


_KNOWN = T.StructType([T.StructField("key", T.StringType()), T.StructField("pid", T.LongType())])


def _speaker(label: Column, rows: tuple) -> Column:
    """(key, pid) of a label: the person it names, else its own words; NULL without label."""

    @F.arrow_udf(_KNOWN)
    def read(labels: pa.Array) -> pa.Array:
        own, keys, pids = index_of(rows), [], []
        for t in labels.to_pylist():
            if not t:
                keys.append(None)
                pids.append(None)
                continue
            ids = own.match(t)[0]
            words = re.sub(r"[^a-z0-9]+", " ", fold(t)).split()
            words = [w for w in words if w not in ("the", "a")]
            pids.append(ids[0] if len(ids) == 1 else None)
            keys.append(f"p{ids[0]}" if len(ids) == 1 else " ".join(words))
        return pa.StructArray.from_arrays([pa.array(keys, pa.string()), pa.array(pids, pa.int64())], ["key", "pid"])

    return read(label)


def _joined(text: str, at) -> Column:
    return F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(F.col(at).alias("at"), F.col(text).alias("t"))))), lambda x: x["t"]))


def _pieces(transcript: DataFrame, people: DataFrame) -> DataFrame:
    """(file_id, start, id, piece, words, text, sign, key, pid): what is spoken between
    two signs of a change."""
    rows = profile_rows(resolve_people(people))
    seg = transcript.where("id IS NOT NULL AND file_id IS NOT NULL").select(
        "file_id", "id", milliseconds(F.col("time_start")).alias("start"), marked(F.col("text")).alias("m"), F.lower(F.trim("new_speaker")).alias("flag"), F.col("legislator_id").cast("long").alias("leg")
    )
    said = F.lower(F.regexp_replace("m", r"[^\p{L}\d]", ""))
    alone = (F.col("_said") == "") | F.col("start").isNull()  # repeats nothing
    seg = seg.withColumn("_said", said).groupBy("file_id", F.coalesce("start", F.lit(LAST)).alias("start"), F.when(alone, F.concat(F.lit("\x01"), F.col("id").cast("string"))).otherwise(F.col("_said")).alias("_k"))
    seg = seg.agg(F.min_by(F.struct("id", "m", "flag", "leg"), "id").alias("s"))
    cuts = F.transform(F.split("s.m", _CUT), lambda t: F.struct(t.alias("t"), spoken(t).alias("text")))
    has = lambda x: x["text"].rlike(r"[\p{L}\d]")
    seg = seg.select("file_id", "start", "s.id", "s.flag", "s.leg", cuts.alias("cuts"))
    seg = seg.withColumn("said", F.transform("cuts", has))
    seg = seg.withColumns({"lead": F.array_position("said", F.lit(True)) - 1, "single": F.size(F.filter("said", lambda x: x)) == 1})
    piece = seg.select("*", F.posexplode("cuts").alias("piece", "c"))
    # the id tells who speaks at the segment's start, that is its first words
    leads = F.col("piece") == F.col("lead")
    piece = piece.select(
        "file_id", "start", "id", "piece",
        F.element_at("said", F.col("piece") + 1).alias("words"),
        F.col("c.text").alias("text"),
        F.trim("c.t").startswith(">>").alias("mark"),
        F.nullif(F.trim(F.regexp_extract("c.t", f"{_NAME}([^{_NAME}]*){_NAME}", 1)), F.lit("")).alias("label"),
        F.when(leads, F.col("leg")).alias("leg"),
        F.coalesce(leads & F.col("single") & (F.col("flag") == "y"), F.lit(False)).alias("flagged"),
    )
    piece = piece.where("words OR mark OR label IS NOT NULL").withColumn("who", _speaker(F.col("label"), rows))
    sign = F.col("mark") | F.col("label").isNotNull() | F.col("flagged")
    return piece.select("file_id", *ORDER, "words", "text", sign.alias("sign"), F.col("who.key").alias("key"), F.coalesce("who.pid", "leg").alias("pid"))


def _turns(transcript: DataFrame, people: DataFrame, texts: bool) -> DataFrame:
    """(file_id, _chunk, _at, at, pid, who, text) of every turn; text is NULL unless wanted."""
    key = ["file_id"]
    piece = _pieces(transcript, people)
    if not texts:
        piece = piece.withColumn("text", F.lit(None).cast("string"))
    piece = sequences.chunk(piece, key, ORDER, "pieces", heavy=True)
    # a sign opens a tentative turn, and so does another known person than the last since the last sign
    event = F.when(F.col("sign") | F.col("pid").isNotNull(), F.struct("pid"))
    piece = sequences.forward(piece, key, ORDER, before={"_any": F.lit(True), "_l": event})
    new = F.col("_any").isNull() | F.col("sign") | F.coalesce(F.col("pid") != F.col("_l.pid"), F.lit(False))
    at = F.struct(*ORDER)
    told = lambda c, pos: F.min_by(c, F.when(F.col(c).isNotNull(), pos))
    text = _joined("text", "_pos") if texts else F.first("text")
    own = {"pid": told("pid", at), "key": told("key", at), "words": F.max("words"), "at": F.min(F.when(F.col("words"), at)), "text": text}
    piece = piece.withColumn("_pos", at).withColumn("text", F.when(F.col("words"), F.col("text")))
    merge = {"pid": told("pid", F.col("_at")), "key": told("key", F.col("_at")), "words": F.max("words"), "at": F.min("at"), "text": _joined("text", "_at") if texts else F.first("text")}
    tentative = sequences.islands(piece, key, ORDER, new, own, merge, "tentative")
    tentative = tentative.select("file_id", "_chunk", F.col("_at").alias("pos"), "words", "at", "text", "pid", F.coalesce(F.concat(F.lit("p"), F.col("pid").cast("string")), F.col("key")).alias("who"))
    # a label or mark without words names the turn that follows it
    tentative = sequences.forward(tentative, key, ["pos"], before={"_p": F.struct("words", "who", "pid")})
    alone = ~F.col("_p.words") & F.col("who").isNull()
    named = {c: F.when(alone, F.col("_p")[c]).otherwise(F.col(c)) for c in ("pid", "who")}
    turn = materialize(tentative.withColumns(named).where("words").select("file_id", "_chunk", "pos", "pid", "who", "at", "text"), "turns")
    turn = sequences.forward(turn, key, ["pos"], before={"_w": F.struct("who")})
    first = lambda pos: {"at": F.min_by("at", pos), "pid": F.max("pid"), "who": F.max("who"), "text": _joined("text", pos) if texts else F.first("text")}
    return sequences.islands(turn, key, ["pos"], ~F.coalesce(F.col("_w.who") == F.col("who"), F.lit(False)), first("pos"), first("_at"), "turn-pieces")


def speaker_turns(transcript: DataFrame, people: DataFrame) -> DataFrame:
    """(file_id, turn, first_id, legislator_id, speaker, text) in order of turn. The text
    of a turn is one value, whatever its length."""
    turn = materialize(_turns(transcript, people, True), "turn-texts")
    turn = sequences.running_sum(turn, ["file_id"], ["_at"], F.lit(1), "turn")
    return turn.select("file_id", "turn", F.col("at.id").alias("first_id"), F.coalesce("pid", F.lit(0)).cast("int").alias("legislator_id"), F.col("who").alias("speaker"), "text")


def found(transcript: DataFrame, people: DataFrame) -> DataFrame:
    """(file_id, first_id, legislator_id) of every turn."""
    return _turns(transcript, people, False).select("file_id", F.col("at.id").alias("first_id"), F.coalesce("pid", F.lit(0)).cast("int").alias("legislator_id"))
