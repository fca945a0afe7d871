"""Resolution of captions to members: score tiers, context, consensus, history.

Snapshot semantics: every caption is resolved against the table as it stands.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from rostrum.functions import bills, similarity, text
from rostrum.operators import context, jobs

THRESHOLD, CONSENSUS, HISTORY = 75.0, 70.0, 65.0
# Neighbours raise a score by a fifth at most, the list of speakers by a tenth, the party by a
# twentieth: less cannot reach THRESHOLD.
LEAST = THRESHOLD / (1.2 * 1.1 * 1.05) - 1e-9
# Letters and digits taken for each other, one at a time.
MISREAD = {"0": "Oo", "O": "0", "o": "0", "1": "lIi", "l": "1I", "I": "1l", "5": "Ss", "S": "5", "8": "B", "B": "8", "6": "G", "G": "6"}
MOST_READINGS = 10


def clean_name(raw: Column) -> Column:
    """A caption's name: one leading title off; a nickname in brackets replaces what is
    before it; party, district and place go."""
    t = F.trim(F.regexp_replace(raw, r"\s+", " "))
    t = F.regexp_replace(t, r"(?i)^(?:sen\.|del\.|delegate|senator|vice chair|chair|rep\.|representative)\s+", "")
    t = F.trim(F.regexp_replace(t, r"^.*?\((?![RDIrdi](?:-?\d+)?\))([A-Za-z][A-Za-z\s\-]+)\)\s*", "$1 "))
    # the house form names the town before (R85): two words go if more than three stay
    house = F.trim(F.regexp_replace(F.regexp_replace(t, r"(?i)\([RDI]\d+\)", ""), r"\s+", " "))
    house = F.regexp_replace(house, r"^(\S+ \S+(?: \S+)*) \S+ \S+$", "$1")
    t = F.when(t.rlike(r"(?i)\([RDI]\d+\)") & ~t.rlike(r"(?i)\([RDI]-\d+\)"), house).otherwise(t)
    t = F.regexp_replace(t, r"(?i)\([RDI](?:-?\d+)?\)|district\s+\d+|\s*\(\d+\)", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)\s+of\s+[A-Z][a-z]+", ""), r"(?i)\s+-\s*[A-Z][a-z]+$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[,()]+", " "), r"\s+", " "))


def party(raw: Column) -> Column:
    return F.nullif(F.upper(F.regexp_extract(raw, r"(?i)\(([RDI])(?:-?\d+)?\)", 1)), F.lit(""))


def given_first(name: Column) -> Column:
    """'Last, First' as 'First Last'."""
    return F.trim(F.regexp_replace(name, r"^\s*([^,]+?)\s*,\s*(\S.*?)\s*$", "$2 $1"))


def _readings(name: str) -> set[str]:
    out = [name]
    for i, c in enumerate(name):
        for r in MISREAD.get(c, ""):
            v = name[:i] + r + name[i + 1 :]
            if v not in out and len(out) < MOST_READINGS:
                out.append(v)
    return {v.lower() for v in out}


def name_score(raw: str, candidate: str) -> float:
    """0 to 100: 100 equal, 95 equal in another reading or the candidate's last words, 92
    other words of it in a row, 90 and 85 the last name alone, less for likeness, which
    counts a tenth more where both sound the same."""
    low, cand = raw.lower(), candidate.lower()
    if low == cand:
        return 100.0
    if cand in _readings(raw):
        return 95.0
    mine, theirs = low.split(), cand.split()
    n = len(mine)
    if 0 < n < len(theirs):
        at = [i for i in range(len(theirs) - n + 1) if theirs[i : i + n] == mine]
        if at:
            return 95.0 if at[0] + n == len(theirs) else 92.0
    if n == 1 and len(theirs) > 1:
        if theirs[-1] in _readings(raw):
            return 85.0
        near = _combined(low, theirs[-1])
        if near > 0.85:
            return near * 80
    shared = len(set(mine) & set(theirs)) / max(1, len(set(mine) | set(theirs)))
    sound = similarity.sound_value(raw)
    alike = 1.1 if sound and sound == similarity.sound_value(candidate) else 1.0
    return min(100.0, (0.7 * _combined(low, cand) + 0.3 * shared) * 100 * alike)


def _edits(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def _combined(a: str, b: str) -> float:
    x, y = a.encode(), b.encode()
    lev = 1 - _edits(x, y) / max(len(x), len(y), 1)
    words = len(set(a.split()) & set(b.split())) / max(1, len(set(a.split()) | set(b.split())))
    return 0.3 * lev + 0.5 * similarity.jaro_winkler_value(a, b) + 0.2 * words


@F.arrow_udf(DoubleType())
def score(raw: pa.Array, candidate: pa.Array) -> pa.Array:
    return pa.array([None if r is None or c is None else name_score(r, c) for r, c in zip(raw.to_pylist(), candidate.to_pylist())], pa.float64())


def candidates(people: DataFrame, terms: DataFrame, sessions: DataFrame, today: Column) -> DataFrame:
    """(session_id, person_id, party, name): a row for each name of a member in office in a session."""
    s = sessions.select(F.col("id").alias("session_id"), F.col("date_started").alias("a"), F.coalesce("date_ended", today).alias("b"))
    held = terms.select("person_id", "party", "date_started", "date_ended").join(F.broadcast(s), (F.col("date_started") <= F.col("b")) & (F.col("date_ended").isNull() | (F.col("date_ended") >= F.col("a"))))  # fixed tables
    names = people.select(F.col("id").alias("person_id"), F.explode(F.array_distinct(F.array_compact(F.array("name", "name_formal")))).alias("name"))
    return held.select("session_id", "person_id", "party").distinct().join(names, "person_id").withColumn("name", given_first(F.col("name")))


@F.arrow_udf(ArrayType(StringType()))
def _caption_keys(cleaned: pa.Array) -> pa.Array:
    return pa.array([_keys(c, _readings(c)) for c in cleaned.to_pylist()], pa.list_(pa.string()))


@F.arrow_udf(ArrayType(StringType()))
def _name_keys(name: pa.Array) -> pa.Array:
    return pa.array([_keys(c, {c.lower(), *c.lower().split()[-1:]}) for c in name.to_pylist()], pa.list_(pa.string()))


def _keys(text: str, readings: set[str]) -> list[str]:
    return sorted({"w" + w for w in text.lower().split()} | {"r" + r for r in readings} | {"s" + s for s in [similarity.sound_value(text)] if s})


def best_scores(captions: DataFrame, members: DataFrame) -> DataFrame:
    """(session_id, cleaned, person_id, score) of all candidates of each distinct caption
    and session that score LEAST or more. Only pairs that can do so are met: they share a
    word, or a reading of the caption is the name or its last word, or both sound the
    same. Without any of these a score is at most 0.7 x (0.3 + 0.5) = 56."""
    texts = captions.select("session_id", "cleaned").where("cleaned <> ''").distinct()
    left = texts.select("session_id", "cleaned", F.explode(_caption_keys("cleaned")).alias("k"))
    right = members.where("name IS NOT NULL").select(F.col("session_id").alias("s"), "person_id", "party", "name", F.explode(_name_keys("name")).alias("k2"))
    met = left.join(right, (F.col("session_id") == F.col("s")) & (F.col("k") == F.col("k2"))).select("session_id", "cleaned", "person_id", "party", "name").distinct()
    scored = met.withColumn("score", score("cleaned", "name"))
    return scored.groupBy("session_id", "cleaned", "person_id", "party").agg(F.max("score").alias("score")).where(F.col("score") >= LEAST)


def resolve_members(video_index: DataFrame, files: DataFrame, people: DataFrame, terms: DataFrame, sessions: DataFrame, today: Column) -> DataFrame:
    """(id, person_id, confidence, source) of unresolved legislator captions.

    name: the best score, raised by members seen within five frames (5 % each, 20 % at
    most), by standing in the record's list of speakers (10 %) and by a matching party (5 %), if it reaches THRESHOLD; consensus: three votes
    of the neighbours, unless the text names a role; history: the majority of the text.
    """
    days = context.latest_start(files.select("id", "date").dropDuplicates(["id"]), sessions, "id", "date", "id", "date_started", "date_ended", "session_id").select(F.col("id").alias("fid"), "session_id")
    seen = video_index.dropDuplicates(["id"]).where("type = 'legislator' AND coalesce(ignored, 'n') <> 'y'").withColumn("frame", F.col("screenshot").try_cast("long"))
    todo = seen.where("linked_id IS NULL").join(days, F.col("file_id") == F.col("fid"), "left").withColumns({"cleaned": clean_name(F.col("raw_text")), "said": party(F.col("raw_text"))})
    members = candidates(people, terms, sessions, today)
    scores = best_scores(todo.where("session_id IS NOT NULL"), members)
    tried = todo.select("id", "file_id", "frame", "session_id", "cleaned", "said").join(scores, ["session_id", "cleaned"]).withColumn("linked_id", F.col("person_id"))
    seen_near = context.neighbours(tried.select(F.struct("id", "person_id").alias("id"), "file_id", "frame", "linked_id"), seen, 5).select("id.*", "same")
    listed = files.where("video_index_cache IS NOT NULL").select(F.col("id").alias("file_id"), F.explode(jobs.listed_people(F.col("video_index_cache"))).alias("person_id")).distinct().withColumn("listed", F.lit(True))
    boosted = tried.join(seen_near, ["id", "person_id"], "left").join(listed, ["file_id", "person_id"], "left")
    rise = (1 + F.least(F.lit(0.2), 0.05 * F.coalesce("same", F.lit(0)))) * F.when(F.col("listed"), 1.1).otherwise(1.0) * F.when(F.col("said") == F.col("party"), 1.05).otherwise(1.0)
    ranked = boosted.withColumn("c", F.least(F.lit(100.0), F.col("score") * rise)).where(F.col("c") >= THRESHOLD)
    named = ranked.groupBy("id").agg(F.min(F.struct((-F.col("c")).alias("m"), "person_id")).alias("b")).select("id", F.col("b.person_id").alias("n_id"), (-F.col("b.m")).alias("n_c"))
    votes = context.consensus(todo, seen, 5, 3).select("id", F.col("linked_id").alias("v_id"))
    in_office = members.select(F.col("session_id").alias("ms"), F.col("person_id").alias("mp")).distinct()
    history = context.majority(seen.where("linked_id IS NOT NULL"), ["raw_text"], "linked_id").select("raw_text", F.col("linked_id").alias("h_id"))
    all_of = todo.select("id", "raw_text", "session_id", "cleaned").join(named, "id", "left").join(votes, "id", "left").join(history, "raw_text", "left")
    ok = lambda c, df: df.join(in_office, (F.col("ms") == F.col("session_id")) & (F.col("mp") == F.col(c)), "left").withColumn(c, F.col("mp")).drop("ms", "mp")
    all_of = ok("h_id", ok("v_id", all_of))
    v = F.when(~text.is_role(F.col("cleaned")), F.col("v_id"))
    return all_of.select(
        "id",
        F.coalesce("n_id", v, "h_id").alias("person_id"),
        F.when(F.col("n_id").isNotNull(), F.col("n_c")).when(v.isNotNull(), CONSENSUS).when(F.col("h_id").isNotNull(), HISTORY).alias("confidence"),
        F.when(F.col("n_id").isNotNull(), "name").when(v.isNotNull(), "consensus").when(F.col("h_id").isNotNull(), "history").alias("source"),
    ).where("person_id IS NOT NULL")


def resolve_bills(video_index: DataFrame, files: DataFrame, sessions: DataFrame, bill_list: DataFrame) -> DataFrame:
    """(id, linked_id, confidence) of unresolved bill captions.

    A caption is read into chamber and number and looked up in the bills (id, session_id,
    chamber, number) of the file's session: 100 if the number is in the record's agenda, 95
    if neighbours within ten frames show that bill, else 92. If none is there, readings of
    one digit otherwise count if they are in the agenda (92, the first reading wins). Else
    five votes of the neighbours for a bill of that session and chamber (88), else the
    majority of the text over all files if it is a bill of the session (65). Of bills of one
    number the lowest id is taken.
    """
    c = F.col
    days = context.latest_start(files.select("id", "date", "video_index_cache").dropDuplicates(["id"]), sessions, "id", "date", "id", "date_started", "date_ended", "session_id").select(c("id").alias("fid"), "session_id", jobs.agenda_bills(c("video_index_cache")).alias("agenda"))
    seen = video_index.dropDuplicates(["id"]).where("type = 'bill' AND coalesce(ignored, 'n') <> 'y'").withColumn("frame", c("screenshot").try_cast("long"))
    todo = seen.where("linked_id IS NULL").join(days, c("file_id") == c("fid"), "left").withColumn("p", bills.parse(c("raw_text")))
    todo = todo.select("id", "file_id", "frame", "raw_text", "session_id", F.coalesce("agenda", F.array().cast("array<int>")).alias("agenda"), c("p.chamber").alias("chamber"), c("p.number").alias("number"))
    plain = lambda n: F.regexp_replace(F.regexp_replace(n, "[^0-9]", ""), r"^0+(?=\d)", "")
    known = bill_list.groupBy(c("session_id").alias("bs"), F.lower("chamber").alias("bc"), plain(c("number")).alias("bn")).agg(F.min("id").alias("bill"))
    tries = todo.where("number IS NOT NULL AND session_id IS NOT NULL").select("*", F.posexplode(bills.variations(c("number"))).alias("try", "as"))
    tries = tries.where((c("try") == 0) | F.array_contains("agenda", c("as").try_cast("int")))
    met = tries.join(known, (c("session_id") == c("bs")) & (c("chamber") == c("bc")) & (plain(c("as")) == c("bn")))
    first = met.groupBy("id", "file_id", "frame").agg(F.min_by(F.struct("bill", "try", F.array_contains("agenda", c("as").try_cast("int")).alias("on")), "try").alias("m")).select("id", "file_id", "frame", "m.*", c("m.bill").alias("linked_id"))
    near = context.neighbours(first.select("id", "file_id", "frame", "linked_id"), seen, 10).select("id", "same")
    exact = first.join(near, "id", "left").select("id", "linked_id", F.when(c("try") > 0, 92.0).when(c("on"), 100.0).when(c("same") > 0, 95.0).otherwise(92.0).alias("confidence"))
    rest = todo.join(exact.select("id"), "id", "left_anti")
    of = bill_list.select(c("id").alias("linked_id"), c("session_id").alias("bs"), F.lower("chamber").alias("bc"))
    votes = context.consensus(rest.where("number IS NOT NULL"), seen, 10, 5).join(rest.select("id", "session_id", "chamber"), "id").join(of, "linked_id")
    votes = votes.where("session_id = bs AND chamber = bc").select("id", "linked_id", F.lit(88.0).alias("confidence"))
    majority = context.majority(seen.where("linked_id IS NOT NULL"), ["raw_text"], "linked_id").select("raw_text", "linked_id")
    past = rest.join(votes.select("id"), "id", "left_anti").join(majority, "raw_text").join(of, "linked_id").where("session_id = bs").select("id", "linked_id", F.lit(HISTORY).alias("confidence"))
    return exact.unionByName(votes).unionByName(past)


def resolve_captions(video_index: DataFrame, files: DataFrame, people: DataFrame, terms: DataFrame, sessions: DataFrame, bill_list: DataFrame, today: Column, kind: str | None = None, force: bool = False, file_ids: list[int] | None = None) -> DataFrame:
    """(id, type, linked_id, confidence) of the captions of one kind or both, of all files
    or some. ``force`` resolves those that have a link anew; they are no evidence then."""
    rows = video_index if file_ids is None else video_index.where(F.col("file_id").isin(file_ids))
    rows = rows.withColumn("linked_id", F.lit(None).cast("long")) if force else rows
    out = []
    if kind in (None, "legislator"):
        out.append(resolve_members(rows, files, people, terms, sessions, today).select("id", F.lit("legislator").alias("type"), F.col("person_id").cast("long").alias("linked_id"), "confidence"))
    if kind in (None, "bill"):
        out.append(resolve_bills(rows, files, sessions, bill_list).select("id", F.lit("bill").alias("type"), F.col("linked_id").cast("long").alias("linked_id"), "confidence"))
    return out[0].unionByName(out[1]) if len(out) > 1 else out[0]


def resolution_report(video_index: DataFrame, resolved: DataFrame) -> DataFrame:
    """(file_id, type, total, resolved, share): how many captions without a link got one."""
    todo = video_index.dropDuplicates(["id"]).where("linked_id IS NULL AND coalesce(ignored, 'n') <> 'y'").select("id", "file_id", "type")
    got = todo.join(resolved.select("id", F.lit(1).alias("_r")), "id", "left").groupBy("file_id", "type").agg(F.count("*").alias("total"), F.count("_r").alias("resolved"))
    return got.withColumn("share", text.percentage(F.col("resolved"), F.col("total")))
