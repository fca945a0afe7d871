import datetime as dt
import random

from pyspark.sql import functions as F

from rostrum.operators import bitemporal, clips, context, ingest, sequences


def _clips(spark, times):
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate(times)], "k int, t long, id long")
    return sorted((r.start_s, r.end_s) for r in clips.reduce_to_clips(df, ["k"], "t", "id").collect())


def test_clips(spark):
    assert _clips(spark, [300, 310, 320]) == [(290, 330)]
    assert _clips(spark, [300, 360]) == [(285, 315), (345, 375)]
    assert _clips(spark, [300]) == [(285, 315)]
    assert _clips(spark, [5, 8]) == [(0, 24)]
    assert _clips(spark, []) == []


def test_chunked_windows_equal_plain_ones(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else rng.choice("ab"), rng.randrange(500), i, rng.choice([None, 1, 2])) for i in range(700)]
    df = sequences.chunk(spark.createDataFrame(rows, "k string, t int, id int, v int"), ["k"], ["t", "id"], parts=7)
    assert df.where("k = 'hot'").select("_chunk").distinct().count() > 1
    got = sequences.running_sum(df, ["k"], ["t", "id"], F.coalesce("v", F.lit(0)), "s")
    got = sequences.previous(got, ["k"], ["t", "id"], ["id"], "p_")
    got = {r.id: (r.s, r.p_id) for r in got.collect()}
    fill = {r.id: r.v for r in sequences.fill_forward(df, ["k"], ["t", "id"], ["v"]).collect()}
    for k in {r[0] for r in rows}:
        total, before, last = 0, None, None
        for _, t, i, v in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
            total, last = total + (v or 0), v if v is not None else last
            assert got[i] == (total, before) and fill[i] == last
            before = i


def test_islands_over_chunks_equal_plain_ones(spark):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("ab"), t, t, rng.random() < 0.03) for t in range(600)]
    df = sequences.chunk(spark.createDataFrame(rows, "k string, t int, id int, cut boolean"), ["k"], ["t", "id"], parts=9)
    df = sequences.forward(df, ["k"], ["t", "id"], before={"any": F.lit(True)}, after={"next_cut": F.when(F.col("cut"), F.col("t"))})
    got = sequences.islands(df, ["k"], ["t", "id"], F.col("any").isNull() | F.col("cut"), {"a": F.min("t"), "n": F.count("*")}, {"a": F.min("a"), "n": F.sum("n")})
    want, seen = {}, {}
    for k, t, _, cut in sorted(rows):
        if cut or k not in seen:
            seen[k] = t
        want[k, seen[k]] = want.get((k, seen[k]), 0) + 1
    assert {(r.k, r.a): r.n for r in got.collect()} == want and {r._at.t for r in got.collect()} == {t for _, t in want}
    for r in df.collect():
        assert r.next_cut == min((t for k, t, _, c in rows if c and k == r.k and t >= r.t), default=None)


def _brute(rows, day):
    known = [r for r in rows if r[2] <= day and r[0] <= day]
    if not known:
        return 0
    best = max(known, key=lambda r: (r[0], r[3], r[4]))
    return best[4] if best[1] is None or best[1] >= day else 0


def test_rectangles_are_disjoint_and_right():
    rng = random.Random(1)
    for _ in range(300):
        rows = [(s := rng.randrange(20), rng.choice([None, s + rng.randrange(8)]), rng.randrange(25), rng.randrange(4), i + 1) for i in range(rng.randrange(7))]
        rects = bitemporal.sweep(rows)
        assert len(rects) <= 6 * max(1, len(rows))
        for day in range(30):
            hit = [r[4] for r in rects if r[0] <= day < r[1] and r[2] <= day < r[3]]
            assert len(hit) <= 1 and (hit[0] if hit else 0) == _brute(rows, day)


def test_members_with_empty_and_null_rows(spark):
    vi = spark.createDataFrame([(1, 9, "legislator", 5, None), (2, 8, "legislator", 5, "n"), (3, None, "legislator", 5, "n"), (4, 9, "bill", 5, "n")], "id int, file_id int, type string, linked_id long, ignored string")
    files = spark.createDataFrame([(9, None)], "id int, date date")
    terms = spark.createDataFrame([], "id int, person_id int, date_started date, date_ended date, date_created timestamp")
    sessions = spark.createDataFrame([], "id int, date_started date, date_ended date")
    assert sorted(map(tuple, bitemporal.members_in_force(vi, files, terms, sessions).collect())) == [(8, 5, 0, 0), (9, 5, 0, 0)]


def test_majority(spark):
    def of(counts):
        rows = [("x", v) for v, n in counts.items() for _ in range(n)]
        return [r.v for r in context.majority(spark.createDataFrame(rows, "k string, v int"), ["k"], "v").collect()]

    assert of({1: 2}) == [] and of({1: 3, 2: 3}) == [] and of({1: 4}) == [1] and of({1: 5, 2: 1}) == [1] and of({1: 4, 2: 1}) == [1]


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], "k int, v string, _pos int")
    new = spark.createDataFrame([(2, "B", 1), (2, "BB", 2), (None, "m", 3)], "k int, v string, _pos int")
    assert sorted((r.k or 0, r.v) for r in ingest.upsert(old, new, F.col("k").cast("string")).collect()) == [(0, "m"), (0, "n"), (1, "a"), (2, "BB")]
    batch = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4)], "key string, id int")
    there = spark.createDataFrame([("y", 0), (None, 0)], "key string, id int")
    assert sorted(r.id for r in ingest.insert_absent(there, batch, "key", ["id"]).collect()) == [1, 4]


def test_patch_json(spark):
    df = spark.createDataFrame([('{"a": "1", "b": "2", "l": [{"x": true}], "n": 1.5, "z": null}',), (None,), ("[1]",)], "j string")
    got = [r.x for r in df.select(ingest.patch_json(F.col("j"), {"b": F.lit("true")}).alias("x")).collect()]
    assert got[0] == '{"a":"1","l":[{"x":true}],"n":1.5,"z":null,"b":true}' and got[1:] == ['{"b":true}', '{"b":true}']


def test_streaming_clips(spark, tmp_path):
    from rostrum.streaming import clips as stream

    rows = spark.createDataFrame([(1, 0), (1, 20), (1, 100)], "k int, s int").select("k", F.timestamp_seconds("s").alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("k int, ts timestamp").parquet(str(tmp_path / "in"))
    seen = []
    stream.drain(source, lambda b, _: seen.extend(r.n_rows for r in stream.session_clips(b, "ts", ["k"]).collect()), str(tmp_path / "cp"))
    assert sorted(seen) == [1, 2]


def test_names_and_scores(spark):
    from rostrum.operators import resolve

    cases = {"Sen. Orrin Q. Vasterling (R-6)": "Orrin Q. Vasterling", "Senator Imke Dray-Ostler (D-42)": "Imke Dray-Ostler", "Nils Harrow of Vexley": "Nils Harrow", "Nils Harrow - Vexley": "Nils Harrow", "Delegate Dray-Ostler": "Dray-Ostler",
             "Del. P. U. (Pim) Oster": "Pim Oster", "Del. Nils Harrow\nBrackwater Bay (R35)": "Nils Harrow", "Del. Imke Lowe Tarn (D42)": "Imke Lowe Tarn"}
    df = spark.createDataFrame(list(cases.items()), "raw string, want string").select("raw", "want", resolve.clean_name(F.col("raw")).alias("got"))
    assert [(r.raw, r.got) for r in df.collect() if r.want != r.got] == []
    s = resolve.name_score
    assert s("Nils Harrow", "Nils Harrow") == 100 and s("Ni1s Harrow", "Nils Harrow") > 90 and s("Imke Oster", "Nils Harrow") < 50
    assert s("Lowe Tarn", "Imelda P. Lowe Tarn") >= 95 and s("Oster", "Pim Oster") == 95  # its last words
    assert 50 <= s("Tod Garvich", "Todrick A. Garvich") < 75


def test_committee_directory():
    from rostrum.operators.committees import Directory, PeopleList

    d = Directory([(1, None, "Waterways and Harbors", "WAH", "house"), (2, 1, "Subcommittee #1", None, "house"), (3, 1, "Dredging and Locks", None, "house"), (4, 1, "Waterways and Harbors - Piers", None, "house"),
                   (7, None, "Finance and Appropriations", None, "senate"), (8, 7, "Capital Outlay", None, "senate"), (9, 7, "Piers and Ferries", None, "senate"), (5, 7, "Criminal", None, "senate")])
    of = lambda label, kind="subcommittee", chamber="house": d.match(label, chamber, kind)
    assert of("Waterways & Harbors", "committee") == 1 and of("Harbors", "committee") == 1 and of("Harb", "committee") is None
    assert of("Waterways and Harbors: Subcommittee #1") == 2 and of("Dredging and Lockz") == 3 and of("Waterways and Harbors Piers Subcommittee") == 4
    assert of("SFAC", "committee", "senate") == 7 and of("Capital Outlay & Transportation", chamber="Senate") == 8 and of("SFAC: Ferries", chamber="senate") == 9
    assert of("Criminal Subcommittee") == 5  # an alias, whatever the chamber
    assert of("Administrative Law", "committee") is None and of(None, "committee") is None and of("x", "committee", None) is None
    p = PeopleList([(2, "Ann Tarn"), (1, "Imke Oster"), (3, "Ann Tarm")])
    assert p.match("ann tarn") == 2 and p.match("Ann Tarr") == 2 and p.match("Imke 0ster") == 1 and p.match("Zz") is None and PeopleList([]).match("x") is None


def test_feeds(spark):
    from rostrum.sources import feeds

    df = spark.createDataFrame([(1, '{"en": [{"Begin": "2024-01-01T00:00:05", "End": "2024-01-01T00:00:07", "Content": "a"}, {"Begin": "x", "End": "y", "Content": "b"}]}'), (2, None)], "id int, j string")
    assert [tuple(r) for r in feeds.caption_feed(df, "id", "j").collect()] == [(1, 0, 0.0, 2.0, "a")]
    ag = spark.createDataFrame([(1, '{"agenda": [{"text": "HB 12 and SB 3", "startTime": "0:10"}, {"text": ""}]}'), (2, "bad"), (3, None)], "id int, j string")
    assert [(r.id, r.bill) for r in feeds.agenda_rows(ag, "id", "j").collect()] == [(1, "HB12")]


def _resolved(spark, captions, cache=None):
    """(id, source) of the captions resolved against two members."""
    from rostrum.operators import resolve

    vi = spark.createDataFrame([(i, 1, str(100 * i), "legislator", c, None, None) for i, c in enumerate(captions)], "id int, file_id int, screenshot string, type string, raw_text string, linked_id int, ignored string")
    files = spark.createDataFrame([(1, dt.date(2020, 1, 9), cache)], "id int, date date, video_index_cache string")
    people = spark.createDataFrame([(7, "Stediver, Deborah", "Deborah Stediver"), (8, "Bostwater, Ann", None)], "id int, name string, name_formal string")
    terms = spark.createDataFrame([(p, "D", dt.date(2019, 1, 1), None) for p in (7, 8)], "person_id int, party string, date_started date, date_ended date")
    sessions = spark.createDataFrame([(3, dt.date(2020, 1, 1), dt.date(2020, 3, 1))], "id int, date_started date, date_ended date")
    got = resolve.resolve_members(vi, files, people, terms, sessions, F.lit("2026-01-01").cast("date"))
    return {r.id: (r.person_id, round(r.confidence, 2)) for r in got.collect()}


def test_equal_sound_raises_a_score(spark):
    from rostrum.functions import similarity
    from rostrum.operators import resolve

    assert round(resolve.name_score("Deborah Stedivar", "Deborah Stediver"), 2) == 75.33
    assert resolve.name_score("Tom Garrett", "Thomas A. Garrett") < 75  # T526 and T522
    words = ["Ashcraft", "Tymczak", "Pfister", "Honeyman", "O'Hara", "Ann Wheelwright", "12", "Hw", "Lloyd"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", similarity.sound(F.col("w")).alias("s"))
    assert [r for r in df.collect() if similarity.sound_value(r.w) != r.s] == []
    assert _resolved(spark, ["Del. Deborah Stedivar"]) == {0: (7, 75.33)}


def test_listed_speakers_raise_a_score(spark):
    assert _resolved(spark, ["Del. Debra Stediver"]) == {}
    assert list(_resolved(spark, ["Del. Debra Stediver"], '{"speakers": [{"person_id": 7}]}')) == [0]


def test_bills_are_looked_up(spark):
    from rostrum.operators import resolve

    rows = [(1, "HB 12", None), (2, "SB 12", None), (3, "HB 10", None), (4, "HB 99", None), (5, "none", None), (6, "SB 7", None), (9, "HB 18", None), (7, "S.B. 3", 33), (8, "SB 3", None)]
    rows += [(20 + i, "HB 12", 11) for i in range(6)]  # six neighbours show bill 11
    vi = spark.createDataFrame([(i, 1, str(100 if i < 5 or i >= 20 else 500 + 50 * i) if i < 20 else str(101 + i % 6), "bill", t, k, None) for i, t, k in rows], "id int, file_id int, screenshot string, type string, raw_text string, linked_id int, ignored string")
    files = spark.createDataFrame([(1, dt.date(2020, 1, 9), '{"agenda": ["HB 18 and more"]}')], "id int, date date, video_index_cache string")
    sessions = spark.createDataFrame([(3, dt.date(2020, 1, 1), None)], "id int, date_started date, date_ended date")
    listed = spark.createDataFrame([(11, 3, "house", "HB0012"), (12, 3, "senate", "SB 12"), (13, 3, "house", "18"), (33, 3, "senate", "3"), (34, 4, "senate", "7")], "id int, session_id int, chamber string, number string")
    got = {r.id: (r.linked_id, r.confidence) for r in resolve.resolve_bills(vi, files, sessions, listed).collect()}
    # seen nearby; alone; a misread digit on the agenda; the neighbours' vote; alone; on the agenda
    assert got == {1: (11, 95.0), 2: (12, 92.0), 3: (13, 92.0), 4: (11, 88.0), 8: (33, 92.0), 9: (13, 100.0)}
    forced = resolve.resolve_captions(vi, files, None, None, sessions, listed, None, "bill", force=True)
    assert {r.id: r.linked_id for r in forced.collect()}[7] == 33
    report = resolve.resolution_report(vi, forced).collect()
    assert [(r.total, r.resolved, r.share) for r in report] == [(8, 5, "62.5%")]


def test_frames_are_read_by_a_callable(spark):
    from rostrum.operators import jobs

    def read(picture):
        return {b"a": "HB 1", b"b": ""}[picture]

    df = spark.createDataFrame([(1, b"a"), (2, b"b"), (3, b"?"), (4, None)], "n int, content binary")
    got = [tuple(r) for r in jobs.read_frames(df, read).orderBy("n").collect()]
    assert got == [(1, "HB 1", False), (2, "", False), (3, None, True), (4, None, True)]


def test_snapshot_is_written_in_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    ingest.write_snapshot(df, str(tmp_path / "s"), "2026-01-01")
    assert spark.read.json(str(tmp_path / "s" / "head")).first().asDict() == {"generated_at": "2026-01-01", "record_count": 2}
    assert spark.read.json(str(tmp_path / "s" / "records")).count() == 2


def test_misread_first_letters_meet_their_member(spark):
    assert _resolved(spark, ["Delegate B0stwater", "Del. 8ostwater"]) == {0: (8, 85.0), 1: (8, 85.0)}


def test_candidates_equal_all_pairs(spark, sf):
    from rostrum.operators import resolve
    from rostrum.session import table

    people, terms, sessions = (table(spark, sf, t) for t in ("people", "terms", "sessions"))
    members = resolve.candidates(people, terms, sessions, F.lit("2026-01-01").cast("date")).cache()
    one = members.groupBy().agg(F.max("session_id")).first()[0]
    raw = table(spark, sf, "video_index").where("type = 'legislator' AND raw_text IS NOT NULL").select(F.lit(one).alias("session_id"), resolve.clean_name(F.col("raw_text")).alias("cleaned")).distinct().orderBy("cleaned").limit(400).cache()
    got = {(r.cleaned, r.person_id): r.score for r in resolve.best_scores(raw, members).collect()}
    names = [(r.person_id, r.name) for r in members.where(F.col("session_id") == one).collect()]
    want = {}
    for c in (r.cleaned for r in raw.collect() if r.cleaned):
        for p, n in names:
            if (s := resolve.name_score(c, n)) >= resolve.LEAST:
                want[c, p] = max(s, want.get((c, p), 0))
    assert want and got == want


def test_names_of_all_captions(spark, sf):
    from rostrum.operators import resolve
    from rostrum.plans import catalog
    from rostrum.session import table

    cases = {"Del. Ann Tarn\nDunmarrow (R7),": "Ann Tarn", "Delegate Ann Tarn\nNew Vexley (D17) |": "Ann Tarn New", "Sen Ann Tarn (R-6) ~": "Sen Ann Tarn ~", "Del. A. (Annie) Tarn-Lowe (Ash)": "Annie Tarn-Lowe Ash",
             "Tarn-Lowe, Ann (D)": "Tarn-Lowe Ann", "Ann Tarn - Yewton": "Ann Tarn", "Delegate (Ann Tarn - Yewton)": "Ann Tarn"}
    df = spark.createDataFrame(list(cases.items()), "raw string, want string").select("raw", "want", resolve.clean_name(F.col("raw")).alias("got"))
    assert [r for r in df.collect() if r.want != r.got] == []
    ids = [r.id for r in table(spark, sf, "video_index").where("type = 'legislator' AND raw_text IS NOT NULL").select("id").distinct().collect()]
    assert sorted(r.id for r in catalog.QUERIES["name_extract"](spark, sf).collect()) == sorted(ids)
