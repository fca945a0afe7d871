"""Training-data operators: goldens, brute force, round trips, and odd inputs."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rostrum.llm import bodies, packing, persons, queries, recordings, runs, subjects, tokenize, turns
from rostrum.session import table


def rows_of(spark, sf, name):
    return [r.asDict(recursive=True) for r in table(spark, sf, name).collect()]


def empty_like(spark, sf, name):
    return table(spark, sf, name).where("false")


# -- 7: tokens ---------------------------------------------------------------------------


def test_tokens_equal_the_library(spark, sf):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(tokenize.DEFAULT_VOCABULARY)
    lib.encode_special_tokens = True
    rng = random.Random(3)
    texts = [r["text"] or "" for r in rows_of(spark, sf, "documents")]
    texts += ["", " ", "<|endoftext|>", "a" * 3000, "ab" * 2000, "日本語 ñ é́", "\x00\x01\n\t 　x", "=-" * 500]
    texts += ["".join(rng.choice("aabceth 1é\n'") for _ in range(rng.randrange(60))) for _ in range(300)]
    auto = tokenize.load(tokenize.DEFAULT_VOCABULARY)
    for t in texts:
        ids = tokenize.encode_text(t)
        assert ids == lib.encode(t, add_special_tokens=False).ids
        assert auto.decode(ids).decode() == t


def test_tokens_of_null_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "Hello world", 5)], "doc_id long, text string, ids int")
    got = [tuple(r) for r in tokenize.encode_corpus(df).collect()]
    assert sorted(got) == [(1, []), (2, []), (2, [15496, 995])]
    back = tokenize.encode_corpus(df).select(tokenize.text_column(F.col("ids")).alias("t"))
    assert sorted(r.t for r in back.collect()) == ["", "", "Hello world"]


# -- 8: packing --------------------------------------------------------------------------


def best_fit(lengths, capacity):
    spaces = []
    for n in sorted(lengths, reverse=True):
        fit = [(s, i) for i, s in enumerate(spaces) if s >= n]
        if fit:
            spaces[min(fit)[1]] -= n
        else:
            spaces.append(capacity - n)
    return len(spaces)


def test_plan_equals_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(200):
        lengths = [rng.randrange(1, 31) for _ in range(rng.randrange(60))]
        hist = {n: lengths.count(n) for n in lengths}
        slots, opened = packing.plan(hist, 30)
        used = defaultdict(int)
        for n in hist:
            own = sorted(s for s in slots if s[0] == n)
            for r in range(hist[n]):
                s = max(x for x in own if x[1] <= r)
                used[s[2] + (r - s[1]) // s[3]] += n
        assert not used or (max(used.values()) <= 30 and set(used) == set(range(opened)))
        assert opened == best_fit(lengths, 30)


def test_packing_is_complete(spark):
    rng = random.Random(4)
    sizes = [(i, rng.choice([None, 0, 1, 7, 7, 7, 30, 61, 100])) for i in range(400)] + [(1, 7), (1, 7)]
    got = packing.pack(spark.createDataFrame(sizes, "doc_id long, n int"), "doc_id", "n", 30, ranked=20)
    rows = [r.asDict() for r in got.collect()]
    assert sum(r["n_units"] for r in rows) == sum(n or 0 for _, n in sizes)
    used = defaultdict(int)
    for r in rows:
        used[r["container_id"]] += r["n_units"]
    assert max(used.values()) <= 30
    assert {r["doc_id"] for r in rows} == {i for i, _ in sizes}
    assert packing.pack(spark.createDataFrame([], "doc_id long, n int"), "doc_id", "n", 30).count() == 0
    only = packing.pack(spark.createDataFrame([(1, 0), (2, None)], "doc_id long, n int"), "doc_id", "n", 30).collect()
    assert [r.container_id for r in only] == [0, 0] or {r.n_units for r in only} == {0}


# -- 1: canonical list -------------------------------------------------------------------

COMMITTEES = [(1, None, "Waterways and Harbors", "WAH", "house"), (2, 1, "Subcommittee #1", None, "house"), (3, 1, "Dredging and Locks", None, "house"), (4, None, "Roads, Rails and Ferries", "RRF", "house"), (5, None, "Waterways and Harbors", "WAH", "senate"), (6, 4, "Rail Crossings", None, "house")]


@pytest.mark.parametrize(
    "title, chamber, want",
    [
        ("House of Delegates: Waterways & Harbors on 2014-05-20 [Finished]", "house", 1),
        ("Senate of Somewhere: WAH on 2014-05-20", None, 5),
        ("Wa'terways amd Harbosr - Sub. 1 - SR A - 7:30 am", "house", 2),
        ("LIVE: Dredging &amp; L0cks Subcmte 9/1/20", "house", 3),
        ("Roads, Railt and Ferries Cmte", "house", 4),
        ("Roads, Rails", "house", 4),
        ("RRF / Rail Crossings", "house", 6),
        ("Waterways and Harbors Sub. 7", "house", 0),
        ("Roads, Rails and Ferries", "senate", 0),
        ("House Floor Session", "house", 0),
        ("Commission on Rail Heritage", "house", 0),
        ("Waterways and Harbors", None, 0),
    ],
)
def test_titles(title, chamber, want):
    assert bodies.BodyResolver(COMMITTEES).resolve(title, chamber) == want


def test_titles_odd_inputs(spark, sf):
    videos, committees = table(spark, sf, "youtube_videos"), table(spark, sf, "committees")
    ids = {r["id"] for r in rows_of(spark, sf, "youtube_videos") if (r["snippet"]["title"] or "").strip()}
    got = queries.p1_found(spark, sf).collect()
    assert {r.id for r in got} == ids and len(got) == len(ids)
    assert bodies.map_titles(videos.where("false"), committees).count() == 0
    assert {r.committee_id for r in bodies.map_titles(videos, committees.where("false")).collect()} == {0}


# -- 2: names ----------------------------------------------------------------------------

PEOPLE = [(1, "Drayford, Katherine C.", "Katherine C. Drayford"), (2, "  Drayford, Kathy ", None), (3, "Drayford, Katherine W.", "Katherine W. Drayford"), (4, "Bosctree, Robert Jr.", "Robert Bosctree, Jr."), (5, "Bosctree, Robert", "Robert Bosctree"), (6, "Ivorland, William K.", "William K. Ivorland"), (7, "Ivroland Bill", None), (8, None, None), (9, "", " ")]


def profiles(spark):
    return persons.resolve_people(spark.createDataFrame(PEOPLE, "id int, name string, name_formal string"))


def test_people(spark):
    got = sorted(map(tuple, persons.pairs(profiles(spark)).collect()))
    assert (6, 7) in got and (1, 3) not in got and (4, 5) not in got
    assert (1, 2) not in got  # Kathy fits two persons
    nobody = persons.resolve_people(spark.createDataFrame([], "id int, name string, name_formal string"))
    assert persons.pairs(nobody).count() == 0


def test_mentions(spark):
    index = persons.index_of(persons.profile_rows(profiles(spark)))
    for text, want in {
        "Del. Wiliiam Ivorland (D-7)": (6,), "IVORLAND, BILL": (6,), "SENATORIvorland": (6,), "Bil1 Ivor.land - Somewhere": (6,), "W. K. Ivorland": (6,),
        "William P. Ivorland": (), "Dr. Ivorland": (), "Roll Call Vote": (), "": (), None: (), "Robert Bosctree Jr.": (4,), "Robert Bosctree": (5,), "Katherine W. Drayford": (3,),
    }.items():
        assert index.match(text)[0] == want, text


def test_captions_enrich_profiles_and_are_rematched(spark):
    people = persons.resolve_people(spark.createDataFrame([(1, "Tarn, Nils", "Nils Tarn"), (2, "Tarn, Nathan", "Nathan Tarn")], "id int, name string, name_formal string"))

    def linked(*texts):
        links, rich = persons.link_texts(spark.createDataFrame([(t,) for t in texts], "text string"), people)
        return {r.text: r.pid for r in links.collect()}, {r.pid: r.middles for r in rich.collect()}

    # the initial that two captions tell decides a third, which fits both persons alone
    assert linked("N. C. Tarn", "Dr. Tarn") == ({}, {1: [], 2: []})
    assert linked("N. C. Tarn", "Del. Nils C. Tarn", "TARN, NILS C.") == ({"N. C. Tarn": 1, "Del. Nils C. Tarn": 1, "TARN, NILS C.": 1}, {1: ["c"], 2: []})
    assert linked() == ({}, {1: [], 2: []})


def test_screen_rows(spark, sf):
    got = queries.p2_found(spark, sf).collect()
    open_ids = {r["id"] for r in rows_of(spark, sf, "video_index") if r["type"] == "legislator" and r["linked_id"] is None and r["ignored"] != "y"}
    screen = [r for r in got if r.kind == "screen"]
    assert {r.right_id for r in screen} <= open_ids and len({r.right_id for r in screen}) == len(screen)
    # captions whose person is known are read alike
    index = persons.index_of(persons.profile_rows(persons.resolve_people(table(spark, sf, "people"))))
    known = [r for r in rows_of(spark, sf, "video_index") if r["type"] == "legislator" and r["linked_id"]]
    assert sum(index.match(r["raw_text"])[0] == (r["linked_id"],) for r in known) >= 0.95 * len(known)


# -- 3: runs -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "a, b, kind, same",
    [("HB 2O46", "HB 2046", "bill", True), ("HB 2046", "HB 2047", "bill", False), ("S8 38", "SB 3B", "bill", True), ("SB 12", "SJR 12", "bill", False),
     ("Del. Mirrshaw", "DEL. MIRRSHAW", "legislator", True), ("' Tim Caldyeo", "Tim Ca1dyeo", "legislator", True), ("Tim Caldyeo", "Rebecca Brinquist", "legislator", False),
     (None, " ", "legislator", True), (None, "x", "legislator", False)],
)
def test_same_caption(a, b, kind, same):
    assert runs.same_caption(a, b, kind) is same


def test_difference_of_row_numbers_parts_the_runs(spark):
    """One file over several chunks; captions come back, so their value alone says too little."""
    rng = random.Random(8)
    rows, texts = [], ["Ann Tarn", "Imke Oster", "Nils Harrow"]
    for i in range(900):
        last = rows[-1][4] if rows else None
        rows.append((i + 1, 7, "", f"{i + 2:08d}", last if last and rng.random() < 0.7 else rng.choice(texts), "legislator", "n"))
    df = spark.createDataFrame(rows + rows[100:140], "id long, file_id int, time string, screenshot string, raw_text string, type string, ignored string")
    got = runs.caption_runs(df).collect()
    want = []
    for r in rows:
        if want and want[-1][0] == r[4]:
            want[-1] = (r[4], want[-1][1], r[0], want[-1][3] + 1)
        else:
            want.append((r[4], r[0], r[0], 1))
    assert sorted((r.caption, r.first_id, r.last_id, r.n) for r in got) == sorted(want)
    assert len(got) > len({r.caption for r in got}) == 3  # grouping by the value alone would leave three


def brute_runs(rows):
    groups, out = defaultdict(dict), set()
    for r in rows:
        if r["ignored"] != "y":
            parts = (r["time"] or "").strip().split(":")
            ok = len(parts) == 3 and all(p.isdigit() for p in parts) and len(parts[1]) == len(parts[2]) == 2
            t = int(parts[0]) * 3600 + int(parts[1]) * 60 + int(parts[2]) if ok else int(r["screenshot"]) - 1
            groups[r["file_id"], r["type"]][r["id"]] = (t, r["id"], r["raw_text"])
    for (f, kind), g in groups.items():
        run = []
        for x in [*sorted(g.values()), None]:
            if run and x and runs.same_caption(run[-1][2], x[2], kind):
                run.append(x)
                continue
            if len(run) > 1:
                out.add((f, min(run[0][1], run[-1][1]), max(run[0][1], run[-1][1])))
            run = [x]
    return out


def test_runs_equal_brute_force(spark, sf):
    assert {tuple(r) for r in queries.p3_found(spark, sf).collect()} == brute_runs(rows_of(spark, sf, "video_index"))


def test_runs_odd_inputs(spark, sf):
    assert runs.found(empty_like(spark, sf, "video_index")).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, None, None, None), (2, 7, "x", None, "A", None, None), (2, 7, "x", None, "A", None, None), (3, 7, "9", "00000010", "A", "legislator", "n"), (4, 7, "9", "00000010", "A", "legislator", "n")], "id long, file_id int, time string, screenshot string, raw_text string, type string, ignored string")
    assert {tuple(r) for r in runs.found(odd).collect()} == {(7, 3, 4)}
    event = runs.caption_runs(odd, 2).first()
    assert (event.n, event.duration_s) == (2, 0)


# -- 4: turns ----------------------------------------------------------------------------


def test_turns(spark):
    people = spark.createDataFrame(PEOPLE, "id int, name string, name_formal string")
    rows = [
        (1, 1, "[gavel]", "00:00:01.00", "y", None), (2, 1, ">> Good morning um, members.", "00:00:02,00", "y", None), (3, 1, "Is there a motion", "00:03.00", "n", None),
        (4, 1, "SENATOR Ivorland: I move. >> Second.", "00:00:04.00", None, None), (5, 1, "(inaudible)", "00:00:05.00", "y", None), (6, 1, "Ivorland, Bill", "bad", None, None),
        (7, 1, "- Bil1 Ivorland: we-- we agree &nbsp; <i>now</i>", "00:00:06.00", "n", 6), (8, 1, ">> Bill Ivorland: again", "00:00:07.00", "y", None), (9, 1, "again", "00:00:07.00", "n", None),
        (10, 1, None, "00:00:08.00", "n", None), (2, 1, ">> Good morning um, members.", "00:00:02,00", "y", None), (20, None, "x", "00:00:01.00", "n", None),
    ]
    df = spark.createDataFrame(rows, "id long, file_id int, text string, time_start string, new_speaker string, legislator_id int")
    got = [(r.first_id, r.legislator_id, r.text) for r in turns.speaker_turns(df, people).orderBy("turn").collect()]
    assert got[0] == (2, 0, "Good morning members. Is there a motion")
    assert got[1] == (4, 6, "I move.") and got[2] == (4, 0, "Second.")
    assert got[3][:2] == (7, 6) and got[3][2].startswith("we agree now again")
    # unreadable starts are no repeats of each other
    odd = spark.createDataFrame([(1, 5, "Thank you.", s, "y", None) if i == 0 else (i + 1, 5, t, s, "y", None) for i, (t, s) in enumerate([("Thank you.", "x"), ("No, wait.", "x"), ("Thank you.", "x"), ("Thank you.", None)])], df.schema)
    assert [(r.first_id, r.text) for r in turns.speaker_turns(odd, people).orderBy("turn").collect()] == [(1, "Thank you."), (2, "No, wait."), (3, "Thank you."), (4, "Thank you.")]
    assert turns.found(df.where("false"), people).count() == 0


# -- 6: recordings -----------------------------------------------------------------------


def test_recordings_equal_brute_force(spark, sf):
    committees = table(spark, sf, "committees")
    reader = recordings.TitleReader(bodies.committee_rows(committees))
    by_id = {r["id"]: r for r in rows_of(spark, sf, "files") if (r["title"] or "").strip()}
    groups, want = defaultdict(list), set()
    for i in sorted(by_id):
        chamber, body, topic, portion, day = reader.read(by_id[i]["title"], by_id[i]["chamber"])
        groups[chamber, day or by_id[i]["date"], body, portion].append((i, topic))
    for g in groups.values():
        comps = []
        for i, t in g:
            hit = [c for c in comps if any(recordings.same_topic(t, u) for _, u in c)]
            comps = [c for c in comps if c not in hit] + [[(i, t), *(x for c in hit for x in c)]]
        want |= {(min(c)[0], i) for c in comps for i, _ in c if i != min(c)[0]}
    for rounds in (1, 3):
        got = recordings.find_repeats(table(spark, sf, "files"), committees, rounds=rounds)
        assert {tuple(r) for r in got.collect()} == want


def test_recordings_batches(spark):
    committees = spark.createDataFrame(COMMITTEES, "id int, parent_id int, name string, shortname string, chamber string")
    d, c = dt.date(2020, 1, 2), dt.datetime(2020, 1, 3)
    rows = [(1, "house", "Waterways and Harbors, Briefing on winter deeds", d, c), (2, "House", "WAH - winter decds Briefing on January 2, 2020", dt.date(2020, 1, 3), c), (3, "house", "Waterways and Harbors - Markup: rural jails", d, c),
            (4, None, "House Waterways & Harbors: winter deeds Briefing", d, dt.datetime(2021, 1, 1)), (5, "house", None, d, c), (6, "house", "  ", d, c), (7, "senate", "Waterways and Harbors, Briefing on winter deeds", d, c), (8, "house", "WAH Part 1", d, c), (9, "house", "Waterways and Harbors Pt. I", d, c), (10, "house", "WAH Part 2", d, None)]
    df = spark.createDataFrame(rows, "id int, chamber string, title string, date date, date_created timestamp_ntz")
    got = {tuple(r) for r in recordings.find_repeats(df, committees).collect()}
    assert got == {(1, 2), (1, 4), (8, 9)}
    assert recordings.find_repeats(df.where("false"), committees).count() == 0


def test_store_is_opened_again(spark, tmp_path):
    """Each batch by a store of its own on the same path; a bridge joins what was apart."""
    committees = spark.createDataFrame(COMMITTEES, "id int, parent_id int, name string, shortname string, chamber string")
    d = dt.date(2020, 1, 2)
    title = "Waterways and Harbors, Briefing on {}"
    topics = ["winter deeds", "winter deedxy", "winter deedx", "summer fees", "winter deeds", None]
    rows = [(i + 1, "house", title.format(t) if t else None, d, dt.datetime(2020, 1, 3 + i)) for i, t in enumerate(topics)]
    df = spark.createDataFrame(rows, "id int, chamber string, title string, date date, date_created timestamp_ntz")
    read = recordings.read_titles(df, committees).cache()
    apart, all_at_once = not recordings.same_topic(topics[0], topics[1]), recordings.RecordingStore(spark)
    for i in range(6):
        out = recordings.RecordingStore(spark, str(tmp_path / "store"), fan=2).admit(read.where(F.col("id") == i + 1))
        if i == 1:
            assert [r.recording_id for r in out.collect()] == [2 if apart else 1]
    again = recordings.RecordingStore(spark, str(tmp_path / "store"), fan=2)
    got = {r.id: r.recording_id for r in again.members().collect()}
    all_at_once.admit(read)
    assert got == {r.id: r.recording_id for r in all_at_once.members().collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1}
    version, live = again.runs()
    assert version == 5 and len(live) < 5  # runs were compacted
    # only the parts that a filter lets through are opened: a record of another day hits none
    other = read.where("id = 1").withColumns({"day": F.lit(dt.date(2021, 5, 5)), "id": F.lit(50)})
    assert [r.recording_id for r in again.admit(other).collect()] == [50]


@pytest.mark.parametrize("buckets", [1, 3])
def test_components_equal_search(spark, buckets):
    rng = random.Random(5)
    edges = [(key, *(key * 1000 + rng.randrange(80) for _ in "ab")) for key in range(-2, 6) for _ in range(40)]
    near = defaultdict(set)
    for _, a, b in edges:
        near[a].add(b), near[b].add(a)
    want = {}
    for node in sorted(near):
        reached = [] if node in want else [node]
        while reached:
            if (n := reached.pop()) not in want:
                want[n] = node
                reached += near[n]
    got = recordings.components(spark.createDataFrame(edges, "key long, a long, b long"), buckets).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == set(want.items())


def test_long_chain_of_misreadings_takes_no_more_jobs(spark, monkeypatch):
    """Each topic is an edit from the next; joins repeated until nothing moves took a round for every few of them."""
    rng, word, topics = random.Random(3), list("abcdefghijklmnopqrst"), []
    for i in range(400):
        word[i % 20] = chr(97 + (ord(word[i % 20]) - 97 + 7) % 26)
        topics.append("".join(word))
    ids = rng.sample(range(1, 401), 400)
    df = spark.createDataFrame([(i, "house", "1", t, "", dt.date(2020, 1, 2)) for i, t in zip(ids, topics)], "id int, chamber string, body string, topic string, portion string, day date")
    cuts, real = [], recordings.cut

    def counted(*args):
        assert len(cuts) < 12, "rounds follow the chain"
        cuts.append(real(*args))
        return cuts[-1]

    monkeypatch.setattr(recordings, "cut", counted)
    store = recordings.RecordingStore(spark)
    odd = F.col("id") % 2 == 1
    apart = {r.recording_id for r in store.admit(df.where(odd)).collect()}
    cuts.clear()
    store.admit(df.where(~odd))
    assert len(apart) > 1 and {r.recording_id for r in store.members().collect()} == {1}


# -- 9: subjects -------------------------------------------------------------------------


def test_subjects(spark):
    rng = random.Random(1)
    terms = {
        "farming": "apple orchards;dairy cattle;soil vouchers;grain silos", "roads": "bridge tolls;ferry routes;highway signs;truck lanes", "health": "nurse ratios;dental cover;vaccine stocks;opioid clinics",
        "courts": "jury summons;bail bonds;prison terms;judge vacancies", "energy": "solar panels;coal plants;pipeline leaks;turbine leases", "tax": "levy caps;refund delays;bond ratings;estate duties",
    }
    names = sorted(terms)
    fill = ["The committee met about {}.", "Witnesses spoke on {} today.", "Nobody had counted {} before."]
    docs, labels = [], []
    for i in range(240):
        s, other = names[i % 6], names[(i + 1) % 6]
        text = " ".join(rng.choice(fill).format(rng.choice(terms[s].split(";"))) for _ in range(5)) + f" Someone asked in passing about {rng.choice(terms[other].split(';'))}."
        docs.append((i, text, "en"))
        if i < 60:
            labels.append((i, s))
    docs += [(500, None, "en"), (501, "", None), (502, "  ", "en"), (503, "Copies are available. The room is closed.", "en")]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    areas = spark.createDataFrame([*((n, None) for n in names[1:]), (names[0], "Judges and juries"), (None, None)], "subject string, description string")
    lab = spark.createDataFrame([*labels, (0, "unknown"), (None, "roads"), (9999, "roads"), labels[0]], "doc_id long, subject string")
    got = {(r.doc_id, r.subject) for r in subjects.found(d, areas, lab).collect()}
    want = {(i, names[i % 6]) for i in range(240)}
    assert len(got ^ want) <= 4 and all(i < 240 for i, _ in got)
    # seeds are trusted where their document bears them out, and clamped there
    wrong = lab.unionByName(spark.createDataFrame([(7, names[4])], "doc_id long, subject string"))
    graph = subjects.SubjectGraph(d, areas, wrong)
    graph.trust(graph.start())
    trusted = {(r.doc_id, names[r.z]) for r in graph.seeds.collect()}
    assert len(trusted) >= 55 and (7, names[4]) not in trusted and trusted <= set(labels)
    scores = graph.start()
    assert {(r.doc_id, names[r.z]) for r in graph.clamped(scores).where("q = 1").collect()} >= trusted
    assert trusted <= {(r.doc_id, r.subject) for r in graph.assign(scores).collect()}
    assert subjects.found(d.where("false"), areas, lab).count() == 0
    assert subjects.found(d, areas, lab.where("false")).count() >= 0
    assert subjects.found(d, areas.where("false"), lab).count() == 0
