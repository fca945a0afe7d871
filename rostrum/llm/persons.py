"""Variant spellings of names typed by people.

Parsing: a spelling is read into surname, first-name forms, initials and suffix,
whatever the order, case, abbreviation or misspelling.

Resolution is merge-and-rematch: records are blocked on misspelling-tolerant surname
keys and compared with the merged profiles of their block, the fullest records first;
a record that fits exactly one profile is merged into it, which unions spellings and
initials; the richer profiles re-enter blocking, until a round merges nothing.

Captions are records too: each distinct one is blocked with the profiles, merged into the
one it fits, and what it tells enriches the profile for the captions still open and for
another merging of people. Labels of transcripts are matched against the resolved
profiles, a reference table of bounded size (MAX_PROFILES, checked).

Defined results: NULL and blank names resolve to nobody; a spelling that fits several
persons equally well is linked to none of them; other initials or another suffix are
another person (relatives, namesakes); spellings of an outside title (Dr., Mayor, Ms.)
and roles name no member.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.llm.bodies import distance, fold
from rostrum.session import cut, materialize

MAX_PROFILES = 200_000

# Well-known short forms of first names.
NICKNAMES = """
abigail abby gail; alexander alex sasha al; andrew andy drew; andres andy; anthony tony; benjamin ben benny; catherine cathy kate;
charles charlie chuck chas; christopher chris kit; daniel dan danny; deborah debbie deb; dorothea dottie dot dora dolly;
edward ed eddie ned ted; eleanor nell ellie nora; elizabeth betsy liz beth betty; frederick fred freddie; gerald gerry jerry;
gregory greg; harold hal harry; imogen immy; james jim jimmy jas; jennifer jenny jen; john jack johnny jno; joseph joe joey;
katherine kathy kate kay kitty; kenneth ken kenny; lawrence larry; leonard len lenny leo; margaret peggy maggie meg marge;
matthew matt; michael mike mick; nathaniel nate nat; nicholas nick; obadiah obie; patricia trish pat patty; penelope penny;
peter pete; philip phil pip; priscilla cilla prissy; quentin quin; rebecca becky becca; renee ren; richard dick rick rich;
robert bob rob bobby; ronald ron ronnie; samuel sam sammy; stephanie steph; susan sue susie; theodore ted theo teddy;
thomas tom tommy thos; timothy tim; ursula ursi; victoria vicky tori; vincent vince vinny; walter walt wally;
william bill will billy wm; yolanda yoli; zachary zach zack
"""
SHORT: dict[str, set[str]] = {}
for _line in NICKNAMES.split(";"):
    _full, *_rest = _line.split()
    for _n in _rest:
        SHORT.setdefault(_n, set()).add(_full)

SUFFIXES = {"jr": "jr", "sr": "sr", "ii": "ii", "iii": "iii", "iv": "iv"}
MEMBER_TITLES = ("delegate", "senator", "del", "sen", "chair", "chairman", "chairwoman", "rep", "representative")
OUTSIDE_TITLES = {"dr", "mayor", "ms", "mr", "mrs", "prof", "professor", "rev", "reverend", "judge", "sheriff", "secretary", "commissioner", "chief", "director", "rabbi", "pastor", "councilman", "supervisor"}
HONORS = {"the", "hon", "honorable"}

_MISREAD = str.maketrans("0158692|", "olsbbqzl")


def letters(word: str) -> str:
    """A folded word's letters, digits read as the letters they are mistaken for."""
    return re.sub(r"[^a-z]", "", word.translate(_MISREAD))


class Spelling:
    """One way to write a name: title, surname given apart (comma), words, suffix."""

    __slots__ = ("title", "words", "comma", "suffix", "party", "district", "outside", "nick")

    def __init__(self, text: str):
        self.title = self.suffix = self.party = self.nick = ""
        self.district, self.outside, self.comma = 0, False, False
        text = fold(text).strip()
        text = re.sub(r"[’`']", "", text)
        if m := re.search(r"\(\s*([drip])?\s*[-.]?\s*(\d{1,3})\s*\)", text):
            self.party, self.district = m[1] or "", int(m[2])
        elif m := re.search(r"\(\s*([drip])?\s*\)", text):
            self.party = m[1] or ""
        if m := re.search(r"\bdist\w*\s+(\d{1,3})\b", text):
            self.district = int(m[1])
        head = text.split("\n")[0]
        if m := re.search(r'["“(]\s*([a-z.\']{2,})\s*["”)]', head):
            self.nick = "" if re.fullmatch(r"[drip]{1,2}", letters(m[1])) else letters(m[1])
        head = re.sub(r'\([^)]*\)?|"[^"]*"', " ", head)
        head = re.sub(r",\s*\S{5,10}\s+\d{1,3}\W*$|\bdistrict\s+\d+\W*$|,\s*vice\b.*$|,\s*[a-z.]{3,6}\s+[a-z.]*h[a-z.]*\W*$(?<=[rt.])", " ", head)
        head = re.split(r"\s[-–|~]+\s|(?<=[a-z.]\s)\s*(?:[o0][a-z]|[a-z]f|off|f)\s+(?=[a-z])|\s*\|\s*(?=\S)|\s[-–]\s*$", re.sub(r"^[\s|~_.\-–,:;]+", "", head))[0]
        head = re.sub(r"(?<=[a-z])[.,](?=[a-z]{2})", lambda m: m[0] if m[0] == "," else "", head) if "," not in head or ", " in head else head
        head = re.sub(r"(?<=\b[a-z])\.(?=[a-z]\b)", ". ", head)
        head = re.sub(r"\s,(?=\S)", " ", head)
        before, comma, after = head.partition(", " if ", " in head else ",")
        tail = [letters(w) for w in after.split()]
        if comma and tail and all(w in SUFFIXES or not w for w in tail):
            self.suffix = next((w for w in tail if w), "")
            comma, after = "", ""
        read = lambda part: [w[:1] if len(w) == 2 and w[0] == w[1] else w for w in (letters(x) for x in part.split() if re.search(r"[a-z0-9]", x)) if w]
        first, second = read(before), read(after)
        first = [w for w in first if w not in HONORS]
        first = self._untitle(first)
        out = []
        for w in first + second:
            if w in SUFFIXES and len(first + second) > 1:
                self.suffix = w
            else:
                out.append(w)
        self.comma = bool(comma and second and first)
        self.words = ([("".join(w for w in first if w not in SUFFIXES))] + [w for w in second if w not in SUFFIXES]) if self.comma else out

    def _untitle(self, words: list[str]) -> list[str]:
        while words:
            w = words[0]
            if w in OUTSIDE_TITLES:
                self.outside = True
                return words[1:]
            if len(words) == 1:
                return words
            if w in MEMBER_TITLES:
                found = w
            elif len(w) >= 6:
                found = next((t for t in ("delegate", "senator") if distance(w, t, 2) <= 2), "")
            elif 2 <= len(w) <= 4:
                found = next((t for t in ("del", "sen") if distance(w, t, 1) <= 1 and w not in SHORT and len(w) + len(t) >= 5), "")
            else:
                found = ""
            if 4 <= len(w) <= 6 and not found:
                found = "chair" if distance(w, "chair", 1) <= 1 else ""
            if not found:
                return words
            self.title = self.title or ("del" if found[0] == "d" else "sen" if found[0] == "s" else found)
            words = words[1:]
        return words


def first_name_fits(word: str, firsts: set[str], nicks: set[str]) -> float:
    """How well a word stands for one of the first names: 1 exact or known short form,
    less for abbreviations and misspellings, 0 if not."""
    if word in firsts or word in nicks or SHORT.get(word, set()) & firsts:
        return 1.0
    best = 0.0
    for f in firsts:
        if len(word) == 1:
            best = max(best, 0.7 if f[0] == word else 0)
        elif len(f) == 1:
            full = SHORT.get(word, {word})
            best = max(best, 0.7 if any(x[0] == f for x in full) or word[0] == f else 0)
        else:
            if 2 <= len(word) < len(f) and f.startswith(word):
                best = max(best, 0.9)
            elif 2 <= len(word) <= 5 and len(word) < len(f) and word[0] == f[0] and _within(word, f) and word not in SHORT:
                best = max(best, 0.85)
            most = 1 if min(len(word), len(f)) < 7 else 2
            if min(len(word), len(f)) >= 4 and distance(word, f, most) <= most:
                best = max(best, 0.8)
            if len(word) >= 3 and len(f) > len(word) and distance(word, f[: len(word)], 1) <= 1 and word[0] == f[0] and word not in SHORT:
                best = max(best, 0.6)
    for n in nicks | {s for s, fulls in SHORT.items() if fulls & firsts}:
        if min(len(word), len(n)) >= 3 and (distance(word, n, 1) <= 1 if len(n) < 7 else distance(word, n, 2) <= 2):
            best = max(best, 0.6)
        elif 2 <= len(n) <= 3 and len(word) >= 2 and word[0] == n[0] and distance(word, n, 1) <= 1:
            best = max(best, 0.5)
    return best


def _within(short: str, long: str) -> bool:
    it = iter(long)
    return all(c in it for c in short)


def surname_edits(n: int) -> int:
    return 0 if n < 4 else 1 if n < 7 else 2


class Profile:
    """Union of the spellings of one person."""

    def __init__(self, ids=()):
        self.ids: set[int] = set(ids)
        self.surnames: dict[str, int] = {}
        self.firsts: set[str] = set()
        self.nicks: set[str] = set()
        self.middles: set[str] = set()
        self.suffixes: set[str] = set()
        self.clean = False

    def merge(self, o: Profile) -> None:
        self.ids |= o.ids
        for s, n in o.surnames.items():
            self.surnames[s] = self.surnames.get(s, 0) + n
        self.firsts |= o.firsts
        self.nicks |= o.nicks
        self.middles |= o.middles
        self.suffixes |= o.suffixes
        self.clean |= o.clean

    def full(self) -> int:
        return 4 * self.clean + 2 * any(len(f) > 4 for f in self.firsts) + bool(self.middles) + bool(self.suffixes)


def read_profile(id_: int, name: str | None, formal: str | None, lexicon: set[str]) -> Profile:
    """A record's profile. lexicon: first names of the list, to tell the order of words."""
    p = Profile([id_])
    is_first = lambda w: w in lexicon or w in SHORT or len(w) == 1 or any(2 <= len(w) < len(f) and (f.startswith(w) or (w[0] == f[0] and len(w) <= 4 and _within(w, f))) for f in lexicon)
    for text in (name, formal):
        if not text or not text.strip():
            continue
        s = Spelling(text)
        words = list(s.words)
        if not words:
            continue
        if s.comma:
            surname, rest = words[0], words[1:]
        else:
            at = len(words) - 1
            if len(words) > 1 and is_first(words[-1]) and not is_first(words[0]):
                at = 0
            surname, rest = words[at], words[:at] + words[at + 1 :]
        p.surnames[surname] = p.surnames.get(surname, 0) + 1
        longs = [w for w in rest if len(w) > 1]
        ones = [w for w in rest if len(w) == 1]
        if longs:
            p.firsts |= SHORT.get(longs[0], set()) if longs[0] in SHORT and longs[0] not in lexicon else {longs[0]}
            p.middles |= set(ones)
            if longs[0] in SHORT:
                p.nicks.add(longs[0])
        elif ones:
            p.firsts.add(ones[0])
            p.middles |= set(ones[1:])
        if s.nick:
            p.nicks.add(s.nick)
        if s.suffix:
            p.suffixes.add(SUFFIXES[s.suffix])
    long_firsts = {f for f in p.firsts if len(f) > 1}
    if long_firsts:
        p.firsts = long_firsts
    p.clean = bool(p.firsts) and all(f in lexicon for f in p.firsts) and len(p.surnames) == 1 and not re.search(r"[^\w\s,.\"'-]|^\s|[A-Z]{4}|,\S", (name or "x").strip("")) and not (p.nicks and not (formal and '"' in formal))
    return p


def same_person(a: Profile, b: Profile) -> float:
    """Score in (0, 1] if the profiles can be one person, else 0."""
    best = 0.0
    for s in a.surnames:
        for t in b.surnames:
            most = surname_edits(min(len(s), len(t)))
            d = distance(s, t, most)
            if d <= most:
                best = max(best, 1 - 0.15 * d)
    if not best or not a.firsts or not b.firsts:
        return 0.0
    fit = max(max(first_name_fits(w, b.firsts, b.nicks) for w in a.firsts), max(first_name_fits(w, a.firsts, a.nicks) for w in b.firsts))
    if not fit:
        return 0.0
    if a.middles and b.middles and not a.middles & b.middles:
        return 0.0
    if a.suffixes and b.suffixes and not a.suffixes & b.suffixes:
        return 0.0
    if bool(a.suffixes) != bool(b.suffixes):
        if a.clean and b.clean:
            return 0.0
        best -= 0.2
    if a.clean and b.clean and best < 1:
        return 0.0  # two well-written records of other surnames
    if a.clean and b.clean and bool(a.middles) != bool(b.middles):
        best -= 0.1
    return best * fit


def block_keys(surname: str) -> set[str]:
    """A surname and what remains when one letter is lost."""
    return {surname} | {surname[:i] + surname[i + 1 :] for i in range(len(surname))}


def swoosh(profiles: list[Profile]) -> list[Profile]:
    """Merges the profiles of one block, fullest first, into those they alone fit."""
    merged: list[Profile] = []
    for p in sorted(profiles, key=lambda q: (-q.full(), min(q.ids))):
        fits = sorted(((same_person(p, m), -min(m.ids), m) for m in merged), key=lambda x: (-x[0], x[1]))
        fits = [f for f in fits if f[0] > 0]
        if fits and (len(fits) == 1 or fits[0][0] > fits[1][0] + 0.05):
            fits[0][2].merge(p)
        else:
            q = Profile()
            q.merge(p)
            merged.append(q)
    return merged


_PROFILE = "pid long, ids array<long>, surnames array<string>, firsts array<string>, nicks array<string>, middles array<string>, suffixes array<string>, clean boolean"


def _to_row(p: Profile) -> dict:
    return {"pid": min(p.ids), "ids": sorted(p.ids), "surnames": sorted(p.surnames), "firsts": sorted(p.firsts), "nicks": sorted(p.nicks), "middles": sorted(p.middles), "suffixes": sorted(p.suffixes), "clean": p.clean}


def _of_row(r) -> Profile:
    p = Profile(int(i) for i in r["ids"])
    p.surnames = {s: 1 for s in r["surnames"]}
    p.firsts, p.nicks, p.middles, p.suffixes, p.clean = set(r["firsts"]), set(r["nicks"]), set(r["middles"]), set(r["suffixes"]), bool(r["clean"])
    return p


def lexicon_of(people: DataFrame) -> set[str]:
    """First names of well-written records (Surname, First ...), by frequency."""
    rows = (
        people.where("name IS NOT NULL")
        .select(F.lower(F.regexp_extract("name", r"^\s*[^,]+,\s*([^\s.,]{3,})(?:\s|$)", 1)).alias("f"))
        .where("f <> ''")
        .groupBy("f")
        .count()
        .where("count > 1 OR length(f) > 4")
        .orderBy(F.desc("count"), "f")
        .limit(MAX_PROFILES + 1)
        .collect()
    )
    if len(rows) > MAX_PROFILES:
        raise ValueError(f"more than {MAX_PROFILES} first names")
    return first_lexicon([(r["f"], r["count"]) for r in rows])


def first_lexicon(counts: list[tuple[str, int]]) -> set[str]:
    """Full first names among (word, count): no short forms, abbreviations or misspellings of more frequent words."""
    often = {letters(fold(f)) for f, n in counts if n > 1}
    out = set()
    for f, n in counts:
        w = letters(fold(f))
        if w in SHORT or any(len(f) < len(o) and o.startswith(f) for o, _ in counts):
            continue
        if n > 1 or not any(distance(w, o, 2) <= 2 for o in often):
            out.add(w)
    return out


def resolve_people(people: DataFrame) -> DataFrame:
    """Profiles of distinct persons (pid = lowest id, ids = all ids, and their spellings)."""
    lexicon = lexicon_of(people)
    one = people.select(F.col("id").cast("long").alias("id"), "name", "name_formal").where("id IS NOT NULL").dropDuplicates(["id"])

    def read(batches):
        for pdf in batches:
            yield pd.DataFrame([_to_row(read_profile(int(i), n, f, lexicon)) for i, n, f in zip(pdf["id"], pdf["name"], pdf["name_formal"])], columns=[c.split()[0] for c in _PROFILE.split(", ")])

    return merge_profiles(cut(one.mapInPandas(read, _PROFILE)))


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """profiles merged with those of the same person, round by round until none merges."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(i, min(m.ids)) for m in swoosh([_of_row(r) for r in pdf.to_dict("records")]) for i in {int(x) for x in pdf["pid"]} & m.ids if i != min(m.ids)]
        return pd.DataFrame(out, columns=["pid", "to"])

    while True:
        # blocks hold the misspellings of one surname; a profile re-enters under all its surnames
        keyed = profiles.select("pid", F.explode(F.array_distinct(F.flatten(F.transform("surnames", deletion_keys)))).alias("_key"))
        # many keys give the same block: it is compared once
        blocks = keyed.groupBy("_key").agg(F.sort_array(F.collect_set("pid")).alias("_pids")).where(F.size("_pids") > 1).select("_pids").distinct()
        members = blocks.select(F.xxhash64("_pids").alias("_block"), F.explode("_pids").alias("pid"))
        found = members.join(profiles, "pid").groupBy("_block").applyInPandas(links, "pid long, to long").distinct()
        votes = cut(found.groupBy("pid").agg(F.min("to").alias("to"), F.countDistinct("to").alias("n")).where("n = 1").select("pid", "to"))
        if votes.isEmpty():
            break
        # a target may itself be merged elsewhere this round: follow one step, the next rounds do the rest
        up = votes.select(F.col("pid").alias("to"), F.col("to").alias("up"))
        moved = votes.join(up, "to", "left").select("pid", F.coalesce("up", "to").alias("to"))
        profiles = cut(
            profiles.join(moved, "pid", "left")
            .groupBy(F.coalesce("to", "pid").alias("_g"))
            .agg(
                *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("ids", "surnames", "firsts", "nicks", "middles", "suffixes")),
                F.max("clean").alias("clean"),
            )
            .select(F.array_min("ids").alias("pid"), "ids", "surnames", "firsts", "nicks", "middles", "suffixes", "clean")
        )
    return profiles


def pairs(profiles: DataFrame) -> DataFrame:
    """(left_id, right_id) of all rows of one person; a person's rows are few."""
    one = profiles.where(F.size("ids") > 1)
    return one.select(F.explode("ids").alias("left_id"), "ids").select("left_id", F.explode("ids").alias("right_id")).where("left_id < right_id")


class PersonIndex:
    """Finds the persons a mention can mean."""

    def __init__(self, rows: list[dict]):
        self.people = {r["pid"]: _of_row(r) for r in rows}
        self.by_key: dict[str, set[str]] = {}
        self.by_surname: dict[str, set[int]] = {}
        self.first_words = {f for p in self.people.values() for f in p.firsts | p.nicks if len(f) > 2} | set(SHORT)
        for pid, p in self.people.items():
            for s in p.surnames:
                self.by_surname.setdefault(s, set()).add(pid)
        for s in self.by_surname:
            for k in block_keys(s) | (set().union(*(block_keys(k) for k in block_keys(s))) if surname_edits(len(s)) == 2 else set()):
                self.by_key.setdefault(k, set()).add(s)
        self._near: dict[str, dict[str, int]] = {}
        self._memo: dict[str, tuple] = {}

    def near(self, word: str) -> dict[str, int]:
        """Known surnames that the word can be, with the edits between."""
        got = self._near.get(word)
        if got is None:
            got = {}
            if len(word) >= 3:
                most = surname_edits(len(word))
                pool = set().union(*(self.by_key.get(k, set()) for k in (block_keys(word) if most else {word})))
                if most == 2:
                    pool |= set().union(*(self.by_key.get(k2, set()) for k in block_keys(word) for k2 in block_keys(k)))
                for s in pool:
                    d = distance(word, s, most)
                    if d <= min(most, surname_edits(len(s))):
                        got[s] = d
            if len(self._near) > 300_000:
                self._near.clear()
            self._near[word] = got
        return got

    def match(self, text: str | None) -> tuple[tuple[int, ...], str, str, int]:
        """(ids of the persons that fit best, title, party, district)"""
        if not text or not text.strip():
            return (), "", "", 0
        got = self._memo.get(text)
        if got is None:
            if len(self._memo) > 300_000:
                self._memo.clear()
            got = self._memo[text] = self._match(text)
        return got

    def _match(self, text: str) -> tuple[tuple[int, ...], str, str, int]:
        ids, s = self._of(Spelling(text))
        if not ids and re.search(r"\w,\w", text):  # a mark inside a word, not the comma of an order
            again, t = self._of(Spelling(re.sub(r"(?<=\w),(?=\w)", "", text)))
            if again:
                ids, s = again, t
        return ids, s.title, s.party, s.district

    def _of(self, s: Spelling) -> tuple[tuple[int, ...], Spelling]:
        if s.outside or not s.words:
            return (), s
        tries = [s.words, *run_in(s.words)]
        best: dict[int, float] = {}
        for k, words in enumerate(tries):
            for pid, score in self._score(words, s).items():
                best[pid] = max(best.get(pid, 0), score - 0.05 * (k > 0))
        if not best:
            return (), s
        top = max(best.values())
        return tuple(sorted(p for p, v in best.items() if v >= top - 0.04)), s

    def _score(self, words: list[str], s: Spelling) -> dict[int, float]:
        out: dict[int, float] = {}
        n = len(words)
        for i in range(n):
            for j in (i + 1, i + 2):
                if j > n or (s.comma and i > 0):
                    continue
                word, rest = "".join(words[i:j]), words[:i] + words[j:]
                if j == i + 2 and min(len(w) for w in words[i:j]) < 3:
                    continue
                if rest and not s.comma and 0 < i and j < n:
                    continue  # a surname stands first or last
                for surname, d in self.near(word).items():
                    if d and len(word) < 9 and word in self.first_words and rest:
                        continue
                    for pid in self.by_surname[surname]:
                        v = self._fit(self.people[pid], rest, s)
                        if v:
                            out[pid] = max(out.get(pid, 0), v - 0.12 * d)
        return out

    @staticmethod
    def _fit(p: Profile, rest: list[str], s: Spelling) -> float:
        score = 1.0
        if s.suffix and SUFFIXES[s.suffix] not in p.suffixes:
            return 0.0
        if not s.suffix and p.suffixes:
            score -= 0.06
        longs, ones = [w for w in rest if len(w) > 1], [w for w in rest if len(w) == 1]
        if s.nick:
            fit = first_name_fits(s.nick, p.firsts, p.nicks)
            if not fit:
                return 0.0
            score += 0.1 * fit
        used_first = False
        for w in longs:
            fit = first_name_fits(w, p.firsts, p.nicks)
            if not fit:
                return 0.0
            used_first, score = True, score - 0.2 * (1 - fit)
        for k, w in enumerate(ones):
            if not used_first and k == 0:
                if not any(f[0] == w for f in p.firsts) and not any(x[0] == w for x in p.nicks):
                    return 0.0
                used_first, score = True, score - 0.02
            elif p.middles and w not in p.middles:
                return 0.0
            else:
                score += 0.05 if w in p.middles else -0.05
        return score


@lru_cache(maxsize=4)
def _index(key: int, rows: tuple) -> PersonIndex:
    return PersonIndex([dict(zip(("pid", "ids", "surnames", "firsts", "nicks", "middles", "suffixes", "clean"), r)) for r in rows])


def profile_rows(profiles: DataFrame) -> tuple:
    """The resolved list for the workers; refused beyond MAX_PROFILES."""
    rows = profiles.select("pid", "ids", "surnames", "firsts", "nicks", "middles", "suffixes", "clean").limit(MAX_PROFILES + 1).collect()
    if len(rows) > MAX_PROFILES:
        raise ValueError(f"more than {MAX_PROFILES} persons")
    return tuple(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in sorted(rows))


def index_of(rows: tuple) -> PersonIndex:
    return _index(hash(rows), rows)


# -- captions as records -------------------------------------------------------------------


def spellings_of(text: str) -> list[Spelling]:
    """The ways to read a text: as it stands, then, with a mark inside a word, without it."""
    return [Spelling(text)] + ([Spelling(re.sub(r"(?<=\w),(?=\w)", "", text))] if re.search(r"\w,\w", text) else [])


def surname_words(s: Spelling) -> list[tuple[str, list[str], int]]:
    """(word, other words, 1 if a title ran into the first word) of the words of a spelling
    that can be the surname: the first or last, or two halves of it."""
    if s.outside or not s.words:
        return []
    tries = [(s.words, 0)] + [(words, 1) for words in run_in(s.words)]
    out = []
    for words, k in tries:
        n = len(words)
        for i in range(n):
            for j in (i + 1, i + 2):
                if j > n or (s.comma and i > 0) or (j == i + 2 and min(len(w) for w in words[i:j]) < 3):
                    continue
                rest = words[:i] + words[j:]
                if not (rest and not s.comma and 0 < i and j < n):
                    out.append(("".join(words[i:j]), rest, k))
    return out


def run_in(words: list[str]) -> list[list[str]]:
    """The words without a title that is run into the first of them."""
    w, out = words[0], []
    for t in ("delegate", "senator", "del", "sen", "chair") if len(w) > 6 else ():
        for n in (len(t), len(t) - 1, len(t) + 1):
            if n >= 3 and len(w) - n >= 4 and distance(w[:n], t, 1 + (len(t) > 6)) <= (0 if len(t) < 5 else 1 + (len(t) > 6)):
                out.append([w[n:], *words[1:]])
    return out


def fit_of(s: Spelling, p: Profile, near: dict[str, int], first_words: set[str]) -> tuple[float, list[str], list[str]]:
    """How well a spelling fits a profile (0: not), and the initials and short names it adds.
    near: edits between the spelling's words and the profile's surnames."""
    best, rest_of = 0.0, []
    for word, rest, k in surname_words(s):
        d = near.get(word)
        if d is None or (d and len(word) < 9 and word in first_words and rest):
            continue
        v = PersonIndex._fit(p, rest, s)
        if v and v - 0.12 * d - 0.05 * k > best:
            best, rest_of = v - 0.12 * d - 0.05 * k, rest
    ones = [w for w in rest_of if len(w) == 1]
    longs = [w for w in rest_of if len(w) > 1]
    return best, ones if longs else ones[1:], [s.nick] if s.nick and best else []


def _deletions(word):
    """The word with one letter less, for each of its letters."""
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))


def deletion_keys(word):
    """Keys of which words share one if they are within the edits that surnames forgive:
    the word, and what is left without one letter, or two of seven or more."""
    one = _deletions(word)
    two = F.when(F.length(word) >= 7, F.flatten(F.transform(one, _deletions))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(word), F.when(F.length(word) >= 4, F.concat(one, two)).otherwise(F.array().cast("array<string>"))))


_TRY = T.ArrayType(T.StructType([T.StructField("reading", T.IntegerType()), T.StructField("word", T.StringType())]))
_FIT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("middles", T.ArrayType(T.StringType())), T.StructField("nicks", T.ArrayType(T.StringType()))])


def link_texts(texts: DataFrame, profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text, pid) of distinct texts that name one person, and the profiles enriched by them.

    Texts are records: blocked with the profiles on deletion keys of the words that can be
    surnames, verified in pairs of text and profile, and merged into the one profile they fit
    best. Merging unions initials (told by two texts) and short names into the profile; the
    enriched profiles meet the texts still open again, until a round links none.
    """
    first_words = {f for r in profiles.select(F.explode(F.array_union("firsts", "nicks")).alias("f")).where("length(f) > 2").distinct().limit(MAX_PROFILES).collect() for f in [r["f"]]} | set(SHORT)

    @F.arrow_udf(_TRY)
    def tries(column: pa.Array) -> pa.Array:
        rows = ({(i, w) for i, s in enumerate(spellings_of(t)) for w, _, _ in surname_words(s) if len(w) >= 3} for t in column.to_pylist())
        return pa.array([[{"reading": i, "word": w} for i, w in sorted(r)] for r in rows], pa.list_(pa.struct([("reading", pa.int32()), ("word", pa.string())])))

    @F.arrow_udf(T.IntegerType())
    def edits(a: pa.Array, b: pa.Array) -> pa.Array:
        most = [(x, y, min(surname_edits(len(x)), surname_edits(len(y)))) for x, y in zip(a.to_pylist(), b.to_pylist())]
        got = [(distance(x, y, m), m) for x, y, m in most]
        return pa.array([d if d <= m else None for d, m in got], pa.int32())

    said = cut(texts.select("text", F.explode(tries("text")).alias("t")).select("text", "t.reading", "t.word"))
    surnames = profiles.select(F.explode("surnames").alias("surname")).distinct()
    keyed = said.select("word").distinct().select("word", F.explode(deletion_keys(F.col("word"))).alias("k"))
    near = keyed.join(surnames.select("surname", F.explode(deletion_keys(F.col("surname"))).alias("k")), "k").select("word", "surname").distinct()
    near = near.withColumn("d", edits("word", "surname")).where("d IS NOT NULL")
    owners = profiles.select("pid", F.explode("surnames").alias("surname"))
    met = cut(said.join(near, "word").join(owners, "surname").groupBy("text", "reading", "pid", "word").agg(F.min("d").alias("d")).groupBy("text", "reading", "pid").agg(F.map_from_entries(F.collect_list(F.struct("word", "d"))).alias("near")))

    @F.arrow_udf(_FIT)
    def fit(column: pa.Array, reading: pa.Array, words: pa.Array, person: pa.Array) -> pa.Array:
        memo: dict = {}
        out = []
        for t, i, n, p in zip(column.to_pylist(), reading.to_pylist(), words.to_pylist(), person.to_pylist()):
            if t not in memo:
                memo[t] = spellings_of(t)
            if p["pid"] not in memo:
                memo[p["pid"]] = _of_row(p)
            v, m, k = fit_of(memo[t][i], memo[p["pid"]], dict(n), first_words)
            out.append({"score": v, "middles": m, "nicks": k})
        return pa.array(out, pa.struct([("score", pa.float64()), ("middles", pa.list_(pa.string())), ("nicks", pa.list_(pa.string()))]))

    links, rich = None, profiles
    while True:
        scored = met.join(rich, "pid").withColumn("f", fit("text", "reading", "near", F.struct(*rich.columns))).select("text", "reading", "pid", "f.*").where("score > 0")
        per = scored.groupBy("text", "reading").agg(F.max("score").alias("top"), F.collect_list(F.struct("pid", "score", "middles", "nicks")).alias("all"))
        first = per.groupBy("text").agg(F.min_by(F.struct("top", "all"), "reading").alias("b"))
        kept = F.filter("b.all", lambda x: x["score"] >= F.col("b.top") - 0.04)
        new = cut(first.select("text", kept.alias("c")).where(F.size(F.array_distinct(F.transform("c", lambda x: x["pid"]))) == 1).select("text", F.col("c")[0].alias("c")).select("text", "c.*"))
        if new.isEmpty():
            break
        links = new.select("text", "pid") if links is None else cut(links.unionByName(new.select("text", "pid")))
        told = new.select("pid", F.explode("middles").alias("m")).groupBy("pid", "m").count().where("count > 1").groupBy("pid").agg(F.collect_set("m").alias("more"))
        short = new.select("pid", F.explode("nicks").alias("n")).groupBy("pid").agg(F.collect_set("n").alias("short"))
        got = rich.join(told, "pid", "left").join(short, "pid", "left")
        add = lambda c, more: F.array_sort(F.array_union(c, F.coalesce(more, F.array().cast("array<string>")))).alias(c)
        grown = cut(got.select(*(add("middles", "more") if c == "middles" else add("nicks", "short") if c == "nicks" else F.col(c) for c in rich.columns)))
        changed = grown.join(rich.select("pid", F.col("middles").alias("_m"), F.col("nicks").alias("_n")), "pid").where("middles <> _m OR nicks <> _n").select("pid")
        rich = grown
        again = met.join(changed, "pid", "left_semi").select("text").distinct()
        met = cut(met.join(new.select("text"), "text", "left_anti").join(again, "text", "left_semi"))
    if links is None:
        links = met.select("text", "pid").where("false")
    return links, rich


def found(people: DataFrame, video_index: DataFrame) -> DataFrame:
    """(kind, left_id, right_id): pairs of people rows of one person, and unresolved
    captions with the lowest people id of the person they name.

    People are merged, captions linked and unioned into the profiles, which then enter
    the merging of people once more; captions of merged persons follow.
    """
    profiles = resolve_people(people)
    open_rows = (
        video_index.where("type = 'legislator' AND linked_id IS NULL AND coalesce(ignored, 'n') <> 'y' AND id IS NOT NULL AND trim(raw_text) <> ''")
        .select(F.col("id").cast("long").alias("right_id"), F.col("raw_text").alias("text"))
        .distinct()
    )
    open_rows = materialize(open_rows, "open-captions")
    links, rich = link_texts(open_rows.select("text").distinct(), profiles)
    profiles = merge_profiles(rich)
    final = profiles.select(F.explode("ids").alias("pid"), F.col("pid").alias("left_id"))
    screen = open_rows.join(links, "text").join(final, "pid").groupBy("right_id").agg(F.min("left_id").alias("left_id"))
    return pairs(profiles).select(F.lit("people").alias("kind"), "left_id", "right_id").unionByName(screen.select(F.lit("screen").alias("kind"), "left_id", "right_id"))
