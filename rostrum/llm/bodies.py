"""Mapping freely typed values to the entries of a canonical list.

A multi-pattern automaton over the canonical names and aliases finds the mentions
embedded in a value; the longest mentions that don't overlap win. Tokens that stay
uncovered are corrected against the words of the list and matched again. What still
isn't covered goes to a token-set similarity against the list. A value that keeps
uncovered words is reported as unmatched (id 0), as are values of unknown places.

The list is a reference table of bounded size (MAX_ENTRIES, checked); the values
are mapped where they lie, without a shuffle.
"""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from rostrum.session import spread

#: The list is shipped to every worker, so a larger one is refused.
MAX_ENTRIES = 100_000

# Words that name no body.
CONNECTIVES = {"and", "the", "of", "on", "for", "in", "at", "a", "s"}
COMMITTEE_WORDS = {"committee", "comm", "cmte", "comittee", "com"}
SUB_WORDS = {"subcommittee", "subcmte", "subcomittee", "subcomm", "sub"}
GENERIC = {"meeting", "live", "finished", "house", "senate", "delegates", "stream"}
NUMBERS = {w: i + 1 for i, w in enumerate("one two three four five six seven eight nine ten".split())}
ROMAN = {w: i + 1 for i, w in enumerate("i ii iii iv v vi vii viii ix x".split())}
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

_MONTH = r"(?:" + "|".join(MONTHS) + r")[a-z]*\.?"
DATE = re.compile(rf"\b{_MONTH}\s+\d{{1,2}},?\s+\d{{4}}\b|\b\d{{1,2}}/\d{{1,2}}/(?:\d{{4}}|\d{{2}})\b|\b\d{{4}}-\d{{2}}-\d{{2}}\b|\b(?:19|20)\d{{6}}\b")
_CLOCK = re.compile(r"\b\d{1,2}:\d{2}\s*[ap]\.?m\b\.?")
_ROOM = re.compile(r"\b(?:hearing\s+room|room|sr|hr)\s+(?:\d+|[a-z])\b")
_TAG = re.compile(r"\[(?:live|finished|archived?|replay)\]")


def fold(text: str) -> str:
    """Lower case without accents, entities, or typographic variants."""
    text = html.unescape(html.unescape(text))
    text = unicodedata.normalize("NFKD", text).replace("–", "-").replace("—", "-").replace("’", "'")
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between a and b, or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, prev2[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        prev2, prev = prev, row
    return prev[-1]


def allowed(n: int) -> int:
    """Edits forgiven in a word of n letters."""
    return 0 if n < 4 else 1 if n < 8 else 2


def deleted(word: str, most: int) -> set[str]:
    """The word and what is left of it without up to ``most`` letters: words within so many
    edits share one of these."""
    out = last = {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


def clean_tokens(text: str) -> list[str]:
    """Words of a folded text; marks inside words are misreadings and go."""
    out = []
    for w in text.split():
        w = re.sub(r"^[^a-z0-9#]+|[^a-z0-9]+$", "", w)
        w = re.sub(r"[^a-z0-9#]", "", w)
        if w:
            out.append(w)
    return out


class BodyResolver:
    """committees: (id, parent_id, name, shortname, chamber) rows."""

    def __init__(self, committees: list[tuple]):
        self.chambers = sorted({fold(c) for *_, c in committees if c})
        self.chamber_of = {i: fold(c or "") for i, _, _, _, c in committees}
        self.parent = {i: p for i, p, *_ in committees}
        self.numbered: dict[tuple, int] = {}
        names: dict[str, set[int]] = {}
        leads: dict[str, set[int]] = {}
        self.tokens: dict[int, frozenset] = {}
        for i, p, name, short, _ in sorted(committees, key=lambda r: r[0]):
            toks = [t for t in clean_tokens(fold(name or "").replace("&", " and ").replace("-", " ")) if t not in CONNECTIVES]
            kind, number = self._sub(toks)
            if kind and number and not [t for t in toks if not self._is_sub(t) and not self._number(t)]:
                self.numbered.setdefault((p, number), i)
                continue
            if toks:
                names.setdefault(" ".join(toks), set()).add(i)
                self.tokens[i] = frozenset(toks)
            for alias in [short] if short else []:
                names.setdefault(" ".join(clean_tokens(fold(alias))), set()).add(i)
            lead = [t for t in clean_tokens(re.split(r"\band\b|&", fold(name or ""))[0]) if t not in CONNECTIVES]
            if len(toks) > len(lead) >= 2:  # lists are also cut before their last part
                leads.setdefault(" ".join(lead), set()).add(i)
        for lead, ids in leads.items():
            names.setdefault(lead, set()).update(ids)
        self.names = names
        self.short = {t for n in names for t in n.split() if len(t) < 5}
        self.by_key: dict[str, set[str]] = {}
        for v in {t for n in names for t in n.split() if len(t) >= 4}:
            for k in deleted(v, allowed(len(v))):
                self.by_key.setdefault(k, set()).add(v)
        self.automaton = ahocorasick.Automaton()
        for n in names:
            self.automaton.add_word(f" {n} ", n)
        if names:
            self.automaton.make_automaton()
        self._memo: dict = {}
        self._corrected: dict[str, str] = {}

    # -- words ---------------------------------------------------------------------------

    def _is_sub(self, t: str) -> bool:
        return t in SUB_WORDS or (len(t) >= 6 and t[:2] in ("su", "sb", "ub") and any(distance(t, s, 2) <= 2 for s in ("subcommittee", "subcomittee", "subcmte") if len(s) >= 7))

    def _is_committee(self, t: str) -> bool:
        return t in COMMITTEE_WORDS or (len(t) >= 7 and t[0] in "cos" and distance(t, "committee", 2) <= 2)

    def _is_and(self, t: str) -> bool:
        return 2 <= len(t) <= 4 and t.isalpha() and t not in self.short and t not in ("no", "sub", "i", "ii", "iii") and distance(t, "and", 1) <= 1

    @staticmethod
    def _number(t: str) -> int:
        t = t.lstrip("#")
        return int(t) if t.isdigit() and len(t) < 4 else ROMAN.get(t, NUMBERS.get(t, 0))

    def _sub(self, toks: list[str]) -> tuple[bool, int]:
        """Whether a subcommittee is named by word, and its number."""
        for k, t in enumerate(toks):
            if self._is_sub(t):
                rest = toks[k + 1 : k + 3]
                if rest and rest[0] in ("no", "#", "number"):
                    rest = rest[1:]
                return True, self._number(rest[0]) if rest else 0
        return False, 0

    def correct(self, t: str) -> str:
        """The word of the list that t misspells, else t."""
        found = self._corrected.get(t)
        if found is None:
            best, ties = allowed(max(len(t), 5)) + 1, []
            for v in sorted(set().union(*(self.by_key.get(k, set()) for k in deleted(t, 2)))):
                d = distance(t, v, min(allowed(len(v)), best))
                if d <= allowed(len(v)):
                    if d < best:
                        best, ties = d, [v]
                    elif d == best:
                        ties.append(v)
            found = ties[0] if len(ties) == 1 else t
            if len(self._corrected) > 200_000:
                self._corrected.clear()
            self._corrected[t] = found
        return found

    # -- mentions ------------------------------------------------------------------------

    def mentions(self, toks: list[str]) -> tuple[list[str], list[str]]:
        """Longest mentions that don't overlap, and the tokens outside them."""
        if not self.names or not toks:
            return [], list(toks)
        text = " " + " ".join(toks) + " "
        spans = sorted(((end + 1 - len(n) - 2, end + 1, n) for end, n in self.automaton.iter(text)), key=lambda s: (s[0] - s[1], s[0]))
        taken: list[tuple[int, int, str]] = []
        for s, e, n in spans:
            if all(e - 1 <= ts or s >= te - 1 for ts, te, _ in taken):
                taken.append((s, e, n))
        rest, at = [], 0
        for s, e, _ in sorted(taken):
            rest += text[at : s + 1].split()
            at = e - 1
        return [n for *_, n in sorted(taken)], rest + text[at:].split()

    def parse(self, text: str) -> tuple[list[str], list[str], bool, int]:
        """Mentions, uncovered words, whether a subcommittee is named by word, its number."""
        toks = [t for t in clean_tokens(text.replace("&", " and ").replace("/", " ").replace("#", " #")) if t not in CONNECTIVES and not self._is_and(t)]
        sub, number = self._sub(toks)
        if sub:
            k = next(i for i, t in enumerate(toks) if self._is_sub(t))
            after = k + 1 + (toks[k + 1 : k + 2] != [] and toks[k + 1] in ("no", "#", "number"))
            toks = toks[:k] + toks[after + bool(number) :]
        toks = [t for t in toks if not self._is_committee(t)]
        found, rest = self.mentions(toks)
        if any(t not in GENERIC for t in rest):
            again = [self.correct(t) for t in toks]
            if again != toks:
                found, rest = self.mentions(again)
        return found, [t for t in rest if t not in GENERIC], sub, number

    def pick(self, found: list[str], sub: bool, number: int, chamber: str | None) -> int:
        """The entry that the mentions mean within the chamber; 0 if none or unclear."""
        ids = [{i for i in self.names[n] if chamber is None or self.chamber_of[i] == chamber} for n in found]
        tops = {i for s in ids for i in s if self.parent[i] is None}
        subs = {i for s in ids for i in s if self.parent[i] is not None}
        if any(not s for s in ids):
            return 0
        under = {i for i in subs if self.parent[i] in tops}
        if under or subs:
            pick = under or (subs if not tops else set())
            return pick.pop() if len(pick) == 1 else 0
        if number:
            pick = {self.numbered[p, number] for p in tops if (p, number) in self.numbered}
            return pick.pop() if len(pick) == 1 else 0
        return tops.pop() if len(tops) == 1 and not sub else 0

    def similar(self, toks: list[str], number: int, sub: bool, chamber: str | None, least: float = 0.8) -> int:
        """Token-set similarity: the one entry (alone or with its parent) whose words are
        nearest to those given, words counting as equal up to misspelling."""
        if not toks:
            return 0
        best, ties = least, []
        for i, own in self.tokens.items():
            if chamber is not None and self.chamber_of[i] != chamber:
                continue
            for words in {own, own | self.tokens.get(self.parent[i], own)}:
                if abs(len(words) - len(toks)) > 2:
                    continue
                near = {(t, w) for w in words for t in toks if distance(t, w, 2) <= (2 if len(w) >= 6 else 1 if len(w) >= 4 else 0)}
                score = 2 * min(len({t for t, _ in near}), len({w for _, w in near})) / (len(words) + len(toks))
                if score > best:
                    best, ties = score, [i]
                elif score == best and i not in ties:
                    ties.append(i)
        if len(ties) != 1 or best <= least:
            return 0
        if number and self.parent[ties[0]] is None:
            return self.numbered.get((ties[0], number), 0)
        return 0 if sub and self.parent[ties[0]] is None else ties[0]

    def resolve(self, title: str, chamber: str | None) -> int:
        key = (title, chamber)
        found = self._memo.get(key)
        if found is None:
            if len(self._memo) > 200_000:
                self._memo.clear()
            found = self._memo[key] = self._resolve(title, chamber)
        return found

    def _resolve(self, title: str, chamber: str | None) -> int:
        text = fold(title)
        for p in (_TAG, DATE, _CLOCK, _ROOM):
            text = p.sub(" ", text)
        parts = [p for p in text.split("|") if re.search(r"[a-z]", p)]
        text = re.sub(r"^[\s:,-]*(?:live\s*:)?\s*", "", parts[0] if parts else "")
        said = None
        for c in self.chambers:
            m = re.match(rf"{c}(?:\s+of\s+\w+)?\b\s*:?\s*", text)
            if m:
                said, text = c, text[m.end() :]
        chamber = chamber or said
        if chamber is None:
            return 0
        names, rest, sub, number = self.parse(text)
        if not rest:
            return self.pick(names, sub, number, chamber)
        toks = [w for n in names for w in n.split()] + [t for t in rest if len(t) > 2]
        return self.similar(toks, number, sub, chamber)


@lru_cache(maxsize=4)
def resolver(committees: tuple) -> BodyResolver:
    return BodyResolver(list(committees))


def committee_rows(committees: DataFrame) -> tuple:
    """The reference list for the workers; refused beyond MAX_ENTRIES."""
    rows = committees.select("id", "parent_id", "name", "shortname", "chamber").where("id IS NOT NULL").limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the canonical list has more than {MAX_ENTRIES} entries")
    return tuple(sorted((tuple(r) for r in rows), key=lambda r: r[0]))


def map_titles(videos: DataFrame, committees: DataFrame) -> DataFrame:
    """(id, committee_id) of every distinct video whose title isn't NULL or blank.

    Of several fetches the latest with a title counts. The chamber is the one named
    by the channel; if the channel is NULL, the one the title begins with. Channels
    of no chamber have no committees. Unmatched titles get 0.
    """
    rows = committee_rows(committees)
    chambers = sorted({fold(r[4]) for r in rows if r[4]})
    @F.arrow_udf(IntegerType())
    def pick(titles: pa.Array, channels: pa.Array) -> pa.Array:
        own, out = resolver(rows), []
        for t, c in zip(titles.to_pylist(), channels.to_pylist()):
            if c is None:
                out.append(own.resolve(t, None))
            else:
                named = [x for x in chambers if x in c.lower()]
                out.append(own.resolve(t, named[0]) if len(named) == 1 else 0)
        return pa.array(out, pa.int32())

    # every fetch is read where it lies, so that only ids and results are shuffled
    fetched = videos.select("id", F.col("snippet.title").alias("title"), F.col("snippet.channelid").alias("channel"), "fetched_at").where(F.length(F.trim(F.regexp_replace("title", r"\s+", " "))) > 0)
    read = spread(fetched).withColumn("committee_id", pick("title", "channel"))
    return read.groupBy("id").agg(F.max_by("committee_id", F.struct("fetched_at", "title", "channel")).alias("committee_id"))
