"""Committee and legislator directories: labels to entries by likeness."""

from __future__ import annotations

import difflib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

LEAST, LEAST_PERSON, MAX_ENTRIES = 70.0, 60.0, 100_000
# Least score of a subcommittee label holding a dash or slash; what a part's
# place adds; a number's worth; what a contained label scores.
LEAST_DASHED, PLACE, UNNUMBERED, NUMBERED, INSIDE, LONG_INSIDE = 85.0, 0.5, -15.0, 5.0, 75.0, 80.0
# Abbreviations of committees, and labels that stand for one subcommittee.
ABBREVIATIONS = {"ACNR": "Agriculture, Conservation and Natural Resources", "CCT": "Counties, Cities and Towns", "SFAC": "Finance and Appropriations"}
ALIASES = {
    "compensation and retirement subcommittee": ("Workers' Compensation, Unemployment Compensation and Labor", "senate", "subcommittee"),
    "criminal subcommittee": ("Criminal", "senate", "subcommittee"),
    "capital outlay and transportation": ("Capital Outlay", "senate", "subcommittee"),
}

_SUB = re.compile(r"\b(?:subcommittee|subcomittee|subco)\b", re.IGNORECASE)


def _plain(name: str, marks: str = "") -> str:
    return " ".join(re.sub(rf"[^a-z0-9{marks}\s]", " ", name.lower().replace("&", "and")).split())


def _sub_label(name: str) -> str:
    return _plain(_SUB.sub("", name), "#")


def _like(a: str, b: str) -> float:
    return 100 * difflib.SequenceMatcher(None, a.upper(), b.upper(), autojunk=False).ratio()


def _closeness(label: str, entry: str) -> float:
    """Likeness of two plain labels; more where one holds the other."""
    if not label or not entry:
        return 0.0
    if label == entry:
        return 100.0
    score = _like(label, entry)
    if label in entry or entry in label:
        score = max(score + 10, INSIDE) + (5 if label.startswith(entry) else 0)
    return score


def _parts_score(label: str, entry: str) -> float:
    """The best of a label's parts (between &); later parts count a little more."""
    parts = [p.strip() for p in label.split("&") if p.strip()]
    return max((_closeness(_sub_label(p), _sub_label(entry)) + PLACE * i for i, p in enumerate(parts)), default=0.0)


def _best(scored, least: float):
    """The first entry of the highest score, if it reaches ``least``."""
    top = max(scored, key=lambda s: s[0], default=(0.0, None))
    return top[1] if top[0] >= least and top[0] > 0 else None


class Directory:
    """rows: (id, parent_id, name, shortname, chamber); entries without parent are committees."""

    def __init__(self, rows: list[tuple]):
        self.name = {r[0]: r[2] for r in rows}
        self.of: dict[tuple[str, str], list[tuple]] = {}
        for i, parent, name, _, chamber in sorted(rows, key=lambda r: r[0]):
            self.of.setdefault(((chamber or "").lower(), "committee" if parent is None else "subcommittee"), []).append((i, parent, name))

    def match(self, label: str | None, chamber: str | None, kind: str | None) -> int | None:
        """The entry of chamber and kind that the label names, by the first way that finds
        one: an alias (of whatever chamber), 'Parent: Child', a subcommittee's label, the
        equal or likest name from LEAST on."""
        if not label or not label.strip() or not chamber or not kind:
            return None
        for short, full in ABBREVIATIONS.items():
            label = re.sub(rf"\b{short}\b", full, label.strip(), flags=re.IGNORECASE)
        chamber, kind = chamber.lower(), kind.lower()
        own = self.of.get((chamber, kind), [])
        if not own:
            return None
        ways = [self._alias(label)]
        if kind == "subcommittee":
            parent, colon, child = (x.strip() for x in label.partition(":"))
            if colon and parent and child:
                top = self._named(parent, self.of.get((chamber, "committee"), []))
                ways.append(self._child(top, child, own) if top else None)
            ways.append(self._sub(label, chamber, own) if not any(ways) else None)
        return next((w for w in ways if w is not None), None) or self._named(label, own, inside=True)

    def _named(self, label: str, rows: list[tuple], inside: bool = False) -> int | None:
        plain = _plain(label)

        def score(name: str) -> float:
            entry = _plain(name)
            if entry == plain:
                return 1000.0
            return max(_like(name, label), LONG_INSIDE if inside and len(plain) >= 6 and plain in entry else 0.0)

        return _best(((score(n), i) for i, _, n in rows), LEAST)

    def _alias(self, label: str) -> int | None:
        plain = _plain(label)
        bare = " ".join(re.sub(r"\bsubcommittee\b", "", plain).split())
        meant = next((v for k, v in ALIASES.items() if k in plain), None) or next((v for k, v in ALIASES.items() if bare and bare == k.replace("subcommittee", "").strip()), None)
        return self._named(meant[0], self.of.get(meant[1:], [])) if meant else None

    def _child(self, parent: int, label: str, own: list[tuple]) -> int | None:
        """The parent's subcommittee; a name may repeat the parent's in front."""
        scored = []
        for i, p, name in own:
            if p != parent:
                continue
            entry = name[len(self.name[parent]) :].strip() if _plain(name).startswith(_plain(self.name[parent])) else name
            equal = _sub_label(entry) == _sub_label(label) != ""
            scored.append((1000.0 if equal else _parts_score(label, entry), i))
        return _best(scored, LEAST)

    def _sub(self, label: str, chamber: str, own: list[tuple]) -> int | None:
        bare = _SUB.sub("", label).strip()
        if not _sub_label(bare):
            return None
        front = next((r for r in self.of.get((chamber, "committee"), []) if _plain(label).startswith(_plain(r[2]))), None)
        if front:
            rest = label[len(front[2]) :].strip()
            found = None if " and " in rest.lower() else self._child(front[0], _SUB.sub("", rest).strip(), own)
            if found is not None:
                return found
        numbered = re.search(r"#\d+", bare) is not None
        scored = []
        for i, _, name in own:
            entry = _SUB.sub("", name).strip()
            if _sub_label(entry):
                bonus = (NUMBERED if numbered else UNNUMBERED) if re.search(r"#\d+", entry) else 0.0
                scored.append((_parts_score(bare, entry) + bonus, i))
        return _best(scored, LEAST_DASHED if re.search(r"[-/]", bare) else LEAST)


def directory(committees: DataFrame) -> Directory:
    rows = [tuple(r) for r in committees.select("id", "parent_id", "name", "shortname", "chamber").where("id IS NOT NULL AND name IS NOT NULL").limit(MAX_ENTRIES + 1).collect()]
    if len(rows) > MAX_ENTRIES:
        raise ValueError("the committee list is too large to ship")
    return Directory(rows)


def match_committees(labels: DataFrame, committees: DataFrame) -> DataFrame:
    """labels (label, chamber, kind) with committee_id and committee, its name; each distinct
    label is matched once a batch."""
    own = directory(committees)

    @F.arrow_udf("committee_id int, committee string")
    def match(label: pa.Array, chamber: pa.Array, kind: pa.Array) -> pa.Array:
        memo: dict = {}
        out = []
        for key in zip(label.to_pylist(), chamber.to_pylist(), kind.to_pylist()):
            if key not in memo:
                memo[key] = own.match(*key)
            out.append(memo[key])
        return pa.StructArray.from_arrays([pa.array(out, pa.int32()), pa.array([own.name.get(i) for i in out], pa.string())], ["committee_id", "committee"])

    return labels.withColumn("_m", match("label", "chamber", "kind")).select("*", "_m.*").drop("_m")


class PeopleList:
    """Finds the likest name of a list: letter counts bound a likeness from above, so only
    names that can still be the best are compared."""

    def __init__(self, rows: list[tuple]):
        self.rows = [(i, n.upper()) for i, n in sorted(rows)]
        self.exact: dict[str, int] = {}
        for i, n in self.rows:
            self.exact.setdefault(n, i)
        self.counts = np.array([np.bincount([ord(c) % 128 for c in n] or [0], minlength=128) for _, n in self.rows]).reshape(-1, 128)
        self.sizes = np.array([len(n) for _, n in self.rows])

    def match(self, name: str | None) -> int | None:
        """The equal name's id, else the likest of more than LEAST_PERSON, the first of equals."""
        if not name or not name.strip() or not self.rows:
            return None
        want = name.strip().upper()
        if want in self.exact:
            return self.exact[want]
        mine = np.bincount([ord(c) % 128 for c in want], minlength=128)
        bound = 200.0 * np.minimum(self.counts, mine).sum(axis=1) / (self.sizes + len(want))
        best, at = LEAST_PERSON, None
        for k in np.argsort(-bound, kind="stable"):
            if bound[k] < best or bound[k] <= LEAST_PERSON:
                break
            score = 100 * difflib.SequenceMatcher(None, self.rows[k][1], want, autojunk=False).ratio()
            if score > best or (score == best and at is not None and k < at):
                best, at = score, int(k)
        return None if at is None else self.rows[at][0]


def match_people(labels: DataFrame, people: DataFrame, label: str = "label") -> DataFrame:
    """labels with person_id, the person of the list named likest. The list is refused beyond
    MAX_ENTRIES."""
    rows = [tuple(r) for r in people.where("id IS NOT NULL AND name IS NOT NULL").select("id", "name").distinct().limit(MAX_ENTRIES + 1).collect()]
    if len(rows) > MAX_ENTRIES:
        raise ValueError("the list of people is too large to ship")

    @F.arrow_udf(LongType())
    def match(names: pa.Array) -> pa.Array:
        own = PeopleList(rows)
        memo: dict = {}
        for n in names.to_pylist():
            if n not in memo:
                memo[n] = own.match(n)
        return pa.array([memo[n] for n in names.to_pylist()], pa.int64())

    found = labels.where(F.col(label).isNotNull()).select(F.col(label).alias("_n")).distinct().withColumn("person_id", match("_n"))
    return labels.join(found, F.col(label) == F.col("_n"), "left").drop("_n")


def largest_media(files: DataFrame, key: str, name: str, size: str, preferred: str) -> DataFrame:
    """(key, name) of the preferred file, else the largest MP4; the later name wins ties."""
    mp4 = files.where(F.lower(F.col(name)).endswith(".mp4"))
    return mp4.groupBy(key).agg(F.max_by(name, F.struct((F.col(name) == F.col(preferred)).alias("p"), size, name)).alias("picked"))


def decay_sample(rows: DataFrame, key: str, age_days: str, run: str, fresh: int = 30) -> DataFrame:
    """Rows younger than ``fresh`` days, and older ones with probability fresh / age.
    The draw is a hash of key and run, so a run can be repeated."""
    u = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(run)), F.lit(1_000_000)) / 1_000_000
    return rows.where((F.col(age_days) <= fresh) | (u < F.lit(fresh) / F.col(age_days)))
