"""String similarities. Built-in expressions where they exist, Arrow UDFs elsewhere."""

from __future__ import annotations

import difflib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - edits / longer length, over bytes of the lower-cased texts; 1 for two empty texts."""
    bytes_of = lambda c: F.decode(F.encode(F.lower(c), "UTF-8"), "ISO-8859-1")
    longer = F.greatest(F.octet_length(F.lower(a)), F.octet_length(F.lower(b)))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(bytes_of(a), bytes_of(b)) / longer)


def token_set(a: Column, b: Column) -> Column:
    """Shared over all distinct lower-cased words; 1 for two empty texts."""
    w = lambda c: F.array_distinct(F.split(F.lower(c), " "))
    return F.size(F.array_intersect(w(a), w(b))) / F.size(F.array_union(w(a), w(b)))


def jaro_winkler_value(a: str, b: str) -> float:
    """Jaro-Winkler with the prefix bonus at any height, over bytes of lower-cased texts."""
    a, b = a.lower().encode(), b.lower().encode()  # type: ignore[assignment]
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    free = [True] * len(b)
    mine = []
    for i, x in enumerate(a):
        at = next((j for j in range(max(0, i - reach), min(i + reach + 1, len(b))) if free[j] and b[j] == x), None)
        if at is not None:
            free[at] = False
            mine.append(x)
    if not mine:
        return 0.0
    theirs = [y for y, f in zip(b, free) if not f]
    m, off = len(mine), sum(x != y for x, y in zip(mine, theirs))
    jaro = (m / len(a) + m / len(b) + (m - off / 2) / m) / 3
    same = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        same += 1
    return jaro + same * 0.1 * (1 - jaro)


@F.arrow_udf(DoubleType())
def jaro_winkler(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if x is None or y is None else jaro_winkler_value(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


def combined(a: Column, b: Column) -> Column:
    """0.3 edit similarity + 0.5 Jaro-Winkler + 0.2 shared words."""
    return 0.3 * levenshtein_similarity(a, b) + 0.5 * jaro_winkler(a, b) + 0.2 * token_set(a, b)


def sound(c: Column) -> Column:
    """Soundex of the letters a to z of a lower-cased text; empty if it has none."""
    return F.soundex(F.regexp_replace(F.lower(c), "[^a-z]", ""))


def same_sound(a: Column, b: Column) -> Column:
    return sound(a) == sound(b)


SOUNDS = {c: d for d, letters in {"0": "aeiouy", "1": "bfpv", "2": "cgjkqsxz", "3": "dt", "4": "l", "5": "mn", "6": "r"}.items() for c in letters}


def sound_value(text: str) -> str:
    """The value of ``sound`` in Python; h and w do not part equal codes."""
    letters = [c for c in text.lower() if "a" <= c <= "z"]
    if not letters:
        return ""
    out, last = letters[0].upper(), SOUNDS.get(letters[0])
    for c in letters[1:]:
        code = SOUNDS.get(c, last)
        if code not in (last, "0", None):
            out += code
        last = code
    return out[:4].ljust(4, "0")


@F.arrow_udf(DoubleType())
def similar_text(a: pa.Array, b: pa.Array) -> pa.Array:
    """Percentage of letters in the recursive longest common substrings."""
    ratio = lambda x, y: 100 * difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()
    return pa.array([None if x is None or y is None else ratio(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())
