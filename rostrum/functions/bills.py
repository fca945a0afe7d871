"""Bill numbers in captions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms of bill numbers in the order in which they are tried.
FORMS = [
    ("house", "bill", "HB", r"HB|H\.B\.|House\s+Bill"),
    ("senate", "bill", "SB", r"SB|S\.B\.|Senate\s+Bill"),
    ("house", "joint_resolution", "HJR", r"HJR|HJ|H\.J\.R\.|House\s+Joint\s+Resolution"),
    ("senate", "joint_resolution", "SJR", r"SJR|SJ|S\.J\.R\.|Senate\s+Joint\s+Resolution"),
    ("house", "resolution", "HR", r"HR|H\.R\.|House\s+Resolution"),
    ("senate", "resolution", "SR", r"SR|S\.R\.|Senate\s+Resolution"),
]
# Misread prefixes and what they stand for, applied in order.
MISREAD = [
    (r"(?i)\b[HL1I]\s*8\s*(\d)", "HB $1"),
    (r"(?i)\b[HL1I]\s*3\s*(\d)", "HB $1"),
    (r"(?i)\b[HL1I]\s*E\s*(\d)", "HB $1"),
    (r"(?i)\b[5S]\s*8\s*(\d)", "SB $1"),
    (r"(?i)\b[5S]\s*E\s*(\d)", "SB $1"),
    (r"(?i)\b[L1I]\s*H\s*B\s*(\d)", "HB $1"),
    (r"(?i)\b[L1I]\s*S\s*B\s*(\d)", "SB $1"),
    (r"(?i)\b([HS])\s*J\s*[8R]\s*(\d)", "$1JR $2"),
]
# Digits and the digits they are mistaken for.
DIGITS = {"0": ["8"], "1": ["7"], "5": ["6"], "8": ["0", "3"]}


def tokens(text: Column) -> Column:
    """Distinct bill numbers HB/SB of up to four digits, upper case without spaces, in order."""
    found = F.regexp_extract_all(F.upper(text), F.lit(r"\b([HS]B\s*\d{1,4})\b"), 1)
    return F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, r"\s+", "")))


def corrected(text: Column) -> Column:
    for pattern, to in MISREAD:
        text = F.regexp_replace(text, pattern, to)
    return text


def parse(text: Column) -> Column:
    """STRUCT<chamber, type, number, label> of the first form found; NULL if none."""

    def first_form(t: Column) -> Column:
        tries = []
        for chamber, kind, short, form in FORMS:
            n = F.regexp_extract(t, rf"(?i)\b(?:{form})\s*(\d{{1,4}})\b", 1)
            plain = n.try_cast("int").cast("string")
            tries.append(F.when(n != "", F.struct(F.lit(chamber).alias("chamber"), F.lit(kind).alias("type"), plain.alias("number"), F.concat(F.lit(short), plain).alias("label"))))
        return F.coalesce(*tries)

    # the corrected text is bound once, not repeated in every form
    return F.get(F.transform(F.array(corrected(text)), first_form), F.lit(0))


def variations(number: Column) -> Column:
    """The number and what one misread digit can make of it, in order of place."""
    chars = F.split(number, "")
    swaps = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length(number)),
            lambda i: F.coalesce(
                *(
                    F.when(F.substr(number, i, F.lit(1)) == d, F.array(*(F.concat(F.substr(number, F.lit(1), i - 1), F.lit(r), F.substr(number, i + 1)) for r in to)))
                    for d, to in DIGITS.items()
                ),
                F.array().cast("array<string>"),
            ),
        )
    )
    return F.when(F.size(chars) > 0, F.array_distinct(F.concat(F.array(number), swaps)))
