"""Corpus encoding with a byte-level BPE vocabulary, run as a token automaton.

The merges are compiled, one gadget after the other in rank order, into a
deterministic automaton over tokens. Its states are the tokens last emitted; the
gadget of a merge (a, b -> z) adds the state z and takes from every state that
still exposes ``a`` at its right edge the arcs to tokens that expose ``b`` at
their left edge. What remains are exactly the token sequences that the merges
produce, so each byte string has one path. Exposure is kept as intervals of
ranks: a piece is at an edge from its own merge until its parent's, and a merge
of rank k cuts an arc if both pieces are exposed at k (the left one strictly
before its parent; the right one up to it, as equal merges apply left to right).

Encoding walks a byte trie of the vocabulary from every position and takes the
one arc that the table allows; decoding concatenates the arc labels.

NULL and empty texts have the empty list of ids. No special tokens are made and
their strings in a text are ordinary text.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from rostrum.session import spread

#: Where the public vocabularies lie unless the caller names another place.
DEFAULT_VOCABULARY = os.environ.get("ROSTRUM_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.json"

# The pattern that splits text into words before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_FOREVER = 1 << 40


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: bytes that print
    stand for themselves, the others follow from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenAutomaton:
    """Deterministic automaton over the tokens of a merge list."""

    def __init__(self, singles: dict[int, int], merges: list[tuple[int, int, int]]):
        """singles: id of each byte. merges: (left id, right id, new id) in rank order."""
        top = max([*singles.values(), *(z for _, _, z in merges)]) + 1
        self.labels: list[bytes] = [b""] * top
        #: Pieces exposed at the right and left edge of each token, with the rank at which they end.
        self._right: list[tuple] = [()] * top
        self._left: list[tuple] = [()] * top
        self._cut: dict[int, int] = {}
        self._arcs: dict[int, bool] = {}
        self._step: dict[int, int] = {}
        self._final: dict[int, int] = {}
        self._states = 1
        self._words: dict[bytes, tuple] = {}
        for b, i in singles.items():
            self.labels[i] = bytes([b])
            self._right[i] = self._left[i] = ((i, _FOREVER),)
            self._spell(i)
        for rank, (a, b, z) in enumerate(merges):
            self._gadget(rank, a, b, z)

    def _gadget(self, rank: int, a: int, b: int, z: int) -> None:
        self.labels[z] = self.labels[a] + self.labels[b]
        self._right[z] = ((z, _FOREVER), *((p, min(until, rank)) for p, until in self._right[b]))
        self._left[z] = ((z, _FOREVER), *((p, min(until, rank)) for p, until in self._left[a]))
        self._cut[a << 20 | b] = rank
        self._spell(z)

    def _spell(self, token: int) -> None:
        at = 0
        for byte in self.labels[token]:
            key = at << 8 | byte
            nxt = self._step.get(key)
            if nxt is None:
                nxt = self._step[key] = self._states
                self._states += 1
            at = nxt
        self._final[at] = token

    def allows(self, u: int, v: int) -> bool:
        """Whether the automaton has an arc v from the state of u."""
        key = u << 20 | v
        found = self._arcs.get(key)
        if found is None:
            found, cut = True, self._cut
            for x, x_until in self._right[u]:
                for y, y_until in self._left[v]:
                    rank = cut.get(x << 20 | y)
                    if rank is not None and rank < x_until and rank <= y_until:
                        found = False
            if len(self._arcs) > 4_000_000:  # a table of memory, not of rows
                self._arcs.clear()
            self._arcs[key] = found
        return found

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        found = self._words.get(word)
        if found is not None:
            return found
        n, step, final = len(word), self._step, self._final
        last, came = [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            before, at = last[i], 0
            for j in range(i, n):
                at = step.get(at << 8 | word[j], 0)
                if not at:
                    break
                token = final.get(at, -1)
                if token >= 0 and last[j + 1] < 0 and (i == 0 or self.allows(before, token)):
                    last[j + 1], came[j + 1] = token, i
        path, i = [], n
        while i:
            path.append(last[i])
            i = came[i]
        out = tuple(reversed(path))
        if n <= 64:
            if len(self._words) > 400_000:
                self._words.clear()
            self._words[word] = out
        return out

    def decode(self, ids) -> bytes:
        return b"".join(self.labels[i] for i in ids)


@lru_cache(maxsize=4)
def load(path: str) -> TokenAutomaton:
    """Compiled once per Python worker."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, vocab = _byte_letters(), model["vocab"]
    singles = {b: vocab[c] for c, b in letters.items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return TokenAutomaton(singles, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])


_split = regex.compile(SPLIT)


def encode_text(text: str | None, path: str = DEFAULT_VOCABULARY) -> list[int]:
    if not text:
        return []
    auto, out = load(path), []
    words, encode = auto._words, auto.encode_word
    for w in _split.findall(text):
        b = w.encode("utf-8")
        out.extend(words.get(b) or encode(b))
    return out


def _encode_batch(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    ends, flat = np.zeros(len(texts) + 1, dtype=np.int64), []
    for i, text in enumerate(texts):
        flat.extend(encode_text(text.as_py(), path))
        ends[i + 1] = len(flat)
    return ends, np.asarray(flat, dtype=np.int32)


def ids_column(text: Column, path: str = DEFAULT_VOCABULARY) -> Column:
    """ARRAY<INT> of ids; the empty list for NULL and empty texts."""

    @F.arrow_udf(ArrayType(IntegerType(), False))
    def encode(texts: pa.Array) -> pa.Array:
        ends, flat = _encode_batch(texts, path)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return encode(F.make_valid_utf8(text))


def count_column(text: Column, path: str = DEFAULT_VOCABULARY) -> Column:
    """INT number of ids, without shipping the ids to the JVM."""

    @F.arrow_udf(IntegerType())
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(np.diff(_encode_batch(texts, path)[0]).astype(np.int32))

    return count(F.make_valid_utf8(text))


def text_column(ids: Column, path: str = DEFAULT_VOCABULARY) -> Column:
    """The text of ids (inverse of ids_column; '' for NULL and empty lists)."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        auto = load(path)
        return pa.array([auto.decode(r.as_py() or ()).decode("utf-8", "replace") for r in rows], pa.string())

    return decode(ids)


def encode_corpus(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(id, ids) of every row: a map over the scan of two columns, which only inputs of few partitions shuffle."""
    return spread(documents.select(id_col, text_col)).select(F.col(id_col), ids_column(F.col(text_col), path).alias("ids"))
