"""Deduplicating new batches against all history.

A title is read as (chamber, day, body, topic, portion). The content of a record is
its topic in that context; its character grams are winnowed to fingerprints. A batch
is admitted in these steps:

1. exact copies collapse to one record (pre-aggregation before any join);
2. the batch's distinct fingerprints are screened by the store's Bloom filters, one for
   each part of each run of the store;
3. positives alone look up the persistent fingerprint store, of which only the parts
   with positives are opened, and the batch itself;
4. candidates are verified: shared coverage of the fingerprints, then the topic text;
5. linked records and accepted recordings are put together (a record may join several,
   which the store then remembers as merged); store and filters are appended to.

Defined results: rows of NULL or blank title are no records; rows repeated under one
id count once; a NULL chamber is taken from the title, a day in the title outweighs
the date column; an unknown body is compared by its words.
"""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.llm.bodies import CONNECTIVES, DATE, MONTHS, _CLOCK, _ROOM, _TAG, clean_tokens, committee_rows, distance, fold, resolver
from rostrum.session import cut, file_system, fresh_path, shared_dir, spread

GRAM, WINDOW = 3, 2
PART_ROWS, FAN = 1_000_000, 8
BITS_PER_ITEM, PROBES = 12, 6

# The occasions that stand before or after a topic.
KINDS = [("public", "hearing"), ("work", "session"), ("publichearing",), ("worksession",), ("briefing",), ("markup",)]

_PORTION = re.compile(r"\b(?:part|pt)\b\.?\s*(\d+|[ivx]+)\b|\(\s*(\d+)\s+of\s+\d+\s*\)|\b([ap])\.?m\b\.?|\b(morning|afternoon|evening)\b(?:\s+session)?")
_ROMAN = {w: str(i + 1) for i, w in enumerate("i ii iii iv v vi vii viii ix x".split())}


def title_day(text: str) -> dt.date | None:
    """The day written in a folded title."""
    for m in DATE.finditer(text):
        s = m.group(0)
        try:
            if w := re.match(r"([a-z]{3})[a-z]*\.?\s+(\d{1,2}),?\s+(\d{4})", s):
                return dt.date(int(w[3]), MONTHS.index(w[1]) + 1, int(w[2]))
            if w := re.match(r"(\d{1,2})/(\d{1,2})/(\d{2,4})$", s):
                return dt.date(int(w[3]) + (2000 if len(w[3]) == 2 else 0), int(w[1]), int(w[2]))
            if w := re.match(r"(\d{4})-?(\d{2})-?(\d{2})$", s):
                return dt.date(int(w[1]), int(w[2]), int(w[3]))
        except ValueError:
            continue
    return None


def _kind_at(words: list[str]) -> tuple[int, int] | None:
    """Where the occasion stands among words, up to misspelling."""
    near = lambda a, b: a == b or (len(a) > 3 and distance(a, b, 2) <= (2 if len(b) > 6 else 1))
    for kind in KINDS:
        for i in range(len(words) - len(kind) + 1):
            if all(near(words[i + j], k) for j, k in enumerate(kind)):
                return i, i + len(kind)
    return None


class TitleReader:
    def __init__(self, committees: tuple):
        self.own = resolver(committees)

    def read(self, title: str, chamber: str | None) -> tuple[str, str, str, str, dt.date | None]:
        """(chamber, body, topic, portion, day in the title)"""
        text = fold(title)
        day = title_day(text)
        for p in (_TAG, DATE, _CLOCK, _ROOM):
            text = p.sub(" ", text)
        portion = ""
        if m := _PORTION.search(text):
            portion = _ROMAN.get(m[1] or "", m[1] or m[2] or "") or (m[3] or {"morning": "a"}.get(m[4], "p")) + "m"
            text = text[: m.start()] + " " + text[m.end() :]
        text = re.sub(r"^[\s:,|-]*(?:live\s*:)?[\s:,|-]*", "", text)
        said = ""
        for c in self.own.chambers:
            if m := re.match(rf"{c}(?:\s+of\s+(?:delegates|\w+\s*:))?\b\s*:?\s*", text):
                said, text = c, text[m.end() :]
        chamber = fold(chamber or "").strip() or said
        text, topic = self._topic(text)
        names, rest, sub, number = self.own.parse(text)
        body = 0
        if not rest:
            body = self.own.pick(names, sub, number, chamber or None)
        elif not topic and names and not any(self.own.correct(t) != t for t in rest):
            topic, body = " ".join(rest), self.own.pick(names, sub, number, chamber or None)
        if not body:
            toks = [w for n in names for w in n.split()] + [t for t in rest if len(t) > 2]
            body = self.own.similar(toks, number, sub, chamber or None)
            if not body:
                floor = {"session", "floor", "chamber"} & set(toks)
                return chamber, "floor" if floor and not names else " ".join(sorted(toks)) + (f" #{number}" if number else ""), topic, portion, day
        if not chamber:
            chamber = self.own.chamber_of.get(body, "")
        return chamber, str(body), topic, portion, day

    def _topic(self, text: str) -> tuple[str, str]:
        """The text without occasion and topic, and the topic's words."""
        pieces = re.split(r"(\(|\)|:|,(?=\s)|\s-\s|\s-$|\|)", text)
        for at in range(0, len(pieces), 2):
            words = pieces[at].split()
            bare = [re.sub(r"[^a-z0-9]", "", w) for w in words]
            found = _kind_at(bare)
            if not found:
                continue
            i, j = found
            after, before = words[j:], words[:i]
            if after and bare[j] in ("on", "0n", "om", "of"):
                after = after[1:]
            rest = pieces[:at] + [" , "] + pieces[at + 1 :]
            if any(re.sub(r"[^a-z0-9]", "", w) for w in after):
                topic, rest[at] = after, " ".join(before)
            elif before:
                topic, rest[at] = before, " "
            elif at + 2 < len(pieces) and pieces[at + 1] in (":", " - ", ",") and pieces[at + 2].strip():
                topic = pieces[at + 2].split()
                rest[at + 2] = " "
            elif at >= 2:
                topic, rest[at - 2] = pieces[at - 2].split(), " "
            else:
                topic = []
            return " ".join(rest), " ".join(t for t in clean_tokens(" ".join(topic)) if t not in CONNECTIVES)
        return text, ""


def same_topic(a: str, b: str) -> bool:
    """Equal up to misspelling; no topic equals only no topic."""
    if a == b:
        return True
    if not a or not b:
        return False
    x, y = a.replace(" ", ""), b.replace(" ", "")
    most = 1 if max(len(x), len(y)) < 10 else 2
    return distance(x, y, most) <= most


def winnow(context: Column, content: Column) -> Column:
    """Fingerprints of content within its context: the least gram hash of each window.
    A content shorter than a gram is one gram."""
    s = F.replace(content, F.lit(" "), F.lit(""))
    grams = F.sequence(F.lit(1), F.greatest(F.length(s) - (GRAM - 1), F.lit(1)))
    hashes = F.transform(grams, lambda i: F.xxhash64(context, F.substr(s, i, F.lit(GRAM))))
    return F.array_distinct(F.transform(hashes, lambda h, i: F.array_min(F.slice(hashes, F.least(i + 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(1))), WINDOW))))


_RECORD = T.StructType(
    [T.StructField("chamber", T.StringType()), T.StructField("body", T.StringType()), T.StructField("topic", T.StringType()), T.StructField("portion", T.StringType()), T.StructField("day", T.DateType())]
)


def read_titles(files: DataFrame, committees: DataFrame) -> DataFrame:
    """(id, batch, chamber, day, body, topic, portion) of every record of a title."""
    rows = committee_rows(committees)
    one = files.select("id", "title", "chamber", "date", "date_created").where("id IS NOT NULL AND trim(title) <> ''").dropDuplicates(["id"])

    @F.arrow_udf(_RECORD)
    def read(titles: pa.Array, chambers: pa.Array) -> pa.Array:
        reader = TitleReader(rows)
        memo: dict = {}
        out = []
        for key in zip(titles.to_pylist(), chambers.to_pylist()):
            if key not in memo:
                memo[key] = reader.read(*key)
            out.append(memo[key])
        cols = list(zip(*out)) or [()] * 5
        return pa.StructArray.from_arrays([*(pa.array(c, pa.string()) for c in cols[:4]), pa.array(cols[4], pa.date32())], ["chamber", "body", "topic", "portion", "day"])

    got = spread(one).withColumn("r", read("title", "chamber"))
    return got.select("id", F.col("date_created").cast("timestamp").alias("batch"), "r.chamber", F.coalesce("r.day", "date").alias("day"), "r.body", "r.topic", "r.portion")


# -- Bloom filters -----------------------------------------------------------------------


def _probes(fps: np.ndarray, bits: int) -> np.ndarray:
    a = fps.astype(np.uint64)
    b = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (a >> np.uint64(31)) | np.uint64(1)
    return np.stack([((a >> np.uint64(7)) + np.uint64(i) * b) % np.uint64(bits) for i in range(PROBES)])


def _filter(pdf: pd.DataFrame) -> pd.DataFrame:
    """One Bloom filter over the fingerprints of a part, about PART_ROWS of them."""
    fps = pdf["fp"].to_numpy()
    bits = max(1024, 1 << int(len(fps) * BITS_PER_ITEM - 1).bit_length())
    flags = np.zeros(bits, dtype=bool)
    flags[_probes(fps, bits).ravel()] = True
    return pd.DataFrame({"run": [pdf["run"].iloc[0]], "part": [int(pdf["part"].iloc[0])], "bits": [bits], "filter": [np.packbits(flags).tobytes()]})


def _screen(pdf: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """The fingerprints that the filter of their run and part may hold."""
    fps = pdf["fp"].to_numpy()
    hit = np.zeros(len(fps), dtype=bool)
    for bits, raw in zip(filters["bits"], filters["filter"]):
        flags = np.unpackbits(np.frombuffer(raw, dtype=np.uint8))
        hit |= flags[_probes(fps, int(bits))].all(axis=0)
    return pdf.loc[hit, ["run", "part", "fp"]]


def _labels(pdf: pd.DataFrame) -> pd.DataFrame:
    """(node, label) of a bucket's edges: a root hooks on to the least root next to it, then
    all move to their root, until no edge joins two roots."""
    nodes, at = np.unique(np.concatenate([pdf["a"].to_numpy(), pdf["b"].to_numpy()]), return_inverse=True)
    a, b = at[: len(pdf)], at[len(pdf) :]
    root = np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return pd.DataFrame({"node": nodes, "label": nodes[root]})


def components(edges: DataFrame, buckets: int = 1) -> DataFrame:
    """(node, label): the least node connected to each node of edges (key, a, b), of which
    connected ones have one key. A bucket of keys is settled in one task, so the number of
    jobs doesn't follow the length of chains. (Joins repeated until nothing moves take a
    round for every few links, and the optimizer's size of each round is the product of the
    one before with itself: a number that fills the driver's memory.)"""
    of = edges.select(F.pmod("key", F.lit(buckets)).alias("bucket"), "a", "b")
    return cut(of.groupBy("bucket").applyInPandas(lambda pdf: _labels(pdf), "node long, label long"))


# -- store -------------------------------------------------------------------------------

_STORED = {
    "fingerprints": "fp long, id long, context string, topic string, n int, recording_id long, run string, part int",
    "filters": "run string, part int, bits long, filter binary",
    "members": "id long, recording_id long",
    "merges": "version long, old long, new long",
    "manifest": "version long, run string, tier int, parts int, rows long",
}


class RecordingStore:
    """The accepted records under a path, which any later process may open.

    Every admitted batch adds a run: its fingerprints, partitioned by fingerprint and
    sorted, and one Bloom filter a part. FAN runs of a size are compacted into one, so
    a batch meets a logarithmic number of filters, and reads only the parts whose
    filter it hits. Recordings that a later record turns out to join are listed in
    merges. The manifest names the live runs and is written last: what a lost driver left
    behind is in no manifest and never read.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, part_rows: int = PART_ROWS, fan: int = FAN):
        self.spark, self.path, self.part_rows, self.fan = spark, path or fresh_path(spark, "recordings"), part_rows, fan
        shared_dir(spark)

    def _there(self, name: str) -> bool:
        fs, at = file_system(self.spark, f"{self.path}/{name}")
        return fs.exists(at)

    def _read(self, name: str, paths: list[str] | None = None) -> DataFrame:
        """A table of the store; without paths or files it is empty."""
        kind = name.split("/")[-1]
        if paths is None:
            paths = [f"{self.path}/{name}"] if self._there(name) else []
        if not paths:
            return self.spark.createDataFrame([], _STORED[kind])
        return self.spark.read.schema(_STORED[kind]).option("basePath", f"{self.path}/{name}").parquet(*paths)

    def runs(self) -> tuple[int, list]:
        """The last version and its live runs: a logarithmic number of rows."""
        rows = self._read("manifest").collect() if self._there("manifest") else []
        version = max((r["version"] for r in rows), default=0)
        return version, [r for r in rows if r["version"] == version and r["run"]]

    def _merges(self, version: int) -> DataFrame:
        seen = self._read("merges").where(F.col("version") <= version)
        return seen.groupBy("old").agg(F.max_by("new", "version").alias("new"))

    def members(self) -> DataFrame:
        """(id, recording_id) of all accepted records as known now."""
        version, _ = self.runs()
        names = [f"{self.path}/members/{v}" for v in range(1, version + 1)]
        return self._now(self.spark.read.schema(_STORED["members"]).parquet(*names) if names else self._read("members", []), version)

    def _now(self, rows: DataFrame, version: int) -> DataFrame:
        """rows with the recording_id that merges have put in place of theirs."""
        if not self._there("merges"):
            return rows
        moved = rows.join(self._merges(version).withColumnRenamed("old", "recording_id"), "recording_id", "left")
        return moved.withColumn("recording_id", F.coalesce("new", "recording_id")).select(*rows.columns)

    def _stored(self, flat: DataFrame, rows: int, version: int, runs: list) -> DataFrame:
        """The stored fingerprints that the filters let through and that are there."""
        live = F.array(*(F.struct(F.lit(r["run"]).alias("run"), F.lit(r["parts"]).alias("parts")) for r in runs))
        probe = flat.select("fp").distinct().select("fp", F.explode(live).alias("r")).select("r.run", F.pmod("fp", "r.parts").cast("int").alias("part"), "fp")
        # a large batch over few parts is cut into groups of about part_rows
        salts = max(1, -(-rows // (self.part_rows * min(r["parts"] for r in runs))))
        probe = probe.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(salts)))
        filters = self._read("filters", [f"{self.path}/filters/{r['run']}" for r in runs]).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        keys = ["run", "part", "salt"]
        positive = cut(probe.groupBy(*keys).cogroup(filters.groupBy(*keys)).applyInPandas(_screen, "run string, part int, fp long"))
        hit = positive.select("run", "part").distinct().collect()  # parts to open: names, not rows
        stored = self._read("fingerprints", [f"{self.path}/fingerprints/run={h['run']}/part={h['part']}" for h in hit])
        return self._now(stored.join(positive, ["run", "part", "fp"], "left_semi"), version)

    def admit(self, batch: DataFrame, least_coverage: float = 0.2) -> DataFrame:
        """(id, recording_id) of every record of the batch; recording_id is the lowest
        id with that recording in history and batch. Updates store and filters."""
        version, runs = self.runs()
        context = F.concat_ws("\x1f", "chamber", F.col("day").cast("string"), "body", "portion")
        keyed = cut(batch.where("day IS NOT NULL").select(F.col("id").cast("long").alias("id"), context.alias("context"), "topic"))
        records = keyed.groupBy("context", "topic").agg(F.min("id").alias("id"))  # exact copies are one record
        flat = cut(records.withColumn("fps", winnow(F.col("context"), F.col("topic"))).select("id", "context", "topic", F.size("fps").alias("n"), F.explode("fps").alias("fp")))
        rows = flat.count()
        if not rows:
            return keyed.select("id", F.col("id").alias("recording_id"))
        key = F.xxhash64("context").alias("key")
        flat_of = flat.select("fp", key, "topic", "n", "id")
        known = flat_of.withColumnRenamed("id", "node")
        if runs:
            known = known.unionByName(self._stored(flat, rows, version, runs).select("fp", key, "topic", "n", F.col("recording_id").alias("node")))
        other = known.select("fp", "key", F.col("topic").alias("k_topic"), F.col("n").alias("k_n"), "node")
        pairs = flat_of.join(other, ["fp", "key"]).where("node <> id").groupBy("key", "id", "topic", "n", "node", "k_topic", "k_n").agg(F.count("*").alias("shared"))
        pairs = pairs.where((F.col("shared") >= least_coverage * F.least("n", "k_n")) & _same(F.col("topic"), F.col("k_topic")))
        labels = components(pairs.select("key", F.col("id").alias("a"), F.col("node").alias("b")), max(1, -(-rows // self.part_rows)))
        own = records.join(labels, F.col("id") == F.col("node"), "left").select("context", "topic", F.col("id").alias("root"), F.coalesce("label", "id").alias("recording_id"))
        out = cut(keyed.join(own, ["context", "topic"]).select("id", "recording_id"))
        ids = keyed.select(F.col("id").alias("node"))
        self._commit(version + 1, runs, flat, rows, out, labels.where("label < node").join(ids, "node", "left_anti"))
        return out

    def _commit(self, version: int, runs: list, flat: DataFrame, rows: int, out: DataFrame, moved: DataFrame) -> None:
        new = cut(moved.select(F.col("node").alias("old"), F.col("label").alias("new")))
        if not new.isEmpty():
            # merges lead to the end at once: those that led to a recording now merged are renewed
            again = self._merges(version).withColumnRenamed("new", "mid").join(new.withColumnRenamed("old", "mid"), "mid").select("old", "new")
            cut(new.unionByName(again).withColumn("version", F.lit(version).cast("long"))).select("version", "old", "new").write.mode("append").parquet(f"{self.path}/merges")
        out.write.mode("overwrite").parquet(f"{self.path}/members/{version}")
        labelled = flat.join(out, "id").select("fp", "id", "context", "topic", "n", "recording_id")
        live = [(r["run"], r["tier"], r["parts"], r["rows"]) for r in runs] + [self._write(f"r{version}", 0, labelled, rows)]
        tier, gone = 0, []
        while len(same := [r for r in live if r[1] == tier]) >= self.fan:
            merged = self._read("fingerprints", [f"{self.path}/fingerprints/run={r[0]}" for r in same]).drop("run", "part")
            live = [r for r in live if r[1] != tier] + [self._write(f"r{version}t{tier + 1}", tier + 1, merged, sum(r[3] for r in same))]
            gone, tier = gone + [r[0] for r in same], tier + 1
        self.spark.createDataFrame([(version, *r) for r in live], _STORED["manifest"]).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        for name in gone:
            for kind in (f"fingerprints/run={name}", f"filters/{name}"):
                fs, at = file_system(self.spark, f"{self.path}/{kind}")
                fs.delete(at, True)

    def _write(self, run: str, tier: int, fps: DataFrame, rows: int) -> tuple:
        parts = max(1, -(-rows // self.part_rows))
        kept = fps.withColumns({"run": F.lit(run), "part": F.pmod("fp", F.lit(parts)).cast("int")})
        at = f"{self.path}/fingerprints/run={run}"
        kept.drop("run").repartition(parts, "part").sortWithinPartitions("part", "fp").write.mode("overwrite").partitionBy("part").parquet(at)
        built = self._read("fingerprints", [at]).select("run", "part", "fp").distinct().groupBy("run", "part").applyInPandas(_filter, _STORED["filters"])
        built.write.mode("overwrite").parquet(f"{self.path}/filters/{run}")
        return run, tier, parts, rows


def _same(a: Column, b: Column) -> Column:
    @F.arrow_udf(T.BooleanType())
    def verified(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([same_topic(s, t) for s, t in zip(x.to_pylist(), y.to_pylist())], pa.bool_())

    return verified(a, b)


def find_repeats(files: DataFrame, committees: DataFrame, rounds: int = 3, store: RecordingStore | None = None) -> DataFrame:
    """(id_a, id_b): id_b repeats the recording whose lowest id is id_a.

    The delivered batches (date_created) are admitted in ``rounds`` groups of consecutive
    batches, each checked against the store left by those before; the result doesn't
    depend on the cuts, as later links relabel earlier records.
    """
    spark = files.sparkSession
    titles = cut(read_titles(files, committees))
    edges = [b for b in (titles.selectExpr(f"percentile_approx(unix_micros(batch), array({','.join(str(i / rounds) for i in range(1, rounds))})) AS q").first()["q"] or [])] if rounds > 1 else []
    store, low = store or RecordingStore(spark), None
    at = F.coalesce(F.unix_micros("batch"), F.lit(1 << 62))
    for high in [*sorted(set(edges)), None]:
        part = titles
        if low is not None:
            part = part.where(at > low)
        if high is not None:
            part = part.where(at <= high)
        store.admit(part)
        low = high
    kind = dict(files.dtypes)["id"]
    return store.members().where("recording_id < id").select(F.col("recording_id").cast(kind).alias("id_a"), F.col("id").cast(kind).alias("id_b"))
