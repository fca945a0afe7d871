"""Subject areas of documents, by label propagation over a document-similarity graph.

Nodes are passages (a few sentences in a row) of the documents. They are linked through
their sentences: sentences of the same set of distinctive words, in whatever documents,
are one representative, found by comparing the sets; representatives are linked as far as
they share distinctive words. A link is verified by its word: it must be neither rare, nor
of the language's common stock, nor spread over the subjects. The graph is kept passage -
sentence - word, since all pairs of the passages of a word would be too many. A step is
DataFrame joins there and back: words to sentences to passages, and back.

Labels set by hand are incomplete and partly wrong. Those which the words of some
passage of their document bear out are trusted seeds: such passages are clamped to the
seed in every step, and trusted seeds are in the result. Passages keep all their subjects.
Steps end when they change the leading subject of no more than SETTLED of the words.

A document is about a subject if sentences that lead to it stand close together in
passages that bear its label after the last step, so that a passing mention doesn't count
however long the document is.

Words are whole words and word beginnings without accents; the latter carry subjects
over misreadings, inflections and between related languages.

Size bound of the word table, which joins may broadcast: a word is kept only if it is in
MIN_SHARE of the documents, so no more than (distinct words a document / MIN_SHARE) are.

Defined results: NULL, empty and blank texts and documents without a subject have no
row; labels of unknown documents or subjects are ignored; repeated labels count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rostrum.session import cut, materialize, spread

BLOCK = 3  # sentences of a passage
MIN_SHARE, MIN_DOCS = 5e-4, 3
MAX_SHARE = 0.3  # of a language's documents: its common stock of words
STEM = 5
PRIOR = 0.3
TRUST = 0.5  # share of a passage that bears a label out
BEARS = 0.1  # least share of a passage's label
SETTLED, STEPS = 0.02, 12  # steps end when settled; a graph that never settles ends after STEPS
NEAR, NEED = 4, 2  # so many sentences of the subject within a stretch of NEAR

_ACCENTS = ("áàâäãåéèêëíìîïóòôöõúùûüçñý", "aaaaaaeeeeiiiiooooouuuucny")


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"(?<=[.?!])\s+|\n+"), lambda s: F.length(F.trim(s)) > 0)


def words(sentence: Column) -> Column:
    """Distinct words of four letters or more, and the beginnings of longer ones."""
    w = F.array_distinct(F.regexp_extract_all(F.lower(sentence), F.lit(r"\p{L}{4,}"), 0))
    stems = F.transform(F.filter(w, lambda x: F.length(x) > STEM), lambda x: F.concat(F.lit("~"), F.substring(F.translate(x, *_ACCENTS), 1, STEM)))
    return F.array_distinct(F.concat(w, stems))


def distinctive(docs: DataFrame) -> DataFrame:
    """(word, f): the words that may link passages, with their key. docs: (l, sents), the
    words of each sentence."""
    counts = docs.select("l", F.explode(F.array_distinct(F.flatten("sents"))).alias("word")).groupBy("word", "l").count()
    sizes = docs.groupBy("l").agg(F.count("*").alias("size"))
    total = docs.agg(F.count("*").alias("total"))
    stat = (
        counts.join(sizes, "l")
        .groupBy("word")
        .agg(F.sum("count").alias("n"), F.max(F.when((F.col("size") >= 30) & ~F.col("l").isin("", "un"), F.col("count") / F.col("size"))).alias("share"))
        .join(F.broadcast(total), F.lit(True))  # one row
        .where((F.col("n") >= F.greatest(F.lit(MIN_DOCS), F.col("total") * MIN_SHARE)) & (F.coalesce("share", F.lit(0)) <= MAX_SHARE))
    )
    stat = cut(stat.select("word", "n"))
    # a beginning that one word accounts for adds nothing
    whole = stat.where("NOT startswith(word, '~')")
    best = whole.where(F.length("word") > STEM).groupBy(F.concat(F.lit("~"), F.substring(F.translate("word", *_ACCENTS), 1, STEM)).alias("word")).agg(F.max("n").alias("m"))
    stems = stat.where("startswith(word, '~')").join(best, "word", "left").where("m IS NULL OR n > 1.05 * m").select("word", "n")
    return materialize(whole.unionByName(stems).select("word", F.xxhash64("word").alias("f")), "subject-words")


class SubjectGraph:
    """Passages, sentences and words of a corpus, and the propagation over them.

    Subjects are numbered; a word's scores are rows (f, z, p, v): its share p of subject z
    and the weight v of its links.
    """

    def __init__(self, documents: DataFrame, areas: DataFrame, labels: DataFrame):
        self.subjects = [r[0] for r in areas.where("subject IS NOT NULL").select("subject").distinct().orderBy("subject").limit(1001).collect()]
        if len(self.subjects) > 1000:
            raise ValueError("more than 1000 subjects")
        spark = documents.sparkSession
        number = spark.createDataFrame([(s, i) for i, s in enumerate(self.subjects)], "subject string, z int")
        lang = F.substring(F.lower(F.trim(F.coalesce("lang", F.lit("")))), 1, 2)
        docs = spread(documents.select("doc_id", "text", "lang").where("trim(text) <> '' AND doc_id IS NOT NULL"))
        docs = materialize(docs.select("doc_id", lang.alias("l"), F.transform(sentences(F.col("text")), words).alias("sents")), "subject-texts")
        vocabulary = distinctive(docs)
        found = docs.select("doc_id", F.posexplode("sents").alias("sent", "ws")).select("doc_id", "sent", F.explode("ws").alias("word")).join(vocabulary, "word").groupBy("doc_id", "sent").agg(F.sort_array(F.collect_set("f")).alias("fs"))
        sents = materialize(found.withColumn("sig", F.xxhash64("fs")), "subject-sentences")
        self.texts = materialize(sents.groupBy("sig").agg(F.first("fs").alias("fs")), "subject-representatives")
        self.places = materialize(sents.select("doc_id", F.floor(F.col("sent") / BLOCK).cast("int").alias("blk"), "sent", "sig"), "subject-places")
        self.seeds = cut(labels.where("doc_id IS NOT NULL").join(F.broadcast(number), "subject").join(docs.select("doc_id"), "doc_id", "left_semi").select("doc_id", "z").distinct())
        text = F.concat_ws(" ", "subject", F.coalesce("description", F.lit("")))
        self.described = cut(areas.where("subject IS NOT NULL").select("subject", F.explode(words(text)).alias("word")).join(vocabulary, "word").join(F.broadcast(number), "subject").select("f", "z").distinct())

    def _scores(self, weights: DataFrame) -> DataFrame:
        """The scores of words from weights (f, z, w), to which the descriptions' words are
        added; only words that lean to some subject have any."""
        mass = weights.unionByName(self.described.select("f", "z", F.lit(1.0).alias("w"))).groupBy("f", "z").agg(F.sum("w").alias("w"))
        base = F.element_at(F.array(*(F.lit(float(b)) for b in self.base)), F.col("z") + 1)
        one = mass.groupBy("f").agg(F.sum("w").alias("t"), F.collect_list(F.struct("z", "w", base.alias("b"))).alias("l")).where("t > 0")
        share = F.transform("l", lambda x: F.struct(x["z"].alias("z"), ((x["w"] + PRIOR * x["b"]) / (F.col("t") + PRIOR)).alias("p")))
        one = one.select("f", share.alias("l")).withColumn("top", F.array_max(F.transform("l", lambda x: x["p"])))
        v = F.greatest(F.lit(0.0), (F.col("top") - 0.3) / 0.7)
        return cut(one.where(v > 0).select("f", "top", v.alias("v"), "l"))

    def start(self) -> DataFrame:
        """Word scores from the labels alone: each word once a document and label."""
        share = self.seeds.join(self.seeds.groupBy("doc_id").agg((1 / F.count("*")).alias("w")), "doc_id")
        per = share.groupBy("z").agg(F.sum("w").alias("b")).collect()  # a row a subject
        n = sum(r["b"] for r in per)
        got = {r["z"]: r["b"] for r in per}
        self.base = [(got.get(i, 0) + 1) / (n + len(self.subjects)) for i in range(len(self.subjects))]
        seeded = self.places.join(self.seeds.select("doc_id").distinct(), "doc_id", "left_semi").join(self.texts, "sig").select("doc_id", F.explode("fs").alias("f")).distinct()
        return self._scores(seeded.join(share, "doc_id").groupBy("f", "z").agg(F.sum("w").alias("w")))

    def _sentences(self, scores: DataFrame, weight: Column) -> DataFrame:
        """(sig, zs): the subjects of the representatives and their weights by their words."""
        met = self.texts.select("sig", F.explode("fs").alias("f")).join(scores, "f").select("sig", F.explode("l").alias("x"), "v", "top")
        one = met.select("sig", "x.z", weight.alias("w")).where("w > 0").groupBy("sig", "z").agg(F.sum("w").alias("s"))
        return one.groupBy("sig").agg(F.collect_list(F.struct("z", "s")).alias("zs"))

    def passages(self, scores: DataFrame) -> DataFrame:
        """(doc_id, blk, z, q): the labels of the passages. Shares are squared, weak ones
        dropped and the rest scaled down where few words speak."""
        by_text = self._sentences(scores, F.col("v") * F.col("x.p"))
        met = self.places.select("doc_id", "blk", "sig").join(by_text, "sig").select("doc_id", "blk", "zs").repartition("doc_id", "blk")
        s = met.select("doc_id", "blk", F.explode("zs").alias("x")).groupBy("doc_id", "blk", "x.z").agg(F.sum("x.s").alias("s"))
        one = s.groupBy("doc_id", "blk").agg(F.sum("s").alias("t"), F.sum(F.col("s") * F.col("s")).alias("t2"), F.collect_list(F.struct("z", "s")).alias("l")).where("t > 0.3")
        q = one.select("doc_id", "blk", "t", "t2", F.explode("l").alias("x")).select("doc_id", "blk", "x.z", (F.col("x.s") * F.col("x.s") / F.col("t2")).alias("q"), "t")
        return q.where(F.col("q") > BEARS).select("doc_id", "blk", "z", (F.col("q") * F.least(F.lit(1.0), F.col("t") / 2)).alias("q"))

    def trust(self, scores: DataFrame) -> None:
        """Keeps as seeds the labels that a passage of their document bears out."""
        borne = self.passages(scores).where(F.col("q") >= TRUST).select("doc_id", "z").distinct()
        self.seeds = cut(self.seeds.join(borne, ["doc_id", "z"], "left_semi"))

    def clamped(self, scores: DataFrame) -> DataFrame:
        """passages, those clamped whose leading label is a trusted seed of their document."""
        p = self.passages(scores).join(self.seeds.withColumn("seed", F.lit(True)), ["doc_id", "z"], "left")
        lead = F.max(F.struct("q", "z", "seed")).over(W.partitionBy("doc_id", "blk"))
        fixed = F.coalesce(lead["seed"], F.lit(False))
        return p.select("doc_id", "blk", "z", F.when(~fixed, F.col("q")).when(lead["z"] == F.col("z"), 1.0).alias("q")).where("q IS NOT NULL")

    def step(self, scores: DataFrame) -> DataFrame:
        """Labels move from words to passages and back."""
        back = self.places.select("doc_id", "blk", "sig").join(self.clamped(scores), ["doc_id", "blk"]).groupBy("sig", "z").agg(F.sum("q").alias("q"))
        return self._scores(back.join(self.texts, "sig").select(F.explode("fs").alias("f"), "z", "q").groupBy("f", "z").agg(F.sum("q").alias("w")))

    def settled(self, old: DataFrame, new: DataFrame) -> bool:
        """Whether a step has left the leading subject of all but SETTLED of the words."""
        lead = lambda df: df.select("f", F.array_max(F.transform("l", lambda x: F.struct(x["p"], x["z"])))["z"].alias("z"))
        both = lead(old).join(lead(new).withColumnRenamed("z", "y"), "f", "full")
        got = both.agg(F.count_if(~F.col("z").eqNullSafe(F.col("y"))).alias("moved"), F.count("*").alias("n")).first()
        return got["moved"] <= SETTLED * got["n"]

    def assign(self, scores: DataFrame) -> DataFrame:
        """(doc_id, subject): subjects of sentences that stand close together in passages of
        that label, and trusted seeds."""
        bears = self.clamped(scores).select("doc_id", "blk", "z")
        sure = F.when((F.col("top") > 0.55) & (F.col("x.p") == F.col("top")), F.col("top") - 0.4)
        best = F.array_max(F.transform("zs", lambda x: F.struct(x["s"].alias("s"), (-x["z"]).alias("n"))))  # the first of equals
        lead = self._sentences(scores, F.coalesce(sure, F.lit(0.0))).select("sig", best.alias("b")).where("b.s > 0.25").select("sig", (-F.col("b.n")).alias("z"))
        sent = self.places.join(lead, "sig").join(bears, ["doc_id", "blk", "z"], "left_semi").select("doc_id", "sent", "z")
        w = W.partitionBy("doc_id", "z").orderBy("sent")
        near = sent.withColumn("_before", F.lag("sent", NEED - 1).over(w)).where(F.col("sent") - F.col("_before") < NEAR)
        names = F.array(*(F.lit(s) for s in self.subjects))
        return near.select("doc_id", "z").unionByName(self.seeds).distinct().select("doc_id", F.element_at(names, F.col("z") + 1).alias("subject"))


def found(documents: DataFrame, areas: DataFrame, labels: DataFrame, steps: int = STEPS) -> DataFrame:
    """(doc_id, subject), a row for each subject a document is about."""
    graph = SubjectGraph(documents, areas, labels)
    if not graph.subjects:
        return documents.select("doc_id", F.lit("").alias("subject")).where("false")
    scores = graph.start()
    graph.trust(scores)
    for _ in range(steps):
        old, scores = scores, graph.step(scores)
        if graph.settled(old, scores):
            break
    return graph.assign(scores)


def composition(assigned: DataFrame, documents: DataFrame) -> DataFrame:
    """(subject, documents, characters) of the corpus; a document counts under each of its subjects."""
    return assigned.join(documents.select("doc_id", "n_chars"), "doc_id").groupBy("subject").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("characters"))
