"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

1. A lexicon is learned from labelled documents: whole words and word
   beginnings (4 to 8 letters) that occur far more often under label 1. A
   short public list of insults is always part of it.
2. Each text, whole, becomes a dense vector: lexicon densities, second-person
   words near a hit, capitals, punctuation and obfuscation rates.
3. Spark ML's gradient-boosted trees are fitted on one part of the labelled
   sample and an isotonic regression on the other, so that the score is a
   calibrated probability; a thousandth of the raw one keeps the order within
   a step.

Sampling bound: ``TRAIN_ROWS`` labelled documents (lowest hash of the id);
features and scores cover every row. Defined results: null counts as the empty
text, whose vector is zero and which is scored like any other; several labels
of one id count as 1 if any is 1; without both classes among the labels every
score is the share of label 1 (0 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import map_batches, materialise, pieces, strings

#: Labelled rows learned from (a quarter of them calibrates), and terms of the lexicon: the most frequent of those that
#: ``LEAST_LIFT`` and at least four (from 800 label-1 rows on, half a percent of these) label-1 documents speak for.
TRAIN_ROWS = 8000
LEXICON_SIZE = 400
STEM_LENGTHS = (4, 5, 6, 7, 8)
#: A term is learned when label-1 documents hold it this many times as often as others.
LEAST_LIFT = 20.0
#: Common insults, and second-person words of some languages.
INSULTS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown"]
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "tu", "toi", "ton", "vous", "votre", "du", "dich",
                 "dir", "dein", "deine", "ihr", "euch", "usted", "ustedes", "ti", "tus", "vosotros"]
NEAR = 60   # characters on either side of a hit
WORD = re.compile(r"[^\W\d_]+")
YOU = re.compile(r"\b(?:" + "|".join(SECOND_PERSON) + r")\b")
INSIDE = re.compile(r"[^\W\d_][0-9@$*!]+[^\W\d_]")
SPACED = re.compile(r"\b(?:[^\W\d_][ .\-*]){3,}[^\W\d_]\b")
LONG_RUN = re.compile(r"([^\W\d_])\1{3,}")
LEET = str.maketrans("013457@$!", "oieastasi")
UPPER, LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
FEATURES = ["word_density", "stem_density", "hits", "insult_density", "distinct_hits", "near_second_person",
            "hidden_hits", "inside_rate", "spaced_rate", "run_rate", "capital_share", "exclamation_rate",
            "question_rate", "symbol_rate", "comma_rate", "log_words", "word_length"]


def learnable(id_col: str = "doc_id") -> Column:
    """Rows whose labels may be learned from; the rest is held out."""
    return F.crc32(F.col(id_col).cast("string")) % 5 != 0


def terms(text: str) -> set[str]:
    """Candidate lexicon terms of a text: its words (marked with a final space) and their beginnings."""
    words = set(WORD.findall(text.lower()))
    return {w + " " for w in words} | {w[:k] for w in words for k in STEM_LENGTHS if len(w) >= k}


def learn_lexicon(train: DataFrame, n_toxic: int, n_clean: int, size: int = LEXICON_SIZE) -> list[str]:
    """Terms of ``train`` (text, toxic) by lift; each task counts its rows before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(strings(batch, "text"), batch.column(1).to_pylist()):
                (toxic if label else clean).update(terms(text))
        # Terms without a label-1 row here may have some elsewhere: all counts go on.
        keys = list(toxic.keys() | clean.keys())
        for at in range(0, len(keys), 50_000):
            part = keys[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([toxic[k] for k in part], pa.int64()),
                                              pa.array([clean[k] for k in part], pa.int64())], names=["term", "t", "n"])

    lift = ((F.col("t") + 0.5) / (n_toxic + 1)) / ((F.col("n") + 0.5) / (n_clean + 1))
    counts = (map_batches(train.select("text", "toxic"), run, "term string, t bigint, n bigint")
              .groupBy("term").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
              .filter((F.col("t") >= max(4, n_toxic // 200)) & (lift >= LEAST_LIFT)))
    return sorted(r["term"] for r in counts.orderBy(F.desc("t"), "term").limit(size).collect())


class Featuriser:
    def __init__(self, lexicon: list[str]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        self.insults = set(INSULTS)
        # A beginning also covers the whole word, so it takes the place of one.
        whole = {t[:-1]: True for t in [*lexicon, *(w + " " for w in INSULTS)] if t.endswith(" ")}
        for term, only in {**whole, **{t: False for t in lexicon if not t.endswith(" ")}}.items():
            self.automaton.add_word(term, (term, only))
        self.automaton.make_automaton()

    def hits(self, low: str) -> list[tuple[int, str, bool]]:
        """(start of word, term, whole word only) of every hit at the beginning of a word, one per word."""
        found: dict[int, tuple[int, str, bool]] = {}
        for end, (term, whole) in self.automaton.iter(low):
            start = end - len(term) + 1
            if start and low[start - 1].isalpha():
                continue
            if whole and end + 1 < len(low) and low[end + 1].isalpha():
                continue
            if start not in found or len(term) > len(found[start][1]):
                found[start] = (start, term, whole)
        return list(found.values())

    def __call__(self, text: str) -> list[float]:
        if not text:
            return [0.0] * len(FEATURES)
        raw = text.encode("utf-8", "replace")
        low = text.lower()
        n = max(len(raw.split()), 1)
        chars = len(text)
        hits = self.hits(low)
        whole = sum(w for _, _, w in hits)
        near = sum(bool(YOU.search(low, max(0, s - NEAR), s + NEAR)) for s, _, _ in hits)
        inside = len(INSIDE.findall(text))
        spaced = len(SPACED.findall(text))
        hidden = 0
        if inside or spaced:
            plain = low.translate(LEET)
            plain = SPACED.sub(lambda m: re.sub(r"[ .\-*]", "", m[0]), plain)
            hidden = max(0, len(self.hits(plain)) - len(hits))
        count = lambda marks: len(raw) - len(raw.translate(None, marks))
        upper, lower = count(UPPER), count(LOWER)
        return [whole / n, (len(hits) - whole) / n, float(np.log1p(len(hits))),
                sum(t in self.insults for _, t, _ in hits) / n, float(len({t for _, t, _ in hits})),
                near / n, float(np.log1p(hidden)), inside / n, spaced / n, len(LONG_RUN.findall(low)) / n,
                upper / max(upper + lower, 1), count(b"!") / n, count(b"?") / n, count(b"#*$%&|<>@") / n,
                count(b",;:") / n, float(np.log1p(n)), chars / n]


def features(df: DataFrame, lexicon: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the columns of :data:`FEATURES` for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Featuriser(lexicon)
        for whole in batches:
            for batch in pieces(whole, "text"):
                cols = list(zip(*(vector(t) for t in strings(batch, "text"))))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.float64()) for c in cols)],
                                                 names=["id", *FEATURES])

    kind = dict(df.dtypes)[id_col]
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (map_batches(narrow, run, f"id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))
            .withColumnRenamed("id", id_col))


def training_ids(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic, part): the bounded labelled sample; part 1 calibrates, part 0 grows the trees."""
    key = F.xxhash64(F.col("doc_id").cast("string"))
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learnable())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .withColumn("part", (F.pmod(key, F.lit(4)) == 0).cast("int"))
            .orderBy(key, "doc_id").limit(rows))


def score(docs: DataFrame, labels: DataFrame, iterations: int = 20, depth: int = 3) -> DataFrame:
    """``doc_id``, score (0 to 1) for every row of ``docs``; ``labels`` has doc_id and toxic (0 or 1)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    picked = materialise(training_ids(labels.select("doc_id", "toxic")), "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in picked.groupBy("toxic").count().collect()}
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    # The sample has at most TRAIN_ROWS rows, so it may be broadcast.
    # Part 1 calibrates, so neither trees nor lexicon learn from it.
    grown = {r["toxic"]: r["count"] for r in picked.filter("part = 0").groupBy("toxic").count().collect()}
    train_text = docs.select("doc_id", "text").join(F.broadcast(picked.filter("part = 0")), "doc_id")
    lexicon = learn_lexicon(train_text, grown.get(1, 0), grown.get(0, 0)) if len(grown) == 2 else []
    table = materialise(features(docs, lexicon), "toxicity-features")
    fit = materialise(table.join(F.broadcast(picked), "doc_id"), "toxicity-train")
    parts = {(r["part"], r["toxic"]): r["count"] for r in fit.groupBy("part", "toxic").count().collect()}
    if len(parts) < 4:
        return table.select("doc_id", F.lit(float(share)).alias("score"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=iterations, maxDepth=depth, seed=7,
                          stepSize=0.3, maxBins=32)
    model = trees.fit(assembler.transform(fit.filter("part = 0").coalesce(2)))
    raw = lambda df: (model.transform(assembler.transform(df))
                      .withColumn("raw", vector_to_array("probability")[1]))
    steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(
        raw(fit.filter("part = 1")).select("raw", F.col("toxic").cast("double").alias("label")))
    return (steps.transform(raw(table))
            .select("doc_id", F.least(F.greatest(F.col("calibrated") * 0.999 + F.col("raw") * 0.001,
                                                 F.lit(0.0)), F.lit(1.0)).alias("score")))


__all__ = ["training_ids", "learn_lexicon", "features", "score", "learnable", "Featuriser", "terms"]
