"""Corpus pipeline: from ``documents`` to packed training sequences in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that the
stage before kept, with every column of ``documents``; the last one returns
packed pieces. ``run`` writes each stage's result as Parquet to the shared
folder and reads it back as the next one's input.

1. ``language_id``: rows without an identified language go (null or letterless
   text, or two languages practically level).
2. ``quality_rules``: rows that fail a rule of the latest policy go.
3. ``jaccard_join``: of each group of near duplicates (five-word shingles,
   similarity 0.8 or more) the row with the smallest id stays.
4. ``suffix_dedup``: passages of over fifty words that occur more than once are
   cut out of the texts; every row stays, ``n_chars`` follows the text. Found
   are repeated strings of ``PASSAGE_BYTES``, so passages of one-letter words
   can be too short to be found.
5. ``packing``: what is left becomes sequences of at most 1024 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.llm import jaccard_join, language_id, packing, quality_ledger, suffix_dedup
from sentinela.llm.base import materialise, read_table

#: Passages of over fifty words: 51 words of two bytes, with spaces between, are 152 bytes.
PASSAGE_WORDS, PASSAGE_BYTES = 51, 152


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    samples = language_id.sample(docs.filter(language_id.learnable()))
    return language_id.filter_documents(docs, samples)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_ledger.filter_documents(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs, n=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(docs, length=PASSAGE_BYTES, least_words=PASSAGE_WORDS)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return cleaned.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("jaccard_join", join_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("packing", pack_sequences),
]
#: SQL has no learned models or tokenizers; the tests hold the Jaccard and suffix stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
