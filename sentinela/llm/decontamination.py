"""Benchmark decontamination on a distributed positional inverted index. DataFrame functions only.

The index holds one posting ``(row, doc_id, pos, term)`` for every training word
that also occurs in the test items, written as a Parquet table in the order of
the scan (no shuffle), and for every document one row without a term whose
``pos`` is the document's number of words.

Exact phrases (windows of ``width`` consecutive item words, a shorter item being
one window) are found by intersecting offset-adjusted posting lists:

1. The terms of a window are ordered by the length of their lists. The list of
   the rarest term, moved to the window's start, is intersected with the list of
   the second rarest; windows that share these two terms at the same distance
   share the intersection.
2. What is left are alignments (item, row, shift) of an item with a document.
   The other terms of their windows are looked up in the postings at
   ``shift + offset``, all at once.
3. Runs of consecutive offsets found there that are as long as a window are hits.

Proximity matches ask for all terms of a window near its rarest one, in any order.

Vocabulary, list lengths and windows are tables of their own, written first, so
Spark knows their size and broadcasts them only below its threshold; beyond it
the same joins shuffle. No group is collected but the item ids of a document,
at most as many as it has hit words.

Defined results: null texts have no words (``n_words`` 0, not contaminated);
items without words have no windows; repeated document rows are answered each
on its own, rows of one item id are one item; a null item id is the item named
by the empty string; empty tables give an empty result or clean documents.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentinela.llm.base import materialise

WIDTH = 10
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text as they stand (letter case kept), an empty array for null."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), F.lit(0))


def folded(word: Column) -> Column:
    """Only A-Z lower-cased; the quick way for words of ASCII characters."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)) \
        .otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


# --- test items -------------------------------------------------------------

def item_words(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, name, at, word, n): the words of every item row; ``item`` numbers the distinct rows."""
    rows = (items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"),
                         F.transform(words(F.col(text_col)), folded).alias("w"))
            .filter(F.size("w") > 0).distinct())
    # Equal rows were merged, so the name and a digest of the words name a row.
    named = rows.select(F.sha2(F.concat_ws(" ", "name", "w"), 256).alias("item"), "name", "w", F.size("w").alias("n"))
    return named.select("item", "name", "n", F.posexplode("w").alias("at", "word"))


def vocabulary(asked: DataFrame) -> DataFrame:
    """(word, term): the distinct item words, numbered; to be written before use, so that the numbers stay."""
    return asked.select("word").distinct().select("word", F.monotonically_increasing_id().alias("term"))


# --- index ------------------------------------------------------------------

def index(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, pos, term): the postings of the vocabulary's words; with term null, pos is the number of words."""
    found = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                         words(F.col(text_col)).alias("w"))
             # The element after the last word marks the document itself.
             .select("row", "doc_id", F.posexplode(F.array_append("w", F.lit(None).cast("string"))).alias("pos", "raw"))
             .withColumn("word", folded(F.col("raw"))))
    return (found.join(vocab, "word", "left").filter("term IS NOT NULL OR word IS NULL")
            .select("row", "doc_id", "pos", "term"))


def list_lengths(postings: DataFrame) -> DataFrame:
    return postings.filter("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("df"))


def windows(asked: DataFrame, vocab: DataFrame, lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, start, len, t1, o1, t2, o2): each window's two rarest terms and their offsets; t2 is null for one word.

    Windows with a word that no document has are left out.
    """
    terms = asked.join(vocab, "word").join(lengths, "term", "left").select("item", "n", "at", "term", F.coalesce("df", F.lit(0)).alias("df"))
    reach = F.least("n", F.lit(width))
    first = F.greatest(F.col("at") - reach + 1, F.lit(0))
    last = F.least(F.col("at"), F.col("n") - reach)
    spread = terms.select("item", reach.alias("len"), F.explode(F.sequence(first, last)).alias("start"), "at", "term", "df")
    best = spread.groupBy("item", "start", "len").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("df", (F.col("at") - F.col("start")).alias("o"), "term"))), 1, 2).alias("r"))
    return best.filter(F.col("r")[0]["df"] > 0).select(
        "item", "start", "len", F.col("r")[0]["term"].alias("t1"), F.col("r")[0]["o"].alias("o1"),
        F.get("r", F.lit(1))["term"].alias("t2"), F.get("r", F.lit(1))["o"].alias("o2"))


# --- phrases ----------------------------------------------------------------

def candidate_windows(postings: DataFrame, wins: DataFrame) -> DataFrame:
    """(item, row, shift, start, len): windows whose two rarest terms stand in a document at the right distance."""
    near = wins.withColumn("delta", F.col("o2") - F.col("o1"))
    listed = postings.filter("term IS NOT NULL").select("row", "pos", "term")
    pairs = near.select("t1", "t2", "delta").distinct()
    rare = listed.join(pairs, listed.term == pairs.t1).select("row", "pos", "t1", "t2", "delta")
    seconds = listed.join(pairs.select(F.col("t2").alias("term")).distinct(), "term", "left_semi") \
        .select(F.col("row").alias("row2"), F.col("pos").alias("pos2"), F.col("term").alias("term2"))
    both = (rare.filter("t2 IS NOT NULL")
            .join(seconds, (F.col("row") == F.col("row2")) & (F.col("pos") + F.col("delta") == F.col("pos2"))
                  & (F.col("t2") == F.col("term2")))
            .select("row", "pos", "t1", "t2", "delta"))
    alone = rare.filter("t2 IS NULL")
    met = both.unionByName(alone).withColumnsRenamed({"t1": "a", "t2": "b", "delta": "d"})
    return (met.join(near, (F.col("a") == F.col("t1")) & F.col("b").eqNullSafe(F.col("t2")) & F.col("d").eqNullSafe(F.col("delta")))
            .filter(F.col("pos") >= F.col("o1"))
            .select("item", "row", (F.col("pos") - F.col("o1") - F.col("start")).alias("shift"), "start", "len"))


def phrase_runs(postings: DataFrame, asked: DataFrame, vocab: DataFrame, wins: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, name, row, begin, end): maximal runs of document words that equal an item's words, of a window or more."""
    offsets = F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("at")
    needed = candidate_windows(postings, wins).select("item", "row", "shift", offsets).distinct()
    spelled = asked.join(vocab, "word").select("item", "at", F.col("term").alias("wanted"), "name", "n")
    needed = needed.join(spelled, ["item", "at"]).withColumn("place", F.col("shift") + F.col("at"))
    rows = needed.select("row").distinct()
    listed = (postings.filter("term IS NOT NULL").join(rows, "row", "left_semi")
              .select(F.col("row").alias("in_row"), "pos", "term"))
    same = needed.join(listed, (needed.row == listed.in_row) & (needed.place == listed.pos) & (needed.wanted == listed.term))
    order = Window.partitionBy("item", "row", "shift").orderBy("at")
    runs = (same.select("item", "name", "row", "shift", "at", "n", (F.col("at") - F.row_number().over(order)).alias("run"))
            .groupBy("item", "name", "row", "shift", "n", "run").agg(F.min("at").alias("a"), F.max("at").alias("b")))
    return (runs.filter(F.col("b") - F.col("a") + 1 >= F.least("n", F.lit(width)))
            .select("item", "name", "row", (F.col("shift") + F.col("a")).alias("begin"), (F.col("shift") + F.col("b") + 1).alias("end")))


def proximity_matches(postings: DataFrame, asked: DataFrame, vocab: DataFrame, lengths: DataFrame,
                      reach: int = 20, width: int = WIDTH) -> DataFrame:
    """(item, start, row, pos): occurrences of a window's rarest term with all its other terms within ``reach`` words."""
    wins = windows(asked, vocab, lengths, width).select("item", "start", "len", "t1")
    rest = asked.join(vocab, "word").select("item", "at", "term")
    terms = (wins.join(rest, "item").filter((F.col("at") >= F.col("start")) & (F.col("at") < F.col("start") + F.col("len")))
             .select("item", "start", "term").distinct())
    count = terms.groupBy("item", "start").agg(F.count("*").alias("asked"))
    listed = postings.filter("term IS NOT NULL").select("row", "pos", "term")
    near = (listed.join(wins, listed.term == wins.t1).select("item", "start", "row", "pos")
            .join(terms, ["item", "start"]))
    # Positions meet in strips of ``reach`` words: a near posting lies in the same strip or one beside it.
    strips = near.withColumn("strip", F.explode(F.array(*[F.floor(F.col("pos") / reach) + i for i in (-1, 0, 1)])))
    others = listed.select("row", "term", F.floor(F.col("pos") / reach).alias("strip"), F.col("pos").alias("other"))
    met = (strips.join(others, ["row", "term", "strip"]).filter(F.abs(F.col("pos") - F.col("other")) <= reach)
           .groupBy("item", "start", "row", "pos", "term").agg(F.lit(1).alias("one"))
           .groupBy("item", "start", "row", "pos").agg(F.count("*").alias("found")))
    return met.join(count, ["item", "start"]).filter("found = asked").select("item", "start", "row", "pos")


# --- the whole --------------------------------------------------------------

def build(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(postings, item words, vocabulary, list lengths), each a written table."""
    asked = materialise(item_words(items, item_col, item_text), "decontam-items")
    vocab = materialise(vocabulary(asked), "decontam-vocabulary")
    postings = materialise(index(docs, vocab, id_col, text_col), "decontam-postings")
    return postings, asked, vocab, materialise(list_lengths(postings), "decontam-lengths")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id_col``, n_words, n_hit, items (sorted item ids as strings) and spans (begin, end in words) per document row."""
    postings, asked, vocab, lengths = build(docs, items, id_col, text_col, item_col, item_text)
    wins = materialise(windows(asked, vocab, lengths, width), "decontam-windows")
    runs = materialise(phrase_runs(postings, asked, vocab, wins, width), "decontam-runs")
    # Overlapping runs, of one item or several, are merged so that each word counts once.
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = (runs.select("row", "begin", "end").distinct()
             .withColumn("opens", F.coalesce(F.col("begin") > F.max("end").over(before), F.lit(True)).cast("int"))
             .withColumn("span", F.sum("opens").over(before.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("row", "span").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
             .groupBy("row").agg(F.sum(F.col("end") - F.col("begin")).alias("n_hit"),
                                 F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans")))
    named = runs.groupBy("row").agg(F.array_sort(F.collect_set("name")).alias("items"))
    found = postings.filter("term IS NULL").join(spans.join(named, "row"), "row", "left")
    return found.select(F.col("doc_id").alias(id_col), F.col("pos").cast("long").alias("n_words"),
                        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")
