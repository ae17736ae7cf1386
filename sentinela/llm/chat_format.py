"""Chat formatting in Spark expressions only.

The turns of a conversation are collected as structs and sorted by
(turn, role, text); array aggregation merges neighbours of one role into one
block; the blocks are concatenated under a template:

    <|im_start|>ROLE
    TEXT<|im_sep|>TEXT<|im_end|>

``<|im_sep|>`` stands between merged turns, so the original turns can be read
back. Texts and roles are escaped first: ``&`` becomes ``&amp;`` and ``<|``
becomes ``&lt;|``, hence no control string can occur inside a text, and
unescaping (``&lt;`` first, then ``&amp;``) restores it exactly.

The loss mask is a list of (start, length) spans in code points of the
formatted string; each covers the escaped text of one assistant turn.

Defined results: null role or text counts as empty; equal (turn, role) rows
are ordered by text and all kept; a null conversation id is a conversation of
its own; an empty table gives an empty result. A conversation is the unit of
output, so its turns meet in one row; conversations are spread by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    """A role stands on one line."""
    return F.replace(escape(role), F.lit(NEWLINE), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit(NEWLINE)))


def merge_runs(turns: Column) -> Column:
    """Array of (role, texts): neighbouring turns of one role share a block.

    A turn starts a block where its role differs from the one before; block
    bounds are the starts, and each block is one slice of the sorted array.
    """
    index = F.sequence(F.lit(1), F.size(turns))
    starts = F.filter(index, lambda i: (i == 1) | (F.element_at(turns, i.cast("int"))["role"]
                                                   != F.try_element_at(turns, (i - 1).cast("int"))["role"]))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(turns) + 1))
    return F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e")),
        lambda b: F.struct(F.element_at(turns, b["s"].cast("int"))["role"].alias("role"),
                           F.transform(F.slice(turns, b["s"], b["e"] - b["s"]), lambda t: t["text"]).alias("texts")))


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_col``, formatted, loss_spans array<struct<start,length>>."""
    row = F.struct(F.col(turn_col).alias("turn"),
                   escape_role(F.coalesce(F.col(role_col).cast("string"), F.lit(""))).alias("role"),
                   escape(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"))
    grouped = (df.select(F.col(conv_col).alias("conv"), row.alias("row"))
               .groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("turns"))
               .select("conv", merge_runs(F.col("turns")).alias("blocks")))
    head = lambda b: F.concat(F.lit(START), b["role"], F.lit(NEWLINE))
    body = lambda b: F.array_join(b["texts"], SEP)
    written = grouped.withColumn("parts", F.transform("blocks", lambda b: F.concat(head(b), body(b), F.lit(END), F.lit(NEWLINE))))
    # Where each block begins: the lengths of all parts before it.
    sizes = F.transform("parts", lambda p: F.length(p).cast("long"))
    begins = F.aggregate(sizes, F.array(F.lit(1).cast("long")),
                         lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    spans = F.flatten(F.transform(
        F.filter(F.arrays_zip(F.col("blocks").alias("b"), F.slice(F.col("begins"), 1, F.size("blocks")).alias("at")),
                 lambda z: z["b"]["role"] == F.lit(loss_role)),
        lambda z: F.aggregate(
            z["b"]["texts"],
            F.struct((z["at"] + F.length(head(z["b"]))).alias("at"),
                     F.array().cast("array<struct<start:bigint,length:bigint>>").alias("out")),
            lambda acc, t: F.struct(
                (acc["at"] + F.length(t) + len(SEP)).alias("at"),
                F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"),
                                                      F.length(t).cast("long").alias("length")))).alias("out")),
            lambda acc: acc["out"])))
    return (written.withColumn("begins", begins)
            .select(F.col("conv").alias(conv_col), F.array_join("parts", "").alias("formatted"),
                    spans.alias("loss_spans")))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(_after_newline(b), r"<\|im_sep\|>"),
        lambda t: F.struct(unescape_role(_role(b)).alias("role"), unescape(t).alias("text")))))


def _role(block: Column) -> Column:
    """Between the start marker and the first newline that follows the role."""
    return F.regexp_extract(block, r"(?s)^<\|im_start\|>([^\n]*)", 1)


def _after_newline(block: Column) -> Column:
    return block.substr(F.length(_role(block)) + len(START) + 2, F.length(block))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        formatted.substr(s["start"].cast("int"), s["length"].cast("int")))), "")
