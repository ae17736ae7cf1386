"""Quality rules as a bitmask ledger.

Each text is measured once and every rule is evaluated once; the ledger holds
the measurements and one bit per failed rule. A policy is a versioned mask of
the rules it enforces, so applying one, or asking what a rule alone removes
(an ablation), is integer arithmetic over the ledger: no text is read again.

Words are runs of anything but the ASCII white space x20, x09-x0D.

Defined results: a null or empty text has no words and fails ``few_words``
only; equal rows are judged alike; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import fresh, map_batches, materialise, pieces, utf8

WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper"]
NOT_WORD = bytes(range(0x80, 0xC0)) + b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(0x41, 0x5B))
ASCII_LETTERS = UPPER + bytes(range(0x61, 0x7B))


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` (an SQL condition over the measurements) holds; ``since`` is the
    first policy version that enforces it. Bits are given out in order and never reused."""

    name: str
    fails: str
    since: int = 1


#: Policy 1 is the base; later versions add rules. Clean prose is far from every bound.
RULES = [
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", 2),
    Rule("duplicate_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 50 * n_lines", 2),
    Rule("word_length", "n_words >= 20 and (word_chars < 2 * n_words or word_chars > 20 * n_words)", 2),
    Rule("shouting", "n_words >= 20 and n_letters >= 20 and 2 * n_upper > n_letters", 2),
]
LATEST = 2


def bit(name: str, rules: list[Rule] = RULES) -> int:
    return 1 << [r.name for r in rules].index(name)


def policy(version: int, rules: list[Rule] = RULES) -> int:
    """Mask of the rules that ``version`` enforces."""
    return sum(1 << i for i, r in enumerate(rules) if r.since <= version)


def repeat_words(words: list[bytes]) -> int:
    """Words lying in a window of eight words that occurs more than once in the text.

    Windows are compared by a 64-bit hash first; those that look repeated are
    compared word by word.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    count = n - WINDOW + 1
    key = ids[:count].copy()
    for j in range(1, WINDOW):
        key *= np.uint64(0x9E3779B97F4A7C15)
        key += ids[j:count + j]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(key, twice)).tolist()
    windows = [tuple(words[i:i + WINDOW]) for i in at]
    counts = Counter(windows)
    edge = np.zeros(n + 1, np.int64)
    hits = np.array([i for i, w in zip(at, windows) if counts[w] > 1], np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + WINDOW, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = len(text) - len(text.translate(None, ASCII_LETTERS))
    upper = len(text) - len(text.translate(None, UPPER))
    if not text.isascii():
        other = [c for c in text.decode("utf-8", "replace") if c > "\x7f" and c.isalpha()]
        letters += len(other)
        upper += sum(c.isupper() for c in other)
    return (len(words), len(text.translate(None, NOT_WORD)), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines), letters, upper)


def measured(df: DataFrame, text_col: str = "text", names: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the measurements appended (column names by ``names``, default :data:`MEASURES`)."""
    names = names or {m: m for m in MEASURES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, text_col):
                rows = [measure(t) for t in utf8(batch, text_col)]
                cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *cols],
                                                 names=[*batch.schema.names, *(names[m] for m in MEASURES)])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), *(f"`{names[m]}` bigint" for m in MEASURES)])
    return map_batches(df, run, schema)


def failed_bits(rules: list[Rule] = RULES, names: dict[str, str] | None = None) -> Column:
    """Failure bits over measurement columns, each rule evaluated once."""
    total = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        condition = rule.fails
        for m in sorted(names or {}, key=len, reverse=True):
            condition = condition.replace(m, f"`{names[m]}`") if names[m] != m else condition
        total = total.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return total


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: id, the measurements, ``failed`` (bits)."""
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (measured(narrow).select(F.col("id").alias(id_col), *MEASURES)
            .withColumn("failed", failed_bits(rules)))


def apply_policy(book: DataFrame, version: int = LATEST, rules: list[Rule] = RULES) -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    return book.withColumn("kept", F.col("failed").bitwiseAND(F.lit(policy(version, rules))) == 0)


def ablations(book: DataFrame, version: int = LATEST, rules: list[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it removes, and that would be kept without it.

    The ledger is first reduced to counts per distinct mask (at most two to
    the number of rules), so the rest is arithmetic on a few rows.
    """
    mask = policy(version, rules)
    masks = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    one = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
           for i, r in enumerate(rules) if mask >> i & 1]
    sum_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return (masks.select("bits", "n", F.explode(F.array(*one)).alias("r")).select("bits", "n", "r.*")
            .groupBy("rule")
            .agg(sum_if(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
                 sum_if(F.col("bits") == F.col("bit")).alias("n_only"),
                 sum_if(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"),
                 F.bit_or("bits").alias("seen_bits"), F.sum("n").alias("n_documents")))


def filter_documents(df: DataFrame, text_col: str = "text", version: int = LATEST) -> DataFrame:
    """The rows of ``df`` that the policy keeps, columns unchanged."""
    names = {m: fresh(df, f"_{m}") for m in MEASURES}
    body = measured(df, text_col, names)
    keep = failed_bits(RULES, names).bitwiseAND(F.lit(policy(version))) == 0
    return body.filter(keep).select(*df.columns)


__all__ = ["Rule", "RULES", "LATEST", "bit", "policy", "measure", "repeat_words", "measured", "failed_bits", "ledger",
           "apply_policy", "ablations", "filter_documents", "materialise"]
