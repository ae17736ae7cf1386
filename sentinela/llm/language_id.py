"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a sample of its labelled
text. A text is parsed greedily into the longest phrases that occur in the
sample; the fewer phrases a language needs, the closer the text is to it. The
phrase count, times the bits that name a place in the sample and per letter of
the text, is an upper estimate of the cross entropy; the lowest one wins.

The greedy parse is a run of the automaton that goes back to its root whenever
it has no transition, so it is tabulated as one dense table per language
(state by letter class) with a mark on the steps that begin a phrase. Texts
are cut into blocks of ``BLOCK`` letters, a phrase ending at a block's end, and
all blocks of a batch take each step together.

Letters are lower-cased; a run of other characters is one space. Letters that
no sample has fit nothing and are a phrase each.

Sampling bound: per language whole labelled texts, in the order of a hash of the
id and those up to ``SHORT_CHARS`` characters first, as long as they are at most
``SAMPLE_DOCS`` and ``SAMPLE_CHARS`` characters together (the first one always);
no text is cut, and nothing else is bounded. Defined results: null text, or text without a letter, is ``und`` with
score 0; equal texts get equal answers; on a tie the smaller language name
wins; without labelled text everything is ``und``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.llm.base import fresh, map_batches, pieces, worker_table

UNKNOWN = "und"
#: Whole texts per language that are learned from, and their characters together; about 25 MB of tables a language.
SAMPLE_DOCS, SAMPLE_CHARS, SHORT_CHARS = 250, 40_000, 2000
BLOCK = 256
MARK = np.int32(1 << 30)
SPACE, OTHER, PAD = 0, 1, 2    # classes before those of the letters


def sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple[str, list[str]]]:
    """Bounded sample of whole labelled texts per language, as (language, texts), both in a fixed order."""
    key = F.xxhash64(F.col(id_col).cast("string"))
    rows = (df.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
            .select(F.col(lang_col).alias("lang"), (F.length(text_col) > SHORT_CHARS).alias("long"), key.alias("key"),
                    F.col(text_col).alias("passage")))
    # Few rows per language pass the first limit, so texts travel only for those.
    order = Window.partitionBy("lang").orderBy("long", "key", "passage")
    first = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= docs)
    total = F.sum(F.length("passage")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    kept = first.withColumn("total", total).filter((F.col("total") <= chars) | (F.col("n") == 1))
    out: dict[str, list[str]] = {}
    for r in kept.orderBy("lang", "n").collect():
        out.setdefault(r["lang"], []).append(r["passage"])
    return sorted(out.items())


def suffix_automaton(classes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a class string; state 0 is the root."""
    nexts, link, length = [{}], [-1], [0]
    last = 0
    for c in classes:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nexts


class CrossParser:
    def __init__(self, samples: list[tuple[str, list[str]]]):
        self.langs = [lang for lang, _ in samples]
        joined = [" ".join(p).lower() for _, p in samples]
        letters = sorted({c for t in joined for c in t if c.isalpha()})
        self.classes = PAD + 1 + len(letters)
        codes = np.zeros(0x110000, np.uint16)
        codes[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
        for k, c in enumerate(letters):
            codes[ord(c)] = PAD + 1 + k
        self.codes = codes
        self.tables, self.bits = [], []
        for text in joined:
            self.tables.append(self._table(text))
            self.bits.append(math.log2(max(len(text), 2)))

    def _class_string(self, text: str) -> np.ndarray:
        found = self.codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not len(found):
            return found
        keep = found != SPACE
        keep[1:] |= found[:-1] != SPACE       # one space for a run
        return found[keep]

    def _table(self, text: str) -> np.ndarray:
        nexts = suffix_automaton([c for c in self._class_string(text).tolist() if c != OTHER])
        root = np.full(self.classes, MARK, np.int32)
        for c, to in nexts[0].items():
            root[c] = to | MARK
        table = np.tile(root, (len(nexts), 1))
        for s, step in enumerate(nexts):
            for c, to in step.items():
                table[s, c] = to
        table[0] |= MARK                      # a step from the root begins a phrase
        table[:, PAD] = np.arange(len(nexts))
        return table.ravel()

    def costs(self, texts: list[str]) -> np.ndarray:
        """Cross entropy estimate (bits a letter) of each text under each language; inf for no letters."""
        strings = [self._class_string(t.lower()) for t in texts]
        lengths = np.array([len(s) for s in strings])
        blocks = -(-lengths // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        grid = np.full((first[-1], BLOCK), PAD, np.uint16)
        for s, at, n in zip(strings, first, lengths):
            grid[at:at + -(-n // BLOCK)].reshape(-1)[:n] = s
        columns = np.ascontiguousarray(grid.T)
        out = np.empty((len(texts), len(self.langs)))
        for k, (table, bits) in enumerate(zip(self.tables, self.bits)):
            state = np.zeros(len(grid), np.int32)
            phrases = np.zeros(len(grid), np.int32)
            for column in columns:
                step = table[state * self.classes + column]
                phrases += step >> 30
                state = step & (MARK - 1)
            total = np.add.reduceat(np.append(phrases, 0), first[:-1])[:len(texts)] if len(texts) else 0
            out[:, k] = np.where(blocks > 0, total * bits / np.maximum(lengths, 1), np.inf)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        given = [t or "" for t in texts]
        has_letter = [any(map(str.isalpha, t)) for t in given]
        if not self.langs:
            return [UNKNOWN] * len(given), [0.0] * len(given)
        costs = self.costs(given)
        best = costs.argmin(axis=1)
        low = costs.min(axis=1)
        second = np.partition(costs, 1, axis=1)[:, 1] if costs.shape[1] > 1 else low
        alone = costs.shape[1] == 1
        langs, scores = [], []
        for letter, b, x, y in zip(has_letter, best, low, second):
            langs.append(self.langs[b] if letter else UNKNOWN)
            # How much cheaper the winner is than the runner-up, from 0.5 (level) to 1.
            scores.append(0.0 if not letter else 1.0 if alone else float(y / (x + y)))
        return langs, scores


def identified(df: DataFrame, samples: list[tuple[str, list[str]]], text_col: str = "text",
               lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``df`` with the predicted language and its score appended."""
    key = ("parser", hashlib.sha256(repr(samples).encode("utf-8", "surrogatepass")).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = worker_table(key, lambda: CrossParser(samples))
        for whole in batches:
            for batch in pieces(whole, text_col, 4 << 20):
                langs, scores = parser.predict(batch.column(batch.schema.get_field_index(text_col)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*batch.schema.names, lang_out, score_out])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), f"`{lang_out}` string, `{score_out}` double"])
    return map_batches(df, run, schema, key)


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that may be learned from; the rest is held out."""
    return F.crc32(F.col(id_col).cast("string")) % 4 != 2


#: Under this score the two best languages are practically level.
LEAST_SCORE = 0.505


def filter_documents(df: DataFrame, samples: list[tuple[str, list[str]]], text_col: str = "text",
                     least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``df`` in an identified language, columns unchanged."""
    lang, score = fresh(df, "_lang_pred"), fresh(df, "_lang_score")
    body = identified(df, samples, text_col, lang, score)
    return body.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*df.columns)
