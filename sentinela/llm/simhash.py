"""Document fingerprints: SimHash, and a search within a Hamming radius by permuted block tables.

A text's terms are its words (runs of anything but ASCII white space) and its
pairs of neighbouring words. Each distinct spelling hashes to 128 bits; a word
weighs its length over three bytes (so function words weigh little, at least
one, at most eight), a pair weighs four, and every occurrence votes with its weight for or
against each bit. Equal texts have equal fingerprints.

Search: of ``radius + 3`` or more blocks, two fingerprints within ``radius``
bits agree on at least three, the first of them among the first ``radius + 1``.
The distinct fingerprints are entered once per such block, keyed by the block
number and its bits (the permuted tables). A key with many entries is searched
under keys of two and three blocks, by the same argument, where these are
selective; pairs are compared by popcount, tile by tile. A pair is counted
only under the first blocks on which it agrees, so the search is exact.

``RADIUS`` is chosen from edited texts: of 404 copies of sf0.001 texts (60 to
600 words, one word to 3 % of the words changed) whose five-word shingles keep
a Jaccard similarity of 0.8, 95 % lie within 13 bits, and 88 % of those between
0.8 and 0.85; 3 bits reach 18 % and 6 %. Unrelated texts differ in about 64.

Defined results: texts without words (null, empty, blank) have the fingerprint 0; copies of a text
share one entry, whatever their number; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import map_batches, materialise, pieces, ship, strings, text_or_empty

BITS = 128
RADIUS = 13
PAIR_WEIGHT, SHORT, LEAST, MOST = 4, 3, 1, 8
#: Distinct spellings whose hashes a worker keeps.
CACHE_WORDS = 200_000
#: Terms voted at a time (their bits are 128 numbers each).
VOTE_TERMS = 1 << 14
#: Up to so many entries a key's pairs are compared directly, in tiles of so many rows a side.
DIRECT, TILE = 2048, 512
#: Sorts before every id; stands for a null id.
NULL_KEY = -(1 << 63)


class Hasher:
    """Term hashes and weights of texts; word hashes are kept in a bounded cache."""

    def __init__(self):
        self.index: dict[bytes, int] = {}
        self.hashes = np.zeros((CACHE_WORDS, 2), np.uint64)
        self.weights = np.zeros(CACHE_WORDS, np.float32)

    def _learn(self, words: list[bytes]) -> None:
        new = set(words).difference(self.index)
        if len(self.index) + len(new) > len(self.hashes):
            self.index.clear()
            new = set(words)
            if len(new) > len(self.hashes):
                self.hashes = np.zeros((len(new), 2), np.uint64)
                self.weights = np.zeros(len(new), np.float32)
        at = len(self.index)
        if not new:
            return
        raw = b"".join([xxhash.xxh3_128_digest(w) for w in new])
        self.hashes[at:at + len(new)] = np.frombuffer(raw, ">u8").reshape(-1, 2)
        self.weights[at:at + len(new)] = [min(max(len(w) - SHORT, LEAST), MOST) for w in new]
        self.index.update(zip(new, range(at, at + len(new))))

    def votes(self, text: bytes) -> np.ndarray:
        """Signed votes of the text's terms on each bit."""
        words = text.split()
        total = np.zeros(BITS, np.float64)
        # A text is voted block by block; blocks share one word, so that no pair is lost.
        for at in range(0, len(words), VOTE_TERMS):
            block = words[at:at + VOTE_TERMS + 1]
            self._learn(block)
            ids = np.fromiter(map(self.index.__getitem__, block), np.int64, len(block))
            h, w = self.hashes[ids], self.weights[ids]
            own = min(VOTE_TERMS, len(block))
            total += vote(h[:own], w[:own])
            if len(block) > 1:
                total += PAIR_WEIGHT * vote(mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]), None)
        return total

    def fingerprint(self, text: bytes) -> bytes:
        return np.packbits(self.votes(text) > 0).tobytes()


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all bits of each half."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def vote(hashes: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), 16), axis=1)
    if weights is None:
        return 2.0 * bits.sum(axis=0, dtype=np.int64) - len(hashes)
    return 2.0 * (weights @ bits.astype(np.float32)).astype(np.float64) - float(weights.sum())


def half(c: Column, k: int) -> Column:
    """64-bit half ``k`` of a hex fingerprint."""
    # Two 32-bit quarters joined: conv() alone would saturate at the signed limit.
    part = lambda i: F.conv(c.substr(i * 8 + 1, 8), 16, 10).cast("long")
    return F.shiftleft(part(2 * k), 32).bitwiseOR(part(2 * k + 1))


def likeness(a: Column, b: Column) -> Column:
    """1 less the share of differing bits of two hex fingerprints."""
    distance = sum((F.bit_count(half(a, k).bitwiseXOR(half(b, k))) for k in (0, 1)), F.lit(0))
    return 1 - distance / F.lit(float(BITS))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 out_col: str = "fingerprint") -> DataFrame:
    """``id_col`` and the fingerprint (hex) of each row's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for whole in batches:
            for batch in pieces(whole, "text"):
                found = [hasher.fingerprint(t.encode()).hex() for t in strings(batch, "text")]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["id", "fp"])

    kind = dict(df.dtypes)[id_col]
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(narrow, run, f"id {kind}, fp string").toDF(id_col, out_col)


def ordered_runs(df: DataFrame, parts: int) -> DataFrame:
    """Rows (part, k, id, text, tail) of ``df`` (id, text): consecutive ranges of ids, each closed by the
    first rows of the next range (tail = 1).

    Only ids are read to place the borders (approximate quantiles) and to find
    each range's first id, one number per range; then each text moves once,
    with a second copy of the border rows. The last range is closed by the
    first, so the order is a circle. A null id sorts first.
    """
    rows = df.withColumn("k", F.coalesce(F.col("id").cast("long"), F.lit(NULL_KEY)))
    keys = rows.select("k")
    shares = F.array(*[F.lit(i / parts) for i in range(1, max(parts, 2))])
    cuts = keys.agg(F.percentile_approx("k", shares, F.lit(max(10_000, 20 * parts)))).first()[0]
    borders = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, k.to_numpy(), side="right").astype(np.int32))

    firsts = sorted((r["part"], r["first"]) for r in
                    keys.withColumn("part", place("k")).groupBy("part").agg(F.min("k").alias("first")).collect())
    closes = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}   # first id -> range it closes
    known = np.array(sorted(closes), np.int64)
    target = np.array([closes[k] for k in known], np.int64)

    @F.pandas_udf("array<int>")
    def places(k: pd.Series) -> pd.Series:
        values = k.to_numpy()
        own = np.searchsorted(borders, values, side="right")
        at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
        also = known[at] == values if len(known) else np.zeros(len(values), bool)
        return pd.Series([[o, target[t]] if a else [o] for o, t, a in zip(own, at, also)])

    return (rows.withColumn("places", places("k"))
            .select(F.posexplode("places").alias("tail", "part"), "k", "id", "text")
            .select("part", "k", "id", "text", "tail"))


def edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Per row: the fingerprint of its text and of the edited text, and the next row's fingerprint.

    The edited text has its last floor(n/2) code points replaced by the first
    as many (or all) of the next row by ascending id (after the last: the
    first; equal ids by text). Returns id, n_chars, edited_sha256 and three
    fingerprints (hex).
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(df.dtypes)[id_col]
    ship(spark)
    runs = ordered_runs(df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), 2 * parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        part = before = None
        for whole in batches:
            out: list[tuple] = []
            for batch in pieces(whole, "text"):
                for p, i, text, tail in zip(*(c.to_pylist() for c in batch.columns)):
                    if p != part:
                        part, before = p, None
                    if tail and before is None:   # the range is closed already
                        continue
                    fp = hasher.fingerprint(text.encode()).hex()
                    if before is not None:
                        last_id, own, own_fp = before
                        half = len(own) // 2
                        edited = (own[:len(own) - half] + text[:half]).encode()
                        out.append((last_id, len(own), hashlib.sha256(edited).hexdigest(), own_fp,
                                    hasher.fingerprint(edited).hex(), fp))
                    before = None if tail else (i, text, fp)
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 *(pa.array(c, pa.string()) for c in cols[2:])],
                names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"])

    spread = (runs.repartition(parts, "part").sortWithinPartitions("part", "tail", "k", "text")
              .select("part", F.col("id").cast("long").alias("id"), "text", "tail"))
    out = map_batches(spread, run, "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, next_fingerprint string")
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


# --- search -----------------------------------------------------------------

class Search:
    """Counts, for each row of ``fps`` (uint64 x 2), the weights of the other rows within ``radius``."""

    def __init__(self, fps: np.ndarray, weights: np.ndarray, radius: int, blocks: list[tuple[int, int]]):
        self.fps, self.weights, self.radius, self.blocks = fps, weights, radius, blocks
        self.total = np.zeros(len(fps), np.int64)

    def run(self, a: np.ndarray, b: np.ndarray | None, agreed: tuple[int, ...]) -> None:
        """Counts pairs of rows of ``a`` and ``b`` (None: within ``a``) whose first equal blocks are ``agreed``."""
        size = len(a) * len(a if b is None else b)
        spare = len(self.blocks) - self.radius - len(agreed)
        if size > DIRECT * DIRECT and spare > 0:
            # The next block on which a close pair agrees; taken only where its keys are selective.
            nexts = range(agreed[-1] + 1, len(self.blocks) - spare + 1)
            split = [(k, list(self.groups(a, b, k))) for k in nexts]
            if 2 * sum(len(x) * len(x if y is None else y) for _, gs in split for x, y in gs) < size:
                for k, gs in split:
                    for x, y in gs:
                        self.run(x, y, (*agreed, k))
                return
        skip = [k for k in range(agreed[-1]) if k not in agreed]
        for at in range(0, len(a), TILE):
            for to in range(at if b is None else 0, len(a if b is None else b), TILE):
                self.tile(a[at:at + TILE], (a if b is None else b)[to:to + TILE], b is None and at == to, skip)

    def groups(self, a: np.ndarray, b: np.ndarray | None, k: int) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Rows that agree on block ``k``."""
        own = field(self.fps[a], *self.blocks[k])
        order = np.argsort(own, kind="stable")
        values, starts = np.unique(own[order], return_index=True)
        sides = np.split(a[order], starts[1:])
        if b is None:
            yield from ((x, None) for x in sides if len(x) > 1)
            return
        other = field(self.fps[b], *self.blocks[k])
        order = np.argsort(other, kind="stable")
        lo, hi = (np.searchsorted(other[order], values, side=s) for s in ("left", "right"))
        yield from ((x, b[order[i:j]]) for x, i, j in zip(sides, lo, hi) if j > i)

    def tile(self, a: np.ndarray, b: np.ndarray, same: bool, skip: list[int]) -> None:
        x = [self.fps[a, h][:, None] ^ self.fps[b, h][None] for h in (0, 1)]
        close = np.bitwise_count(x[0]) + np.bitwise_count(x[1]) <= self.radius
        i, j = np.nonzero(np.triu(close, 1) if same else close)
        for k in skip:
            if not len(i):
                return
            lo, hi = self.blocks[k]
            mask = np.uint64(((1 << (hi - lo)) - 1) << (64 - hi % 64 if hi % 64 else 0))
            keep = x[lo // 64][i, j] & mask != 0
            i, j = i[keep], j[keep]
        if len(i):
            # Sums of weights are row counts, exact as doubles.
            for rows, own, far in ((a, i, self.weights[b[j]]), (b, j, self.weights[a[i]])):
                self.total[rows] += np.bincount(own, far, len(rows)).astype(np.int64)


def field(fps: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Bits lo..hi (from the most significant of 128); a field lies within one 64-bit half."""
    side, start, width = lo // 64, lo % 64, hi - lo
    return (fps[:, side] << np.uint64(start)) >> np.uint64(64 - width)


def block_ranges(radius: int) -> list[tuple[int, int]]:
    """At least ``radius + 1`` blocks of whole hex digits that cover the fingerprint; none crosses its halves."""
    per_half = -(-(radius + 1) // 2)
    if per_half > 16:
        raise ValueError("radius too large for 128 bits")
    cuts = [4 * (k * 16 // per_half) for k in range(per_half + 1)]
    return [(half + lo, half + hi) for half in (0, 64) for lo, hi in zip(cuts, cuts[1:])]


def neighbours(df: DataFrame, id_col: str = "doc_id", fp_col: str = "fingerprint", radius: int = RADIUS) -> DataFrame:
    """Per row: class_id (smallest id with the same fingerprint), near_docs (other rows within ``radius``)."""
    # Two blocks more than the pigeonhole needs: a close pair agrees on three.
    blocks = block_ranges(radius + 2)
    distinct = materialise(df.groupBy(F.col(fp_col).alias("fp"))
                           .agg(F.min(id_col).alias("class_id"), F.count("*").alias("n"))
                           .withColumns({"hi": half(F.col("fp"), 0), "lo": half(F.col("fp"), 1)}), "simhash-classes")
    entries = distinct.select("hi", "lo", "n", F.posexplode(F.array(*[
        bits_of(F.col("fp"), lo, hi) for lo, hi in blocks[:radius + 1]])).alias("block", "bits"))
    key = ["block", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(group: list[np.ndarray]) -> tuple[np.ndarray, ...] | None:
            block, _, hi, lo, n = group
            if len(n) < 2:
                return None
            search = Search(np.stack([hi, lo], axis=1).view(np.uint64), n, radius, blocks)
            search.run(np.arange(len(n)), None, (int(block[0]),))
            hit = np.flatnonzero(search.total)
            return hi[hit], lo[hit], search.total[hit]

        def result(found: list) -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*(f for f in found if f is not None))] or [np.zeros(0, np.int64)] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["hi", "lo", "near"])

        held = None   # the rows of the key that may go on in the next batch
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols)]
            if not len(cols[0]):
                continue
            new = np.zeros(len(cols[0]) - 1, bool)
            for c in cols[:len(key)]:
                new |= c[1:] != c[:-1]
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
            held = [c[cuts[-1]:] for c in cols]
            yield result([close([c[at:to] for c in cols]) for at, to in zip(cuts, cuts[1:])])
        if held is not None:
            yield result([close(held)])

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = (entries.select(*key, "hi", "lo", "n").repartition(parts, *key).sortWithinPartitions(*key))
    near = (map_batches(grouped, run, "hi bigint, lo bigint, near bigint")
            .groupBy("hi", "lo").agg(F.sum("near").alias("near")))
    classes = distinct.join(near, ["hi", "lo"], "left").select(
        F.col("fp").alias("_fp"), "class_id", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("near_docs"))
    return df.join(classes, F.col(fp_col) == F.col("_fp"), "left").drop("_fp")


def bits_of(fp: Column, lo: int, hi: int) -> Column:
    """Bits lo..hi of a hex fingerprint as a number; the range covers whole hex digits, at most 15."""
    return F.conv(fp.substr(lo // 4 + 1, (hi - lo) // 4), 16, 10).cast("long")
