"""Phrase collocation mining with an FM-index per shard over word ids.

A task cuts its documents into shards of bounded size. A shard's words become
ids, its pieces one sequence with breaks between them, and that sequence an
FM-index: the depth-limited Burrows-Wheeler transform (suffixes sorted by their
first words, as deep as is asked for), and the LF mapping. Enumeration is
interval extension in both directions: an interval is the run of suffixes that
begin with a phrase, extending it to the left sends its rows through the LF
mapping, where equal symbols before equal intervals stay together, and
extending it to the right cuts it by the following word. All intervals of a
depth are extended at once (:class:`FmIndex`). The counts of a phrase are summed
across shards; its strongest left and right extensions come from the summed
counts of the phrases one word longer.

A phrase cannot be more frequent than its parts, so three passes keep what is
shuffled small and lose nothing:

1. words are counted (every word);
2. two-word phrases of frequent words;
3. phrases of three and four words whose neighbouring pairs are all frequent.

Tasks recognise frequent words and pairs by a bit set of fixed size (hashed, so
it may let others through, which then fail the exact threshold on their counts).

Words travel as 64-bit hashes of language and word. Before use it is made sure
that no frequent word shares its hash with another word of the corpus; if one
does, the next seed is taken. So counts are exact.

Scores are ``floor(2000000 a / (l + r))`` of the lowest-scoring cut, computed in
38-digit decimals.

Defined results: a null text has no words; a null language is ``und``; repeated
rows count each; an empty table gives no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentinela.llm.base import map_batches, materialise, pieces, utf8

DEPTH = 4
#: Words of a shard; a text is never split, so one may be longer.
SHARD_WORDS = 1 << 21
#: Distinct words that the first pass holds before it sends their counts.
HELD_WORDS = 1 << 18
#: Bits of the sets of frequent words and pairs: 4 MB and 16 MB.
WORD_BITS, PAIR_BITS = 1 << 25, 1 << 27
BITMAP_BITS = 1 << 15   # of Spark's bitmap aggregate
UNKNOWN = "und"
BREAK = b"\xff"         # in no UTF-8 text
_BREAKS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(0xFF if c in _BREAKS else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words(texts: list[bytes]) -> list[bytes]:
    """The words of texts with ``BREAK`` between pieces and texts; empty strings among them are no words."""
    joined = BREAK.join(texts).translate(FOLD).replace(BREAK, b" \xff ")
    return joined.split(b" ")


def word_hash(lang: bytes, seed: int):
    prefix = lang + b"\x00"
    return lambda w: xxhash.xxh3_64_intdigest(prefix + w, seed)


def pair_bit(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Place of a pair of word hashes in a bit set."""
    h = a * FIRST + (b ^ (b >> np.uint64(29))) * SECOND
    return ((h ^ (h >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64)


def by_lang(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[bytes]]]:
    """The texts of a batch (lang, text) by language."""
    groups: dict[bytes, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), utf8(batch, "text")):
        groups.setdefault(UNKNOWN.encode() if lang is None else lang.encode(), []).append(text)
    yield from groups.items()


# --- the index --------------------------------------------------------------

def stable_order(values: np.ndarray) -> np.ndarray:
    """``np.argsort(values, kind="stable")`` of small non-negative integers, as one plain sort of (value, place)."""
    shift = np.int64(max(len(values), 1).bit_length())
    return np.sort((values.astype(np.int64) << shift) | np.arange(len(values))) & ((np.int64(1) << shift) - 1)


class FmIndex:
    """FM-index of a sequence of word ids (0 is the break), its suffixes sorted by their first ``depth`` words.

    ``intervals(d)`` numbers, in suffix order, the interval of each suffix's
    first ``d`` words. ``extend_left`` is backward search for all intervals and
    all symbols at once.
    """

    def __init__(self, ids: np.ndarray, depth: int = DEPTH - 1):
        n = len(ids)
        self.ids, self.depth = ids, depth
        wide = np.int64(ids.max(initial=0) + 1)
        padded = np.concatenate([ids, np.zeros(depth, ids.dtype)]).astype(np.int64)
        # Rank of the first two words, then of four: suffix order without comparing suffixes.
        rank, span = padded[:n + depth], 1
        while span < depth:
            key = rank.copy()
            key[:-span] = rank[:-span] * wide + rank[span:]
            key[-span:] = rank[-span:] * wide
            values, rank = np.unique(key, return_inverse=True)
            wide, span = np.int64(len(values)), span * 2
        self.order = stable_order(rank[:n])                            # suffix array, to the depth
        self.bwt = padded[self.order - 1]                              # the word before each suffix
        self.bwt[self.order == 0] = 0
        # Rows in LF order: row j of the index is reached from row came[j] by prepending bwt[came[j]].
        self.came = stable_order(self.bwt)
        self.symbol = self.bwt[self.came]

    def words_at(self, offset: int) -> np.ndarray:
        """The word ``offset`` places into each suffix, in suffix order."""
        at = self.order + offset
        return np.where(at < len(self.ids), self.ids[np.minimum(at, len(self.ids) - 1)], 0)

    def extend_left(self, interval: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, interval, count) for every symbol that precedes an interval; breaks and interval -1 are left out."""
        before = interval[self.came]
        new = np.ones(len(before), bool)
        new[1:] = (before[1:] != before[:-1]) | (self.symbol[1:] != self.symbol[:-1])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(before)))
        ok = (self.symbol[starts] != 0) & (before[starts] >= 0)
        return self.symbol[starts][ok], before[starts][ok], counts[ok]

    def intervals(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Interval number of each suffix by its first ``length`` words (-1 where a break is among them), and where each
        interval starts; found by extending the intervals one word shorter to the right."""
        cols = [self.words_at(k) for k in range(length)]
        new = np.zeros(len(self.order), bool)
        new[:1] = True
        broken = np.zeros(len(self.order), bool)
        for col in cols:
            new[1:] |= col[1:] != col[:-1]
            broken |= col == 0
        number = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        return np.where(broken, -1, number), starts

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(word ids, count) of every phrase of ``length`` words: intervals one word shorter, extended to the left."""
        if length == 1:
            number, starts = self.intervals(1)
            counts = np.diff(np.append(starts, len(number)))
            ok = number[starts] >= 0
            return self.words_at(0)[starts][ok][:, None], counts[ok]
        number, starts = self.intervals(length - 1)
        symbol, interval, counts = self.extend_left(number)
        row = starts[interval]
        return np.stack([symbol, *(self.words_at(k)[row] for k in range(length - 1))], axis=1), counts


# --- passes -----------------------------------------------------------------

def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, hash, n): all words, one row per task that met them often enough to hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, dict[bytes, int]] = {}

        def sent() -> pa.RecordBatch:
            cols: list[list] = [[], [], [], []]
            for lang, counts in held.items():
                own = word_hash(lang, seed)
                cols[0] += [lang.decode()] * len(counts)
                cols[1] += counts.keys()
                cols[2] += map(own, counts)
                cols[3] += counts.values()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()),
                 pa.array(np.array(cols[2], np.uint64).view(np.int64), pa.int64()), pa.array(cols[3], pa.int64())],
                names=["lang", "word", "hash", "n"])

        for whole in batches:
            for batch in pieces(whole, "text"):
                for lang, texts in by_lang(batch):
                    counts = held.setdefault(lang, {})
                    get = counts.get
                    for w in words(texts):
                        counts[w] = get(w, 0) + 1
                    counts.pop(BREAK, None)
                    counts.pop(b"", None)
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield sent()
        yield sent()

    return map_batches(docs, run, "lang string, word binary, hash bigint, n bigint")


def bit_set(places: DataFrame, bits: int) -> np.ndarray:
    """The bits at the column ``place`` as bytes, lowest bit first; Spark merges them per block of ``BITMAP_BITS``."""
    blocks = places.groupBy((F.col("place") / BITMAP_BITS).cast("long").alias("block")) \
        .agg(F.bitmap_construct_agg(F.col("place") % BITMAP_BITS).alias("bitmap"))
    out = np.zeros(bits // 8, np.uint8)
    for r in blocks.toLocalIterator():
        raw = np.frombuffer(bytes(r["bitmap"]), np.uint8)
        at = r["block"] * (BITMAP_BITS // 8)
        out[at:at + len(raw)] = raw
    return out


def has_bit(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def places_of(df: DataFrame, bits: int) -> DataFrame:
    """``place`` of each row (hash, or pair a, b) in a bit set."""
    pair = "b" in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_numpy().view(np.uint64) for c in batch.columns]
            place = pair_bit(cols[0], cols[1], bits) if pair else (cols[0] & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place)], names=["place"])

    return map_batches(df, run, "place bigint")


def phrase_counts(docs: DataFrame, lengths: tuple[int, ...], seed: int, word_bits: np.ndarray,
                  pair_bits: np.ndarray | None = None) -> DataFrame:
    """(h, n): the phrases of every shard as arrays of word hashes; only words and neighbouring pairs that the sets have."""
    sent = docs.sparkSession.sparkContext.broadcast((word_bits, pair_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, known_pairs = sent.value
        numbers: dict[bytes, dict[bytes, int]] = {}     # language -> word -> id in the shard; 0: a break
        hashes, held, size = [0], [], 0

        def learn(lang: bytes, found: list[bytes]) -> np.ndarray:
            ids = numbers.setdefault(lang, {BREAK: 0})
            new = list(set(found).difference(ids))
            if new:
                h = np.fromiter(map(word_hash(lang, seed), new), np.uint64, len(new))
                often = has_bit(known_words, (h & np.uint64(len(known_words) * 8 - 1)).astype(np.int64))
                ids.update(dict.fromkeys(new, 0))
                kept = np.flatnonzero(often).tolist()
                ids.update(zip([new[i] for i in kept], range(len(hashes), len(hashes) + len(kept))))
                hashes.extend(h[often].tolist())
            return np.fromiter(map(ids.__getitem__, found), np.int32, len(found))

        def counted() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate(held)
            table = np.array(hashes, np.uint64)
            if known_pairs is not None:
                ids = self_contained(ids, table, known_pairs, min(lengths))
            fm = FmIndex(ids, max(lengths) - 1)   # a phrase is an interval one word shorter, extended
            for length in lengths:
                phrases, counts = fm.phrases(length)
                for at in range(0, len(counts), 200_000):
                    block = phrases[at:at + 200_000]
                    flat = pa.array(table[block.ravel()].view(np.int64), pa.int64())
                    ends = pa.array(np.arange(len(block) + 1) * length, pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, flat),
                                                      pa.array(counts[at:at + 200_000], pa.int64())], names=["h", "n"])

        for whole in batches:
            for batch in pieces(whole, "text"):
                for lang, texts in by_lang(batch):
                    found = [w for w in words(texts) if w]
                    held.append(squeezed(np.append(learn(lang, found), np.int32(0))))
                    size += len(held[-1])
                if size >= SHARD_WORDS:
                    yield from counted()
                    numbers, hashes, held, size = {}, [0], [], 0
        if held:
            yield from counted()

    return map_batches(docs, run, "h array<bigint>, n bigint")


def squeezed(ids: np.ndarray) -> np.ndarray:
    """Runs of breaks become one."""
    keep = ids != 0
    keep[:1] = True
    keep[1:] |= ids[:-1] != 0
    return ids[keep]


def self_contained(ids: np.ndarray, table: np.ndarray, pairs: np.ndarray, least: int) -> np.ndarray:
    """The runs of at least ``least`` words in which every neighbouring pair is in the set, with breaks between."""
    place = pair_bit(table[ids[:-1]], table[ids[1:]], len(pairs) * 8)
    joined = (ids[:-1] != 0) & (ids[1:] != 0) & has_bit(pairs, place)
    starts = np.flatnonzero(np.concatenate([[True], ~joined]))
    sizes = np.diff(np.append(starts, len(ids)))
    ok = (sizes >= least) & (ids[starts] != 0)
    starts, sizes = starts[ok], sizes[ok]
    out = np.zeros(int(sizes.sum()) + len(sizes) + 1, ids.dtype)
    into = np.cumsum(sizes + 1) - sizes - 1
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(into, sizes) + within] = ids[np.repeat(starts, sizes) + within]
    return out


# --- the whole --------------------------------------------------------------

def counted_words(docs: DataFrame, least: int) -> tuple[DataFrame, int]:
    """(lang, word, hash, n) of all words, and the seed under which frequent words share their hash with no other."""
    seed = 0
    while True:
        table = materialise(word_counts(docs, seed).groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")), "colloc-words")
        shared = table.groupBy("hash").agg(F.count("*").alias("k"), F.max("n").alias("n")).filter((F.col("k") > 1) & (F.col("n") >= least))
        if shared.isEmpty():
            return table, seed
        seed += 1


def frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(h, a) of all phrases of 1 to 4 words with a >= ``least``, and the table of all words."""
    table, seed = counted_words(docs, least)
    often = table.filter(F.col("n") >= least)
    word_bits = bit_set(places_of(often.select("hash"), WORD_BITS), WORD_BITS)
    summed = lambda df: df.groupBy("h").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    pairs = materialise(summed(phrase_counts(docs, (2,), seed, word_bits)), "colloc-pairs")
    pair_bits = bit_set(places_of(pairs.select(F.col("h")[0].alias("a"), F.col("h")[1].alias("b")), PAIR_BITS), PAIR_BITS)
    longer = materialise(summed(phrase_counts(docs, (3, 4), seed, word_bits, pair_bits)), "colloc-longer")
    single = often.select(F.array("hash").alias("h"), F.col("n").alias("a"))
    return single.unionByName(pairs).unionByName(longer), table


def collocations(df: DataFrame, least: int = 30, cover: int = 80, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and the phrase's strongest extensions (left_ext, right_ext).

    A phrase inside a longer one that has at least ``cover`` percent of its
    occurrences is left out. It is enough to look at phrases one word longer:
    the longer a containing phrase, the rarer it is, and all of them are
    candidates.
    """
    docs = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                     F.col(text_col).cast("string").alias("text"))
    known, table = frequent_phrases(docs, least)
    known = materialise(known, "colloc-phrases")
    size = F.size("h")
    long_ = known.filter(size >= 3)
    ext = (long_.select(F.slice("h", 2, size - 1).alias("h"), F.col("a").alias("left_ext"), F.lit(None).cast("long").alias("right_ext"))
           .unionByName(long_.select(F.slice("h", F.lit(1), size - 1).alias("h"), F.lit(None).cast("long").alias("left_ext"),
                                     F.col("a").alias("right_ext")))
           .groupBy("h").agg(F.max("left_ext").alias("left_ext"), F.max("right_ext").alias("right_ext")))
    most = F.greatest(F.coalesce("left_ext", F.lit(0)), F.coalesce("right_ext", F.lit(0)))
    free = (known.filter(size >= 2).join(ext, "h", "left")
            .filter(~(most.cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(20,0)") * cover)))
    part = known.select(F.col("h").alias("part"), F.col("a").alias("f"))
    cuts = (free.select("h", "a", "left_ext", "right_ext", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .withColumn("first", F.slice("h", F.lit(1), F.col("k"))).withColumn("rest", F.expr("slice(h, k + 1, size(h) - k)"))
            .join(part.withColumnsRenamed({"part": "first", "f": "l"}), "first")
            .join(part.withColumnsRenamed({"part": "rest", "f": "r"}), "rest"))
    score = F.expr("cast((cast(a as decimal(20,0)) * cast(2000000 as decimal(8,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    lowest = (cuts.withColumn("score", score).groupBy("h", "a", "left_ext", "right_ext")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("c")))
    spelled = table.filter(F.col("n") >= least).select("lang", F.col("word").cast("string").alias("word"), "hash")
    rows = lowest.select("*", F.col("h")[0].alias("h1"))
    for i in range(DEPTH):
        own = spelled.select(F.col("hash").alias(f"x{i}"), F.col("word").alias(f"w{i}"), *(["lang"] if i == 0 else []))
        rows = rows.join(own, F.get("h", F.lit(i)) == F.col(f"x{i}"), "inner" if i < 2 else "left").drop(f"x{i}")
    named = rows.select("lang", F.concat_ws(" ", *[f"w{i}" for i in range(DEPTH)]).alias("phrase"), "a", "c.l", "c.r", "c.score",
                        "left_ext", "right_ext")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    totals = table.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left_ext", "right_ext")
