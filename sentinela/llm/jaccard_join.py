"""N-gram Jaccard self-join: T-occurrence search with DivideSkip.

A document is the set of its distinct n-word shingles; two documents link when
``100 * |intersection| >= percent * |union|``. The join is exact:

1. *Sets.* Equal sets share one set id (a 128-bit digest), so copies, however
   many, are one entry from here on.
2. *Candidates.* In a global order with frequent shingles last, linked sets
   share ``k`` shingles among their first ``|x| - ceil(percent |x| / 100) + k``,
   where ``k`` grows with the set (:func:`shared_needed`). Sets meet in the
   lists of those shingles; pairs must fit in size and in the parity bitmap
   bound (two sets differ in at least as many elements as their parity bitmaps
   differ in bits). Lists up to ``SHORT_LIST`` entries give their pairs
   directly; a pair must come from ``k`` of them (one that also meets in a long
   list is found there), and is then held against wide bitmaps.
3. *Verification* by T-occurrence: a query set's candidates are indexed by
   shingle; of the query's inverted lists the longest are set aside, the short
   ones merged by a heap, and sets reaching the reduced count are looked up in
   the long lists by binary search, until they reach the overlap or cannot.
4. *Long lists* (large groups of near copies) would give all pairs, so their
   entries are first compared with the list's leader only. Entries that then
   lie outside the list's largest component are searched against all entries
   of other components, in blocks; pairs within a component need no test, and
   no link between components is lost.
5. Connected components over the verified links.

The order table holds at most ``ORDER_SHINGLES`` shingles; any order is
correct, this one only shortens the lists.

Defined results: null, empty or blank text has an empty set, links with
nothing and is its own component; a text of fewer than n words is one shingle;
repeated rows are copies; a null id is smallest of none (documents linked only
with others without an id have a null component_id); an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import fresh, map_batches, materialise, pieces, utf8
from sentinela.llm.components import connected_components

#: Distinct spellings whose hashes a worker keeps.
CACHE_WORDS = 200_000
#: Shingles counted at a time for the order table.
COUNT_SHINGLES = 1 << 21
#: Size of the broadcast order table, and how often a shingle must occur to enter it.
ORDER_SHINGLES, FREQUENT = 1 << 18, 16
SHORT_LIST = 64
#: Entries of a long list that meet in one block.
BLOCK_ROWS = 4096
#: Bits of the parity bitmap that travels with each list entry: about the set's size within these bounds.
LEAST_BITS, MOST_BITS = 64, 256
#: Bits of the wide bitmap that each pair is held against before any set is fetched: over twice the set's size.
WIDE_BITS = 1 << 18
#: Up to so many wanted sets (about 60 bytes each) their ids are broadcast to the scan of the texts.
BROADCAST_SETS = 1_000_000
CANDIDATES = 256
#: A pair of larger sets must share more of their prefixes: one shingle more for every so many, up to a bound.
SHARED_STEP, MOST_SHARED = 100, 12
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes (64 bits) of texts: ASCII letters lower-cased, ASCII white space between words."""

    def __init__(self, n: int):
        self.n = n
        self.hashes: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.hashes
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = set(words)
            known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(words))
        out = h[:len(h) - n + 1] ^ np.uint64(n)
        for j in range(1, n):
            out = mix(out * FIRST + h[j:len(h) - n + 1 + j])
        return np.unique(mix(out * SECOND))


def set_id(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def shared_needed(size: int) -> int:
    """Shingles that a linked partner must share with the prefix, which is longer by as many."""
    return 1 + min(size // SHARED_STEP, MOST_SHARED - 1)


def overlap_needed(x: int, y: int, percent: int) -> int:
    return -(-percent * (x + y) // (100 + percent))


def parity_bitmap(shingles: np.ndarray, wide: bool = False) -> bytes:
    bits = 1 << (len(shingles) - 1).bit_length()
    bits = min(max(2 * bits, LEAST_BITS), WIDE_BITS) if wide else min(max(bits, LEAST_BITS), MOST_BITS)
    odd = np.bincount((shingles >> np.uint64(17)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two parity bitmaps differ, the longer folded onto the shorter."""
    if len(a) < len(b):
        a, b = b, a
    x, y, width = int.from_bytes(a, "little"), int.from_bytes(b, "little"), len(a) * 8
    while width > len(b) * 8:
        width //= 2
        x = (x >> width) ^ (x & ((1 << width) - 1))
    return (x ^ y).bit_count()


def may_link(n_a: int, map_a: bytes, n_b: int, map_b: bytes, percent: int) -> bool:
    """False only for pairs that cannot link."""
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    return differing_bits(map_a, map_b) <= n_a + n_b - 2 * overlap_needed(n_a, n_b, percent)


def divide_skip(query: np.ndarray, sets: list[np.ndarray], percent: int) -> list[int]:
    """Indexes of ``sets`` that link with ``query`` (T-occurrence search)."""
    needs = [overlap_needed(len(query), len(s), percent) for s in sets]
    index: dict[int, list[int]] = {}
    for k, s in enumerate(sets):
        at = np.searchsorted(query, s)
        at[at == len(query)] = 0
        for token in s[query[at] == s].tolist():
            index.setdefault(token, []).append(k)
    lists = sorted(index.values(), key=len)
    least = min(needs, default=1)
    # Set aside as many of the longest lists as leaves at least one hit to be found in the short ones.
    aside = min(least - 1, len(lists))
    short, long_ = lists[:len(lists) - aside], lists[len(lists) - aside:]
    found = []
    merged = heapq.merge(*short)
    current, count = None, 0

    def probe(k: int, hits: int) -> bool:
        left = len(long_)
        for entries in long_:
            if hits >= needs[k]:
                return True
            if hits + left < needs[k]:
                return False
            at = bisect.bisect_left(entries, k)
            hits += at < len(entries) and entries[at] == k
            left -= 1
        return hits >= needs[k]

    for k in merged:
        if k != current:
            if current is not None and probe(current, count):
                found.append(current)
            current, count = k, 0
        count += 1
    if current is not None and probe(current, count):
        found.append(current)
    return found


# --- 1. sets ----------------------------------------------------------------

def document_sets(df: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(id, sid, n, bits) of every row of (id, text), and (shingle, weight): counts of shingles repeated within a task.

    ``bits`` is the set's wide bitmap.
    """
    kind = dict(df.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        held: list[np.ndarray] = []
        total = 0
        id_type = None

        def counted() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            often = counts > 1
            m = int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(m, id_type), pa.nulls(m, pa.binary()), pa.array(counts[often], pa.int64()),
                 pa.array(values[often].view(np.int64), pa.int64()), pa.nulls(m, pa.binary())],
                names=["id", "sid", "n", "shingle", "bits"])

        for whole in batches:
            id_type = whole.column(0).type
            for batch in pieces(whole, "text"):
                sets = [shingle(t) for t in utf8(batch, "text")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([set_id(s) for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.nulls(len(sets), pa.int64()),
                     pa.array([parity_bitmap(s, wide=True) if len(s) else None for s in sets], pa.binary())],
                    names=["id", "sid", "n", "shingle", "bits"])
                held += sets
                total += sum(map(len, sets))
                if total > COUNT_SHINGLES:
                    yield counted()
                    total = 0
        if held:
            yield counted()

    both = materialise(map_batches(df, run, f"id {kind}, sid binary, n bigint, shingle bigint, bits binary"),
                       "jaccard-sets")
    return (both.filter("shingle is null").select("id", "sid", "n", "bits"),
            both.filter("shingle is not null").select("shingle", F.col("n").alias("weight")))


def order_table(counts: DataFrame, size: int = ORDER_SHINGLES) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (sorted) and their rank classes: log2 of the count; at most ``size`` entries."""
    rows = (counts.groupBy("shingle").agg(F.sum("weight").alias("w")).filter(F.col("w") >= FREQUENT)
            .orderBy(F.desc("w"), "shingle").limit(size).toPandas())
    shingles = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    rank = np.floor(np.log2(np.maximum(rows["w"].to_numpy(np.float64), 1))).astype(np.int8)
    order = np.argsort(shingles)
    return shingles[order], rank[order]


# --- 2. candidates ----------------------------------------------------------

def prefix_entries(df: DataFrame, n: int, percent: int, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(shingle, sid, n, bits): one row per set and prefix shingle; each set once per task."""
    frequent = df.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ranks = frequent.value
        shingle, seen = Shingler(n), set()
        for whole in batches:
            for batch in pieces(whole, "text"):
                cols: list[list] = [[], [], []]
                prefixes, repeats = [], []
                for text in utf8(batch, "text"):
                    s = shingle(text)
                    sid = set_id(s)
                    if sid is None or sid in seen:
                        continue
                    seen.add(sid)
                    p = prefix_length(len(s), percent) + shared_needed(len(s)) - 1
                    if len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        rank = np.where(known[at] == s, ranks[at], 0)
                        chosen = s[np.argsort(rank, kind="stable")[:p]]
                    else:
                        chosen = s[:p]
                    prefixes.append(chosen)
                    repeats.append(len(chosen))
                    for col, value in zip(cols, (sid, len(s), parity_bitmap(s))):
                        col.append(value)
                if not prefixes:
                    continue
                at = pa.array(np.repeat(np.arange(len(repeats)), repeats))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(prefixes).view(np.int64), pa.int64()),
                     pa.array(cols[0], pa.binary()).take(at), pa.array(cols[1], pa.int32()).take(at),
                     pa.array(cols[2], pa.binary()).take(at)], names=["shingle", "sid", "n", "bits"])

    return map_batches(df.select("text"), run, "shingle bigint, sid binary, n int, bits binary")


def list_pairs(entries: DataFrame, percent: int, parts: int) -> DataFrame:
    """(a, b, shingle, need): candidate pairs of short lists with the number of lists they must come from;
    for long lists their entries, with b null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list, list] = ([], [], [], [])
        group: list[tuple[int, bytes, bytes]] = []
        key, last, is_long = None, None, False

        def emit(a: bytes, b: bytes | None, shingle: int, need: int | None = None) -> None:
            for col, value in zip(out, (a, b, shingle, need)):
                col.append(value)

        def close() -> None:
            if is_long or len(group) < 2:
                return
            group.sort()
            for j in range(1, len(group)):
                n_b, sid_b, map_b = group[j]
                for i in range(j - 1, -1, -1):
                    n_a, sid_a, map_a = group[i]
                    if 100 * n_a < percent * n_b:
                        break
                    if may_link(n_a, map_a, n_b, map_b, percent):
                        # The smaller set comes first in the group and asks for fewer.
                        emit(max(sid_a, sid_b), min(sid_a, sid_b), key, shared_needed(n_a))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.int32())], names=["a", "b", "shingle", "need"])
            for col in out:
                col.clear()
            return batch

        for batch in batches:
            shingles = batch.column(0).to_numpy()
            # Rows whose list certainly has one entry are passed over without making objects of them.
            same = np.zeros(len(shingles), bool)
            same[1:] = shingles[1:] == shingles[:-1]
            keep = same.copy()
            keep[:-1] |= same[1:]
            keep[-1:] = True
            keep[:1] = True
            rows = batch.filter(pa.array(keep))
            for shingle, sid, n, bits in zip(*(c.to_pylist() for c in rows.columns)):
                if shingle != key:
                    close()
                    group.clear()
                    key, is_long = shingle, False
                if is_long:
                    if sid != last:
                        emit(sid, None, shingle)
                elif not group or group[-1][1] != sid:
                    group.append((n, sid, bits))
                    if len(group) > SHORT_LIST:
                        is_long = True
                        for _, other, _ in group:
                            emit(other, None, shingle)
                last = sid
            if len(out[0]) > 20_000:
                yield flush()
        close()
        yield flush()

    ordered = entries.repartition(parts, "shingle").sortWithinPartitions("shingle", "sid")
    return map_batches(ordered, run, "a binary, b binary, shingle bigint, need int")


# --- 3. verification --------------------------------------------------------

def shingle_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(sid, shingles) for the sets in ``wanted`` (sid, id), computed from one document of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for whole in batches:
            for batch in pieces(whole, "text"):
                sets = [shingle(t) for t in utf8(batch, "text")]
                yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["sid", "shingles"])

    ids = wanted.select("id").distinct()
    few = ids.limit(BROADCAST_SETS + 1).count() <= BROADCAST_SETS
    schema = "sid binary, shingles binary"
    picked = docs.join(F.broadcast(ids) if few else ids, "id", "left_semi").select("text")
    # Sets that only documents without an id have are found among these by the set id.
    nameless = (map_batches(docs.filter("id is null").select("text"), run, schema)
                .join(wanted.filter("id is null").select("sid"), "sid", "left_semi"))
    return map_batches(picked, run, schema).unionByName(nameless).dropDuplicates(["sid"])


def plausible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their wide bitmaps (sid, n, bits) do not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "bits_b"):
                n_a, bits_a, n_b, bits_b = (c.to_pylist() for c in batch.columns[2:])
                keep = [may_link(*x, percent) for x in zip(n_a, bits_a, n_b, bits_b)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: bitmaps.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "bits_a", "n_b", "bits_b")
    return map_batches(joined, run, "a binary, b binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """The pairs (a, b) that link: per query a, a T-occurrence search over its candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = key = None
        ids: list[bytes] = []
        sets_: list[np.ndarray] = []
        out: tuple[list, list] = ([], [])

        def close() -> None:
            if ids and query is not None:
                for k in divide_skip(query, sets_, percent):
                    out[0].append(key)
                    out[1].append(ids[k])
            ids.clear()
            sets_.clear()

        for batch in batches:
            for a, b, raw in zip(*(c.to_pylist() for c in batch.columns)):
                values = np.frombuffer(raw, np.uint64)
                if a != key:
                    close()
                    key, query = a, None
                if b is None:
                    query = values
                else:
                    ids.append(b)
                    sets_.append(values)
                    if len(ids) >= CANDIDATES:
                        close()
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], names=["a", "b"])
            out[0].clear()
            out[1].clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], names=["a", "b"])

    own = pairs.select("a").distinct().join(sets, F.col("a") == F.col("sid")).select("a", F.lit(None).cast("binary").alias("b"), "shingles")
    other = pairs.join(sets, F.col("b") == F.col("sid")).select("a", "b", "shingles")
    # The query's own row sorts before its candidates.
    rows = own.unionByName(other).repartition(parts, "a").sortWithinPartitions("a", F.col("b").asc_nulls_first())
    return map_batches(rows, run, "a binary, b binary")


# --- 4. long lists ----------------------------------------------------------

def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Parity bitmaps (rows of 64-bit words) folded to ``width`` words."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


class Queries:
    """Sets that one member after another is held against, all at once: the bounds of :func:`may_link`."""

    def __init__(self, percent: int):
        self.percent = percent
        self.rows: dict[int, list] = {}       # words of the bitmap -> (n, bits, payload)
        self.tables: dict[int, tuple] = {}    # the same as arrays, and their folds

    def add(self, n: int, bits: bytes, payload: tuple) -> None:
        self.rows.setdefault(len(bits) // 8, []).append((n, bits, payload))

    def plausible(self, n: int, bits: bytes) -> Iterator[tuple]:
        """Payloads of the queries that may link with the member."""
        if len(self.tables) < len(self.rows):
            for words, rows in self.rows.items():
                table = np.frombuffer(b"".join(r[1] for r in rows), np.uint64).reshape(-1, words)
                self.tables[words] = (np.array([r[0] for r in rows], np.int64), {words: table})
        own = np.frombuffer(bits, np.uint64)
        for words, (sizes, folds) in self.tables.items():
            width = min(words, len(own))
            if width not in folds:
                folds[width] = folded(folds[words], width)
            differ = np.bitwise_count(folds[width] ^ folded(own, width)).sum(axis=1, dtype=np.int64)
            need = -(-self.percent * (sizes + n) // (100 + self.percent))
            fits = (100 * np.minimum(sizes, n) >= self.percent * np.maximum(sizes, n)) & (differ <= sizes + n - 2 * need)
            for k in np.flatnonzero(fits).tolist():
                yield self.rows[words][k][2]


def leader_pairs(long_: DataFrame) -> DataFrame:
    """Each entry of a long list with the list's leader: the entry that stands in most long lists."""
    weight = long_.groupBy("sid").agg(F.count("*").alias("w"))
    leaders = (long_.join(weight, "sid").groupBy("shingle")
               .agg(F.max(F.struct("w", "sid"))["sid"].alias("leader")))
    return (long_.join(leaders, "shingle").filter("sid <> leader")
            .select(F.col("sid").alias("a"), F.col("leader").alias("b")).distinct())


def outside_pairs(long_: DataFrame, bitmaps: DataFrame, comps: DataFrame, percent: int, parts: int) -> DataFrame:
    """Candidate pairs of long lists between components, at least one end outside the list's largest component."""
    named = (long_.join(comps, long_.sid == comps.node, "left")
             .select("shingle", "sid", F.coalesce("component", "sid").alias("comp")))
    sizes = named.groupBy("shingle", "comp").agg(F.count("*").alias("c"))
    # Lists that lie within one component have nothing to search.
    lists = (sizes.groupBy("shingle").agg(F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("main"))
             .select("shingle", F.col("main.comp").alias("main"), F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("blocks"),
                     F.ceil((F.col("m") - F.col("main.c")) / BLOCK_ROWS).cast("int").alias("query_blocks"))
             .filter("query_blocks > 0"))
    held = long_.groupBy("sid").agg(F.sort_array(F.collect_set("shingle")).alias("lists"))
    rows = (named.join(lists, "shingle").join(held, "sid").join(bitmaps, "sid")
            .withColumn("hash", F.xxhash64("sid")).withColumn("outside", F.col("comp") != F.col("main")))
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    own = lambda blocks: F.pmod(F.col("hash"), F.col(blocks)).cast("int")
    # Queries are the outside entries alone: a member goes only to as many blocks as these fill.
    asked = rows.filter("outside").select("shingle", own("query_blocks").alias("qb"), every("blocks").alias("mb"),
                                          F.lit(0).alias("side"), "sid", "comp", "n", "bits", "lists", "outside")
    members = rows.select("shingle", every("query_blocks").alias("qb"), own("blocks").alias("mb"), F.lit(1).alias("side"),
                          "sid", "comp", "n", "bits", "lists", "outside")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, queries = None, Queries(percent)
        for batch in batches:
            a, b = [], []
            for shingle, qb, mb, side, sid, comp, n, bits, lists_, outside in zip(*(c.to_pylist() for c in batch.columns)):
                if (shingle, qb, mb) != key:
                    key, queries = (shingle, qb, mb), Queries(percent)
                if side == 0:
                    queries.add(n, bits, (sid, comp, set(lists_)))
                    continue
                for q_sid, q_comp, q_lists in queries.plausible(n, bits):
                    if q_comp == comp or (outside and q_sid < sid):
                        continue
                    # A pair of several lists is given by the first of them only.
                    if next(x for x in lists_ if x in q_lists) == shingle:
                        a.append(q_sid)
                        b.append(sid)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    spread = (asked.unionByName(members).repartition(parts, "shingle", "qb", "mb")
              .sortWithinPartitions("shingle", "qb", "mb", "side"))
    return map_batches(spread, run, "a binary, b binary").distinct()


# --- the join ---------------------------------------------------------------

def jaccard_components(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles, component_id (smallest id reachable by links) for every row."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    members, counts = document_sets(docs, n)
    owners = members.filter("sid is not null").groupBy("sid").agg(F.min("id").alias("id"))
    entries = prefix_entries(docs, n, percent, order_table(counts))
    found = materialise(list_pairs(entries, percent, parts), "jaccard-candidates")
    long_ = found.filter("b is null").select(F.col("a").alias("sid"), "shingle")
    short = (found.filter("b is not null").groupBy("a", "b")
             .agg(F.count("*").alias("shared"), F.min("need").alias("need")).filter("shared >= need"))
    pairs = short.select("a", "b").unionByName(leader_pairs(long_)).distinct()
    pairs = materialise(pairs, "jaccard-pairs")
    asked = (pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct())
    bitmaps = materialise(members.select("sid", "n", "bits").join(asked, "sid", "left_semi").dropDuplicates(["sid"]),
                          "jaccard-bitmaps")
    pairs = materialise(plausible(pairs, bitmaps, percent), "jaccard-pairs")
    wanted = (pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid")))
              .unionByName(long_.select("sid")).distinct().join(owners, "sid"))
    sets = materialise(shingle_sets(docs, wanted, n), "jaccard-shingles")
    links = materialise(verified(pairs, sets, percent, parts), "jaccard-links")
    comps = materialise(connected_components(links, "a", "b"), "jaccard-components")
    if not long_.isEmpty():
        more = materialise(outside_pairs(long_, bitmaps, comps, percent, parts), "jaccard-outside")
        extra = materialise(verified(more, sets, percent, parts), "jaccard-links")
        comps = materialise(connected_components(links.unionByName(extra), "a", "b"), "jaccard-components")
    least = (comps.join(owners, comps.node == owners.sid).groupBy("component").agg(F.min("id").alias("least")))
    of_set = (comps.join(least, "component").select(F.col("node").alias("sid"), "least")
              .unionByName(owners.join(comps, owners.sid == comps.node, "left_anti")
                           .select("sid", F.col("id").alias("least"))))
    return (members.select("id", "sid", "n").join(of_set, "sid", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("least", "id").alias("component_id")))


def one_per_group(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``df`` with one row of each group of linked documents: the one with the smallest id, null ids last
    (equal ids: with the smallest digest of the text).

    Only links and repeats remove rows. A repeat has the id and the text of
    another row; blank texts link with nothing, so without an id they all stay.
    """
    text = F.col(text_col).cast("string")
    mark = fresh(df, "_row")
    # A row's key: its id and a 128-bit digest of its text; never null itself, so that it joins.
    named = df.withColumn(mark, F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                                         F.unhex(F.md5(text.cast("binary"))).alias("digest")))
    single = F.col(id_col).isNull() & ~F.coalesce(text.rlike(r"[^\t\n\x0B\f\r ]"), F.lit(False))
    groups = jaccard_components(named, n, percent, mark, text_col)
    heads = groups.filter(F.col("component_id") == F.col(mark)).select(mark).distinct()
    kept = named.filter(~single).join(heads, mark, "left_semi").dropDuplicates([mark])
    return kept.select(*df.columns).unionByName(df.filter(single))
