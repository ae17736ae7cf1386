"""Exact substring deduplication by suffix sorting (deep-shallow).

A byte is removed when it lies in a string of ``length`` bytes that also starts
anywhere else, in another text or the same one. The suffixes that can share
such a string are brought together and sorted; nothing is sampled.

1. *Anchors.* Every window of ``length`` bytes holds at least one anchor: the
   smallest hash among its k-byte strings (winnowing). Equal windows have their
   anchor at the same place, so two windows can only be equal if the strings at
   their anchors are. An anchor stands for the run of windows it was chosen by;
   the bytes of that run are its context. Equal texts are handled once: with a
   copy elsewhere, a text of at least ``length`` bytes is removed whole.
2. *Lists.* Anchors with equal strings form a list. Entries whose whole context
   is equal settle each other by a digest, whatever their number; only entries
   with a context of their own, and one of each settled class, go on.
3. *Suffix sorting.* In a list the suffixes from the anchor on, and the reversed
   prefixes before it, are ordered by deep-shallow sorting: multikey quicksort
   down to a shallow depth, then a blind trie for each group that is still
   equal. From the two orders and their common prefix lengths the longest
   reach of every entry to the left and right follows, over all partners with
   which it shares ``length`` bytes, by merging sorted groups small to large.
4. *Spans* per text are united and cut out.

A list longer than ``BLOCK_ROWS`` is handled as pairs of blocks, whose reaches
are joined by maximum, so no task holds more than two blocks.

Defined results: null counts as the empty text; texts under ``length`` bytes
lose nothing; repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import fresh, map_batches, materialise, pieces, text_or_empty, utf8

LENGTH = 400
#: Bytes hashed at a time (a longer text is hashed alone).
HASH_BYTES = 1 << 20
BLOCK_ROWS = 4096
#: Anchors a task remembers in order to settle repeated ones itself (about 150 bytes each).
KNOWN_ANCHORS = 300_000
SHALLOW = 32
DIRECT = 24
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
PLACE_BITS = np.uint64(28)


def gram(length: int) -> int:
    """Bytes of an anchor string: long enough that common lines do not form lists."""
    return max(8, length * 8 // 25)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Winnower:
    """Anchors of texts: arrays (position, first window, last window, hash) for each text."""

    def __init__(self, length: int):
        self.length, self.k = length, gram(length)
        self.w = length - self.k + 1
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        empty = np.zeros(0, np.int64)
        none = (empty, empty, empty, np.zeros(0, np.uint64))
        if len(data) < self.length:
            return [none] * len(texts)
        if len(self.up) < len(data):
            n = max(len(data), HASH_BYTES)
            self.up, self.down = powers(BASE, n), powers(INVERSE, n)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=sums[1:])
        h = (sums[self.k:] - sums[:-self.k]) * self.down[:len(data) - self.k + 1]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        packed = ((h >> PLACE_BITS) << PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        places = (window_minimum(packed, self.w) & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
        out, at = [], 0
        for text in texts:
            last = at + len(text) - self.length
            if last < at:
                out.append(none)
            else:
                own = places[at:last + 1]
                change = np.flatnonzero(own[1:] != own[:-1]) + 1
                first = np.concatenate([[0], change])
                end = np.concatenate([change - 1, [len(own) - 1]])
                out.append((own[first] - at, first, end, h[own[first]]))
            at += len(text)
        return out


def window_minimum(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, in linear time."""
    blocks = -(-len(values) // w)
    grid = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    grid[:len(values)] = values
    grid = grid.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - w + 1
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


# --- suffix sorting ---------------------------------------------------------

def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, at least ``known``."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n           # equal up to low, different within high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Orders strings that share a long prefix: inner nodes hold only the depth of the first difference."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = None           # a leaf is a list of equal strings' indexes, a node [depth, children, any index]

    def _symbol(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int, known: int) -> None:
        if self.root is None:
            self.root = (None, [i], i)
            return
        # Blind descent to some leaf, then one comparison tells the depth of the difference.
        node = self.root
        while node[0] is not None:
            node = node[1].get(self._symbol(i, node[0])) or next(iter(node[1].values()))
        a, b = self.strings[i], self.strings[node[2]]
        depth = common(a, b, known)
        if depth == len(a) == len(b):
            node[1].append(i)
            return
        parent, node = None, self.root
        while node[0] is not None and node[0] < depth:
            parent, node = node, node[1][self._symbol(i, node[0])]
        if node[0] == depth:
            node[1][self._symbol(i, depth)] = (None, [i], i)
            return
        inner = (depth, {self._symbol(node[2], depth): node, self._symbol(i, depth): (None, [i], i)}, i)
        if parent is None:
            self.root = inner
        else:
            parent[1][self._symbol(i, parent[0])] = inner

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            depth, below, _ = stack.pop()
            if depth is None:
                out += below
            else:
                stack += [below[c] for c in sorted(below, reverse=True)]
        return out


def deep_shallow(strings: list[bytes], known: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Indexes of ``strings`` in order; all share their first ``known`` bytes."""
    out: list[int] = []
    stack = [(list(range(len(strings))), known)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out += group
            continue
        if depth - known >= shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i, depth)
            out += trie.ordered()
            continue
        # Multikey quicksort on eight bytes at a time.
        keys = [strings[i][depth:depth + 8] for i in group]
        pivot = keys[len(keys) // 2]
        less = [i for i, k in zip(group, keys) if k < pivot]
        same = [i for i, k in zip(group, keys) if k == pivot]
        more = [i for i, k in zip(group, keys) if k > pivot]
        if more:
            stack.append((more, depth))
        if len(pivot) < 8:             # the strings end here and are equal
            stack.extend(([i], depth) for i in reversed(same))
        else:
            stack.append((same, depth + 8))
        if less:
            stack.append((less, depth))
    return out


class RangeMinimum:
    def __init__(self, values: list[int]):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append([min(x, y) for x, y in zip(last, last[step:])])
            step *= 2

    def __call__(self, lo: int, hi: int) -> int:
        """Minimum of values[lo:hi]."""
        k = (hi - lo).bit_length() - 1
        row = self.rows[k]
        return min(row[lo], row[hi - (1 << k)])


def reaches(lefts: list[bytes], rights: list[bytes], length: int, known: int) -> list[tuple[int, int]]:
    """For every entry the longest reach to the left and right over partners that share ``length`` bytes
    around the anchor; (0, 0) without such a partner.

    ``lefts`` are reversed; ``rights`` share their first ``known`` bytes.
    """
    n = len(lefts)
    order_r, order_l = deep_shallow(rights, known), deep_shallow(lefts)
    lcp_r = [common(rights[a], rights[b], known) for a, b in zip(order_r, order_r[1:])]
    lcp_l = [common(lefts[a], lefts[b]) for a, b in zip(order_l, order_l[1:])]
    best = [(0, 0)] * n

    def meet(i: int, j: int, left: int, right: int) -> None:
        if left + right >= length:
            for x in (i, j):
                a, b = best[x]
                if left > a or right > b:
                    best[x] = (max(left, a), max(right, b))

    rank = [0] * n
    for place, i in enumerate(order_l):
        rank[i] = place
    shared_left = RangeMinimum(lcp_l)
    if n <= DIRECT:
        for x in range(n):
            right = 1 << 62
            for y in range(x + 1, n):
                right = min(right, lcp_r[y - 1])
                i, j = order_r[x], order_r[y]
                a, b = sorted((rank[i], rank[j]))
                meet(i, j, shared_left(a, b), right)
        return best
    # Neighbouring groups in suffix order merge from the deepest common prefix up; within a merged group the
    # best partner to the left of an entry is its neighbour in prefix order.
    group = list(range(n))
    members: list[list[int] | None] = [[rank[i]] for i in order_r]

    def find(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    for at in sorted(range(n - 1), key=lambda k: -lcp_r[k]):
        right = lcp_r[at]
        a, b = find(at), find(at + 1)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members[b]
        for r in small:
            place = bisect.bisect_left(large, r)
            if place:
                meet(order_l[r], order_l[large[place - 1]], shared_left(large[place - 1], r), right)
            if place < len(large):
                meet(order_l[r], order_l[large[place]], shared_left(r, large[place]), right)
            large.insert(place, r)
        group[b], members[b] = a, None
    return best


# --- distributed steps ------------------------------------------------------

SETTLED, CLASS_HEAD, OPEN = 0, 1, 2   # states of an anchor
ANCHOR = "hash bigint, context bigint, sid binary, place int, first int, last int, state int"


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """Anchor rows of (sid, text); each text once per task.

    Of equal anchors with equal contexts a task sends two to the list; the
    others are settled already (``state`` is set), so a string that repeats
    thousands of times, in one text or many, is not thousands of list rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow, seen = Winnower(length), set()
        once: set[tuple[int, int]] = set()
        twice: set[tuple[int, int]] = set()

        def settled(key: tuple[int, int]) -> int | None:
            if key in twice:
                return SETTLED
            if len(once) > KNOWN_ANCHORS:    # forgetting only sends more rows to the lists
                once.clear()
                twice.clear()
            (twice if key in once else once).add(key)
            return None

        for whole in batches:
            for batch in pieces(whole, "text", HASH_BYTES):
                texts = []
                for sid, text in zip(batch.column(0).to_pylist(), utf8(batch, "text")):
                    if len(text) >= length and sid not in seen:
                        seen.add(sid)
                        texts.append((sid, text))
                found = winnow([t for _, t in texts])
                cols: list[list] = [[], [], [], [], [], [], []]
                for (sid, text), (places, firsts, lasts, hashes) in zip(texts, found):
                    p, f, e = places.tolist(), firsts.tolist(), lasts.tolist()
                    digests = [xxhash.xxh3_64_intdigest(text[b:c + length], a - b) for a, b, c in zip(p, f, e)]
                    cols[0].append(hashes.view(np.int64))
                    cols[2] += [sid] * len(p)
                    states = [settled(key) for key in zip(hashes.tolist(), digests)]
                    for col, values in zip((cols[1], *cols[3:]), (digests, p, f, e, states)):
                        col += values
                if texts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(cols[0])), pa.array(np.array(cols[1], np.uint64).view(np.int64)),
                         pa.array(cols[2], pa.binary()), *(pa.array(c, pa.int32()) for c in cols[3:])],
                        names=["hash", "context", "sid", "place", "first", "last", "state"])

    return map_batches(docs, run, ANCHOR)


def shared_anchors(rows: DataFrame, parts: int) -> DataFrame:
    """Anchors whose string occurs again, with a state: settled by an equal context, head of such a class
    that others may still match, or open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key = cls = head = last = None
        size = classes = 0

        def end_class(more: bool) -> None:
            """``more``: the list has other classes."""
            if head is not None:
                if size > 1:
                    out.append((*head, CLASS_HEAD if more else SETTLED))
                elif more:
                    out.append((*head, OPEN))

        for batch in batches:
            hashes = batch.column(0).to_numpy()
            # Lists that certainly have one entry are passed over without making objects of it.
            same = np.zeros(len(hashes), bool)
            same[1:] = hashes[1:] == hashes[:-1]
            keep = same | batch.column(6).is_valid().to_numpy(zero_copy_only=False)
            keep[:-1] |= same[1:]
            keep[-1:] = True
            keep[:1] = True
            for *row, state in zip(*(c.to_pylist() for c in batch.filter(pa.array(keep)).columns)):
                h, context, sid, place = row[:4]
                if state is not None:
                    out.append((*row, state))
                elif h != key:
                    end_class(classes > 1)
                    key, cls, head, size, classes, last = h, context, row, 1, 1, (sid, place)
                elif (sid, place) == last:
                    continue            # the same text, read in another task
                elif context != cls:
                    classes += 1
                    end_class(True)
                    cls, head, size, last = context, row, 1, (sid, place)
                else:
                    size += 1
                    out.append((*row, SETTLED))
                    last = (sid, place)
            if len(out) > 20_000:
                yield _rows(out)
        end_class(classes > 1)
        yield _rows(out)

    # Settled rows need no list; they go anywhere, in front of the others.
    goal = F.when(F.col("state").isNull(), F.col("hash")).otherwise(F.xxhash64("sid", "place"))
    ordered = (rows.withColumn("goal", goal).repartition(parts, "goal")
               .sortWithinPartitions(F.col("state").desc_nulls_last(), "hash", "context", "sid", "place").drop("goal"))
    return map_batches(ordered, run, ANCHOR)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out)) or [[]] * 7
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                       names=["hash", "context", "sid", "place", "first", "last", "state"])
    out.clear()
    return batch


def contexts(texts: DataFrame, length: int) -> DataFrame:
    """Context rows of the anchors in (sid, text, open array): reversed bytes before the anchor, bytes from it on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                cols: list[list] = [[], [], [], [], [], []]
                for sid, text, todo in zip(batch.column(0).to_pylist(), utf8(batch, "text"), batch.column(2).to_pylist()):
                    for x in todo or ():
                        place, first, last = x["place"], x["first"], x["last"]
                        values = (x["hash"], sid, place, x["state"], text[first:place][::-1], text[place:last + length])
                        for col, value in zip(cols, values):
                            col.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.binary())],
                    names=["hash", "sid", "place", "state", "left", "right"])

    return map_batches(texts, run, "hash bigint, sid binary, place int, state int, left binary, right binary")


def sorted_spans(rows: DataFrame, lists: DataFrame, length: int, parts: int) -> DataFrame:
    """(sid, start, end) of open anchors, by suffix sorting within each list; ``lists`` has (hash, m)."""
    k = gram(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, last, out = None, [], None, []

        def close() -> None:
            if len(group) < 2:
                return
            for (sid, place, state, _, _), (left, right) in zip(
                    group, reaches([g[3] for g in group], [g[4] for g in group], length, k)):
                if state == OPEN and right:
                    out.append((sid, place - left, place + right))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int32()),
                                               pa.array(cols[2], pa.int32())], names=["sid", "start", "end"])

        for whole in batches:
            for batch in pieces(whole, "right"):
                for h, a, b, sid, place, state, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                    if (h, a, b) != key:
                        close()
                        key, last = (h, a, b), None
                        group.clear()
                    if (sid, place) != last and right[:k] == (group[0][4][:k] if group else right[:k]):
                        group.append((sid, place, state, left, right))
                    last = (sid, place)
                yield flush()
        close()
        yield flush()

    # A list of several blocks is handled once for every two of them.
    blocks = F.ceil(F.col("m") / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("sid", "place"), F.col("blocks")).cast("int")
    spread = (rows.join(lists, "hash").withColumn("blocks", blocks).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .filter("blocks = 1 or own <> other")
              .select("hash", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                      "sid", "place", "state", "left", "right"))
    ordered = spread.repartition(parts, "hash", "a", "b").sortWithinPartitions("hash", "a", "b", "sid", "place")
    return map_batches(ordered, run, "sid binary, start int, end int")


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """United spans, and the bytes outside them."""
    united: list[list[int]] = []
    for start, end in sorted(spans):
        if united and start <= united[-1][1]:
            united[-1][1] = max(united[-1][1], end)
        else:
            united.append([start, end])
    kept, at = [], 0
    for start, end in united:
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    return [tuple(u) for u in united], b"".join(kept)


def with_text_id(df: DataFrame, text_col: str = "text", name: str = "sid") -> DataFrame:
    """``df`` with a digest that names its text."""
    return df.withColumn(name, F.unhex(F.md5(text_or_empty(text_col))))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(sid, spans, kept) of every distinct text of ``docs`` (id, text, sid) that loses bytes.

    ``spans`` are maximal removed byte ranges (start, end), ``kept`` the bytes left.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = (docs.filter(F.octet_length("text") >= length).groupBy("sid")
              .agg(F.count("*").alias("copies"), F.min("id").alias("id"), F.max(F.octet_length("text")).alias("n")))
    whole = copies.filter("copies > 1").select(
        "sid", F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end"))).alias("spans"),
        F.lit(b"").cast("binary").alias("kept"))
    shared = materialise(shared_anchors(anchors(docs.select("sid", "text"), length), parts), "suffix-anchors")
    # Copies are settled whole, but stay in the lists for the other texts.
    open_ = F.struct("hash", "place", "first", "last", "state")
    per_text = (shared.groupBy("sid").agg(F.collect_list(F.when(F.col("state") != SETTLED, open_)).alias("open"))
                .join(copies.select("sid", "id", "copies"), "sid"))
    owned = per_text.select(F.col("sid").alias("of"), F.col("id").alias("owner"), "open", "copies")
    texts = materialise(docs.join(owned, (F.col("sid") == F.col("of")) & F.col("id").eqNullSafe(F.col("owner")))
                        .select("sid", "text", "open", "copies"), "suffix-texts")
    rows = contexts(texts.select("sid", "text", "open"), length)
    lists = shared.filter(F.col("state") != SETTLED).groupBy("hash").agg(F.count("*").alias("m"))
    spans = (shared.filter(F.col("state") != OPEN)
             .select("sid", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
             .unionByName(sorted_spans(rows, lists.filter("m > 1"), length, parts)))
    united = spans.groupBy("sid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in pieces(big, "text"):
                found = [cut(t, [(s["start"], s["end"]) for s in spans_]) for t, spans_ in
                         zip(utf8(batch, "text"), batch.column(2).to_pylist())]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([[{"start": a, "end": b} for a, b in u] for u, _ in found], kind),
                     pa.array([k for _, k in found], pa.binary())], names=["sid", "spans", "kept"])

    partly = map_batches(texts.filter("copies = 1").join(united, "sid").select("sid", "text", "spans"), run,
                         "sid binary, spans array<struct<start:int,end:int>>, kept binary")
    return partly.dropDuplicates(["sid"]).unionByName(whole)


def dedup(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
          with_text: bool = False) -> DataFrame:
    """``id_col``, n_bytes, text_sha256, spans (null: nothing removed) and kept_sha256 for every row.

    ``with_text`` adds what is left as ``text``; bytes that are no whole character there become U+FFFD.
    """
    more = ["text"] if with_text else []
    docs = with_text_id(df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")))
    left = [F.make_valid_utf8(F.col("kept").cast("string")).alias("left")] if with_text else []
    lost = repeated_spans(docs, length).select("sid", "spans", F.sha2("kept", 256).alias("kept_sha256"), *left)
    own = docs.select("id", "sid", F.octet_length("text").cast("long").alias("n_bytes"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), *more)
    return (own.join(lost, "sid", "left")
            .select(F.col("id").alias(id_col), "n_bytes", "text_sha256", "spans",
                    F.coalesce("kept_sha256", "text_sha256").alias("kept_sha256"),
                    *[F.coalesce("left", "text").alias("text") for _ in more]))


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans widened so that no character is cut."""
    out = []
    for start, end in spans:
        while start and start < len(text) and text[start] & 0xC0 == 0x80:
            start -= 1
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        out.append((start, end))
    return out


def remove_repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   least_words: int = 0) -> DataFrame:
    """``df`` with the repeated strings cut out of its texts; characters cut in part go whole. Columns unchanged.

    With ``least_words`` only runs of removed bytes that hold as many words (between white space) are cut.
    """
    sid, body = fresh(df, "_sid"), fresh(df, "_spans")
    named = with_text_id(df, text_col, sid)
    docs = named.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), F.col(sid).alias("sid"))
    lost = repeated_spans(docs, length).select(F.col("sid").alias(sid), F.col("spans").alias(body))
    order = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, text_col):
                at = batch.schema.get_field_index(text_col)
                spans = batch.column(batch.schema.get_field_index(body)).to_pylist()
                texts = []
                for value, given in zip(batch.column(at).to_pylist(), spans):
                    if value is not None and given:
                        raw = value.encode()
                        spans_ = cut(raw, [(s["start"], s["end"]) for s in given])[0]
                        spans_ = [(a, b) for a, b in spans_ if not least_words or len(raw[a:b].split()) >= least_words]
                        value = cut(raw, whole_characters(raw, spans_))[1].decode()
                    texts.append(value)
                columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(order))]
                yield pa.RecordBatch.from_arrays(columns, names=order)

    joined = named.join(lost, sid, "left").select(*order, body)
    return map_batches(joined, run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes))
