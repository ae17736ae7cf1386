"""Ranked lexical search: exact inner-product search with sparse ball trees.

A document is the sparse vector of its term values, an item the vector of its
terms' weights, and a score their inner product in whole numbers:

    weight(term)   = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    value(term, d) = (10^9 tf) div (1000 tf + 20 m),   m = 50 + (50 n N) div L

Spark carries it in three steps:

1. One scan of the documents keeps of each text its number of terms and the
   frequencies of those terms that items ask for, written as a table.
2. Collection statistics (N, L, df) are sums over that table.
3. Every task cuts its documents into shards of bounded size and builds a ball
   tree over each: a node has the centroid of its documents and its radius,
   whole and per group of terms. For every item the nodes are opened best-first
   by ``<q, centroid> + |q| * radius`` (or the sum over term groups, whichever is
   less), rounded up; what cannot reach the item's ``k``-th best score so far is
   pruned, leaves are scored exactly in 64-bit integers. The shards' ``k`` best
   per item meet in one window, which Spark limits before and after the shuffle.

Items are searched in blocks of at most ``BLOCK_TERMS`` terms, so what is sent to
the tasks is bounded whatever the number of items (one item's terms are never
split).

Defined results: a null or empty text has no terms and scores nothing; an item
without terms has no rows; rows of one item id are one item with the terms of
all; repeated documents rank each on its own; equal scores go by id, null ids
last; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentinela.llm.base import map_batches, materialise, pieces, utf8

#: Terms of all items of one block; about 20 MB at most go to the tasks.
BLOCK_TERMS = 1 << 18
#: Entries (document, term) and documents of a shard.
SHARD_ENTRIES, SHARD_DOCS = 1 << 20, 1 << 13
LEAF_DOCS = 48
#: Term groups that have a radius of their own.
GROUPS = 32
#: Bounds are float64 sums of at most some million terms; this covers their rounding.
ROUND_UP = 1 + 1e-9

#: Bytes of a term: ASCII digits and letters, and all bytes of other characters. A-Z become a-z, the rest spaces.
FOLD = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20
             for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# --- items ------------------------------------------------------------------

def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term): the distinct terms of each item; ``item`` is a struct that is never null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                found = [sorted(set(terms(t))) for t in utf8(batch, "text")]
                at = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([t for f in found for t in f], pa.binary())],
                                                 names=["id", "term"])

    kind = dict(items.dtypes)[item_col]
    narrow = items.select(F.col(item_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(narrow, run, f"id {kind}, term binary").select(F.struct("id").alias("item"), "term").distinct()


def vocabulary(asked: DataFrame, blocks: int, block: int) -> list[bytes]:
    """The distinct terms of one block of items, sorted."""
    mine = asked.filter(in_block(blocks, block)).select("term").distinct()
    return sorted(bytes(r["term"]) for r in mine.toLocalIterator())


def in_block(blocks: int, block: int):
    return F.pmod(F.xxhash64("item"), F.lit(blocks)) == block


# --- document vectors -------------------------------------------------------

def vectors(docs: DataFrame, vocab: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, tfs): number of terms of each text, and numbers and frequencies of those in ``vocab``."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(sent.value)}
        look = functools.partial(number.get)
        for whole in batches:
            for batch in pieces(whole, "text"):
                counts, found, tfs = [], [], []
                for text in utf8(batch, "text"):
                    own = terms(text)
                    counts.append(len(own))
                    ids = np.array([x for x in map(look, own) if x is not None], np.int32)
                    t, c = np.unique(ids, return_counts=True)
                    found.append(t)
                    tfs.append(c)
                at = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                flat = (lambda x: np.concatenate(x) if x else np.zeros(0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()),
                     pa.ListArray.from_arrays(at, pa.array(flat(found).astype(np.int32), pa.int32())),
                     pa.ListArray.from_arrays(at, pa.array(flat(tfs).astype(np.int64), pa.int64()))],
                    names=["id", "n", "terms", "tfs"])

    kind = dict(docs.dtypes)[id_col]
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(narrow, run, f"id {kind}, n bigint, terms array<int>, tfs array<bigint>")


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the ``size`` terms; every task sends one row of sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            if len(flat):
                total += np.bincount(flat, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in (map_batches(found.select("terms"), run, "term int, df bigint").groupBy("term")
              .agg(F.sum("df").alias("df")).toLocalIterator()):
        out[r["term"]] = r["df"]
    return out


# --- tree -------------------------------------------------------------------

class Shard:
    """Sparse rows (document -> term, value) of up to ``SHARD_DOCS`` documents."""

    def __init__(self, starts: np.ndarray, cols: np.ndarray, values: np.ndarray):
        self.starts, self.cols, self.values = starts, cols, values

    def rows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``docs``, term, value) of all entries of the documents."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        place = np.repeat(np.arange(len(docs)), sizes)
        at = np.arange(len(place)) + np.repeat(self.starts[docs] - np.cumsum(sizes) + sizes, sizes)
        return place, self.cols[at], self.values[at]


class Node:
    __slots__ = ("docs", "centre", "radius", "parts", "children")

    def __init__(self, docs: np.ndarray):
        self.docs, self.children = docs, ()


def ball(shard: Shard, node: Node, size: int, group: np.ndarray) -> np.ndarray:
    """Sets centre and radii; returns the documents' squared distances from the centre."""
    place, cols, values = shard.rows(node.docs)
    m = len(node.docs)
    centre = np.bincount(cols, weights=values, minlength=size) / m
    near = values - centre[cols]
    base = np.bincount(group, weights=centre * centre, minlength=GROUPS)
    # Entries that a document lacks differ by the centre's own value.
    apart = np.bincount(place * GROUPS + group[cols], weights=near * near - centre[cols] ** 2, minlength=m * GROUPS)
    apart = np.maximum(apart.reshape(m, GROUPS) + base, 0.0) + base * 1e-12
    whole = apart.sum(axis=1)
    node.centre = centre
    node.radius = math.sqrt(whole.max()) * ROUND_UP
    node.parts = np.sqrt(apart.max(axis=0)) * ROUND_UP
    return whole


def build_tree(shard: Shard, size: int, group: np.ndarray, leaf: int = LEAF_DOCS) -> Node:
    """Ball tree: a node's documents go to the nearer of two that lie far apart."""
    n = len(shard.starts) - 1
    root = Node(np.arange(n))
    todo = [root]
    while todo:
        node = todo.pop()
        whole = ball(shard, node, size, group)
        if len(node.docs) <= leaf:
            continue
        place, cols, values = shard.rows(node.docs)
        norm = np.bincount(place, weights=values.astype(np.float64) ** 2, minlength=len(node.docs))

        def distances(k: int) -> np.ndarray:
            one = np.zeros(size)
            _, c, v = shard.rows(node.docs[k:k + 1])
            one[c] = v
            return norm - 2 * np.bincount(place, weights=values * one[cols], minlength=len(node.docs)) + norm[k]

        first = int(whole.argmax())
        from_first = distances(first)
        second = int(from_first.argmax())
        near = from_first <= distances(second)
        if near.all() or not near.any():   # equal documents: halves
            near = np.arange(len(node.docs)) < len(node.docs) // 2
        node.children = (Node(node.docs[near]), Node(node.docs[~near]))
        todo.extend(node.children)
    return root


def nodes_of(root: Node) -> list[Node]:
    out = [root]
    for node in out:
        out.extend(node.children)
    return out


class Searcher:
    """Searches one shard for every item, best bound first."""

    def __init__(self, shard: Shard, size: int, group: np.ndarray, ids: list, items: list[tuple[np.ndarray, np.ndarray]], k: int):
        self.shard, self.size, self.ids, self.items, self.k = shard, size, ids, items, k
        self.opened = self.scored = 0
        self.nodes = nodes_of(build_tree(shard, size, group))
        number = {id(n): i for i, n in enumerate(self.nodes)}
        self.below = [[number[id(c)] for c in n.children] for n in self.nodes]
        self.entries = [shard.rows(n.docs) if not n.children else None for n in self.nodes]
        self.centres = np.stack([n.centre for n in self.nodes])
        self.radius = np.array([n.radius for n in self.nodes])
        self.parts = np.stack([n.parts for n in self.nodes])
        self.group = group

    def bounds(self, cols: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No document below a node scores more."""
        w = weights.astype(np.float64)
        parts = np.sqrt(np.bincount(self.group[cols], weights=w * w, minlength=GROUPS)) * ROUND_UP
        reach = np.minimum(self.radius * math.sqrt((w * w).sum()) * ROUND_UP, self.parts @ parts)
        return (self.centres[:, cols] @ w + reach) * ROUND_UP + 1

    def search(self, cols: np.ndarray, weights: np.ndarray) -> list[tuple[int, int]]:
        """(score, document) of the ``k`` best with a score above 0: highest first, then by rank of the id."""
        dense = np.zeros(self.size, np.int64)
        dense[cols] = weights
        bound = self.bounds(cols, weights)
        heap, best = [(-bound[0], 0)], []          # best: min-heap of (score, -document)
        while heap:
            top, at = heapq.heappop(heap)
            if len(best) == self.k and -top < best[0][0]:
                break
            self.opened += 1
            if self.below[at]:
                for child in self.below[at]:
                    heapq.heappush(heap, (-bound[child], child))
                continue
            docs = self.nodes[at].docs
            place, c, v = self.entries[at]
            scores = np.zeros(len(docs), np.int64)
            np.add.at(scores, place, dense[c] * v)
            self.scored += len(docs)
            floor = best[0][0] if len(best) == self.k else 1
            for j in np.flatnonzero(scores >= max(floor, 1)).tolist():
                entry = (int(scores[j]), -int(docs[j]))
                if len(best) < self.k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1]))


def term_groups(items: list[np.ndarray], size: int) -> np.ndarray:
    """The group of each term: that of the first item that has it, so an item's terms keep to few groups."""
    group = np.zeros(size, np.int64)
    for i in range(len(items) - 1, -1, -1):
        group[items[i]] = i % GROUPS
    return group


def search_shards(found: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], size: int, n_docs: int, total: int,
                  k: int) -> DataFrame:
    """(item number, id, score): every shard's ``k`` best documents of each item."""
    kind = dict(found.dtypes)["id"]
    sent = found.sparkSession.sparkContext.broadcast((items, term_groups([c for c, _ in items], size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, group = sent.value
        held: list[tuple] = []
        entries = 0
        id_type = None

        def answer() -> pa.RecordBatch:
            # Documents by id, null last, so that the order of places settles ties.
            held.sort(key=lambda r: (r[0] is None, 0 if r[0] is None else r[0]))
            starts = np.cumsum([0, *(len(r[2]) for r in held)])
            cols = np.concatenate([r[2] for r in held]).astype(np.int64)
            tfs = np.concatenate([r[3] for r in held])
            lengths = np.array([50 + (50 * r[1] * n_docs) // total for r in held], np.int64)
            values = (10 ** 9 * tfs) // (1000 * tfs + 20 * np.repeat(lengths, np.diff(starts)))
            # Terms that no document of the shard has need no place in its tree.
            used, local = np.unique(cols, return_inverse=True)
            place = np.full(size, -1, np.int64)
            place[used] = np.arange(len(used))
            searcher = Searcher(Shard(starts, local, values), len(used), group[used], [r[0] for r in held], queries, k)
            rows: tuple[list, list, list] = ([], [], [])
            for number, (terms_, weights) in enumerate(queries):
                there = place[terms_]
                here = there >= 0
                if here.any():
                    for score, doc in searcher.search(there[here], weights[here]):
                        for col, x in zip(rows, (number, held[doc][0], score)):
                            col.append(x)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], id_type),
                                               pa.array(rows[2], pa.int64())], names=["number", "id", "score"])

        for batch in batches:
            id_type = batch.column(0).type
            ids, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ends = batch.column(2).offsets.to_numpy()
            cols, tfs = (batch.column(i).flatten().to_numpy() for i in (2, 3))
            ends = ends - ends[0]
            for i, doc in enumerate(ids):
                a, b = ends[i], ends[i + 1]
                if a == b:
                    continue
                held.append((doc, counts[i], cols[a:b].copy(), tfs[a:b].copy()))
                entries += b - a
                if entries >= SHARD_ENTRIES or len(held) >= SHARD_DOCS:
                    yield answer()
                    entries = 0
        if held:
            yield answer()

    return map_batches(found, run, f"number int, id {kind}, score bigint")


# --- the whole --------------------------------------------------------------

def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_col``, rank (from 1), ``id_col``, score: each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    asked = materialise(item_terms(items, item_col, item_text), "search-items")
    blocks = max(1, -(-asked.count() // block_terms))
    parts = [_search_block(docs, asked, blocks, b, k, id_col, text_col) for b in range(blocks)]
    best = functools.reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item.id").alias(item_col), F.col("rank").cast("int").alias("rank"),
                         F.col("id").alias(id_col), "score")


def _search_block(docs: DataFrame, asked: DataFrame, blocks: int, block: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, id, score) of one block of items against all documents."""
    spark = docs.sparkSession
    vocab = vocabulary(asked, blocks, block)
    found = materialise(vectors(docs, vocab, id_col, text_col), "search-vectors")
    # N, L: documents with a term, and all terms.
    sums = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = document_counts(found, len(vocab))
    number = {t: i for i, t in enumerate(vocab)}
    by_item: dict = {}
    for r in asked.filter(in_block(blocks, block)).toLocalIterator():
        by_item.setdefault(r["item"]["id"], []).append(number[bytes(r["term"])])
    names = sorted(by_item, key=lambda x: (x is None, str(x)))
    items = []
    for name in names:
        cols = np.array(sorted(by_item[name]), np.int64)
        items.append((cols, np.array([weight(sums["docs"], int(df[c])) for c in cols], np.int64)))
    if sums["docs"]:
        best = search_shards(found, items, len(vocab), sums["docs"], sums["terms"], k)
    else:
        best = spark.createDataFrame([], f"number int, id {dict(found.dtypes)['id']}, score bigint")
    kind = asked.schema["item"].dataType.simpleString()
    table = spark.createDataFrame([(i, (name,)) for i, name in enumerate(names)], f"number int, item {kind}")
    return best.join(F.broadcast(table), "number").select("item", "id", "score")
