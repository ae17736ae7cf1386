"""Collocations, lexical search and decontamination against plain restatements, edge cases included."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentinela.llm import collocations, decontamination, lexical_search
from sentinela.llm.base import materialise

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
last = lambda i: (i is None, i or 0)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


# --- 11 ---------------------------------------------------------------------

def phrases_by_hand(rows, least, cover, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in (1, 2, 3, 4):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cands.items()):
                continue
            score, _, le, ri = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                   for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), le, ri))
        for rank, (score, a, phrase, le, ri) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, le, ri, n[lang], -score))
    return sorted(out)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocab = ["New", "york", "CITY", "the", "of", "a", "É", "é", "x\x00y", "naïve", "漢字", " "]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 40))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "!"]) for w in words)
        rows.append((text, rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" ,.;", "en"), ("new york city of", "en")] * 3


@pytest.mark.parametrize("shard", [collocations.SHARD_WORDS, 300])
def test_collocations_equal_a_count_by_hand(spark, monkeypatch, shard):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard)
    rows = corpus(5)
    df = spark.createDataFrame([(t, x, 7, "clash", 1.5) for t, x in rows], "text string, lang string, a int, phrase string, n double")
    for least, cover, top in ((5, 80, 2000), (8, 40, 7)):
        got = collocations.collocations(df.repartition(3), least=least, cover=cover, top=top)
        got = sorted(map(tuple, got.drop("left_ext", "right_ext").collect()))
        assert got == phrases_by_hand(rows, least, cover, top) and got


def test_collocations_ties_repeats_long_and_empty(spark):
    # Ties in score and count go by the phrase; one very long text is never split; overlaps of a repeated word count.
    text = " ".join(["aa bb"] * 20 + ["cc dd"] * 20 + ["zz"] * 40)
    rows = [(text * 50, "en"), ("ho ho ho ho ho " * 20, "fr")]
    got = collocations.collocations(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(map(tuple, got.drop("left_ext", "right_ext").collect())) == phrases_by_hand(rows, 30, 80, 2000)
    none = collocations.collocations(spark.createDataFrame([], "text string, lang string"))
    assert none.count() == 0 and none.columns[:3] == ["lang", "rank", "phrase"]
    assert collocations.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).count() == 0


def test_index_extends_left_and_right_like_a_count():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 5, 700).astype(np.int32)
    for m in (1, 2, 3, 4):
        fm = collocations.FmIndex(ids, max(m - 1, 1))
        want = Counter(tuple(ids[i:i + m]) for i in range(len(ids) - m + 1) if (ids[i:i + m] != 0).all())
        found, counts = fm.phrases(m)
        assert {tuple(p): int(c) for p, c in zip(found, counts)} == want and len(found) == len(want)


def test_words_of_one_hash_get_another_seed(spark, monkeypatch):
    real = collocations.word_hash
    monkeypatch.setattr(collocations, "word_hash", lambda lang, seed: (lambda w: 1) if seed == 0 else real(lang, seed))
    monkeypatch.setattr(collocations, "map_batches", lambda df, fn, schema: df.sparkSession.createDataFrame(
        [tuple(r.values()) for b in fn(iter(df.toArrow().to_batches())) for r in b.to_pylist()], schema))
    docs = spark.createDataFrame([("en", "aa bb " * 40)], "lang string, text string")
    table, seed = collocations.counted_words(docs, 30)
    assert seed == 1 and table.count() == 2


# --- 12 ---------------------------------------------------------------------

def ranking_by_hand(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_all = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_all // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 20 * m))
                        for t in ts if bag[t])
            if score > 0:
                scored.append((-score, last(i), i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda r: (last(r[0]), r[1]))


def search_fixture():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(60)] + ["Über", "über", "É", "x1", "漢字"]
    text = lambda n: " ".join(rng.choice(vocab[:rng.choice([8, 65])]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(600)]
    docs += [(600 + i, docs[3][1]) for i in range(30)] + [(None, docs[3][1]), (None, "w1"), (5, docs[5][1]), (700, None), (701, ""),
                                                         (702, "w1 " * 40_000 + "rare"), (703, "--- !!")]
    items = [(1, text(12)), (2, docs[3][1].upper()), (3, None), (4, ""), (5, "nowhere atall"), (6, "rare"), (6, "w1"), (None, "w7 x1"),
             (8, "É über"), (9, " ".join(vocab))]
    return docs, items


@pytest.mark.parametrize("shard_docs, block", [(lexical_search.SHARD_DOCS, lexical_search.BLOCK_TERMS), (90, 20)])
def test_search_equals_a_full_ranking(spark, monkeypatch, shard_docs, block):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard_docs)
    docs, items = search_fixture()
    d = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id bigint, text string, item string, score int").repartition(4)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, rank int")
    for k in (1, 50):
        got = lexical_search.search(d, q, k=k, block_terms=block)
        got = sorted(map(tuple, got.collect()), key=lambda r: (last(r[0]), r[1]))
        assert got == ranking_by_hand(docs, items, k)


def test_search_of_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{c} bigint, text string") for c in ("doc_id", "item_id"))
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    asked = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    for d, q in ((docs, items), (some, items), (docs, asked)):
        out = lexical_search.search(d, q)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]
    assert [tuple(r) for r in lexical_search.search(some.withColumn("doc_id", F.lit("s1")), asked).collect()][0][2] == "s1"


def test_tree_prunes_and_bounds_hold():
    rng = np.random.default_rng(4)
    size, n = 200, 1500
    # Documents of separate subjects: an item of one subject needs only its part of the tree.
    rows = [np.unique(rng.integers(0, 20, 12) + 20 * (i % 10)) for i in range(n)]
    starts = np.cumsum([0, *map(len, rows)])
    shard = lexical_search.Shard(starts, np.concatenate(rows), rng.integers(1, 10 ** 6, starts[-1]))
    items = [(np.arange(20 * g, 20 * g + 15), rng.integers(1, 9000, 15)) for g in range(10)]
    group = lexical_search.term_groups([c for c, _ in items], size)
    tree = lexical_search.Searcher(shard, size, group, list(range(n)), items, 10)
    for cols, weights in items:
        dense = np.zeros(size, np.int64)
        dense[cols] = weights
        place, c, v = shard.rows(np.arange(n))
        scores = np.bincount(place, weights=(dense[c] * v).astype(np.float64), minlength=n)
        bound = tree.bounds(cols, weights)
        assert all(bound[i] >= scores[node.docs].max() for i, node in enumerate(tree.nodes))
        tree.scored = 0
        found = tree.search(cols, weights)
        assert [s for s, _ in found] == sorted(scores.astype(int), reverse=True)[:10]
        assert tree.scored < n / 2


# --- 13 ---------------------------------------------------------------------

def contamination_by_hand(docs, items, width=10):
    wins = defaultdict(set)
    for item, text in items:
        w = terms(text)
        for i in range(max(len(w) - width, 0) + 1 if w else 0):
            wins[tuple(w[i:i + width])].add("" if item is None else str(item))
    sizes = {len(w) for w in wins}
    out = []
    for i, text in docs:
        w = terms(text)
        hit, found = set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                names = wins.get(tuple(w[s:s + size]))
                if names:
                    hit.update(range(s, s + size))
                    found |= names
        out.append((i, len(w), len(hit), tuple(sorted(found, key=str.encode))))
    return sorted(out, key=str)


def leak_fixture():
    rng = random.Random(11)
    vocab = ["the", "of", "Über", "a1", "x", "y", "z"] + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 11, 30]))) for i in range(12)]
    items += [(50, "solo"), (51, None), (52, ""), (53, "the the the the the the the the the the the the"), (2, text(14)), (None, "null item"),
              (54, "missing word nowhere"), (55, items[4][1]), (0, items[0][1])]
    docs = []
    for i in range(200):
        parts = [text(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            cut = rng.randrange(0, 4)
            parts += [rng.choice([" ", ", ", "\n"]).join(w[cut:]).upper(), text(rng.randrange(0, 5))]
        docs.append((i, " ".join(parts)))
    docs += [(3, docs[3][1]), (None, docs[8][1]), (900, None), (901, ""), (902, " \t"), (903, "solo SOLO; solo"), (904, "the " * 30),
             (905, text(40_000) + " " + items[4][1]), (906, "ÜBER überÜ"), (907, "null item")]
    return docs, items


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_contamination_equals_brute_force(spark, threshold):
    docs, items = leak_fixture()
    d = spark.createDataFrame([(i, t, 1, "c", 2, 3) for i, t in docs], "doc_id bigint, text string, row int, term string, pos int, n int")
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id bigint, text string, at int, name int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)   # -1: nothing is broadcast
    try:
        for width in (10, 4):
            out = decontamination.contamination(d.repartition(3), q, width=width).collect()
            got = sorted([(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in out], key=str)
            assert got == contamination_by_hand(docs, items, width)
            assert all(sum(s["end"] - s["begin"] for s in r["spans"] or []) == r["n_hit"] for r in out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_contamination_of_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{c} bigint, text string") for c in ("doc_id", "item_id"))
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    assert decontamination.contamination(docs, items).count() == 0
    assert decontamination.contamination(docs, some.withColumnRenamed("doc_id", "item_id")).count() == 0
    out = decontamination.contamination(some, items).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in out) == [(1, 2, 0, 0), (2, 0, 0, 0)]


def test_proximity_matches(spark):
    docs = [(1, "alpha x x beta x gamma"), (2, "gamma beta alpha"), (3, "alpha " + "x " * 50 + "beta gamma"), (4, "alpha beta"), (5, None)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    q = spark.createDataFrame([(7, "Alpha beta gamma")], "item_id bigint, text string")
    postings, asked, vocab, lengths = decontamination.build(d, q)
    ids = postings.filter("term IS NULL").select("row", "doc_id")
    for reach, want in ((2, {2}), (5, {1, 2}), (60, {1, 2, 3})):
        met = decontamination.proximity_matches(postings, asked, vocab, lengths, reach=reach).join(ids, "row")
        assert {r["doc_id"] for r in met.collect()} == want


def test_no_python_in_decontamination(spark):
    from sentinela.llm.queries import op13_decontamination
    plan = op13_decontamination(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    asked = materialise(decontamination.item_words(items), "t")
    vocab = materialise(decontamination.vocabulary(asked), "t")
    plan = decontamination.index(docs, vocab)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange hashpartitioning" not in plan
