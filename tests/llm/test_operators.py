"""Each operator against a plain restatement of its definition, edge cases included."""

import hashlib
import os
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from sentinela.llm import (
    byte_bpe, chat_format, components, jaccard_join, language_id, packing, quality_ledger, queries, simhash, suffix_dedup,
    toxicity, url_filter,
)

TIKTOKEN, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
SPACE = " \t\n\r\x0b\x0c"
key = lambda i: -1 if i is None else i


def words(text):
    return re.findall(f"[^{SPACE}]+", text or "")


# --- 1 ----------------------------------------------------------------------

def test_simhash_edits(spark, docs, texts):
    rows = simhash.edits(docs, parts=3).collect()
    order = sorted(texts, key=lambda r: (-(1 << 63) if r[0] is None else r[0], r[1] or ""))
    want = []
    for (i, own), (_, nxt) in zip(order, order[1:] + order[:1]):
        own, nxt = own or "", nxt or ""
        half = len(own) // 2
        edited = own[:len(own) - half] + nxt[:half]
        h = simhash.Hasher()
        want.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest(),
                     *(h.fingerprint(x.encode()).hex() for x in (own, edited, nxt))))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_simhash_single_row_follows_itself(spark):
    one = spark.createDataFrame([(5, "abcd efgh")], "doc_id bigint, text string")
    assert simhash.edits(one).first()["edited_sha256"] == hashlib.sha256(b"abcd abcd").hexdigest()


def test_simhash_neighbours_equal_brute_force(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(128) for _ in range(12)]
    values = []
    for i in range(1500):
        v = rng.choice(centres[:3] if i % 2 else centres)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 9])):
            v ^= 1 << rng.randrange(128)
        values.append(v)
    df = spark.createDataFrame([(i, f"{v:032x}") for i, v in enumerate(values)], "doc_id bigint, fingerprint string")
    for radius in (3, 5):
        got = {r["doc_id"]: (r["class_id"], r["near_docs"]) for r in simhash.neighbours(df, radius=radius).collect()}
        for i, v in enumerate(values):
            assert got[i] == (values.index(v), sum((v ^ w).bit_count() <= radius for w in values) - 1)


def test_simhash_radius_finds_edited_copies(spark):
    """Of copies with words changed that keep a Jaccard similarity of 0.8, 90 % are found at the dealt radius."""
    rng = random.Random(5)
    texts = [r["text"].split() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
             .orderBy("doc_id").collect() if r["text"] and 60 <= len(r["text"].split()) <= 600]
    vocabulary, rows, near = [w for t in texts for w in t], [], 0
    for t in texts:
        for share in (0, 0.01, 0.02):
            copy = list(t)
            for p in rng.sample(range(len(t)), max(1, round(share * len(t)))):
                copy[p] = rng.choice(vocabulary)
            a, b = ({tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (t, copy))
            if 100 * len(a & b) >= 80 * len(a | b):
                rows += [(len(rows), " ".join(t)), (len(rows) + 1, " ".join(copy))]
    found = simhash.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string"))
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in found.collect()}
    got = {r["doc_id"]: r["near_docs"] for r in simhash.neighbours(found).collect()}
    for i, v in prints.items():
        assert got[i] == sum((v ^ w).bit_count() <= simhash.RADIUS for w in prints.values()) - 1
    for i in range(0, len(rows), 2):
        near += (prints[i] ^ prints[i + 1]).bit_count() <= simhash.RADIUS
    assert len(rows) > 600 and near >= 0.9 * len(rows) / 2


def test_simhash_short_words_count():
    h = simhash.Hasher()
    prints = [h.fingerprint(t.encode()) for t in ("yes", "no", "a", "漢", "", " \n")]
    assert len(set(prints[:4])) == 4 and bytes(16) not in prints[:4] and prints[4:] == [bytes(16)] * 2


@pytest.mark.parametrize("direct", [4, 64])
def test_simhash_split_keys_equal_brute_force(spark, direct, monkeypatch):
    rng = random.Random(4)
    values = [rng.getrandbits(128) for _ in range(300)]
    for _ in range(300):
        v = rng.choice(values[:40])
        for p in rng.sample(range(128), rng.randint(0, 16)):
            v ^= 1 << p
        values.append(v)
    fps = np.array([[v >> 64, v & (1 << 64) - 1] for v in values], np.uint64)
    blocks = simhash.block_ranges(15)
    monkeypatch.setattr(simhash, "DIRECT", direct)
    monkeypatch.setattr(simhash, "TILE", 8)
    want = [sum((v ^ w).bit_count() <= 13 for w in values) - 1 for v in values]
    for halves in (False, True):       # as one list, and as pairs of two lists
        total = np.zeros(len(values), np.int64)
        for k in range(14):
            for key in set(simhash.field(fps, *blocks[k]).tolist()):
                rows = np.flatnonzero(simhash.field(fps, *blocks[k]) == key)
                parts = [(rows[::2], None), (rows[1::2], None), (rows[::2], rows[1::2])] if halves else [(rows, None)]
                search = simhash.Search(fps, np.ones(len(fps), np.int64), 13, blocks)
                for a, b in parts:
                    if len(a) and (b is None or len(b)):
                        search.run(a, b, (k,))
                total += search.total
        assert total.tolist() == want


def test_simhash_likeness(spark):
    df = spark.createDataFrame([("f" * 32, "0" * 32), ("8" + "0" * 31, "0" * 32)], "a string, b string")
    assert [r[0] for r in df.select(simhash.likeness(F.col("a"), F.col("b"))).collect()] == [0.0, 127 / 128]


def test_simhash_long_text_votes_like_one_block():
    text = " ".join(f"w{i * 7919 % 5003}" for i in range(40_000)).encode()
    h = simhash.Hasher()
    whole = h.votes(text)
    old, simhash.VOTE_TERMS = simhash.VOTE_TERMS, 1 << 17
    try:
        assert np.allclose(whole, simhash.Hasher().votes(text))
    finally:
        simhash.VOTE_TERMS = old


# --- 2 ----------------------------------------------------------------------

def plain_measures(text):
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(spark, docs, texts):
    rows = [tuple(r)[:6] for r in quality_ledger.ledger(docs).drop("failed").collect()]
    small = [(i, t) for i, t in texts if len(t or "") < 5000]
    got = [r for r in rows if r[1] < 5000]
    assert sorted(got, key=str) == sorted(((i, *plain_measures(t)) for i, t in small), key=str)


def test_quality_repeats_random():
    rng = random.Random(1)
    for _ in range(200):
        text = " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))
        assert quality_ledger.measure(text.encode())[:5] == plain_measures(text)


def test_quality_policies_and_ablations(spark, docs):
    book = quality_ledger.ledger(docs).cache()
    kept = quality_ledger.apply_policy(book).filter("kept").count()
    total = book.count()
    for r in quality_ledger.ablations(book).collect():
        bit = quality_ledger.bit(r["rule"])
        fails = [x["failed"] & quality_ledger.policy(quality_ledger.LATEST) for x in book.collect()]
        assert r["n_failed"] == sum(bool(f & bit) for f in fails) and r["n_only"] == sum(f == bit for f in fails)
        assert r["n_kept_without"] == sum(f & ~bit == 0 for f in fails) == kept + r["n_only"]
        assert r["n_documents"] == total
    assert quality_ledger.policy(1) & ~quality_ledger.policy(2) == 0


def test_quality_filter_keeps_columns(spark, docs):
    out = quality_ledger.filter_documents(docs)
    assert out.columns == docs.columns and out.count() == 4   # the long texts and those with a shared passage


# --- 3 ----------------------------------------------------------------------

def plain_fit(rule, host, path):
    return (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)


def test_url_judge(spark):
    rules = [url_filter.Rule("block", "net"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/"),
             url_filter.Rule("block", "a-very-long-host-name-that-spans-more-than-one-machine-word.example.org", "/fr/x/")]
    rng = random.Random(2)
    hosts = ["net", "x.net", "EXAMPLE.net", "www.example.net", "notexample.com", "example.com", "a.b.org", "org", "",
             "a-very-long-host-name-that-spans-more-than-one-machine-word.example.org", "xnet", "é.net"]
    paths = ["", "/", "/en/1", "/en", "/de/", "/fr/x/y", "/x.net/en/", "/fr/"]
    urls = [None, "", "no scheme", "://", "http://", "a://b://c.net/"]
    urls += [f"{s}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/en/', '#x', '?a#b'])}"
             for s in ("http", "ftp", "") for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("host", F.lit(1))
    for r in url_filter.judge(df, rules).collect():
        url = urls[r["page_id"]]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = "".join(c.lower() if c.isascii() else c for c in re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        best = max((x for x in rules if plain_fit(x, host, path)), key=lambda x: len(x.text), default=None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == \
            (host, path, best and best.text, best.verdict if best else "allow"), url


def test_url_wildcards_random():
    rng = random.Random(4)
    for _ in range(150):
        globs = [[rng.choice([97, 98, 46, 47, 256, 257]) for _ in range(rng.randint(1, 7))] for _ in range(rng.randint(1, 20))]
        globs = [g for g in globs if any(x < 256 for x in g)] or [[97]]
        urls = ["".join(rng.choice("ab./") for _ in range(rng.randint(0, 9))).encode() for _ in range(30)]
        hit = url_filter.Automaton(globs).matches(urls)
        for k, g in enumerate(globs):
            text = "".join("[^/]*" if x == 256 else "(?s:.*)" if x == 257 else re.escape(chr(x)) for x in url_filter.squeeze(g))
            for u, row in zip(urls, hit):
                assert row[k] == bool(re.match(text, u.decode())), (g, u)


def test_url_empty(spark):
    df = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge(df, [url_filter.Rule("block", "net")]).count() == 0


# --- 4 ----------------------------------------------------------------------

def plain_removed(texts, length):
    places = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            places.setdefault(t[i:i + length], []).append((d, i))
    out = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                out[d][i:i + length] = True
    return out


def check_dedup(spark, raw, length):
    df = spark.createDataFrame(list(enumerate(raw)), "doc_id bigint, text string")
    want = plain_removed([(t or "").encode() for t in raw], length)
    for r in suffix_dedup.dedup(df, length).collect():
        text, gone = (raw[r["doc_id"]] or "").encode(), want[r["doc_id"]]
        mine = np.zeros(len(text), bool)
        for s in r["spans"] or ():
            mine[s["start"]:s["end"]] = True
        assert (mine == gone).all(), (r["doc_id"], np.flatnonzero(mine != gone))
        assert r["n_bytes"] == len(text)
        assert r["kept_sha256"] == hashlib.sha256(bytes(b for b, g in zip(text, gone) if not g)).hexdigest()


def test_suffix_dedup_random(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(12)]
    raw = [None, "", "x" * 500, "ab" * 200, "ab" * 200, "x" * 30]
    for _ in range(260):
        raw.append(" ".join(word() for _ in range(rng.randint(0, 40))) + rng.choice(passages)[rng.randint(0, 9):]
                   + " ".join(word() for _ in range(rng.randint(0, 30))) + rng.choice(passages))
    raw += rng.choices(raw, k=20)
    check_dedup(spark, raw, 50)


def test_suffix_dedup_blocks(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    cut = lambda: passage[rng.randint(0, 20):90 - rng.randint(0, 20)]
    raw = ["".join(rng.choice("ijkl") for _ in range(30)) + cut() + "".join(rng.choice("ijkl") for _ in range(30)) for _ in range(150)]
    monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", 16)
    check_dedup(spark, raw, 50)


def test_suffix_dedup_query(spark, tmp_path):
    """The registered query over several files: passages of over fifty words on both sides of its 400 bytes."""
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    short, long, own = prose(57) + ".", prose(57) + ".!", prose(57) + "!."       # 399, 400 and 400 bytes
    pool = [prose(rng.randint(52, 90)) + " é" for _ in range(8)]
    raw = [(1, "1" + short + "2"), (2, "3" + short + "4"), (3, "5" + long + "6"), (4, "7" + long + "8"),
           (5, "9" + own + "-" + own + "0"), (6, None), (7, ""), (8, "é" * 300), (8, "é" * 300), (None, prose(80))]
    raw += [(i, prose(rng.randint(1, 40)) + rng.choice(pool)[rng.randint(0, 60):] + prose(rng.randint(1, 40))) for i in range(10, 70)]
    (spark.createDataFrame(raw, "doc_id bigint, text string").repartition(6)
     .write.parquet(str(tmp_path / "documents.parquet")))
    want = []
    texts = [(t or "").encode() for _, t in raw]
    for (i, _), text, gone in zip(raw, texts, plain_removed(texts, 400)):
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone, [0]]).astype(int)) == 1).sum())
        want.append((key(i), len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    rows = queries.op4_suffix_dedup(spark, str(tmp_path)).collect()
    assert sorted((key(r[0]), *r[1:5]) for r in rows) == sorted(want)
    got = {r["doc_id"]: r for r in rows}
    assert [got[i]["n_removed"] for i in range(1, 6)] == [0, 0, 400, 400, 800] and got[5]["text"] == "9-0"


def test_reaches_random():
    rng = random.Random(5)
    for trial in range(120):
        n = rng.choice([2, 3, 10, 30, 80])
        letters = "ab" if trial % 2 else "abcdefgh"
        some = lambda k: "".join(rng.choice(letters) for _ in range(rng.randint(0, k))).encode()
        left, right = [some(12) for _ in range(n)], [b"anchor" + some(50) for _ in range(n)]
        for i in range(0, n, 3):
            right[i] = right[0][:rng.randint(6, len(right[0]))] + right[i][6:12]
        assert [right[i] for i in suffix_dedup.deep_shallow(right, 6)] == sorted(right)
        need = rng.choice([8, 10, 14])
        got = suffix_dedup.reaches(left, right, need, 6)
        for i in range(n):
            pairs = [(len(os.path.commonprefix([left[i], left[j]])), len(os.path.commonprefix([right[i], right[j]])))
                     for j in range(n) if j != i]
            fit = [p for p in pairs if sum(p) >= need]
            assert got[i] == (max((p[0] for p in fit), default=0), max((p[1] for p in fit), default=0))


def test_remove_repeats_keeps_characters_whole(spark, docs):
    out = suffix_dedup.remove_repeats(docs, 200)
    rows = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == docs.columns and out.count() == docs.count()
    assert rows[1] is None and "shared40" not in rows[10] and rows[10].startswith("first words") and rows[8] == ""
    umlaut = spark.createDataFrame([(1, "xä" + "é" * 150 + "b"), (2, "yü" + "é" * 150 + "c")], "doc_id bigint, text string")
    assert {r["text"] for r in suffix_dedup.remove_repeats(umlaut, 200).collect()} <= {"xäb", "yüc", "xb", "yc"}


# --- 5 ----------------------------------------------------------------------

def test_chat_round_trip(spark):
    rng = random.Random(9)
    bits = ["&", "<|", "|>", "<|im_end|>", "<|im_sep|>", "<|im_start|>", "&lt;|", "&amp;", "&#10;", "\n", "ok", "é🙂", "<", ""]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
            rows.append((conv, rng.choice([turn, turn, 0, None]), rng.choice(["user", "assistant", "assistant", "a\nb", None]),
                         rng.choice([text, text, None])))
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit(1))
    out = chat_format.format_chats(df).select(
        "conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append(((-1 if turn is None else turn), role or "", text or ""))
    # Order follows the escaped role and text, which is the order of turns wherever turns differ.
    for r in out.collect():
        got = [(t["role"], t["text"]) for t in r["turns"]]
        want = by_conv.pop(r["conv_id"])
        assert sorted(got) == sorted((x[1], x[2]) for x in want)
        assert r["loss"] == "".join(t for role, t in got if role == "assistant")
        assert r["formatted"].count("<|im_start|>") == 1 + sum(a[0] != b[0] for a, b in zip(got, got[1:]))
    assert not by_conv
    assert chat_format.format_chats(df.limit(0)).count() == 0


# --- 6 ----------------------------------------------------------------------

def plain_sets(texts, n):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    return out


def check_join(spark, rows, n, percent):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = plain_sets([t for _, t in rows], n)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    want = sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))
    assert sorted(map(tuple, jaccard_join.jaccard_components(df, n, percent).collect())) == want


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, n, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 4)     # most groups take the way of long lists
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 8)
    monkeypatch.setattr(jaccard_join, "SHARED_STEP", 20)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one two")]
    for g in range(6):
        base = rng.choices(vocabulary, k=rng.choice([12, 40, 120]))
        for _ in range(rng.choice([2, 5, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, " ".join(rng.choices(vocabulary, k=30))) for i in range(20)]
    check_join(spark, rows, n, percent)


def test_divide_skip_random():
    rng = random.Random(12)
    for _ in range(200):
        pool = rng.sample(range(1 << 40), 60)
        some = lambda: np.unique(np.array(rng.sample(pool, rng.randint(1, 50)), np.uint64))
        query, sets = some(), [some() for _ in range(rng.randint(1, 20))]
        for k in range(0, len(sets), 3):
            sets[k] = query[rng.randint(0, 2):]
            sets[k] = sets[k] if len(sets[k]) else query
        for percent in (50, 80, 90):
            want = [k for k, s in enumerate(sets)
                    if 100 * len(np.intersect1d(query, s)) >= percent * len(np.union1d(query, s))]
            assert sorted(jaccard_join.divide_skip(query, sets, percent)) == want


def test_queries_equal_pairwise_bounds():
    rng = random.Random(13)
    pool = [rng.getrandbits(64) for _ in range(900)]
    sets = [np.unique(np.array(rng.sample(pool, rng.choice([3, 60, 64, 65, 140, 150, 600])), np.uint64)) for _ in range(40)]
    sets += [s[:-1] for s in sets if len(s) > 3]
    rows = [(len(s), jaccard_join.parity_bitmap(s, wide=True)) for s in sets]
    queries = jaccard_join.Queries(80)
    for k, (n, bits) in enumerate(rows):
        queries.add(n, bits, (k,))
    for n, bits in rows:
        want = {k for k, (m, other) in enumerate(rows) if jaccard_join.may_link(n, bits, m, other, 80)}
        assert {k for k, in queries.plausible(n, bits)} == want


def test_one_per_group(spark, docs):
    kept = jaccard_join.one_per_group(docs.filter("doc_id is not null"))
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and sorted(ids) == [1, 2, 3, 4, 5, 6, 8, 10, 12, 13, 14, 15, 16]


def test_one_per_group_drops_by_link_only(spark, docs):
    """Null ids, equal ids of different texts, blank texts: rows go only with a link or as a repeat."""
    kept = jaccard_join.one_per_group(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=key) == [None, 1, 2, 3, 4, 5, 6, 8, 10, 12, 13, 14, 15, 16]
    base = " ".join(f"w{i}" for i in range(60))
    near = base + " more"
    other, third = "a text of its own with seven words", "yet another text that nothing links with"
    rows = [(None, other), (None, third), (None, third), (None, None), (None, None), (None, ""), (2, None), (2, None),
            (7, base), (7, "seven again but a different text altogether"), (7, "seven again but a different text altogether"),
            (9, near), (9, "nine has a clean second text of its own here"), (None, base + " most")]
    got = jaccard_join.one_per_group(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = [(None, other), (None, third), (None, None), (None, None), (None, ""), (2, None), (7, base),
            (7, "seven again but a different text altogether"), (9, "nine has a clean second text of its own here")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_jaccard_links_between_documents_without_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, base), (None, base + " more"), (5, "another text of some words here"), (None, "on its own")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard_join.one_per_group(df).collect()
    assert sorted(r["text"] == "on its own" or r["doc_id"] == 5 for r in got) == [False, True, True]
    # Two sets of null ids link through one another with the smallest id of the group.
    df = df.unionByName(spark.createDataFrame([(3, base + " more tail")], "doc_id bigint, text string"))
    got = jaccard_join.jaccard_components(df, 5, 80).collect()
    assert sorted(key(r["component_id"]) for r in got) == [-1, 3, 3, 3, 5]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 3)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(map(tuple, components.connected_components(df, "a", "b").collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components.connected_components(df.limit(0), "a", "b").count() == 0


# --- 7 ----------------------------------------------------------------------

def test_cross_parse_counts_phrases():
    parser = language_id.CrossParser([("aa", ["the cat sat on the mat"])])
    text = "the mat cat xx the cat"

    def phrases(t):
        n, at = 0, 0
        while at < len(t):
            size = 1
            while at + size < len(t) and t[at:at + size + 1] in "the cat sat on the mat":
                size += 1
            n, at = n + 1, at + size
        return n
    assert parser.costs([text])[0][0] == pytest.approx(phrases(text) * parser.bits[0] / len(text))


def test_language_edges(spark, docs, no_docs):
    samples = [("de", ["der die das und nicht ein eine ist zu von mit"]), ("en", ["the quick brown fox and of to in is that it"])]
    rows = {r["doc_id"]: r for r in language_id.identified(docs.select("doc_id", "text"), samples).collect()}
    assert rows[6]["lang_pred"] == "en" and 0.5 <= rows[6]["score"] <= 1
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (1, 2, 3, 14, 16))
    assert language_id.identified(docs.select("doc_id", "text"), []).filter("lang_pred <> 'und'").count() == 0
    assert language_id.sample(no_docs) == [] and language_id.identified(no_docs.select("text"), samples).count() == 0
    out = language_id.filter_documents(docs, samples)
    assert out.columns == docs.columns and out.filter("text is null").count() == 0


# --- 8 ----------------------------------------------------------------------

def odd_texts(n=4000):
    rng = random.Random(1)
    alphabet = "abe rn .,'\n\t \u00a0\u3000éßñ漢字१२3½🙂\u0301-*$onoOSTs"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_bpe_equals_tiktoken(texts):
    import tiktoken
    ours = [t or "" for _, t in texts] + odd_texts()
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(TIKTOKEN), special_tokens={})
    encoder = byte_bpe.PieceEncoder(TIKTOKEN, capacity=500)     # generations turn over many times
    for at in range(0, len(ours), 100):
        for text, ids in zip(ours[at:at + 100], encoder.encode(ours[at:at + 100])):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text[:80])


def test_bpe_equals_tokenizers():
    ours = odd_texts() + ["<|endoftext|> x"]
    tokenizer = byte_bpe.load(JSON)[0]
    got = byte_bpe.PieceEncoder(JSON).encode(ours)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in tokenizer.encode_batch(ours, add_special_tokens=False)]


def test_bpe_round_trip_and_offsets(spark, docs, texts, no_docs):
    rows = byte_bpe.decode(byte_bpe.encode(docs, TIKTOKEN, offsets=True), TIKTOKEN).collect()
    assert sorted((key(r["doc_id"]), bytes(r["decoded"]).decode()) for r in rows) == sorted((key(i), t or "") for i, t in texts)
    table = byte_bpe.load(TIKTOKEN)[1]
    by_id = {r["doc_id"]: r for r in rows}
    r, text = by_id[12], dict(texts)[12]
    for i, s, e in zip(np.frombuffer(r["ids"], "<u4"), r["starts"], r["ends"]):
        assert table[i] in text[s:e].encode() and e - s >= 1
    assert byte_bpe.encode(no_docs, TIKTOKEN).count() == 0


# --- 9 ----------------------------------------------------------------------

def test_toxicity_features():
    names = toxicity.FEATURES
    f = dict(zip(names, toxicity.Featuriser(["bleh ", "vequ"])("You IDIOT! vequla bleh blehs sub-vequ id1ot i d i o t !!")))
    assert f["distinct_hits"] == 3 and f["near_second_person"] > 0 and f["hidden_hits"] > 0 and f["exclamation_rate"] > 0
    assert toxicity.Featuriser([])("") == [0.0] * len(names)
    assert toxicity.Featuriser([])("idiotic clowns")[names.index("hits")] == 0


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, "")], "doc_id bigint, text string")
    out = toxicity.score(docs.select("doc_id", "text").unionByName(extra), labels, iterations=8)
    rows = {r["doc_id"]: r["score"] for r in out.collect()}
    assert len(rows) == 1002 and all(0 <= s <= 1 for s in rows.values()) and rows[10**6] == rows[10**6 + 1]
    held = labels.filter(~toxicity.learnable()).collect()
    bad = [rows[r["doc_id"]] for r in held if r["toxic"]]
    good = [rows[r["doc_id"]] for r in held if not r["toxic"]]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in bad for b in good]) > 0.75
    none = toxicity.score(docs.limit(5), labels.limit(0))
    assert [r["score"] for r in none.collect()] == [0.0] * 5


# --- 10 ---------------------------------------------------------------------

def check_pieces(rows, ids):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(key(r["doc_id"]), []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024 and at & (at - 1) == 0
    return by_doc


def test_packing(spark, docs, texts, no_docs):
    tokenizer = byte_bpe.load(JSON)[0]
    rows = packing.pack(docs, JSON, with_ids=True).collect()
    got = check_pieces(rows, None)
    want = {}
    for i, t in texts:
        want.setdefault(key(i), []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])
    assert set(got) == set(want)
    for i, all_ids in want.items():
        if len(all_ids) > 1:
            continue
        ids, at = all_ids[0], 0
        for r in sorted(got[i], key=lambda r: r["start"]):
            part = ids[r["start"]:r["start"] + r["length"]]
            raw = struct.pack(f"<{len(part)}I", *part)
            assert r["start"] == at and raw == bytes(r["ids"]) and zlib.crc32(raw) == r["ids_crc32"] and r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)
    assert packing.pack(no_docs, JSON).count() == 0


def test_packer_fills_every_window():
    rng = random.Random(6)
    packer, rows, total = packing.Packer(), [], 0
    for d in range(700):
        n = rng.choice([1, 5, 130, 700, 1024, 1500, 5000])
        total += n
        packer.add((d, n), np.full(n, d, "<u4").tobytes())
        if d % 100 == 99:
            rows += packer.pack()
    rows += packer.pack(last=True)
    sizes, groups = {}, {}
    for (doc, _), start, length, _, sequence, offset, tier, group, ids in rows:
        assert sizes.get(sequence, 0) == offset and len(ids) == 4 * length
        sizes[sequence] = offset + length
        groups.setdefault((tier, group), set()).add(sequence)
        assert sizes[sequence] <= tier
    assert sum(sizes.values()) == total and all(n & (n - 1) == 0 for n in sizes.values())
    assert max(map(len, groups.values())) <= packing.GROUP_WINDOWS
