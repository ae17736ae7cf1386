"""The pipeline's stages against plain restatements, and the registered queries."""

import re

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from sentinela.llm import jaccard_join, language_id, quality_ledger
from sentinela.llm.base import materialise, read_table
from test_operators import plain_removed, plain_sets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = read_table(spark, SF, "documents")
    out = {"documents": docs}
    for name, stage in C.STAGES:
        docs = materialise(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs
    return out


def test_columns(stages):
    for name, _ in C.STAGES[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_language_stage(spark, stages):
    docs = stages["documents"]
    samples = language_id.sample(docs.filter(language_id.learnable()))
    rows = docs.collect()
    langs, scores = language_id.CrossParser(samples).predict([r["text"] for r in rows])
    want = {r["doc_id"] for r, lang, s in zip(rows, langs, scores) if lang != "und" and s >= language_id.LEAST_SCORE}
    assert {r["doc_id"] for r in stages["language_id"].collect()} == want


def test_quality_stage(stages):
    ids = {r["doc_id"] for r in quality_ledger.apply_policy(quality_ledger.ledger(stages["language_id"])).filter("kept").collect()}
    assert {r["doc_id"] for r in stages["quality_rules"].collect()} == ids


def test_jaccard_stage(stages):
    rows = sorted(stages["quality_rules"].collect(), key=lambda r: r["doc_id"])
    sets = plain_sets([r["text"] for r in rows], 5)
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for g, r in zip(group, rows):
        first.setdefault(g, r["doc_id"])
    assert {r["doc_id"] for r in stages["jaccard_join"].collect()} == set(first.values())


def test_suffix_stage(stages):
    rows = sorted(stages["jaccard_join"].collect(), key=lambda r: r["doc_id"])
    raw = [r["text"].encode() for r in rows]
    gone = plain_removed(raw, C.PASSAGE_BYTES)
    got = {r["doc_id"]: r for r in stages["suffix_dedup"].collect()}
    assert len(got) == len(rows)
    for r, text, mask in zip(rows, raw, gone):
        at = 0                            # runs with too few words stay
        while at < len(text):
            end = at
            while end < len(text) and mask[end]:
                end += 1
            if end > at and len(text[at:end].split()) < C.PASSAGE_WORDS:
                mask[at:end] = [False] * (end - at)
            at = end + 1
        for i, b in enumerate(text):      # a character cut in part goes whole
            if mask[i] and b & 0xC0 != 0x80:
                j = i + 1
                while j < len(text) and text[j] & 0xC0 == 0x80:
                    mask[j], j = True, j + 1
            elif mask[i]:
                j = i
                while text[j] & 0xC0 == 0x80:
                    j -= 1
                    mask[j] = True
                j = i + 1
                while j < len(text) and text[j] & 0xC0 == 0x80:
                    mask[j], j = True, j + 1
        kept = bytes(b for b, m in zip(text, mask) if not m).decode()
        assert got[r["doc_id"]]["text"] == kept and got[r["doc_id"]]["n_chars"] == len(kept)


def test_fifty_one_short_words_are_cut_and_fifty_stay(spark):
    passage = " ".join(f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(51))
    few = " ".join(f"short{i}phrase" for i in range(30))
    rows = [(1, f"11 {passage} 22"), (2, f"33 {passage} 44"), (3, f"55 {few} 66"), (4, f"77 {few} 88")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r["text"] for r in C.cut_repeats(spark, docs, "").collect()}
    assert passage not in got[1] + got[2] and got[1].startswith("11") and got[3] == rows[2][1] and got[4] == rows[3][1]


def test_packing_stage(stages):
    rows = stages["packing"].collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in stages["suffix_dedup"].collect()}
    assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())


def test_empty_input(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_registered():
    found = {re.match(r"op(\d+)_", q)[1] for q in E.queries() if q.startswith("op")}
    assert found == {str(n) for n in range(1, 14)} and "pipeline" in E.queries()
    assert jaccard_join.prefix_length(148, 90) == 15
