import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    """Documents with nulls, empty and long texts, ties and repeated rows, odd characters."""
    long_text = " ".join(f"wort{i % 977} and{i % 31}" for i in range(30_000))
    passage = " ".join(f"shared{i}" for i in range(80))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "one two"),
        (6, "The quick brown fox jumps over the lazy dog near the river bank today"),
        (7, "The quick brown fox jumps over the lazy dog near the river bank today"),
        (8, long_text), (9, long_text + " end"), (10, f"first words {passage} tail a b c"),
        (11, f"other start of text {passage} and a different tail"), (12, "naïve café 漢字 🙂 \u2003 x"), (None, "no id here"),
        (13, "a" * 900), (14, "1234 5678 ???"), (15, "DON'T SHOUT AT ME " * 10), (16, None),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """The same rows with columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "src0", len(t or ""), 7, "x", 1.5, b"s", 3) for i, t in texts]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, score string, "
              "part double, sid binary, n_words int")


@pytest.fixture
def no_docs(docs):
    return docs.limit(0)
