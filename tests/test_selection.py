"""Exact median by selection, against sorting; bounded memory on many different values."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from sentinela.operators.selection import exact_median


@pytest.mark.parametrize("case", ["small", "even", "odd", "ties", "wide", "two halves", "one value"])
def test_median_equals_sorting(spark, case):
    rng = random.Random(case)
    values = {
        "small": [3.0], "even": [rng.random() for _ in range(1000)], "odd": [rng.gauss(0, 1e6) for _ in range(1001)],
        "ties": [float(rng.randrange(5)) for _ in range(999)], "wide": [10.0 ** rng.randrange(-300, 300) * rng.choice([-1, 1]) for _ in range(801)],
        "two halves": [-1.7e308] * 300 + [1.7e308 - i for i in range(300)], "one value": [7.5] * 500,
    }[case]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    got = exact_median(df.repartition(3), "v", small=20)
    if case == "two halves":
        assert got == values[299] + (min(values[300:]) - values[299]) / 2
    else:
        assert got == pytest.approx(statistics.median(values), rel=1e-15)


def test_no_values(spark):
    assert exact_median(spark.createDataFrame([(None,)], "v double"), "v") is None
    assert exact_median(spark.createDataFrame([], "v int"), "v") is None


def test_ten_million_different_values(spark):
    """No task returns more than the bucket counts, no sort sees more than ten thousand values."""
    n = 10_000_000
    df = spark.range(n).select(((F.col("id") * 7_368_787) % n + 0.25).alias("v"))
    assert exact_median(df, "v") == n / 2 - 0.5 + 0.25
