"""Scalar helpers at their edges: strip, title case, SQL-style rounding, bands, business hours."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from sentinela import functions as fn


def one(spark, expr, value, typ):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, expected", [
    ("d'avila", "D'Avila"), ("ana-maria", "Ana-Maria"), ("3a", "3A"), ("  joão  silva ", "João  Silva"),
    ("CUSTOMER#0001", "Customer#0001"), ("", ""),
])
def test_title_case(spark, raw, expected):
    assert one(spark, lambda c: fn.title_case(fn.strip(c)), raw, "string") == expected


def test_strip_unicode(spark):
    assert one(spark, fn.strip, " \t abc \n ", "string") == "abc"


@pytest.mark.parametrize("x, p", [(1.005, 2), (2.675, 2), (0.125, 2), (0.285, 2), (1.115, 2), (-2.5, 0),
                                  (0.15 / 3, 1), (-0.15 / 3, 1), (123456.785, 2), (2.5, 0), (-0.5, 0)])
def test_dk_round_matches_sql_round(spark, x, p):
    expected = duckdb.sql(f"SELECT ROUND({x!r}::DOUBLE, {p})").fetchall()[0][0]
    assert one(spark, lambda c: fn.dk_round(c, p), x, "double") == expected


@pytest.mark.parametrize("v, band", [(None, None), (-5.0, None), (0.0, None), (0.01, "micro"), (50.0, "micro"),
                                     (50.01, "pequeno"), (200.0, "pequeno"), (500.0, "medio"), (1000.0, "alto"),
                                     (5000.0, "muito_alto"), (5000.01, "critico")])
def test_faixa_edges(spark, v, band):
    assert one(spark, fn.faixa_valor, v, "double") == band


@pytest.mark.parametrize("ts, off", [(datetime(2026, 1, 1, 7, 59, 59), True), (datetime(2026, 1, 1, 8, 0), False),
                                     (datetime(2026, 1, 1, 18, 59, 59), False), (datetime(2026, 1, 1, 19, 0), True),
                                     (datetime(2026, 1, 15, 22, 30), True)])
def test_fora_horario_edges(spark, ts, off):
    assert one(spark, fn.fora_horario, ts, "timestamp_ntz") is off


def test_coerce_timestamp(spark):
    assert one(spark, fn.coerce_timestamp, "not a date", "string") is None
    assert one(spark, fn.coerce_timestamp, "2026-06-05T16:18:08.742373", "string") == datetime(2026, 6, 5, 16, 18, 8, 742373)


def test_cpf_invalid_counts_null(spark):
    assert one(spark, fn.cpf_invalid, None, "string") is True
    assert one(spark, lambda c: fn.cpf_invalid(fn.digits_only(c)), "123.456.789-00", "string") is False


def test_strip_title_match_python_semantics(spark):
    """Randomised: strip + title case equal ``str.strip().title()`` over Portuguese text."""
    import random
    rnd = random.Random(11)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZáàâãéêíóôõúçÁÂÃÉÍÓÕÚÇ0123456789 -'.#/\t"
    samples = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 24))) for _ in range(300)]
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    got = [r["y"] for r in df.select(fn.title_case(fn.strip("x")).alias("y")).collect()]
    assert got == [s.strip().title() for s in samples]


def test_dk_round_randomised_against_sql(spark):
    """Thousands of doubles (ties, near-ties, negatives, large values) at 0/1/2/4 places."""
    import random

    import pandas as pd
    rnd = random.Random(5)
    xs = []
    for _ in range(1500):
        k = rnd.randint(-10**6, 10**6)
        p = rnd.choice([0, 1, 2, 4])
        xs.append((k + 0.5) / 10**p)                                   # exact or near ties
        xs.append(rnd.uniform(-1e4, 1e4))
        xs.append(rnd.randint(0, 10**5) / 100 * rnd.choice([1, 7, 1.005, 1 / 3]))
    pdf = pd.DataFrame({"i": range(len(xs)), "x": xs})
    sql = ("SELECT i, ROUND(x, 0) AS r0, ROUND(x, 1) AS r1, ROUND(x, 2) AS r2, ROUND(x, 4) AS r4 "
           "FROM pdf ORDER BY i")
    want = [tuple(r[1:]) for r in duckdb.sql(sql).fetchall()]
    df = spark.createDataFrame(pdf)
    got = [tuple(r[1:]) for r in df.select("i", *[fn.dk_round("x", p).alias(f"r{p}") for p in (0, 1, 2, 4)])
           .orderBy("i").collect()]
    assert got == want
