"""Uniqueness audit: rows against set bits, the exact pass over buckets that disagree, and the plain way of other columns."""

import pytest
from pyspark.sql import functions as F

from sentinela.operators import distinct, quality


def audit(spark, ids, kind="bigint", numbers=None):
    rows = [(i, n) for i, n in zip(ids, numbers or [None] * len(ids))]
    df = spark.createDataFrame(rows, "id_conta bigint, numero_conta string").withColumn("id_conta", F.col("id_conta").cast(kind))
    return {r["coluna"]: (r["chaves_duplicadas"], r["linhas_duplicadas"]) for r in quality.audit_unique({"contas": df}).collect()}


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "decimal(20,0)"])
def test_counts_of_repeated_keys(spark, kind):
    ids = [1, 2, 2, 3, 3, 3, 32767, 32768, 32768, 0, -1, -32768, -32768, None, None, 70_000]
    got = audit(spark, ids, kind, ["a", "a", None, "b"] + [f"c{i}" for i in range(12)])
    assert got == {"id_conta": (4, 9), "numero_conta": (1, 2)}


def test_unique_null_and_empty_columns(spark):
    zero = {"id_conta": (0, 0), "numero_conta": (0, 0)}
    assert audit(spark, list(range(-50, 50))) == zero
    assert audit(spark, [None, None]) == zero
    assert audit(spark, []) == zero


def test_sparse_keys_are_grouped(spark):
    ends = [-(2**63), 2**63 - 1, 2**63 - 1, 5]
    df = spark.createDataFrame([(i,) for i in ends], "id bigint")
    assert distinct.dense_columns({"t": (df, "id")}) == []
    assert audit(spark, ends)["id_conta"] == (1, 2)


def test_more_buckets_than_the_broadcast_holds(spark):
    df = spark.range(300_000).select(F.expr("id - id % 2").alias("id_conta"), F.lit(None).cast("string").alias("numero_conta"))
    names = [("contas", "id_conta")]
    buckets = distinct.repeating_buckets(quality._integer_keys({"contas": df}, names)).count()
    assert buckets == 10
    for most in (3, 10, 100):
        got = quality.repeated_integers({"contas": df}, names, most).agg(F.count(F.lit(1)), F.sum("n")).first()
        assert tuple(got) == (150_000, 300_000)


def test_unique_keys_are_not_shuffled(spark):
    """Of 400,000 rows only bit sets, one per task and bucket, and the keys of the one bucket that disagrees move on."""
    once = spark.range(400_000).select(F.col("id").alias("id_conta"))
    df = once.unionAll(spark.range(7, 8).select(F.col("id").alias("id_conta")))
    keys = quality._integer_keys({"contas": df}, [("contas", "id_conta")])
    assert [tuple(r) for r in distinct.repeating_buckets(keys).collect()] == [("contas.id_conta", 0)]
    second = quality.repeated_integers({"contas": df}, [("contas", "id_conta")])
    assert [tuple(r) for r in second.collect()] == [("contas.id_conta", 2)]
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert keys.withColumn("b", distinct.bucket_of(F.col("chave"))).filter("b = 0").count() == 32_769
