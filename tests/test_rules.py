"""Fraud rules: the stored rule combinations, message formats and the velocity window."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sentinela.operators import rules
from sentinela.operators.velocity import ranked_trailing_count, trailing_count

T0 = datetime(2026, 6, 5, 16, 0, 0)
EV_SCHEMA = ("evento_id string, event_ts timestamp_ntz, id_conta bigint, valor double, tipo string, status string, "
             "canal string, estado_origem string, is_fraude boolean, score_fraude double, ip_origem string, "
             "device_id string, comerciante string, descricao string")


def event(eid, secs, conta=1, valor=10.0, status="aprovada", score=0.1):
    return (eid, T0 + timedelta(seconds=secs), conta, valor, "pix", status, "app", "SP", False, score,
            "1.1.1.1", "d", "m", "x")


def test_three_rule_alert(spark):
    df = spark.createDataFrame([event("a", 0, 86, 11632.04, "suspeita", 0.7246)], EV_SCHEMA)
    docs = rules.alert_documents(rules.evaluate(df)).collect()
    assert len(docs) == 1
    al = docs[0]["alertas"]
    assert [a["regra"] for a in al] == ["SCORE_FRAUDE_ALTO", "VALOR_SUSPEITO", "STATUS_SUSPEITA"]
    assert al[0]["descricao"] == "Score 0.7246 acima do limite 0.65"
    assert al[1]["descricao"] == "Transação de R$ 11,632.04 acima do limite"
    assert [a["severidade"] for a in al] == ["ALTA", "MEDIA", "ALTA"]
    assert docs[0]["estado"] == "SP" and docs[0]["transacao"]["evento_id"] == "a"
    assert docs[0]["transacao"]["timestamp"] == "2026-06-05T16:00:00.000000"
    assert list(docs[0]["transacao"].asDict())[:3] == ["evento_id", "timestamp", "id_conta"]


def test_score_and_status_alert(spark):
    df = spark.createDataFrame([event("a", 0, 7, 812.5, "suspeita", 0.8123)], EV_SCHEMA)
    docs = rules.alert_documents(rules.evaluate(df)).collect()
    assert [a["regra"] for a in docs[0]["alertas"]] == ["SCORE_FRAUDE_ALTO", "STATUS_SUSPEITA"]
    assert docs[0]["alertas"][0]["descricao"] == "Score 0.8123 acima do limite 0.65"


def test_status_only_and_no_alert(spark):
    df = spark.createDataFrame([event("a", 0, status="suspeita"), event("b", 1, conta=2)], EV_SCHEMA)
    docs = rules.alert_documents(rules.evaluate(df)).collect()
    assert [(d["evento_id"], [a["regra"] for a in d["alertas"]]) for d in docs] == [("a", ["STATUS_SUSPEITA"])]


def test_thresholds_strict(spark):
    df = spark.createDataFrame([event("a", 0, valor=5000.0, score=0.65)], EV_SCHEMA)
    assert rules.alert_documents(rules.evaluate(df)).count() == 0


def test_velocity_fixture(spark):
    secs = [0, 10, 59, 60, 60, 61]
    df = spark.createDataFrame([event(f"e{i}", s) for i, s in enumerate(secs)], EV_SCHEMA)
    got = [r["janela_n"] for r in trailing_count(df, "id_conta", "event_ts", "evento_id", 60)
           .orderBy("evento_id").collect()]
    assert got == [1, 2, 3, 3, 4, 5]


def test_velocity_alert_text(spark):
    df = spark.createDataFrame([event(f"e{i}", i) for i in range(7)], EV_SCHEMA)
    docs = {d["evento_id"]: d for d in rules.alert_documents(rules.evaluate(df)).collect()}
    assert set(docs) == {"e5", "e6"}
    assert docs["e6"]["alertas"][0]["descricao"] == "Conta 1 com 7 transações no último minuto"


def count_by(method, df, window, pieces=None):
    if method == "ranked":
        return ranked_trailing_count(df, "id_conta", "event_ts", "evento_id", window)
    return trailing_count(df, "id_conta", "event_ts", "evento_id", window, pieces=pieces)


@pytest.mark.parametrize("window, pieces, method", [(60, None, "bucketed"), (7, None, "bucketed"),
                                                    (60, 4, "bucketed"), (120, None, "bucketed"),
                                                    (30, 3, "bucketed"), (60, None, "ranked"), (7, None, "ranked")])
def test_velocity_hot_key_equals_brute_force(spark, window, pieces, method):
    """One account holding most events, across many time buckets, against an O(n^2) count."""
    import random
    rnd = random.Random(7)
    rows, t = [], 0.0
    for i in range(600):
        t += rnd.choice([0.0, 0.0, 0.5, 1.0, 3.0, 20.0])
        rows.append(event(f"{i:05d}", t, conta=1 if i % 3 else rnd.randint(2, 4)))
    df = spark.createDataFrame(rows, EV_SCHEMA)
    got = {r["evento_id"]: r["janela_n"] for r in
           count_by(method, df, window, pieces).collect()}
    w = timedelta(seconds=window)
    for r in rows:
        expect = sum(1 for o in rows if o[2] == r[2] and r[1] - w < o[1] <= r[1]
                     and (o[1] < r[1] or o[0] <= r[0]))
        assert got[r[0]] == expect, r[0]


def test_rule_names(spark):
    df = spark.createDataFrame([event("a", 0, valor=9000.0, status="suspeita", score=0.9)], EV_SCHEMA)
    ev = rules.evaluate(df)
    assert ev.select(rules.rule_names()).first()[0] == "SCORE_FRAUDE_ALTO | VALOR_SUSPEITO | STATUS_SUSPEITA"


@pytest.mark.parametrize("method", ["bucketed", "ranked"])
def test_velocity_repeated_ids(spark, method):
    """Repeated event ids at one instant: every row keeps one count; the counts form 1..n."""
    rows = [event("dup", 0) for _ in range(4)] + [event("x", 0), event("dup", 30), event("y", 61)]
    df = spark.createDataFrame(rows, EV_SCHEMA)
    out = count_by(method, df, 60).collect()
    assert len(out) == len(rows)
    at0 = sorted(r["janela_n"] for r in out if r["event_ts"] == T0)
    assert at0 == [1, 2, 3, 4, 5]
    by_id = {r["evento_id"]: r["janela_n"] for r in out if r["event_ts"] != T0}
    assert by_id == {"dup": 6, "y": 2}


@pytest.mark.parametrize("method, pieces", [("bucketed", None), ("bucketed", 4), ("ranked", None)])
def test_velocity_keeps_rows_without_time_id_or_key(spark, method, pieces):
    """An event without a time counts itself; one without an id or account is counted like any other."""
    rows = [event("a", 0), event("b", 10), event(None, 10), event("c", 20), event("d", 5, conta=None)]
    rows += [("n1", None, *rows[0][2:]), ("n2", None, *rows[0][2:])]
    out = count_by(method, spark.createDataFrame(rows, EV_SCHEMA), 60, pieces).collect()
    assert len(out) == len(rows)
    got = {(r["evento_id"], r["id_conta"]): r["janela_n"] for r in out}
    assert got["a", 1] == 1 and got["c", 1] == 4 and {got["b", 1], got[None, 1]} == {2, 3}
    assert got["d", None] == 1 and got["n1", 1] == 1 and got["n2", 1] == 1


def test_velocity_plan_runs_no_job_and_scans_once(spark):
    """Building the plan starts no job; a one-minute window reads its input once."""
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    tracker, group = spark.sparkContext.statusTracker(), "velocity-plan"
    spark.sparkContext.setJobGroup(group, "plan only")
    try:
        out = trailing_count(df, "user_id", "ts", "event_id", 60)
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
