"""Increments: mergeable distinct counts, marts from stored partials, loads by a mark, replaced catalog tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sentinela.operators import distinct, marts
from sentinela.plans import incremental, tables
from sentinela.session import scratch_path
from sentinela.sources import folders, lake

D1, D2, D3 = datetime(2026, 6, 4, 10), datetime(2026, 6, 5, 10), datetime(2026, 6, 6, 10)


# ------------------------------------------------------------------ distinct counts

KEYS = [0, 1, -1, 32767, 32768, -32768, -32769, 2**63 - 1, -(2**63), None]


@pytest.mark.parametrize("kind", ["bigint", "string", "decimal(20,0)"])
def test_distinct_counts_equal_plain_ones(spark, kind):
    rows = [(g, k) for g in ("a", "b", None) for k in KEYS for _ in range(2) if not (g == "b" and k == 1)]
    df = spark.createDataFrame(rows + [("vazio", None)], "g string, k bigint").withColumn("k", F.col("k").cast(kind))
    got = {r["g"]: r["n"] for r in distinct.counts(distinct.partials(df, ["g"], "k"), ["g"], "n").collect()}
    assert got == {"a": 9, "b": 8, None: 9, "vazio": 0}


def test_distinct_of_merged_partials(spark):
    rows = spark.range(200_000).select((F.col("id") % 7).alias("dia"), (F.col("id") * 37 % 90_001).alias("k"))
    parts = distinct.partials(rows, ["dia"], "k")
    loads = [distinct.partials(rows.filter(c), ["dia"], "k") for c in ("k % 3 = 0", "k % 3 > 0")]
    week = {"semana": F.lit(1)}
    for p in (parts, loads[0].unionByName(loads[1])):
        assert distinct.counts(p, week, "n").first()["n"] == rows.select("k").distinct().count()
        per_day = {r["dia"]: r["n"] for r in distinct.counts(p, ["dia"], "n").collect()}
        assert per_day == {r["dia"]: r["n"] for r in rows.groupBy("dia").agg(F.count_distinct("k").alias("n")).collect()}


def test_hot_group_leaves_a_task_as_one_row_per_bucket(spark):
    df = spark.range(100_000).select(F.lit("quente").alias("g"), (F.col("id") % 40_000).alias("k"))
    parts = distinct.partials(df, ["g"], "k")
    assert parts.count() == 2                      # 40,000 keys lie in two buckets
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_bitmap_construct_agg" in plan


def test_sparse_sets_grow_with_the_keys(spark):
    """Many groups of few keys: a row of a word each, merged without a sort of 4 KB sets; the counts stay exact."""
    rows = [(g, k) for g in ("a", "b", None) for k in KEYS for _ in range(2)] + [("vazio", None)]
    df = spark.createDataFrame(rows, "g string, k bigint")
    parts = distinct.partials(df, ["g"], "k", sparse=True)
    assert {r["g"]: r["n"] for r in distinct.counts(parts, ["g"], "n").collect()} == {"a": 9, "b": 9, None: 9, "vazio": 0}
    assert distinct.counts(parts.unionByName(parts), {"t": F.lit(1)}, "n").first()["n"] == 9
    days = spark.range(20_000).select((F.col("id") % 500).alias("dia"), (F.col("id") * 911 % 1_000_003).alias("k"))
    parts = incremental.partials_of(days.select(F.timestamp_seconds(F.col("dia") * 86_400).cast("timestamp_ntz").alias("data_transacao"),
                                                F.col("k").alias("id_conta"), F.col("k").alias("id_transacao"), F.lit(1).cast("decimal(12,2)").alias("valor"),
                                                F.lit(0.5).alias("score_fraude"), F.lit(False).alias("is_fraude"),
                                                F.lit("aprovada").alias("status"), F.lit("web").alias("canal"),
                                                F.lit("pix").alias("tipo"), F.lit(False).alias("fora_horario_comercial")))[incremental.ACCOUNTS]
    assert sum(f.dataType.typeName() == "binary" for f in parts.schema) == 0 and parts.count() <= 20_000
    merged = distinct.merge(parts, {"mes": F.date_format("data", "yyyy-MM")})._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in merged and "HashAggregate" in merged


def test_distinct_of_no_rows(spark):
    for kind in ("bigint", "string"):
        df = spark.createDataFrame([], f"g string, k {kind}")
        assert distinct.counts(distinct.partials(df, ["g"], "k"), ["g"], "n").collect() == []


# ------------------------------------------------------------------ marts from partials

def facts(spark, rows):
    """(account, day of June, hour, value, score, fraud, status)."""
    base = [(i, a, Decimal(v) if v is not None else None, s, f, st, "web", datetime(2026, 6, d, h), h < 8)
            for i, (a, d, h, v, s, f, st) in enumerate(rows)]
    return spark.createDataFrame(base, "id_transacao bigint, id_conta bigint, valor decimal(12,2), score_fraude double, "
                                       "is_fraude boolean, status string, canal string, data_transacao timestamp_ntz, "
                                       "fora_horario_comercial boolean").withColumn("score_fraude", F.col("score_fraude").cast("decimal(7,5)"))


LOAD_1 = [(1, 1, 3, "10.00", 0.9, True, "suspeita"), (1, 1, 9, "20.50", 0.1, False, "aprovada"), (2, 2, 9, None, None, False, "negada")]
LOAD_2 = [(1, 1, 9, "7.25", 0.5, True, "aprovada"), (3, 2, 23, "1.00", 0.2, False, "cancelada"), (None, 2, 9, "3.00", 0.3, False, "aprovada")]
AGAIN = [(4, 3, 0, "99.99", 0.75, True, "suspeita")]


def dims(spark):
    contas = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 20)], "id_conta bigint, id_cliente bigint")
    clientes = spark.createDataFrame([(10, "Ana", "SP", 400), (20, "Rui", "RJ", None)],
                                     "id_cliente bigint, nome string, estado string, score_credito int")
    return contas, clientes


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def assert_equal_to_whole(spark, root, transacoes):
    contas, clientes = dims(spark)
    got = incremental.marts_of(incremental.read_partials(spark, root), contas, clientes)
    want = {"gold_resumo_fraudes_por_estado": marts.gold_fraude_estado(transacoes, contas, clientes),
            "gold_transacoes_por_hora": marts.gold_por_hora(transacoes),
            "gold_perfil_risco_cliente": marts.gold_perfil_risco(transacoes, contas, clientes),
            "gold_resumo_executivo_diario": marts.gold_diario(transacoes)}
    for name, df in want.items():
        assert got[name].columns == df.columns, name
        assert rows_of(got[name]) == rows_of(df), name


def test_only_new_and_changed_loads_are_read(spark):
    root = scratch_path(spark, "t-incremental")
    path = lake.layer_path(root, "silver", "transacoes")
    one, two, again = (facts(spark, r) for r in (LOAD_1, LOAD_2, AGAIN))
    lake.write_partitioned(one, path, D1)
    assert incremental.refresh(spark, root) == ["2026-06-04"]
    assert_equal_to_whole(spark, root, one)
    lake.write_partitioned(two, path, D2)
    assert incremental.refresh(spark, root) == ["2026-06-05"]
    assert_equal_to_whole(spark, root, one.unionByName(two))
    assert incremental.refresh(spark, root) == []
    lake.write_partitioned(again, path, D1)                       # the first date is loaded again
    assert incremental.refresh(spark, root) == ["2026-06-04"]
    assert_equal_to_whole(spark, root, again.unionByName(two))
    lake.write_partitioned(two.limit(0), path, D2)                # a rerun without rows
    assert incremental.refresh(spark, root) == ["2026-06-05"]
    assert_equal_to_whole(spark, root, again)
    folders.remove(spark, lake.day_folder(path, D2))              # a date that leaves the lake
    lake.write_partitioned(two, path, D3)
    assert incremental.refresh(spark, root) == ["2026-06-06"]
    assert_equal_to_whole(spark, root, again.unionByName(two))


def test_plan_of_a_load_reads_its_folder_alone(spark):
    root = scratch_path(spark, "t-incremental-plan")
    path = lake.layer_path(root, "silver", "transacoes")
    lake.write_partitioned(facts(spark, LOAD_1), path, D1)
    lake.write_partitioned(facts(spark, LOAD_2), path, D2)
    new = incremental.of_load(spark, root, "2026-06-05")
    for part in incremental.partials_of(new).values():
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "isnotnull(dia" in plan.split("PartitionFilters: [")[1]
    assert new.select(F.input_file_name()).distinct().filter(~F.col("input_file_name()").contains("dia=05")).count() == 0


def test_a_run_that_dies_leaves_its_date_pending(spark, monkeypatch):
    root = scratch_path(spark, "t-incremental-dies")
    one = facts(spark, LOAD_1)
    lake.write_partitioned(one, lake.layer_path(root, "silver", "transacoes"), D1)
    real, calls = lake.write_partitioned, []

    def dies(df, path, ts):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(df, path, ts)

    monkeypatch.setattr(lake, "write_partitioned", dies)
    with pytest.raises(RuntimeError):
        incremental.refresh(spark, root)
    monkeypatch.setattr(lake, "write_partitioned", real)
    assert incremental.pending(spark, root) == ["2026-06-04"]
    assert incremental.refresh(spark, root) == ["2026-06-04"]
    assert_equal_to_whole(spark, root, one)


# ------------------------------------------------------------------ loads by a mark

def source_to(spark, top, column="id"):
    df = spark.range(top).select("id", F.expr("timestamp_ntz'2026-01-01' + make_interval(0,0,0,0,0,0,id)").alias("quando"),
                                 F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") / 10).cast("int")).alias("data"))
    return lake.TableSource(lambda name: df)


def held(spark, path, column="id"):
    return {r["dia"]: sorted(r["v"]) for r in lake.read_layer(spark, path).groupBy("dia").agg(F.collect_list(column).alias("v")).collect()}


@pytest.mark.parametrize("mark", ["id", "quando"])
def test_three_loads_hold_every_row_once(spark, mark):
    path = lake.layer_path(scratch_path(spark, "t-marks"), "bronze", "x")
    lake.incremental_load(spark, source_to(spark, 10), "x", mark, path, D1)
    lake.incremental_load(spark, source_to(spark, 25), "x", mark, path, D2)
    lake.incremental_load(spark, source_to(spark, 27), "x", mark, path, D2)      # again on the same date
    last = lake.incremental_load(spark, source_to(spark, 40), "x", mark, path, D3)
    assert held(spark, path) == {"04": list(range(10)), "05": list(range(10, 27)), "06": list(range(27, 40))}
    assert not last["aberta"]
    with pytest.raises(ValueError, match="later than"):
        lake.incremental_load(spark, source_to(spark, 50), "x", mark, path, D1)


def test_no_new_rows_and_an_empty_source(spark):
    path = lake.layer_path(scratch_path(spark, "t-marks-empty"), "bronze", "x")
    assert lake.incremental_load(spark, source_to(spark, 0), "x", "id", path, D1)["ate"] is None
    assert lake.incremental_load(spark, source_to(spark, 4), "x", "id", path, D2) == {"de": None, "ate": "3", "aberta": False}
    assert lake.incremental_load(spark, source_to(spark, 4), "x", "id", path, D3) == {"de": "3", "ate": "3", "aberta": False}
    assert held(spark, path) == {"05": [0, 1, 2, 3]}


@pytest.mark.parametrize("written", [False, True])
def test_a_load_that_dies_is_done_by_the_next_date(spark, monkeypatch, written):
    path = lake.layer_path(scratch_path(spark, "t-marks-dies"), "bronze", "x")
    lake.incremental_load(spark, source_to(spark, 5), "x", "id", path, D1)
    real = lake.write_partitioned

    def dies(df, p, ts):
        if written:
            real(df, p, ts)
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "write_partitioned", dies)
    with pytest.raises(RuntimeError):
        lake.incremental_load(spark, source_to(spark, 8), "x", "id", path, D2)
    monkeypatch.setattr(lake, "write_partitioned", real)
    lake.incremental_load(spark, source_to(spark, 12), "x", "id", path, D3)
    assert held(spark, path) == {"04": list(range(5)), "06": list(range(5, 12))}


def test_rows_without_a_mark_are_refused(spark):
    path = lake.layer_path(scratch_path(spark, "t-marks-null"), "bronze", "x")
    source = lake.TableSource(lambda n: spark.createDataFrame([(1,), (None,)], "id int"))
    with pytest.raises(ValueError, match="have no id"):
        lake.incremental_load(spark, source, "x", "id", path, D1)


def test_the_slice_is_pushed_into_the_source(spark):
    path = scratch_path(spark, "t-marks-push")
    spark.range(100).write.parquet(path)
    plan = lake.slice_between(spark.read.parquet(path), "id", "10", "20")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,10)" in plan and "LessThanOrEqual(id,20)" in plan


# ------------------------------------------------------------------ catalog tables

def test_a_table_is_replaced_while_a_reader_holds_it(spark):
    root = scratch_path(spark, "t-tables")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_gold")
    tables.publish(spark.range(3), "m", root, "t_gold")
    reader = spark.table("t_gold.m")
    reader.count()
    tables.publish(spark.range(5), "m", root, "t_gold")
    assert reader.count() == 3 and sorted(r["id"] for r in reader.collect()) == [0, 1, 2]
    assert spark.sql("SELECT count(*) AS n FROM t_gold.m").first()["n"] == 5
    for n in (6, 7):
        tables.publish(spark.range(n), "m", root, "t_gold")
    assert len(tables.versions(spark, f"{root}/tabelas/t_gold/m")) == tables.KEEP + 1
    assert spark.table("t_gold.m").count() == 7


def test_a_failed_publication_leaves_the_table_and_new_columns_replace_it(spark):
    root = scratch_path(spark, "t-tables-fail")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_gold")
    tables.publish(spark.range(3), "f", root, "t_gold")
    with pytest.raises(Exception):
        tables.publish(spark.range(9).filter(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(True)), "f", root, "t_gold")
    assert spark.table("t_gold.f").count() == 3
    tables.publish(spark.range(2).selectExpr("id", "'a' AS nome"), "f", root, "t_gold")
    assert spark.table("t_gold.f").columns == ["id", "nome"] and spark.table("t_gold.f").count() == 2


def test_the_four_marts_as_tables(spark):
    root = scratch_path(spark, "t-tables-gold")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_marts")
    t, (contas, clientes) = facts(spark, LOAD_1 + LOAD_2), dims(spark)
    lake.write_partitioned(t, lake.layer_path(root, "silver", "transacoes"), D1)
    incremental.refresh(spark, root)
    built = incremental.marts_of(incremental.read_partials(spark, root), contas, clientes)
    for name in tables.publish_gold(built, root, "t_marts"):
        assert rows_of(spark.table(name)) == rows_of(built[name.split(".")[1]])
