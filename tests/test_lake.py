"""Lake layout: same-day overwrite, snapshot union, manifest and report runs."""

from datetime import datetime


from sentinela.plans import medallion
from sentinela.session import scratch_path
from sentinela.sources import lake, testdata

D1, D2 = datetime(2026, 6, 4, 10), datetime(2026, 6, 5, 10)
SF = "/root/testdata/sf0.001"


def test_same_day_rerun_replaces_only_that_day(spark):
    path = lake.layer_path(scratch_path(spark, "t-lake"), "bronze", "x")
    df = spark.range(10)
    lake.write_partitioned(df, path, D1)
    lake.write_partitioned(df, path, D2)
    lake.write_partitioned(spark.range(3), path, D2)
    counts = {(r["mes"], r["dia"]): r["count"] for r in lake.read_layer(spark, path).groupBy("mes", "dia").count().collect()}
    assert counts == {("06", "04"): 10, ("06", "05"): 3}
    assert lake.read_snapshots(spark, path, "all").count() == 13
    assert lake.read_snapshots(spark, path, "latest").count() == 3


def three_days(spark, days, n, fail_at=None):
    from pyspark.sql import functions as F
    ts = F.make_timestamp_ntz(F.lit(2026), F.lit(6), F.element_at(F.array(*[F.lit(d) for d in days]),
                                                                  (F.col("id") % len(days) + 1).cast("int")),
                              F.lit(1), F.lit(2), F.lit(3.0))
    df = spark.range(n).withColumn("ts", ts)
    return df if fail_at is None else df.filter(F.when(F.col("id") == fail_at, F.raise_error(F.lit("lost"))).otherwise(True))


def test_backfill_replaces_exactly_its_days_and_a_failed_one_nothing(spark):
    import pytest
    from pyspark.sql import functions as F
    path = lake.layer_path(scratch_path(spark, "t-backfill"), "silver", "x")
    count = lambda: {r["dia"]: r["count"] for r in lake.read_layer(spark, path).groupBy("dia").count().collect()}
    lake.write_days(three_days(spark, [1, 2, 3, 4, 5], 50), path, F.col("ts"))
    assert lake.write_days(three_days(spark, [2, 3, 4], 9), path, F.col("ts")) == [f"ano=2026/mes=06/dia=0{d}" for d in (2, 3, 4)]
    want = {"01": 10, "02": 3, "03": 3, "04": 3, "05": 10}
    assert count() == want
    for bad in (three_days(spark, [1, 2], 100, fail_at=99), three_days(spark, [1], 4).withColumn("ts", F.lit(None).cast("timestamp_ntz"))):
        with pytest.raises(Exception):
            lake.write_days(bad, path, F.col("ts"))
        assert count() == want
    with pytest.raises(Exception):
        lake.write_partitioned(three_days(spark, [1], 100, fail_at=99), path, datetime(2026, 6, 5))
    assert count() == want


def test_a_type_change_is_refused_and_nothing_is_written(spark):
    import pytest
    path = lake.layer_path(scratch_path(spark, "t-types"), "bronze", "x")
    lake.write_partitioned(spark.range(3).selectExpr("cast(id AS int) AS v"), path, D1)
    for write in (lambda df: lake.write_partitioned(df, path, D2),
                  lambda df: lake.write_days(df, path, df["v"].cast("timestamp_ntz"))):
        with pytest.raises(ValueError, match="column v"):
            write(spark.range(3).selectExpr("cast(id AS string) AS v"))
    assert [r["v"] for r in lake.read_snapshots(spark, path).orderBy("v").collect()] == [0, 1, 2]
    lake.write_partitioned(spark.range(2).selectExpr("cast(id AS int) AS v", "1 AS w"), path, D2)
    assert lake.read_snapshots(spark, path).count() == 5


def test_empty_rerun_replaces_the_day(spark):
    path = lake.layer_path(scratch_path(spark, "t-empty"), "bronze", "x")
    lake.write_partitioned(spark.range(5), path, D1)
    lake.write_partitioned(spark.range(7), path, D2)
    lake.write_partitioned(spark.range(0), path, D2)
    assert lake.read_snapshots(spark, path, "all").count() == 5
    assert lake.read_snapshots(spark, path, "latest").count() == 0


def test_latest_reads_one_folder_and_new_columns_are_kept(spark):
    path = lake.layer_path(scratch_path(spark, "t-latest"), "bronze", "x")
    lake.write_partitioned(spark.range(5), path, D1)
    lake.write_partitioned(spark.range(3).selectExpr("id", "'a' AS extra"), path, D2)
    latest = lake.read_snapshots(spark, path, "latest")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(ano" in plan
    assert latest.filter("extra = 'a'").count() == 3
    assert lake.read_snapshots(spark, path, "all").filter("extra IS NULL").count() == 5
    assert lake.newest_day(spark, path) == {"ano": "2026", "mes": "06", "dia": "05"}


def test_views_fail_on_a_broken_table(spark):
    """Only a table that was never written is left out; a broken one is an error."""
    import os

    import pytest
    root = scratch_path(spark, "t-broken")
    os.makedirs(f"{root.replace('file:', '')}/silver/contas/ano=x")
    with pytest.raises(Exception):
        medallion.register_views(spark, root)
    assert medallion.register_views(spark, f"{root}/nothing") == []


def test_medallion_runs(spark):
    root = scratch_path(spark, "t-medallion")
    src = lake.TableSource(lambda name: testdata.sources(spark, SF).as_dict()[name])
    manifest = medallion.run_bronze(spark, src, root, load_ts=D1)
    assert manifest["total_sucesso"] == 5 and manifest["total_erro"] == 0
    by = {r["tabela"]: r for r in manifest["tabelas"]}
    assert by["transacoes"]["linhas"] == 1000 and by["transacoes"]["colunas"] == 18
    assert by["transacoes"]["tamanho_mb"] > 0 and all(r["arquivo"].endswith("dia=04") for r in by.values())
    assert manifest["total_linhas"] == sum(r["linhas"] for r in by.values())
    assert by["categorias_transacao"]["linhas"] == 14 and by["clientes"]["colunas"] == 14
    report = {r["tabela"]: r for r in medallion.run_silver(spark, root, load_ts=D2)}
    assert report["transacoes"]["removidos"] == report["transacoes"]["total_original"] - report["transacoes"]["total_silver"]
    ins = medallion.run_gold(spark, root, load_ts=D2)
    assert len(ins["top_estados"]) == 3 and len(ins["melhor_dia"]) == 1
    views = medallion.register_views(spark, root)
    assert "gold_resumo_fraudes_por_estado" in views and "silver_transacoes" in views
    top = spark.sql("SELECT estado, pct_fraude FROM gold_resumo_fraudes_por_estado "
                    "ORDER BY pct_fraude DESC, estado LIMIT 3").collect()
    assert [r["estado"] for r in top] == [r["estado"] for r in ins["top_estados"]]


def test_failure_isolated_per_table(spark):
    root = scratch_path(spark, "t-fail")
    tables = testdata.sources(spark, SF).as_dict()

    def read(name):
        if name == "contas":
            raise RuntimeError("source down")
        return tables[name]

    manifest = medallion.run_bronze(spark, lake.TableSource(read), root, load_ts=D1)
    assert manifest["total_erro"] == 1 and manifest["total_sucesso"] == 4
    assert [r["erro"] for r in manifest["tabelas"] if r["status"] == "erro"] == ["source down"]


def test_silver_report_document_is_a_list(spark):
    import json
    import os
    root = scratch_path(spark, "t-report")
    src = lake.TableSource(lambda name: testdata.sources(spark, SF).as_dict()[name])
    medallion.run_bronze(spark, src, root, load_ts=D1)
    medallion.run_silver(spark, root, load_ts=D2)
    folder = f"{root.replace('file:', '')}/silver/_relatorio_qualidade_20260605_100000"
    part = [f for f in os.listdir(folder) if f.startswith("part-")][0]
    doc = json.loads(open(os.path.join(folder, part), encoding="utf-8").read())
    assert [r["tabela"] for r in doc] == lake.TABELAS


def test_sized_settings(spark):
    from sentinela.session import input_bytes, sized_settings
    n = input_bytes(spark, "/root/testdata/sf0.001")
    assert n > 0
    assert sized_settings(n)["spark.sql.shuffle.partitions"] == "8"
    big = sized_settings(100 << 40)
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (200 << 20)
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
