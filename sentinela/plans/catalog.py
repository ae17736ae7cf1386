"""Registered queries: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the provided tables (through the Bronze mapping) over
their whole extent; the matching DuckDB statement lives in
:mod:`sentinela.oracle.queries` under the same key.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela import functions as fn
from sentinela.functions.numeric import dk_round, mean, pct, round_money
from sentinela.functions.timefn import coerce_timestamp, hour_of_day
from sentinela.operators import clean, distinct, marts, quality, rules
from sentinela.operators.selection import exact_median
from sentinela.operators.velocity import ranked_trailing_count, trailing_count
from sentinela.plans.layers import Layers
from sentinela.session import scratch_path
from sentinela.sources import lake, testdata

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ Gold marts

@register("gold_fraude_estado")
def q_gold_fraude_estado(spark, sf_dir):
    return Layers(spark, sf_dir).mart_estado()


@register("gold_por_hora")
def q_gold_por_hora(spark, sf_dir):
    return Layers(spark, sf_dir).mart_hora()


@register("gold_perfil_risco")
def q_gold_perfil_risco(spark, sf_dir):
    return Layers(spark, sf_dir).mart_risco()


@register("gold_diario")
def q_gold_diario(spark, sf_dir):
    return Layers(spark, sf_dir).mart_diario()


@register("gold_fraude_estado_multi")
def q_gold_fraude_estado_multi(spark, sf_dir):
    return Layers(spark, sf_dir, "orders").mart_estado()


@register("gold_perfil_risco_multi")
def q_gold_perfil_risco_multi(spark, sf_dir):
    return Layers(spark, sf_dir, "orders").mart_risco()


@register("gold_diario_multi")
def q_gold_diario_multi(spark, sf_dir):
    return Layers(spark, sf_dir, "orders").mart_diario()


@register("insight_top_estados")
def q_insight_top_estados(spark, sf_dir):
    return marts.insight_top_estados(Layers(spark, sf_dir).mart_estado())


@register("insight_hora_risco")
def q_insight_hora_risco(spark, sf_dir):
    return marts.insight_hora_risco(Layers(spark, sf_dir).mart_hora())


@register("insight_criticos")
def q_insight_criticos(spark, sf_dir):
    return marts.insight_criticos(Layers(spark, sf_dir).mart_risco())


@register("insight_melhor_dia")
def q_insight_melhor_dia(spark, sf_dir):
    return marts.insight_melhor_dia(Layers(spark, sf_dir).mart_diario())


# ------------------------------------------------------------------ helpers

def _bronze(spark, sf_dir, layout="events"):
    return Layers(spark, sf_dir, layout).bronze


def _silver(spark, sf_dir, layout="events"):
    return Layers(spark, sf_dir, layout).silver


def _joined_problems(df: DataFrame) -> DataFrame:
    """Quality rows with the problem list rendered as one ``" | "``-joined string."""
    return df.withColumn("problemas", F.array_join("problemas", " | "))


# ------------------------------------------------------------------ Silver cleaning

@register("clean_clientes")
def q_clean_clientes(spark, sf_dir):
    return _silver(spark, sf_dir)["clientes"]


@register("clean_transacoes")
def q_clean_transacoes(spark, sf_dir):
    return _silver(spark, sf_dir)["transacoes"]


@register("clean_contas")
def q_clean_contas(spark, sf_dir):
    return _silver(spark, sf_dir)["contas"]


@register("clean_generic")
def q_clean_generic(spark, sf_dir):
    return _silver(spark, sf_dir)["comerciantes"]


@register("bronze_audit")
def q_bronze_audit(spark, sf_dir):
    b = lake.add_audit_columns(_bronze(spark, sf_dir)["clientes"], "clientes")
    return b.drop("_ingestao_timestamp")


@register("scan_full_load")
def q_scan_full_load(spark, sf_dir):
    src = lake.TableSource(lambda name: _bronze(spark, sf_dir)[name])
    return lake.full_load(src, "transacoes").drop("_ingestao_timestamp")


@register("drop_audit")
def q_drop_audit(spark, sf_dir):
    return clean.drop_audit(lake.add_audit_columns(_bronze(spark, sf_dir)["contas"], "contas"))


@register("drop_invalid_dates")
def q_drop_invalid_dates(spark, sf_dir):
    t = _bronze(spark, sf_dir)["transacoes"]
    return t.filter(coerce_timestamp("data_transacao").isNull()).select("id_transacao", "data_transacao")


@register("apply_defaults")
def q_apply_defaults(spark, sf_dir):
    c = quality.apply_defaults(_bronze(spark, sf_dir)["contas"], "contas")
    return c.select("id_conta", "saldo", "limite", "ativa")


@register("apply_defaults_clientes")
def q_apply_defaults_clientes(spark, sf_dir):
    c = quality.apply_defaults(_bronze(spark, sf_dir)["clientes"], "clientes")
    return c.select("id_cliente", "ativo", F.col("data_cadastro").isNotNull().alias("com_cadastro"))


@register("apply_defaults_transacoes")
def q_apply_defaults_transacoes(spark, sf_dir):
    t = quality.apply_defaults(_bronze(spark, sf_dir)["transacoes"], "transacoes")
    return t.select("id_transacao", "is_fraude", F.col("data_transacao").isNotNull().alias("com_data"))


@register("silver_stamps")
def q_silver_stamps(spark, sf_dir):
    """Stamps of the cleaned tables: rows that carry the layer time and the quality flag."""
    b = _bronze(spark, sf_dir)
    parts = []
    for table in ("clientes", "contas", "transacoes"):
        df = clean.CLEANERS[table](b[table])
        flag = F.count_if(F.col("_qualidade_ok")) if "_qualidade_ok" in df.columns else F.lit(None).cast("bigint")
        parts.append(df.agg(F.lit(table).alias("tabela"), F.count(F.lit(1)).alias("linhas"),
                            F.count("_silver_timestamp").alias("com_carimbo"), flag.alias("qualidade_ok")))
    return lake.union_by_name(parts)


# ------------------------------------------------------------------ quality and audits

@register("quality_clientes")
def q_quality_clientes(spark, sf_dir):
    return _joined_problems(quality.quality_row("clientes", _bronze(spark, sf_dir)["clientes"]))


@register("quality_transacoes")
def q_quality_transacoes(spark, sf_dir):
    return _joined_problems(quality.quality_row("transacoes", _bronze(spark, sf_dir)["transacoes"]))


@register("quality_contas")
def q_quality_contas(spark, sf_dir):
    return _joined_problems(quality.quality_row("contas", _bronze(spark, sf_dir)["contas"]))


@register("quality_report")
def q_quality_report(spark, sf_dir):
    return _joined_problems(quality.quality_report(_bronze(spark, sf_dir)))


@register("audit_domains")
def q_audit_domains(spark, sf_dir):
    return quality.audit_domains(_silver(spark, sf_dir))


@register("audit_not_null")
def q_audit_not_null(spark, sf_dir):
    return quality.audit_not_null(_bronze(spark, sf_dir))


@register("audit_unique")
def q_audit_unique(spark, sf_dir):
    return quality.audit_unique(_silver(spark, sf_dir))


@register("audit_unique_multi")
def q_audit_unique_multi(spark, sf_dir):
    """Line-item transactions, whose ids repeat, beside accounts that are unique (Q5)."""
    s = _silver(spark, sf_dir, "orders")
    return quality.audit_unique({t: s[t] for t in ("contas", "transacoes")})


@register("audit_fk_orphans")
def q_audit_fk_orphans(spark, sf_dir):
    return quality.audit_fk_orphans(_silver(spark, sf_dir))


# ------------------------------------------------------------------ scalar functions

@register("str_strip")
def q_str_strip(spark, sf_dir):
    c = _bronze(spark, sf_dir)["clientes"]
    return c.select("id_cliente", F.col("nome").alias("nome_bruto"), fn.strip("nome").alias("nome"))


@register("str_title")
def q_str_title(spark, sf_dir):
    c = _bronze(spark, sf_dir)["clientes"]
    return c.select("id_cliente", fn.title_case(fn.strip("nome")).alias("nome"),
                    fn.title_case(fn.strip("cidade")).alias("cidade"))


@register("str_case")
def q_str_case(spark, sf_dir):
    c = _bronze(spark, sf_dir)["clientes"]
    return c.select("id_cliente", F.lower(fn.strip("email")).alias("email"),
                    fn.strip(F.upper("estado")).alias("estado"))


@register("str_cpf_digits")
def q_str_cpf_digits(spark, sf_dir):
    c = _bronze(spark, sf_dir)["clientes"]
    return c.select("id_cliente", F.col("cpf").alias("cpf_bruto"), fn.digits_only("cpf").alias("cpf"),
                    fn.cpf_invalid(fn.digits_only("cpf")).alias("cpf_invalido"))


@register("null_fill")
def q_null_fill(spark, sf_dir):
    return _silver(spark, sf_dir)["contas"].select("id_conta", "saldo")


@register("median_fill")
def q_median_fill(spark, sf_dir):
    return _silver(spark, sf_dir)["clientes"].select("id_cliente", "score_credito")


@register("agg_median")
def q_agg_median(spark, sf_dir):
    """Exact median by distributed selection (A10)."""
    c = _bronze(spark, sf_dir)["clientes"]
    return spark.createDataFrame([(exact_median(c, "score_credito"),)], "mediana_score double")


@register("median_valor")
def q_median_valor(spark, sf_dir):
    """Exact median of the line items' values: many different values (A10)."""
    t = _bronze(spark, sf_dir, "orders")["transacoes"]
    return spark.createDataFrame([(exact_median(t, "valor"),)], "mediana_valor double")


@register("ts_coerce")
def q_ts_coerce(spark, sf_dir):
    t = _bronze(spark, sf_dir)["transacoes"]
    return t.select("id_transacao", F.col("data_transacao").alias("texto"),
                    coerce_timestamp("data_transacao").alias("data_transacao"))


@register("math_abs")
def q_math_abs(spark, sf_dir):
    t = _bronze(spark, sf_dir)["transacoes"]
    return t.select("id_transacao", F.col("valor").alias("valor_bruto"), F.abs("valor").alias("valor"))


@register("faixa_valor")
def q_faixa_valor(spark, sf_dir):
    parts = [_silver(spark, sf_dir, layout)["transacoes"]
             .select(F.lit(layout).alias("layout"), "id_transacao", "valor", "faixa_valor")
             for layout in ("events", "orders")]
    return parts[0].unionByName(parts[1])


@register("fora_horario")
def q_fora_horario(spark, sf_dir):
    t = _silver(spark, sf_dir)["transacoes"]
    return t.select("id_transacao", hour_of_day("data_transacao").alias("hora"),
                    fn.fora_horario("data_transacao").alias("fora_horario_comercial"))


@register("dk_round")
def q_dk_round(spark, sf_dir):
    ev = testdata.read_table(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select("event_id", fn.dk_round(v / 7, 2).alias("r2"), fn.dk_round(v / 7, 4).alias("r4"),
                     fn.dk_round(v * 1.005, 0).alias("r0"), fn.dk_round(-v / 3, 1).alias("rneg"))


@register("partition_cols")
def q_partition_cols(spark, sf_dir):
    t = _silver(spark, sf_dir)["transacoes"]
    return t.select("id_transacao", *lake.partition_columns(F.col("data_transacao")))


@register("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    ev = rules.events_from_silver(_silver(spark, sf_dir)["transacoes"])
    cols = ["evento_id", "id_conta", "valor", "tipo", "status", "score_fraude"]
    as_json = ev.select(F.to_json(F.struct(*cols)).alias("value"))
    schema = "evento_id string, id_conta bigint, valor double, tipo string, status string, score_fraude double"
    return as_json.select(F.from_json("value", schema).alias("e")).select("e.*")


# ------------------------------------------------------------------ aggregates

@register("agg_count")
def q_agg_count(spark, sf_dir):
    t = _silver(spark, sf_dir)["transacoes"]
    return t.agg(F.count(F.lit(1)).alias("linhas"), F.count("id_comerciante").alias("com_comerciante"))


@register("count_fraudes")
def q_count_fraudes(spark, sf_dir):
    t = _silver(spark, sf_dir)["transacoes"]
    return t.filter("is_fraude").agg(F.count(F.lit(1)).alias("fraudes"))


@register("agg_basic")
def q_agg_basic(spark, sf_dir):
    t = _silver(spark, sf_dir)["transacoes"]
    g = t.groupBy("tipo").agg(F.sum("valor").alias("s"), F.count("valor").alias("n"), F.max("valor").alias("mx"))
    return g.select("tipo", round_money("s").alias("soma"), dk_round(mean(F.col("s"), F.col("n")), 2).alias("media"),
                    round_money("mx").alias("maximo"))


@register("agg_conditional")
def q_agg_conditional(spark, sf_dir):
    t = _silver(spark, sf_dir)["transacoes"]
    return t.groupBy("canal").agg(
        F.count_if("is_fraude").cast("bigint").alias("fraudes"),
        round_money(F.sum(F.when(F.col("is_fraude"), F.col("valor")).otherwise(F.lit(0)))).alias("valor_fraudes"))


@register("agg_distinct")
def q_agg_distinct(spark, sf_dir):
    t = _silver(spark, sf_dir)["transacoes"]
    return t.groupBy("status").agg(F.count(F.lit(1)).alias("linhas"),
                                   F.count_distinct("id_conta").cast("bigint").alias("contas"))


@register("agg_ratio")
def q_agg_ratio(spark, sf_dir):
    t = _silver(spark, sf_dir)["transacoes"]
    g = t.groupBy("tipo").agg(F.count_if("is_fraude").alias("f"), F.count(F.lit(1)).alias("n"))
    return g.select("tipo", pct(F.col("f"), F.col("n"), 2).alias("pct2"), pct(F.col("f"), F.col("n"), 4).alias("pct4"))


@register("risk_score")
def q_risk_score(spark, sf_dir):
    return Layers(spark, sf_dir).mart_risco().select("id_cliente", "score_risco_composto")


@register("risk_class")
def q_risk_class(spark, sf_dir):
    return Layers(spark, sf_dir).mart_risco().select("id_cliente", "classificacao_risco")


@register("vw_transacoes_completa")
def q_vw_transacoes_completa(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return marts.vw_transacoes_completa(s["transacoes"], s["contas"], s["clientes"],
                                        s["categorias_transacao"], s["comerciantes"])


# ------------------------------------------------------------------ fraud rules (batch)

def _events(spark, sf_dir, layout="events"):
    return rules.events_from_silver(_silver(spark, sf_dir, layout)["transacoes"])


@register("rule_score")
def q_rule_score(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.filter(rules.score_alto()).select("evento_id", "score_fraude",
                                                rules.score_text(F.col("score_fraude")).alias("descricao"))


@register("rule_valor")
def q_rule_valor(spark, sf_dir):
    ev = _events(spark, sf_dir, "orders")
    return ev.filter(rules.valor_suspeito()).select("evento_id", "valor",
                                                    rules.valor_text(F.col("valor")).alias("descricao"))


@register("rule_status")
def q_rule_status(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.filter(rules.status_suspeita()).select("evento_id", "status")


@register("filter_suspeitas")
def q_filter_suspeitas(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.filter(rules.score_alto() | rules.valor_suspeito()).select("evento_id", "valor", "score_fraude")


@register("rule_descriptions")
def q_rule_descriptions(spark, sf_dir):
    ev = _events(spark, sf_dir, "orders")
    return ev.select("evento_id", rules.score_text(F.col("score_fraude")).alias("texto_score"),
                     rules.valor_text(F.col("valor")).alias("texto_valor"))


@register("velocity_trailing")
def q_velocity_trailing(spark, sf_dir):
    ev = _events(spark, sf_dir)
    out = trailing_count(ev, "descricao", "event_ts", "evento_id", 3600)
    return out.select("evento_id", F.col("descricao").alias("chave"), "janela_n")


@register("rule_velocity")
def q_rule_velocity(spark, sf_dir):
    ev = _events(spark, sf_dir)
    out = trailing_count(ev, "id_conta", "event_ts", "evento_id", rules.JANELA_SEGUNDOS)
    return out.select("evento_id", "id_conta", "janela_n", rules.velocity().alias("alerta"))


@register("alert_documents")
def q_alert_documents(spark, sf_dir):
    return rules.flatten_alerts(rules.batch_alerts(_silver(spark, sf_dir)))


@register("rule_names")
def q_rule_names(spark, sf_dir):
    docs = rules.batch_alerts(_silver(spark, sf_dir))
    return docs.select("evento_id", rules.rule_names().alias("regras"))


@register("alert_event_nested")
def q_alert_event_nested(spark, sf_dir):
    """The event embedded in each alert document, as published."""
    docs = rules.batch_alerts(_silver(spark, sf_dir))
    return docs.select("transacao.*", F.size("alertas").cast("bigint").alias("n_alertas"))


@register("alert_velocity_by_type")
def q_alert_velocity_by_type(spark, sf_dir):
    """All four rules with the velocity key set to the event type over one hour."""
    return rules.flatten_alerts(rules.batch_alerts(_silver(spark, sf_dir), key="descricao", window_seconds=3600))


# ------------------------------------------------------------------ lake I/O (writes below the shared folder)

DAY1 = datetime(2026, 6, 4, 21, 1, 22)
DAY2 = datetime(2026, 6, 5, 15, 57, 22)
DAY3 = datetime(2026, 6, 6, 9, 0, 0)


@register("write_read_roundtrip")
def q_write_read_roundtrip(spark, sf_dir):
    """Same-day rerun replaces its partition, another day is kept (K2)."""
    path = lake.layer_path(scratch_path(spark, "roundtrip"), "silver", "transacoes")
    t = _silver(spark, sf_dir)["transacoes"]
    lake.write_partitioned(t.withColumn("_versao", F.lit(1)), path, DAY1)
    lake.write_partitioned(t.withColumn("_versao", F.lit(2)), path, DAY1)  # rerun: replaces
    lake.write_partitioned(t.withColumn("_versao", F.lit(2)), path, DAY2)
    back = lake.read_layer(spark, path)
    return back.groupBy("ano", "mes", "dia", "_versao").agg(F.count(F.lit(1)).alias("linhas"),
                                                             round_money(F.sum("valor")).alias("valor_total"))


@register("backfill_days")
def q_backfill_days(spark, sf_dir):
    """Several dates in one write: the weekend days are loaded again and exactly these are replaced (K2)."""
    path = lake.layer_path(scratch_path(spark, "backfill"), "silver", "transacoes")
    t = _silver(spark, sf_dir)["transacoes"]
    lake.write_days(t.withColumn("_versao", F.lit(1)), path, F.col("data_transacao"))
    weekend = t.filter(F.dayofweek("data_transacao").isin(1, 7))
    lake.write_days(weekend.withColumn("_versao", F.lit(2)), path, F.col("data_transacao"))
    return lake.read_layer(spark, path).groupBy("ano", "mes", "dia", "_versao").agg(
        F.count(F.lit(1)).alias("linhas"), round_money(F.sum("valor")).alias("valor_total"))


# ------------------------------------------------------------------ loads by increments

def _two_loads(spark, sf_dir, layout):
    """Partials after two loads, the first half of each month and then the rest; refreshed after each."""
    from sentinela.plans import incremental
    root, t = scratch_path(spark, "incremental"), _silver(spark, sf_dir, layout)["transacoes"]
    path = lake.layer_path(root, "silver", "transacoes")
    for day, rows in ((DAY1, F.dayofmonth("data_transacao") <= 15), (DAY2, F.dayofmonth("data_transacao") > 15)):
        lake.write_partitioned(t.filter(rows), path, day)
        incremental.refresh(spark, root)
    s = _silver(spark, sf_dir, layout)
    return incremental.marts_of(incremental.read_partials(spark, root), s["contas"], s["clientes"])


@register("incremental_estado")
def q_incremental_estado(spark, sf_dir):
    """Fraud by state from stored partials of two loads (A1)."""
    return _two_loads(spark, sf_dir, "events")["gold_resumo_fraudes_por_estado"]


@register("incremental_hora")
def q_incremental_hora(spark, sf_dir):
    """Activity per hour from stored partials of two loads, accounts by merged bit sets (A2)."""
    return _two_loads(spark, sf_dir, "events")["gold_transacoes_por_hora"]


@register("incremental_risco_multi")
def q_incremental_risco_multi(spark, sf_dir):
    """Risk profile from stored partials of two loads of line items (A3)."""
    return _two_loads(spark, sf_dir, "orders")["gold_perfil_risco_cliente"]


@register("incremental_diario_multi")
def q_incremental_diario_multi(spark, sf_dir):
    """Daily KPIs from stored partials of two loads of line items (A4)."""
    return _two_loads(spark, sf_dir, "orders")["gold_resumo_executivo_diario"]


@register("distinct_monthly")
def q_distinct_monthly(spark, sf_dir):
    """Accounts and kinds of transaction per month: day partials are written and merged, the rows not read again."""
    root, t = scratch_path(spark, "distinct"), _silver(spark, sf_dir, "orders")["transacoes"]
    day = {"data": F.to_date("data_transacao")}
    stored = {}
    for name, key in (("contas", "id_conta"), ("tipos", "tipo")):
        path = f"{root}/{name}"
        distinct.partials(t, day, key, sparse=True).write.parquet(path)
        stored[name] = spark.read.parquet(path)
    month = {"mes": F.date_format("data", "yyyy-MM")}
    return (distinct.counts(stored["contas"], month, "contas")
            .join(distinct.counts(stored["tipos"], month, "tipos"), "mes"))


@register("incremental_load")
def q_incremental_load(spark, sf_dir):
    """Three loads of a growing source by its high-water mark, the second one run twice; every row once."""
    path = lake.layer_path(scratch_path(spark, "marcas"), "bronze", "transacoes")
    t = _bronze(spark, sf_dir)["transacoes"]
    ends = t.agg(F.min("id_transacao"), F.max("id_transacao")).first()
    cut = lambda part: ends[0] + (ends[1] - ends[0]) * part // 4
    for day, part in ((DAY1, 1), (DAY2, 2), (DAY2, 3), (DAY3, 4)):
        source = lake.TableSource(lambda name, p=part: t.filter(F.col("id_transacao") <= cut(p)))
        lake.incremental_load(spark, source, "transacoes", "id_transacao", path, day)
    back = lake.read_layer(spark, path)
    return back.select(*t.columns, "dia")


@register("gold_tables")
def q_gold_tables(spark, sf_dir):
    """The daily mart as a catalog table that was published twice, read through SQL (K3)."""
    from sentinela.plans import tables
    root, layers = scratch_path(spark, "tabelas"), Layers(spark, sf_dir)
    spark.sql("CREATE DATABASE IF NOT EXISTS sentinela_gold")
    for _ in range(2):
        tables.publish(marts.ordered("gold_resumo_executivo_diario", layers.mart_diario()),
                       "gold_resumo_executivo_diario", root, "sentinela_gold")
    return spark.sql("SELECT * FROM sentinela_gold.gold_resumo_executivo_diario")


@register("union_snapshots")
def q_union_snapshots(spark, sf_dir):
    """Every load date of a table, by column name, duplicates kept."""
    path = lake.layer_path(scratch_path(spark, "snapshots"), "bronze", "clientes")
    b = _bronze(spark, sf_dir)["clientes"]
    lake.write_partitioned(b, path, DAY1)
    lake.write_partitioned(b.withColumn("_lote", F.lit(2)), path, DAY2)
    return lake.read_snapshots(spark, path, "all")


@register("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    """Only the newest load date (partition-pruned read)."""
    path = lake.layer_path(scratch_path(spark, "snapshots"), "bronze", "contas")
    b = _bronze(spark, sf_dir)["contas"]
    lake.write_partitioned(b.withColumn("_lote", F.lit(1)), path, DAY1)
    lake.write_partitioned(b.withColumn("_lote", F.lit(2)), path, DAY2)
    return lake.read_snapshots(spark, path, "latest")


def _medallion_root(spark, sf_dir):
    from sentinela.plans import medallion
    root = scratch_path(spark, "lake")
    src = lake.TableSource(lambda name: _bronze(spark, sf_dir)[name])
    manifest = medallion.run_bronze(spark, src, root, load_ts=DAY1)
    return medallion, root, manifest


@register("ingest_manifest")
def q_ingest_manifest(spark, sf_dir):
    """Load manifest rows of a Bronze run, row counts observed during the writes (K5)."""
    _, _, manifest = _medallion_root(spark, sf_dir)
    rows = lake.manifest_rows(spark, manifest["tabelas"])
    return rows.select("tabela", "linhas", "colunas", "status")


@register("manifest_files")
def q_manifest_files(spark, sf_dir):
    """Size and place of each table's written folder as the manifest states them (K5)."""
    _, _, manifest = _medallion_root(spark, sf_dir)
    rows = lake.manifest_rows(spark, manifest["tabelas"])
    return rows.select("tabela", (F.col("tamanho_mb") >= 0).alias("com_tamanho"),
                       F.element_at(F.split("arquivo", "/bronze/"), -1).alias("pasta"), "erro")


@register("sql_views")
def q_sql_views(spark, sf_dir):
    """Spark SQL over the lake's views, the mart in its presentation order."""
    medallion, root, _ = _medallion_root(spark, sf_dir)
    medallion.run_silver(spark, root, load_ts=DAY2)
    medallion.run_gold(spark, root, load_ts=DAY2)
    medallion.register_views(spark, root)
    return spark.sql("""
        SELECT estado, pct_fraude, row_number() OVER (ORDER BY pct_fraude DESC, estado) AS posicao,
               (SELECT count(*) FROM silver_transacoes) AS transacoes
        FROM gold_resumo_fraudes_por_estado""")


@register("ingest_totals")
def q_ingest_totals(spark, sf_dir):
    """Manifest roll-up: tables, successes, errors, rows."""
    _, _, manifest = _medallion_root(spark, sf_dir)
    return lake.manifest_totals(lake.manifest_rows(spark, manifest["tabelas"]))


@register("silver_run_report")
def q_silver_run_report(spark, sf_dir):
    """Quality report of a Silver run over the Bronze lake, metrics observed in the writes (K7)."""
    medallion, root, _ = _medallion_root(spark, sf_dir)
    report = medallion.run_silver(spark, root, load_ts=DAY2)
    return _joined_problems(spark.createDataFrame(report, quality.REPORT_SCHEMA))


@register("gold_export")
def q_gold_export(spark, sf_dir):
    """Marts exported with ``_gold_timestamp`` and read back from Parquet (K3, K4)."""
    medallion, root, _ = _medallion_root(spark, sf_dir)
    medallion.run_silver(spark, root, load_ts=DAY2)
    medallion.run_gold(spark, root, load_ts=DAY2)
    parts = []
    for name in medallion.GOLD_TABLES:
        back = lake.read_snapshots(spark, lake.layer_path(root, "gold", name), "latest")
        parts.append(back.agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("linhas"),
                              F.count("_gold_timestamp").alias("com_timestamp"),
                              F.lit(len(back.columns)).cast("bigint").alias("colunas")))
    return lake.union_by_name(parts)


@register("gold_export_estado")
def q_gold_export_estado(spark, sf_dir):
    """Mart 1 as read back from the exported Gold Parquet."""
    medallion, root, _ = _medallion_root(spark, sf_dir)
    medallion.run_silver(spark, root, load_ts=DAY2)
    medallion.run_gold(spark, root, load_ts=DAY2)
    back = lake.read_snapshots(spark, lake.layer_path(root, "gold", "gold_resumo_fraudes_por_estado"), "latest")
    return back.drop("_gold_timestamp")


# ------------------------------------------------------------------ streaming (file source replaying the tables)

def _replay(spark, sf_dir, slices=4):
    from sentinela.streaming import events as sev
    root = scratch_path(spark, "stream")
    sev.write_event_files(sev.events_from_tables(_silver(spark, sf_dir)), f"{root}/in", slices)
    return root


@register("stream_parse_events")
def q_stream_parse_events(spark, sf_dir):
    """JSON event stream decoded with a fixed schema."""
    from sentinela.streaming import events as sev
    root = _replay(spark, sf_dir)
    parsed = sev.parse_events(sev.text_source(spark, f"{root}/in"))
    q = (parsed.writeStream.format("parquet").option("checkpointLocation", f"{root}/chk_parse")
         .trigger(availableNow=True).start(f"{root}/parsed"))
    q.awaitTermination()
    return spark.read.parquet(f"{root}/parsed")


@register("keyed_json_records")
def q_keyed_json_records(spark, sf_dir):
    """Key/value records for a keyed topic: key = account, value = event JSON (K9)."""
    from sentinela.streaming import events as sev
    rec = sev.keyed_records(sev.events_from_tables(_silver(spark, sf_dir)))
    return rec.select("key", F.from_json("value", sev.EVENT_SCHEMA).alias("v")).select("key", "v.*")


def _run_stream(spark, sf_dir, layout="events", slices=2, order=None, drain=False, parts=(), **options):
    """Replay the tables slice by slice; each slice is one ``availableNow`` run.

    Every run after the first restarts the queries from their checkpoints, so the
    keyed state is read back between slices. ``order`` is the order in which
    the slices arrive.
    """
    from sentinela.streaming import alerts as sal
    from sentinela.streaming import events as sev
    root = scratch_path(spark, "stream")
    sliced = sev.stage_slices(sev.events_from_tables(_silver(spark, sf_dir, layout)), f"{root}/staged", slices)
    run = lambda: sal.run_available(sev.text_source(spark, f"{root}/in"), f"{root}/out", f"{root}/chk", parts, **options)
    for s in order or range(slices):
        sev.write_slice(sliced, f"{root}/in", s)
        run()
    if drain:
        sev.write_end(spark, f"{root}/in", sal.END_ID)
        run()
    return sal, root


@register("stream_alerts")
def q_stream_alerts(spark, sf_dir):
    """Alert documents of the streaming detector, velocity in keyed state, JSON file sink."""
    sal, root = _run_stream(spark, sf_dir, parts=("alertas",))
    return rules.flatten_alerts(sal.read_alerts(spark, f"{root}/out"))


@register("alert_rate")
def q_alert_rate(spark, sf_dir):
    """Processed / alerted counters of a streaming aggregation, read from its state after two restarts."""
    sal, root = _run_stream(spark, sf_dir, slices=3, parts=("contadores",))
    return sal.alert_rate(spark, f"{root}/chk")


@register("stream_velocity")
def q_stream_velocity(spark, sf_dir):
    """Trailing count of every line item, from a stream whose slices arrive out of time order."""
    # The delay covers a slice (a third of the period), so each run releases a part of what waits.
    sal, root = _run_stream(spark, sf_dir, "orders", 3, (1, 0, 2), drain=True, mode="event_time",
                            delay_seconds=3 * 366 * 86_400)
    return sal.read_evaluated(spark, f"{root}/out").select(
        "evento_id", "id_conta", "janela_n", rules.velocity().alias("alerta"))


@register("stream_alerts_multi")
def q_stream_alerts_multi(spark, sf_dir):
    """Alerts of the stream over line items, where the value and velocity rules fire as well."""
    sal, root = _run_stream(spark, sf_dir, "orders", parts=("alertas",))
    return rules.flatten_alerts(sal.read_alerts(spark, f"{root}/out"))


@register("velocity_ranked")
def q_velocity_ranked(spark, sf_dir):
    """``velocity_trailing`` through the distributed-rank plan used for bursts."""
    ev = _events(spark, sf_dir)
    out = ranked_trailing_count(ev, "descricao", "event_ts", "evento_id", 3600)
    return out.select("evento_id", F.col("descricao").alias("chave"), "janela_n")


@register("rule_velocity_multi")
def q_rule_velocity_multi(spark, sf_dir):
    """Velocity per account (order) over 60 s on line items: many events share one instant."""
    ev = _events(spark, sf_dir, "orders")
    out = trailing_count(ev, "id_conta", "event_ts", "evento_id", rules.JANELA_SEGUNDOS)
    return out.select("evento_id", "id_conta", "janela_n", rules.velocity().alias("alerta"))
