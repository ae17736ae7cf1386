"""Gold marts (A1–A4), the denormalised view (J3) and top-k insights.

Plan shape for the customer-keyed marts (fraud by state, risk profile):
the fact table is first reduced to one row per account with additive
partials (counts, exact decimal sums, max). Spark runs that ``groupBy`` with a
map-side partial aggregate, so even an account holding a third of all
transactions leaves each task as a single row. Only these per-account rows
are joined to accounts and customers and re-aggregated. The raw fact table is
never shuffled for a join, and because every partial is additive (sums of
``decimal``, counts, max) the results equal a join-then-aggregate plan
exactly, including join multiplicities.

Money stays ``decimal`` until the final projection, so totals do not depend
on partitioning; means and percentages are computed in double from exact
sums and counts and rounded with :func:`dk_round`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.functions.numeric import dk_round, mean, pct, round_money
from sentinela.functions.timefn import hour_of_day
from sentinela.operators.joins import left_lookup

# Risk classes by mean fraud score (strict, first match wins).
RISK_CLASSES = [(0.7, "CRITICO"), (0.4, "ALTO"), (0.2, "MEDIO")]
RISK_DEFAULT = "BAIXO"
# Composite score weights: mean score x 40 + frauds x 5 + off-hours x 0.5.
W_SCORE, W_FRAUD, W_OFFHOURS = 40, 5, 0.5


def account_partials(transacoes: DataFrame) -> DataFrame:
    """One row per account with additive partial aggregates."""
    t = transacoes
    return t.groupBy("id_conta").agg(
        F.count("id_transacao").alias("n"),
        F.count_if(F.col("is_fraude")).alias("n_fraude"),
        F.sum("valor").alias("s_valor"),
        F.count("valor").alias("n_valor"),
        F.sum(F.when(F.col("is_fraude"), F.col("valor")).otherwise(F.lit(0))).alias("s_valor_fraude"),
        F.sum("score_fraude").alias("s_score"),
        F.count("score_fraude").alias("n_score"),
        F.max("valor").alias("max_valor"),
        F.count_if(F.col("fora_horario_comercial")).alias("n_fora"),
    )


def merge_account_partials(parts: DataFrame) -> DataFrame:
    """One row per account from the partials of several loads."""
    additive = ["n", "n_fraude", "s_valor", "n_valor", "s_valor_fraude", "s_score", "n_score", "n_fora"]
    return parts.groupBy("id_conta").agg(*[F.sum(c).alias(c) for c in additive], F.max("max_valor").alias("max_valor"))


def _rollup(extra=()) -> list:
    s = F.sum
    return [s("n").alias("n"), s("n_fraude").alias("n_fraude"), s("s_valor").alias("s_valor"),
            s("n_valor").alias("n_valor"), s("s_valor_fraude").alias("s_valor_fraude"),
            s("s_score").alias("s_score"), s("n_score").alias("n_score"), *extra]


def gold_fraude_estado(transacoes: DataFrame, contas: DataFrame, clientes: DataFrame) -> DataFrame:
    """Mart 1: fraud summary per customer state (inner joins fact->account->customer)."""
    return estado_from_accounts(account_partials(transacoes), contas, clientes)


def estado_from_accounts(per_account: DataFrame, contas: DataFrame, clientes: DataFrame) -> DataFrame:
    """Mart 1 from account partials."""
    joined = (per_account
              .join(contas.select("id_conta", "id_cliente"), "id_conta")
              .join(clientes.select("id_cliente", "estado"), "id_cliente"))
    g = joined.groupBy("estado").agg(*_rollup())
    c = F.col
    return g.select(
        "estado",
        c("n").cast("bigint").alias("total_transacoes"),
        c("n_fraude").cast("bigint").alias("total_fraudes"),
        pct(c("n_fraude"), c("n"), 2).alias("pct_fraude"),
        round_money(c("s_valor")).alias("valor_total"),
        round_money(c("s_valor_fraude")).alias("valor_fraudes"),
        dk_round(mean(c("s_score"), c("n_score")), 4).alias("score_fraude_medio"),
        dk_round(mean(c("s_valor"), c("n_valor")), 2).alias("ticket_medio"),
    )


def gold_por_hora(transacoes: DataFrame) -> DataFrame:
    """Mart 2: activity per hour of day (only hours that occur)."""
    return hora_from_groups(per_account_then(transacoes, hour_of_day("data_transacao"), "hora_dia",
                                             {"n_fraude": F.col("is_fraude")}))


def hora_from_groups(g: DataFrame) -> DataFrame:
    """Mart 2 from measures per hour."""
    c = F.col
    return g.select(
        "hora_dia",
        c("n").cast("bigint").alias("total_transacoes"),
        c("n_fraude").cast("bigint").alias("total_fraudes"),
        dk_round(mean(c("s_valor"), c("n_valor")), 2).alias("ticket_medio"),
        round_money(c("s_valor")).alias("volume_total"),
        pct(c("n_fraude"), c("n"), 2).alias("pct_fraude"),
        c("contas_ativas").cast("bigint").alias("contas_ativas"),
    )


def per_account_then(transacoes: DataFrame, key: Column, name: str, counts: dict[str, Column]) -> DataFrame:
    """Additive measures and the exact number of accounts per group, from one scan of the fact.

    The fact is reduced to one row per (group, account) with a map-side partial
    aggregate, then to one row per group; the accounts of a group are its rows.
    """
    first = transacoes.groupBy(key.alias(name), "id_conta").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valor").alias("s_valor"), F.count("valor").alias("n_valor"),
        *[F.count_if(cond).alias(k) for k, cond in counts.items()])
    return first.groupBy(name).agg(
        *[F.sum(k).alias(k) for k in ("n", "s_valor", "n_valor", *counts)], F.count("id_conta").alias("contas_ativas"))


def risk_score(mean_score, n_fraude, n_fora):
    """Composite risk score (A3a); unbounded above despite its 0–100 label."""
    return dk_round(mean_score * W_SCORE + n_fraude * W_FRAUD + n_fora * W_OFFHOURS, 2)


def risk_class(mean_score):
    """Risk class from the mean fraud score (A3b); NULL mean -> BAIXO."""
    expr = None
    for bound, label in RISK_CLASSES:
        expr = F.when(mean_score > bound, label) if expr is None else expr.when(mean_score > bound, label)
    return expr.otherwise(RISK_DEFAULT)


def gold_perfil_risco(transacoes: DataFrame, contas: DataFrame, clientes: DataFrame) -> DataFrame:
    """Mart 3: per-customer risk profile (customers without transactions drop out)."""
    return risco_from_accounts(account_partials(transacoes), contas, clientes)


def risco_from_accounts(per_account: DataFrame, contas: DataFrame, clientes: DataFrame) -> DataFrame:
    """Mart 3 from account partials."""
    joined = (per_account
              .join(contas.select("id_conta", "id_cliente"), "id_conta")
              .join(clientes.select("id_cliente", "nome", "estado", "score_credito"), "id_cliente"))
    g = joined.groupBy("id_cliente", "nome", "estado", "score_credito").agg(
        *_rollup(extra=(F.max("max_valor").alias("max_valor"),
                        F.count_distinct("id_conta").alias("qtd_contas"),
                        F.sum("n_fora").alias("n_fora"))))
    c = F.col
    m = mean(c("s_score"), c("n_score"))
    return g.select(
        "id_cliente", "nome", "estado", "score_credito",
        c("n").cast("bigint").alias("total_transacoes"),
        c("n_fraude").cast("bigint").alias("total_fraudes"),
        round_money(c("s_valor")).alias("volume_total"),
        dk_round(mean(c("s_valor"), c("n_valor")), 2).alias("ticket_medio"),
        round_money(c("max_valor")).alias("maior_transacao"),
        dk_round(m, 4).alias("score_fraude_medio"),
        c("qtd_contas").cast("bigint").alias("qtd_contas"),
        c("n_fora").cast("bigint").alias("transacoes_fora_horario"),
        risk_score(m, c("n_fraude"), c("n_fora")).alias("score_risco_composto"),
        risk_class(m).alias("classificacao_risco"),
    )


def gold_diario(transacoes: DataFrame) -> DataFrame:
    """Mart 4: daily KPIs."""
    return diario_from_groups(per_account_then(transacoes, F.to_date("data_transacao"), "data",
                                               {"n_fraude": F.col("is_fraude"), **daily_counts()}))


def daily_counts() -> dict[str, Column]:
    """Conditions that the daily mart counts."""
    status = {"aprovadas": "aprovada", "negadas": "negada", "canceladas": "cancelada", "suspeitas": "suspeita"}
    canal = {"via_app": "app", "via_web": "web", "via_pos": "pos"}
    return {**{k: F.col("status") == v for k, v in status.items()}, **{k: F.col("canal") == v for k, v in canal.items()}}


def instant_measures() -> list[Column]:
    """Additive measures of the hourly and daily marts."""
    counts = {"n_fraude": F.col("is_fraude"), **daily_counts()}
    return [F.count(F.lit(1)).alias("n"), F.sum("valor").alias("s_valor"), F.count("valor").alias("n_valor"),
            *[F.count_if(cond).alias(k) for k, cond in counts.items()]]


def merge_instants(parts: DataFrame, key: str) -> DataFrame:
    """The measures per date or per hour, summed over partials."""
    return parts.groupBy(key).agg(*[F.sum(k).alias(k) for k in ("n", "s_valor", "n_valor", "n_fraude", *daily_counts())])


def diario_from_groups(g: DataFrame) -> DataFrame:
    """Mart 4 from measures per date."""
    c = F.col
    return g.select(
        "data",
        c("n").cast("bigint").alias("total_transacoes"),
        c("contas_ativas").cast("bigint").alias("contas_ativas"),
        round_money(c("s_valor")).alias("volume_total"),
        dk_round(mean(c("s_valor"), c("n_valor")), 2).alias("ticket_medio"),
        c("n_fraude").cast("bigint").alias("total_fraudes"),
        *[c(x).cast("bigint").alias(x) for x in daily_counts()],
        pct(c("n_fraude"), c("n"), 4).alias("taxa_fraude_pct"),
    )


def vw_transacoes_completa(transacoes: DataFrame, contas: DataFrame, clientes: DataFrame,
                           categorias: DataFrame, comerciantes: DataFrame) -> DataFrame:
    """Denormalised access view: 2 inner joins, 2 left joins, 16 columns.

    Accounts are joined to customers first (account-sized), then looked up
    from the fact, which is scanned once. Categories are a fixed 14-row table
    and are broadcast; accounts and merchants are left to Catalyst/AQE, which
    broadcast them only when their measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and split skewed partitions
    otherwise. Rows without a merchant stay spread out.
    """
    t = transacoes.select("id_transacao", "data_transacao", "valor", "tipo", "status", "canal",
                          "is_fraude", "score_fraude", "id_conta", "id_categoria", "id_comerciante")
    co = contas.select("id_conta", "id_cliente", "numero_conta", "tipo_conta")
    cl = clientes.select("id_cliente", F.col("nome").alias("nome_cliente"),
                         F.col("cidade").alias("cidade_cliente"), F.col("estado").alias("estado_cliente"),
                         "score_credito")
    cat = F.broadcast(categorias.select("id_categoria", F.col("nome").alias("categoria")))
    com = comerciantes.select("id_comerciante", F.col("nome").alias("comerciante"))
    account = co.join(cl, "id_cliente")          # one row per account: account-sized join
    held = t.join(account, "id_conta").join(cat, "id_categoria", "left")
    return (left_lookup(held, com, "id_comerciante", "id_transacao")
            .select("id_transacao", "data_transacao", "valor", "tipo", "status", "canal", "is_fraude",
                    "score_fraude", "numero_conta", "tipo_conta", "nome_cliente", "cidade_cliente",
                    "estado_cliente", "score_credito", "categoria", "comerciante"))


# ---------------------------------------------------------------- insights

def insight_top_estados(mart1: DataFrame, k: int = 3) -> DataFrame:
    """Top-k states by fraud rate (ties broken by state)."""
    return (mart1.orderBy(F.desc("pct_fraude"), F.asc("estado")).limit(k)
            .select("estado", "pct_fraude", "total_fraudes", "valor_fraudes"))


def insight_hora_risco(mart2: DataFrame) -> DataFrame:
    """Hour with the highest fraud rate (ties broken by hour)."""
    return (mart2.orderBy(F.desc("pct_fraude"), F.asc("hora_dia")).limit(1)
            .select("hora_dia", "pct_fraude", "total_transacoes"))


def insight_criticos(mart3: DataFrame) -> DataFrame:
    """Count of CRITICO customers and their mean composite score."""
    crit = mart3.filter(F.col("classificacao_risco") == "CRITICO")
    return crit.agg(F.count(F.lit(1)).cast("bigint").alias("clientes_criticos"),
                    dk_round(F.avg("score_risco_composto"), 2).alias("score_medio"))


def insight_melhor_dia(mart4: DataFrame) -> DataFrame:
    """Day with the highest volume (ties broken by date)."""
    return (mart4.orderBy(F.desc("volume_total"), F.asc("data")).limit(1)
            .select("data", "volume_total", "total_transacoes", "taxa_fraude_pct"))


def ordered(name: str, mart: DataFrame) -> DataFrame:
    """Presentation order of each mart (L1); used by the Gold export and the views."""
    order = {
        "gold_resumo_fraudes_por_estado": [F.desc("pct_fraude"), F.asc("estado")],
        "gold_transacoes_por_hora": [F.asc("hora_dia")],
        "gold_perfil_risco_cliente": [F.desc("score_risco_composto"), F.asc("id_cliente")],
        "gold_resumo_executivo_diario": [F.asc("data")],
    }[name]
    return mart.orderBy(*order)
