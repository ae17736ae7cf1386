"""Fraud rules over events.

An *event* has the stream layout: ``evento_id, event_ts, id_conta, valor,
tipo, status, canal, estado_origem, is_fraude, score_fraude, ip_origem,
device_id, comerciante, descricao``. The same column expressions serve the
batch form (over stored Silver transactions) and the streaming form.

Rules are evaluated in a fixed order (score, value, velocity, status); the
alert list keeps only the rules that fired, built with ``array_compact`` over
``when`` structs, so nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.operators.joins import left_lookup
from sentinela.operators.velocity import trailing_count

# Rule thresholds, names, severities and messages.
LIMITE_SCORE_FRAUDE = 0.65
LIMITE_VALOR_SUSPEITO = 5000.00
MAX_TRANSACOES_JANELA = 5
JANELA_SEGUNDOS = 60
R_SCORE = ("SCORE_FRAUDE_ALTO", "ALTA")
R_VALOR = ("VALOR_SUSPEITO", "MEDIA")
R_VELOCITY = ("VELOCITY_CHECK", "ALTA")
R_STATUS = ("STATUS_SUSPEITA", "ALTA")
MSG_SCORE = "Score %s acima do limite 0.65"
MSG_VALOR = "Transação de R$ %s acima do limite"
MSG_VELOCITY = "Conta %s com %s transações no último minuto"
MSG_STATUS = "Transação marcada como suspeita pelo sistema de origem"
STATUS_SUSPEITA = "suspeita"

EVENT_FIELDS = ["evento_id", "event_ts", "id_conta", "valor", "tipo", "status", "canal", "estado_origem",
                "is_fraude", "score_fraude", "ip_origem", "device_id", "comerciante", "descricao"]


def _alert(rule: tuple[str, str], descricao: Column) -> Column:
    return F.struct(F.lit(rule[0]).alias("regra"), descricao.alias("descricao"), F.lit(rule[1]).alias("severidade"))


def score_alto(score: Column | None = None) -> Column:
    return (F.col("score_fraude") if score is None else score) > LIMITE_SCORE_FRAUDE


def valor_suspeito(valor: Column | None = None) -> Column:
    return (F.col("valor") if valor is None else valor) > LIMITE_VALOR_SUSPEITO


def status_suspeita(status: Column | None = None) -> Column:
    return (F.col("status") if status is None else status) == STATUS_SUSPEITA


def velocity(n: Column | None = None, limit: int = MAX_TRANSACOES_JANELA) -> Column:
    return (F.col("janela_n") if n is None else n) > limit


def score_text(score: Column) -> Column:
    return F.format_string(MSG_SCORE, score.cast("double").cast("string"))


def valor_text(valor: Column) -> Column:
    return F.format_string(MSG_VALOR, F.format_number(valor.cast("double"), 2))


def velocity_text(conta: Column, n: Column) -> Column:
    return F.format_string(MSG_VELOCITY, conta.cast("string"), n.cast("string"))


def alert_list(with_velocity: bool = True) -> Column:
    """``array<struct<regra, descricao, severidade>>`` of the rules that fired, in rule order."""
    c = F.col
    items = [
        F.when(score_alto(c("score_fraude")), _alert(R_SCORE, score_text(c("score_fraude")))),
        F.when(valor_suspeito(c("valor")), _alert(R_VALOR, valor_text(c("valor")))),
    ]
    if with_velocity:
        items.append(F.when(velocity(c("janela_n")), _alert(R_VELOCITY, velocity_text(c("id_conta"), c("janela_n")))))
    items.append(F.when(status_suspeita(c("status")), _alert(R_STATUS, F.lit(MSG_STATUS))))
    return F.array_compact(F.array(*items))


def rule_names(alertas: Column | None = None) -> Column:
    """``"A | B"`` from an alert list."""
    alertas = F.col("alertas") if alertas is None else alertas
    return F.array_join(F.transform(alertas, lambda a: a["regra"]), " | ")


def evaluate(events: DataFrame, key: str = "id_conta", window_seconds: int = JANELA_SEGUNDOS,
             order_col: str = "evento_id", ts_col: str = "event_ts") -> DataFrame:
    """Add ``janela_n`` (trailing count per key) and ``alertas`` to every event."""
    counted = trailing_count(events, key, ts_col, order_col, window_seconds)
    return counted.withColumn("alertas", alert_list())


ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _event_struct(evaluated: DataFrame) -> Column:
    """The event as published: ``timestamp`` as an ISO string, fields in publish order."""
    fields = []
    for name in EVENT_FIELDS:
        if name == "event_ts":
            fields.append(F.date_format("event_ts", ISO_FORMAT).alias("timestamp"))
        elif name in evaluated.columns:
            fields.append(F.col(name))
    return F.struct(*fields)


def alert_documents(evaluated: DataFrame) -> DataFrame:
    """Alert documents for events with at least one rule fired."""
    return (evaluated.filter(F.size("alertas") > 0)
            .select(F.current_timestamp().alias("timestamp_alerta"), "evento_id", "id_conta", "valor", "tipo",
                    F.col("estado_origem").alias("estado"), "score_fraude", "alertas",
                    _event_struct(evaluated).alias("transacao")))


def events_from_silver(transacoes: DataFrame) -> DataFrame:
    """Silver transactions in the event layout, without the dimension lookups.

    ``estado_origem`` and ``comerciante`` are looked up only for events that
    raise an alert (see :func:`enrich`), so the full fact table never joins.
    """
    return transacoes.select(
        F.lpad(F.col("id_transacao").cast("string"), 12, "0").alias("evento_id"),
        F.col("data_transacao").alias("event_ts"),
        "id_conta",
        F.col("valor").cast("double").alias("valor"),
        "tipo", "status", "canal", "is_fraude",
        F.col("score_fraude").cast("double").alias("score_fraude"),
        "ip_origem", "device_id", "descricao", "id_comerciante",
    )


def enrich(events: DataFrame, contas: DataFrame, clientes: DataFrame, comerciantes: DataFrame) -> DataFrame:
    """Attach the customer's state and the merchant name (left joins).

    Only alerting events reach this join; runtime skew is left to AQE's
    skew-join split (``spark.sql.adaptive.skewJoin.enabled``).
    """
    estado = (contas.select("id_conta", "id_cliente")
              .join(clientes.select("id_cliente", F.col("estado").alias("estado_origem")), "id_cliente")
              .drop("id_cliente"))
    merchant = comerciantes.select("id_comerciante", F.col("nome").alias("comerciante"))
    held = events.join(estado, "id_conta", "left")
    return left_lookup(held, merchant, "id_comerciante", "evento_id").drop("id_comerciante")


def batch_alerts(silver: dict[str, DataFrame], key: str = "id_conta",
                 window_seconds: int = JANELA_SEGUNDOS) -> DataFrame:
    """Evaluate all rules over stored Silver transactions; alerting events only."""
    ev = evaluate(events_from_silver(silver["transacoes"]), key, window_seconds)
    alerting = ev.filter(F.size("alertas") > 0)
    return alert_documents(enrich(alerting, silver["contas"], silver["clientes"], silver["comerciantes"]))


def flatten_alerts(docs: DataFrame) -> DataFrame:
    """One row per (event, fired rule) with the rule's position in the list."""
    return docs.select("evento_id", "id_conta", "valor", "tipo", "estado", "score_fraude",
                       F.posexplode("alertas").alias("ordem", "alerta")) \
        .select("evento_id", "id_conta", "valor", "tipo", "estado", "score_fraude",
                F.col("ordem").cast("bigint").alias("ordem"),
                F.col("alerta.regra").alias("regra"), F.col("alerta.descricao").alias("descricao"),
                F.col("alerta.severidade").alias("severidade"))
