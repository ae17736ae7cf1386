"""Silver cleaning.

Each ``clean_*`` is a pure ``DataFrame -> DataFrame`` transformation: a
narrow projection/filter that Catalyst fuses into one codegen stage with the
scan, so cleaning never shuffles. The only non-narrow piece is the median
used to fill missing credit scores, planned as a scalar subquery: Spark's
exact percentile keeps a value -> frequency map, which for a score bounded to
0..1000 stays tiny however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.functions.numeric import faixa_valor
from sentinela.functions.text import digits_only, strip, title_case
from sentinela.functions.timefn import coerce_timestamp, fora_horario

# Bronze audit column names.
AUDIT_COLUMNS = ["_ingestao_timestamp", "_fonte", "_tabela_origem"]


def drop_audit(df: DataFrame) -> DataFrame:
    """Drop the Bronze audit columns; names that are absent are ignored."""
    return df.drop(*AUDIT_COLUMNS)


def stamp(df: DataFrame, column: str = "_silver_timestamp") -> DataFrame:
    """Layer timestamp (one value per query)."""
    return df.withColumn(column, F.current_timestamp())


def median_of(df: DataFrame, column: str) -> Column:
    """Exact median of ``column`` (NULLs skipped) as a lazily planned scalar."""
    return df.agg(F.median(column)).scalar()


def clean_clientes(df: DataFrame, with_stamp: bool = True, median: float | None = None) -> DataFrame:
    """Trim/case names, e-mails, cities and states; CPF digits; median-filled scores.

    ``median`` is the score's, where it is known already (a layer run selects it
    once, see :mod:`selection`); else it is a scalar subquery of the plan.
    """
    median = median_of(df, "score_credito") if median is None else F.lit(median)
    cleaned = df.withColumns({
        "nome": title_case(strip("nome")),
        "email": F.lower(strip("email")),
        "cidade": title_case(strip("cidade")),
        "estado": strip(F.upper("estado")),
        "cpf": digits_only("cpf"),
        "score_credito": F.coalesce(F.col("score_credito").cast("double"), median),
    })
    cleaned = drop_audit(cleaned)
    if with_stamp:
        cleaned = stamp(cleaned).withColumn("_qualidade_ok", F.lit(True))
    return cleaned


def clean_transacoes(df: DataFrame, with_stamp: bool = True) -> DataFrame:
    """Parse dates (bad -> dropped), absolute values, normalised codes, bands.

    Order follows the specification: the date filter comes first, the band is
    computed on the absolute value.
    """
    parsed = df.withColumns({
        "data_transacao": coerce_timestamp("data_transacao"),
        "data_processamento": coerce_timestamp("data_processamento"),
    }).filter(F.col("data_transacao").isNotNull())
    valor = F.abs(F.col("valor"))
    cleaned = parsed.withColumns({
        "valor": valor,
        "tipo": strip(F.lower("tipo")),
        "status": strip(F.lower("status")),
        "canal": strip(F.lower("canal")),
        "score_fraude": F.coalesce(F.col("score_fraude"), F.lit(0).cast(df.schema["score_fraude"].dataType)),
    }).withColumns({
        "faixa_valor": faixa_valor("valor"),
        "fora_horario_comercial": fora_horario("data_transacao"),
    })
    cleaned = drop_audit(cleaned)
    return stamp(cleaned) if with_stamp else cleaned


def clean_contas(df: DataFrame, with_stamp: bool = True) -> DataFrame:
    cleaned = df.withColumns({
        "tipo_conta": strip(F.lower("tipo_conta")),
        "saldo": F.coalesce(F.col("saldo"), F.lit(0).cast(df.schema["saldo"].dataType)),
    })
    cleaned = drop_audit(cleaned)
    return stamp(cleaned) if with_stamp else cleaned


def clean_generic(df: DataFrame, with_stamp: bool = True) -> DataFrame:
    """Generic tables (merchants, categories): audit drop and stamp only."""
    cleaned = drop_audit(df)
    return stamp(cleaned) if with_stamp else cleaned


CLEANERS = {
    "clientes": clean_clientes,
    "contas": clean_contas,
    "transacoes": clean_transacoes,
    "comerciantes": clean_generic,
    "categorias_transacao": clean_generic,
}
