"""Data-quality metrics (Q1–Q5) and constraint audits.

The source database enforced keys, references, domains and defaults at
insert time; a lake does not, so the same rules are checked as aggregations:

* metrics are plain aggregate expressions, usable both in ``agg`` (a
  one-row DataFrame) and in ``DataFrame.observe`` (collected while the
  Silver table is written, with no second pass over the data);
* key audits pre-aggregate per key before any join, so a key holding a
  third of all rows costs one partial-aggregate row per task, not a
  skewed join partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentinela.functions.text import cpf_invalid, digits_only
from sentinela.functions.timefn import coerce_timestamp
from sentinela.operators import distinct

# Problem messages of the quality report (printf-style).
MSG_CPF = "%d CPFs com tamanho inválido"
MSG_SCORE_MEDIAN = "%d scores preenchidos com mediana (%d)"
MSG_BAD_DATES = "%d datas inválidas encontradas"
MSG_NEGATIVE = "%d valores negativos convertidos para positivo"
MSG_ZERO = "%d transações com valor zero"
MSG_NULL_SALDO = "%d saldos nulos preenchidos com 0"

# Allowed domains (CHECK constraints of the source tables).
DOMAINS = {
    "clientes": {"genero": ["M", "F", "O"]},
    "contas": {"tipo_conta": ["corrente", "poupanca", "investimento", "cartao"]},
    "categorias_transacao": {"tipo": ["debito", "credito"]},
    "transacoes": {
        "tipo": ["debito", "credito", "pix", "ted", "doc", "boleto"],
        "status": ["aprovada", "negada", "cancelada", "pendente", "suspeita"],
        "canal": ["app", "web", "pos", "atm", "agencia"],
    },
}
# Value ranges, NOT NULL, UNIQUE and foreign-key columns, and column defaults of the source schema.
RANGES = {
    "clientes": {"score_credito": (0, 1000)},
    "transacoes": {"score_fraude": (0, 1)},
}
NOT_NULL = {
    "clientes": ["id_cliente", "nome", "cpf", "email", "data_nascimento"],
    "contas": ["id_conta", "id_cliente", "numero_conta", "tipo_conta"],
    "categorias_transacao": ["id_categoria", "nome", "tipo"],
    "comerciantes": ["id_comerciante", "nome"],
    "transacoes": ["id_transacao", "id_conta", "valor", "tipo", "status", "data_transacao"],
}
UNIQUE = {
    "clientes": ["id_cliente", "cpf", "email"],
    "contas": ["id_conta", "numero_conta"],
    "categorias_transacao": ["id_categoria", "nome"],
    "comerciantes": ["id_comerciante", "cnpj"],
    "transacoes": ["id_transacao"],
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("contas", "id_cliente", "clientes", "id_cliente"),
    ("transacoes", "id_conta", "contas", "id_conta"),
    ("transacoes", "id_categoria", "categorias_transacao", "id_categoria"),
    ("transacoes", "id_comerciante", "comerciantes", "id_comerciante"),
]
# Column defaults of the source tables (timestamps default to "now").
DEFAULTS = {
    "clientes": {"ativo": True, "data_cadastro": "now"},
    "contas": {"saldo": 0, "limite": 0, "data_abertura": "now", "ativa": True},
    "transacoes": {"is_fraude": False, "data_transacao": "now"},
}

REPORT_SCHEMA = T.StructType([
    T.StructField("tabela", T.StringType()),
    T.StructField("total_original", T.LongType()),
    T.StructField("total_silver", T.LongType()),
    T.StructField("removidos", T.LongType()),
    T.StructField("problemas", T.ArrayType(T.StringType())),
    T.StructField("fraudes", T.LongType()),
    T.StructField("valor_total", T.DoubleType()),
    T.StructField("valor_medio", T.DoubleType()),
])


# ---------------------------------------------------------------- metrics

def quality_metrics(table: str, median: float | None = None) -> dict[str, Column]:
    """Aggregate expressions over the *Bronze* rows of ``table``; ``median`` is the score's, where it is known already."""
    m: dict[str, Column] = {"total_original": F.count(F.lit(1))}
    if table == "clientes":
        m["cpf_invalidos"] = F.count_if(cpf_invalid(digits_only("cpf")))
        m["scores_nulos"] = F.count_if(F.col("score_credito").isNull())
        m["mediana_score"] = F.median("score_credito") if median is None else F.max(F.lit(median))
        m["total_silver"] = F.count(F.lit(1))
    elif table == "transacoes":
        ok = coerce_timestamp("data_transacao").isNotNull()
        m["datas_invalidas"] = F.count_if(~ok)
        m["total_silver"] = F.count_if(ok)
        m["valores_negativos"] = F.count_if(ok & (F.col("valor") < 0))
        m["valores_zero"] = F.count_if(ok & (F.col("valor") == 0))
        m["fraudes"] = F.count_if(ok & F.col("is_fraude"))
        m["valor_soma"] = F.sum(F.when(ok, F.abs(F.col("valor"))))
        m["valor_n"] = F.count(F.when(ok, F.col("valor")))
    elif table == "contas":
        m["saldos_nulos"] = F.count_if(F.col("saldo").isNull())
        m["total_silver"] = F.count(F.lit(1))
    else:
        m["total_silver"] = F.count(F.lit(1))
    return m


def _problem(n: Column, fmt: str, *extra: Column) -> Column:
    return F.when(n > 0, F.format_string(fmt, n, *extra))


def report_from_metrics(table: str, metrics: DataFrame) -> DataFrame:
    """Turn the one-row metric DataFrame into one quality-report row."""
    c = F.col
    if table == "clientes":
        problems = [_problem(c("cpf_invalidos"), MSG_CPF),
                    _problem(c("scores_nulos"), MSG_SCORE_MEDIAN, F.bround(c("mediana_score"), 0).cast("bigint"))]
    elif table == "transacoes":
        problems = [_problem(c("datas_invalidas"), MSG_BAD_DATES),
                    _problem(c("valores_negativos"), MSG_NEGATIVE),
                    _problem(c("valores_zero"), MSG_ZERO)]
    elif table == "contas":
        problems = [_problem(c("saldos_nulos"), MSG_NULL_SALDO)]
    else:
        problems = []
    problem_arr = F.array_compact(F.array(*problems)) if problems else F.array().cast("array<string>")
    is_t = table == "transacoes"
    return metrics.select(
        F.lit(table).alias("tabela"),
        c("total_original").cast("bigint").alias("total_original"),
        c("total_silver").cast("bigint").alias("total_silver"),
        (c("total_original") - c("total_silver")).cast("bigint").alias("removidos"),
        problem_arr.alias("problemas"),
        (c("fraudes") if is_t else F.lit(None)).cast("bigint").alias("fraudes"),
        (c("valor_soma") if is_t else F.lit(None)).cast("double").alias("valor_total"),
        (F.when(c("valor_n") > 0, c("valor_soma").cast("double") / c("valor_n")) if is_t else F.lit(None))
        .cast("double").alias("valor_medio"),
    )


def quality_row(table: str, bronze: DataFrame) -> DataFrame:
    """One quality-report row for ``table``, computed in one aggregation."""
    metrics = bronze.agg(*[e.alias(k) for k, e in quality_metrics(table).items()])
    return report_from_metrics(table, metrics)


def quality_report(bronze: dict[str, DataFrame]) -> DataFrame:
    """Quality rows for all tables (K7 content)."""
    rows = [quality_row(name, df) for name, df in bronze.items()]
    return reduce(DataFrame.unionByName, rows)


# ---------------------------------------------------------------- audits

def _unpivot_counts(agg_row: DataFrame, table: str, value_name: str) -> DataFrame:
    cols = agg_row.columns
    return (agg_row.unpivot([], cols, "coluna", value_name)
            .select(F.lit(table).alias("tabela"), "coluna", F.col(value_name).cast("bigint").alias(value_name)))


def audit_domains(silver: dict[str, DataFrame]) -> DataFrame:
    """Rows violating CHECK domains / ranges per (table, column); NULL passes."""
    parts = []
    for table, df in silver.items():
        exprs = []
        for col, allowed in DOMAINS.get(table, {}).items():
            exprs.append(F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(allowed)).alias(col))
        for col, (lo, hi) in RANGES.get(table, {}).items():
            exprs.append(F.count_if(F.col(col).isNotNull() & ~F.col(col).between(lo, hi)).alias(col))
        if exprs:
            parts.append(_unpivot_counts(df.agg(*exprs), table, "violacoes"))
    return reduce(DataFrame.unionByName, parts)


def audit_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """NULL count per mandatory column."""
    parts = []
    for table, df in tables.items():
        cols = NOT_NULL.get(table, [])
        if cols:
            parts.append(_unpivot_counts(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]),
                                         table, "nulos"))
    return reduce(DataFrame.unionByName, parts)


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill NULLs with the source table's column defaults."""
    fills = {}
    for col, value in DEFAULTS.get(table, {}).items():
        if col not in df.columns:
            continue
        dtype = df.schema[col].dataType
        default = F.current_timestamp().cast(dtype) if value == "now" else F.lit(value).cast(dtype)
        fills[col] = F.coalesce(F.col(col), default)
    return df.withColumns(fills)


def _unpivot(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(name, k): the non-NULL values of several columns from one scan; ``columns`` maps name -> column."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("k"))
                               for n, c in columns.items()]))
    return df.select(each.alias("e")).select("e.name", "e.k").filter(F.col("k").isNotNull())


def _per_name(found: DataFrame, names: list[str], keys: str, rows: str) -> DataFrame:
    """Keys and rows counted per name; names without any get zeros."""
    every = found.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("name"))
    counts = found.groupBy("name").agg(F.count(F.lit(1)).alias(keys), F.sum("n").alias(rows))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return every.join(counts, "name", "left").select("name", zero(keys), zero(rows))


#: Buckets with repeated keys that are looked up by a broadcast (16 bytes each); with more, all keys are grouped.
REPEATING_BUCKETS = 100_000


def _integer_keys(tables: dict[str, DataFrame], names: list[tuple[str, str]]) -> DataFrame:
    """(name, ``chave``): the non-NULL values of dense integer columns, one scan per table."""
    parts = []
    for table in dict.fromkeys(t for t, _ in names):
        each = F.explode(F.array(*[F.struct(F.lit(f"{t}.{c}").alias("name"), F.col(c).cast("bigint").alias(distinct.KEY))
                                   for t, c in names if t == table]))
        parts.append(tables[table].select(each.alias("e")).select("e.*").filter(F.col(distinct.KEY).isNotNull()))
    return reduce(DataFrame.unionByName, parts)


def repeated_integers(tables: dict[str, DataFrame], names: list[tuple[str, str]],
                      most: int = REPEATING_BUCKETS) -> DataFrame | None:
    """(name, ``n``) per integer key that occurs more than once; None if there is none.

    Rows are first held against set bits per bucket of 32,768 keys. Only the keys of buckets that disagree are
    grouped; with more than ``most`` such buckets all keys are, which is then no more work.
    """
    spark, keys = next(iter(tables.values())).sparkSession, _integer_keys(tables, names)
    found = distinct.repeating_buckets(keys).limit(most + 1).collect()
    if not found:
        return None
    if len(found) <= most:
        buckets = spark.createDataFrame(found, "name string, b bigint")
        keys = keys.withColumn("b", distinct.bucket_of(F.col(distinct.KEY))).join(F.broadcast(buckets), ["name", "b"], "left_semi")
    return keys.groupBy("name", distinct.KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name", "n")


def audit_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate keys per unique column: keys seen more than once and their rows (Q5).

    Dense integer columns are audited by bit sets (:func:`repeated_integers`), so their unique keys are neither
    shuffled nor grouped; columns of other types, and sparse ones, are grouped, one scan per table.
    """
    columns = [(t, c) for t in tables for c in UNIQUE.get(t, [])]
    held = {t: tables[t] for t in dict.fromkeys(t for t, _ in columns)}
    dense = set(distinct.dense_columns({f"{t}.{c}": (held[t], c) for t, c in columns}))
    bits = [(t, c) for t, c in columns if f"{t}.{c}" in dense]
    repeated = [] if not bits else [repeated_integers(held, bits)]
    for table, df in held.items():
        plain = {f"{table}.{c}": c for t, c in columns if t == table and f"{t}.{c}" not in dense}
        if plain:
            repeated.append(_unpivot(df, plain).groupBy("name", "k").agg(F.count(F.lit(1)).alias("n"))
                            .filter("n > 1").select("name", "n"))
    spark = next(iter(tables.values())).sparkSession
    none = spark.createDataFrame([], "name string, n bigint")
    every = _per_name(reduce(DataFrame.unionByName, [r for r in repeated if r is not None] or [none]),
                      [f"{t}.{c}" for t, c in columns], "chaves_duplicadas", "linhas_duplicadas")
    place = F.split("name", "\\.")
    return every.select(place[0].alias("tabela"), place[1].alias("coluna"), "chaves_duplicadas", "linhas_duplicadas")


def audit_fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row (anti join). One scan per child table.

    The child side is reduced to (relation, key, rows) first, so the anti join
    sees one row per distinct key and a hot key cannot skew it.
    """
    parts = []
    for child in dict.fromkeys(c for c, _, p, _ in FOREIGN_KEYS if c in tables and p in tables):
        mine = [(ccol, parent, pcol) for c, ccol, parent, pcol in FOREIGN_KEYS if c == child and parent in tables]
        names = {f"{child}.{ccol}->{parent}.{pcol}": ccol for ccol, parent, pcol in mine}
        keys = _unpivot(tables[child], names).groupBy("name", "k").agg(F.count(F.lit(1)).alias("n"))
        parents = reduce(DataFrame.unionByName, [
            tables[parent].select(F.lit(name).alias("name"), F.col(pcol).cast("string").alias("k"))
            for name, (_, parent, pcol) in zip(names, mine)])
        parts.append(_per_name(keys.join(parents, ["name", "k"], "left_anti"), list(names), "chaves_orfas", "linhas_orfas")
                     .withColumnRenamed("name", "relacao"))
    return reduce(DataFrame.unionByName, parts)
