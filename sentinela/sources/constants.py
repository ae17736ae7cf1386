"""Constant dimension: transaction categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The 14 transaction categories (id, nome, tipo), in source order.
CATEGORIAS = [
    (1, "alimentacao", "debito"),
    (2, "transporte", "debito"),
    (3, "saude", "debito"),
    (4, "educacao", "debito"),
    (5, "lazer", "debito"),
    (6, "compras", "debito"),
    (7, "servicos", "debito"),
    (8, "transferencia", "debito"),
    (9, "saque", "debito"),
    (10, "salario", "credito"),
    (11, "pix_recebido", "credito"),
    (12, "estorno", "credito"),
    (13, "investimento", "credito"),
    (14, "outros", "debito"),
]

CATEGORIAS_SCHEMA = T.StructType([
    T.StructField("id_categoria", T.IntegerType(), False),
    T.StructField("nome", T.StringType(), False),
    T.StructField("tipo", T.StringType(), False),
])


def categorias_df(spark: SparkSession) -> DataFrame:
    """The category dimension as a local relation (14 rows, safe to broadcast)."""
    return spark.createDataFrame(CATEGORIAS, CATEGORIAS_SCHEMA)
