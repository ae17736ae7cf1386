"""Bronze-shaped logical tables derived from the provided parquet tables.

The fraud model has five source tables (clientes, contas, transacoes,
comerciantes, categorias_transacao). The provided test data is a TPC-H-like
star schema, so each logical table is a projection of one provided table,
with deliberate dirt (padding, mixed case, punctuated CPFs, negative or zero
values, unparseable dates, NULLs) that the Silver cleaning must undo.

Two account layouts exist:

* ``layout="events"``: one account per customer; transactions are ``events``.
* ``layout="orders"``: one account per order (so a customer holds many
  accounts); transactions are ``lineitem`` rows. This is the larger variant.

Every derived column is a deterministic expression of its source row, so the
mapping is a narrow projection (no shuffle) and scales with the input.
``nation`` and ``region`` are the fixed 25- and 5-row TPC-H dimensions, the
only sides broadcast explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.sources.constants import categorias_df

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Mapping of provided codes onto the fraud model's domains.
EVENT_TIPO = {"purchase": "pix", "click": "debito", "view": "credito", "signup": "ted", "error": "boleto"}
EVENT_STATUS = {"purchase": "aprovada", "click": "aprovada", "view": "negada",
                "signup": "cancelada", "error": "suspeita"}
CANAL_BY_MOD7 = ["app", "app", "app", "web", "pos", "atm", "agencia"]
SEGMENT_TIPO_CONTA = {"AUTOMOBILE": "corrente", "BUILDING": "poupanca", "FURNITURE": "investimento",
                      "MACHINERY": "cartao", "HOUSEHOLD": "corrente"}
TIPO_CONTA_BY_MOD4 = ["corrente", "poupanca", "investimento", "cartao"]
TIPO_BY_MOD6 = ["debito", "credito", "pix", "ted", "doc", "boleto"]
CANAL_BY_MOD5 = ["app", "web", "pos", "atm", "agencia"]
CATEGORIA_COMERCIANTE_BY_MOD3 = ["varejo", "servicos", "alimentacao"]


# Columns of the provided tables; stated, so that a read needs no job for the files' footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def _by_index(idx: Column, values: list) -> Column:
    return _case(idx, dict(enumerate(values)))


def _cents(x: Column) -> Column:
    """Whole cents of a two-decimal double, as bigint."""
    return F.round(x * 100).cast("bigint")


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read_table(spark, sf_dir, "customer")
    na = read_table(spark, sf_dir, "nation")
    re_ = read_table(spark, sf_dir, "region")
    df = (cu.join(F.broadcast(na), cu.c_nationkey == na.n_nationkey, "left")
            .join(F.broadcast(re_), F.col("n_regionkey") == re_.r_regionkey, "left"))
    k = F.col("c_custkey")
    d = F.lpad(k.cast("string"), 11, "0")
    email = F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@email.com"))
    return df.select(
        k.alias("id_cliente"),
        F.when(k % 4 == 0, F.concat(F.lit("  "), F.lower("c_name"), F.lit("  ")))
         .when(k % 4 == 1, F.upper("c_name"))
         .when(k % 4 == 2, F.col("c_name"))
         .otherwise(F.concat(F.lit(" "), F.col("c_name"))).alias("nome"),
        F.when(k % 53 == 0, F.lit(None).cast("string"))
         .when(k % 37 == 0, F.substring(d, 2, 10))
         .otherwise(F.concat(F.substring(d, 1, 3), F.lit("."), F.substring(d, 4, 3), F.lit("."),
                             F.substring(d, 7, 3), F.lit("-"), F.substring(d, 10, 2))).alias("cpf"),
        F.when(k % 4 == 1, F.upper(email)).when(k % 4 == 0, F.concat(F.lit(" "), email))
         .otherwise(email).alias("email"),
        F.date_add(F.lit("1950-01-01").cast("date"), (k % 18000).cast("int")).alias("data_nascimento"),
        F.when(k % 41 == 0, "X").when(k % 3 == 0, "M").when(k % 3 == 1, "F").otherwise("O").alias("genero"),
        F.concat(F.lit(" "), F.lower("r_name")).alias("cidade"),
        F.when(k % 2 == 0, F.lower("n_name")).otherwise(F.concat(F.col("n_name"), F.lit(" "))).alias("estado"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("int"))
         .otherwise(F.floor(F.lit(300) + F.col("c_acctbal") / 15).cast("int")).alias("score_credito"),
        F.timestamp_add("SECOND", k, _ntz("2020-01-01 00:00:00")).alias("data_cadastro"),
        F.when(k % 29 == 0, F.lit(None).cast("boolean")).otherwise(F.lit(True)).alias("ativo"),
    )


def contas(spark: SparkSession, sf_dir: str, layout: str = "events") -> DataFrame:
    if layout == "orders":
        o = read_table(spark, sf_dir, "orders")
        k = F.col("o_orderkey")
        return o.select(
            k.alias("id_conta"),
            F.col("o_custkey").alias("id_cliente"),
            F.lpad(k.cast("string"), 10, "0").alias("numero_conta"),
            _by_index(k % 4, TIPO_CONTA_BY_MOD4).alias("tipo_conta"),
            (_cents(F.col("o_totalprice")) * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(15,2)").alias("saldo"),
            F.lit(0).cast("decimal(15,2)").alias("limite"),
            F.col("o_orderdate").alias("data_abertura"),
            F.lit(True).alias("ativa"),
        )
    cu = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    tipo = _case(F.col("c_mktsegment"), SEGMENT_TIPO_CONTA)
    return cu.select(
        k.alias("id_conta"),
        k.alias("id_cliente"),
        F.concat(F.lpad(k.cast("string"), 8, "0"), F.lit("-"), (k % 10).cast("string")).alias("numero_conta"),
        F.when(k % 3 == 0, F.concat(F.upper(tipo), F.lit(" "))).otherwise(tipo).alias("tipo_conta"),
        F.when(k % 23 == 0, F.lit(None).cast("decimal(15,2)"))
         .otherwise((_cents(F.col("c_acctbal")) * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(15,2)"))
         .alias("saldo"),
        F.when(k % 19 == 0, F.lit(None).cast("decimal(15,2)"))
         .otherwise(F.lit(1000).cast("decimal(15,2)")).alias("limite"),
        F.timestamp_add("SECOND", k, _ntz("2021-01-01 00:00:00")).alias("data_abertura"),
        F.when(k % 31 == 0, F.lit(None).cast("boolean")).otherwise(F.lit(True)).alias("ativa"),
    )


def transacoes(spark: SparkSession, sf_dir: str, layout: str = "events") -> DataFrame:
    if layout == "orders":
        li = read_table(spark, sf_dir, "lineitem")
        return li.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id_transacao"),
            F.col("l_orderkey").alias("id_conta"),
            (F.col("l_partkey") % 14 + 1).cast("int").alias("id_categoria"),
            F.col("l_suppkey").alias("id_comerciante"),
            (_cents(F.col("l_extendedprice")) * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(12,2)").alias("valor"),
            _by_index(F.col("l_linenumber") % 6, TIPO_BY_MOD6).alias("tipo"),
            F.when(F.col("l_returnflag") == "R", "suspeita").when(F.col("l_returnflag") == "A", "negada")
             .otherwise("aprovada").alias("status"),
            _by_index(F.col("l_partkey") % 5, CANAL_BY_MOD5).alias("canal"),
            F.col("l_returnflag").alias("descricao"),
            F.col("l_shipdate").alias("data_transacao"),
            F.col("l_shipdate").alias("data_processamento"),
            ((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.07)).alias("is_fraude"),
            (F.round(F.col("l_discount") * 100).cast("bigint") * F.lit(0.1).cast("decimal(1,1)"))
            .cast("decimal(7,5)").alias("score_fraude"),
            F.lit("10.0.0.1").alias("ip_origem"),
            F.concat(F.lit("device-"), F.col("l_suppkey").cast("string")).alias("device_id"),
        )
    ev = read_table(spark, sf_dir, "events")
    e = F.col("event_id")
    cents = _cents(F.col("value"))
    tipo = _case(F.col("event_type"), EVENT_TIPO)
    status = _case(F.col("event_type"), EVENT_STATUS)
    canal = _by_index(e % 7, CANAL_BY_MOD7)
    signed = F.when(e % 50 == 0, -cents).when(e % 101 == 0, F.lit(0)).otherwise(cents)
    return ev.select(
        e.alias("id_transacao"),
        F.col("user_id").alias("id_conta"),
        F.when(e % 13 == 0, F.lit(None).cast("int")).otherwise((e % 15 + 1).cast("int")).alias("id_categoria"),
        F.when(e % 5 == 0, F.lit(None).cast("bigint")).otherwise(e % 128).alias("id_comerciante"),
        (signed * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(12,2)").alias("valor"),
        F.when(e % 3 == 0, F.upper(F.concat(F.lit(" "), tipo))).otherwise(tipo).alias("tipo"),
        F.when(e % 4 == 0, F.upper(status)).otherwise(status).alias("status"),
        F.when(e % 6 == 0, F.concat(F.upper(canal), F.lit(" "))).otherwise(canal).alias("canal"),
        F.col("event_type").alias("descricao"),
        F.when(e % 211 == 0, F.lit("sem data")).otherwise(F.col("ts").cast("string")).alias("data_transacao"),
        F.timestamp_add("SECOND", e % 300, F.col("ts")).alias("data_processamento"),
        (F.col("value") > 150).alias("is_fraude"),
        F.when(e % 97 == 0, F.lit(None).cast("decimal(7,5)"))
         .otherwise((F.least(cents * (F.lit(1) + F.col("user_id") % 8), F.lit(20000))
                     * F.lit(0.00005).cast("decimal(5,5)")).cast("decimal(7,5)")).alias("score_fraude"),
        F.concat(F.lit("10."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 (e % 256).cast("string"), F.lit(".1")).alias("ip_origem"),
        F.concat(F.lit("device-"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("device_id"),
    )


def comerciantes(spark: SparkSession, sf_dir: str) -> DataFrame:
    su = read_table(spark, sf_dir, "supplier")
    na = read_table(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    d = F.lpad(k.cast("string"), 14, "0")
    return su.join(F.broadcast(na), su.s_nationkey == na.n_nationkey, "left").select(
        k.alias("id_comerciante"),
        F.col("s_name").alias("nome"),
        _by_index(k % 3, CATEGORIA_COMERCIANTE_BY_MOD3).alias("categoria"),
        F.col("n_name").alias("cidade"),
        F.col("n_name").alias("estado"),
        F.concat(F.substring(d, 1, 2), F.lit("."), F.substring(d, 3, 3), F.lit("."), F.substring(d, 6, 3),
                 F.lit("/"), F.substring(d, 9, 4), F.lit("-"), F.substring(d, 13, 2)).alias("cnpj"),
    )


@dataclass
class Sources:
    clientes: DataFrame
    contas: DataFrame
    transacoes: DataFrame
    comerciantes: DataFrame
    categorias_transacao: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def sources(spark: SparkSession, sf_dir: str, layout: str = "events") -> Sources:
    """The five Bronze source tables for one scale-factor folder."""
    return Sources(
        clientes=clientes(spark, sf_dir),
        contas=contas(spark, sf_dir, layout),
        transacoes=transacoes(spark, sf_dir, layout),
        comerciantes=comerciantes(spark, sf_dir),
        categorias_transacao=categorias_df(spark),
    )
