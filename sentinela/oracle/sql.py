"""DuckDB SQL used as the correctness oracle for the registered queries.

The provided tables are registered as views by the checker; the CTEs below
derive the Bronze tables, clean them into Silver and compute each result in
plain SQL. They restate the semantics independently of the Spark code.
"""

from __future__ import annotations

# --------------------------------------------------------------- Bronze

BRONZE = {
    "bronze_clientes": r"""
SELECT c.c_custkey AS id_cliente,
  CASE c.c_custkey % 4 WHEN 0 THEN '  ' || lower(c.c_name) || '  ' WHEN 1 THEN upper(c.c_name)
       WHEN 2 THEN c.c_name ELSE ' ' || c.c_name END AS nome,
  CASE WHEN c.c_custkey % 53 = 0 THEN NULL
       WHEN c.c_custkey % 37 = 0 THEN substr(lpad(CAST(c.c_custkey AS VARCHAR), 11, '0'), 2, 10)
       ELSE substr(lpad(CAST(c.c_custkey AS VARCHAR), 11, '0'), 1, 3) || '.' ||
            substr(lpad(CAST(c.c_custkey AS VARCHAR), 11, '0'), 4, 3) || '.' ||
            substr(lpad(CAST(c.c_custkey AS VARCHAR), 11, '0'), 7, 3) || '-' ||
            substr(lpad(CAST(c.c_custkey AS VARCHAR), 11, '0'), 10, 2) END AS cpf,
  CASE WHEN c.c_custkey % 4 = 1 THEN upper(lower(replace(c.c_name, '#', '.')) || '@email.com')
       WHEN c.c_custkey % 4 = 0 THEN ' ' || lower(replace(c.c_name, '#', '.')) || '@email.com'
       ELSE lower(replace(c.c_name, '#', '.')) || '@email.com' END AS email,
  DATE '1950-01-01' + CAST(c.c_custkey % 18000 AS INTEGER) AS data_nascimento,
  CASE WHEN c.c_custkey % 41 = 0 THEN 'X' WHEN c.c_custkey % 3 = 0 THEN 'M'
       WHEN c.c_custkey % 3 = 1 THEN 'F' ELSE 'O' END AS genero,
  ' ' || lower(r.r_name) AS cidade,
  CASE WHEN c.c_custkey % 2 = 0 THEN lower(n.n_name) ELSE n.n_name || ' ' END AS estado,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CAST(floor(300 + c.c_acctbal / 15) AS INTEGER) END AS score_credito,
  TIMESTAMP '2020-01-01 00:00:00' + to_seconds(c.c_custkey) AS data_cadastro,
  CASE WHEN c.c_custkey % 29 = 0 THEN NULL ELSE TRUE END AS ativo
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",

    "bronze_contas": r"""
SELECT c_custkey AS id_conta, c_custkey AS id_cliente,
  lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '-' || CAST(c_custkey % 10 AS VARCHAR) AS numero_conta,
  CASE WHEN c_custkey % 3 = 0 THEN upper(t) || ' ' ELSE t END AS tipo_conta,
  CASE WHEN c_custkey % 23 = 0 THEN NULL
       ELSE CAST(CAST(round(c_acctbal * 100) AS BIGINT) * 0.01 AS DECIMAL(15,2)) END AS saldo,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(1000 AS DECIMAL(15,2)) END AS limite,
  TIMESTAMP '2021-01-01 00:00:00' + to_seconds(c_custkey) AS data_abertura,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE TRUE END AS ativa
FROM (SELECT *, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'corrente' WHEN 'BUILDING' THEN 'poupanca'
                 WHEN 'FURNITURE' THEN 'investimento' WHEN 'MACHINERY' THEN 'cartao'
                 WHEN 'HOUSEHOLD' THEN 'corrente' END AS t FROM customer) cu""",

    "bronze_transacoes": r"""
SELECT event_id AS id_transacao, user_id AS id_conta,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 15 + 1 AS INTEGER) END AS id_categoria,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 128 END AS id_comerciante,
  CAST((CASE WHEN event_id % 50 = 0 THEN -cents WHEN event_id % 101 = 0 THEN 0 ELSE cents END) * 0.01
       AS DECIMAL(12,2)) AS valor,
  CASE WHEN event_id % 3 = 0 THEN upper(' ' || tipo0) ELSE tipo0 END AS tipo,
  CASE WHEN event_id % 4 = 0 THEN upper(status0) ELSE status0 END AS status,
  CASE WHEN event_id % 6 = 0 THEN upper(canal0) || ' ' ELSE canal0 END AS canal,
  event_type AS descricao,
  CASE WHEN event_id % 211 = 0 THEN 'sem data' ELSE CAST(ts AS VARCHAR) END AS data_transacao,
  ts + to_seconds(event_id % 300) AS data_processamento,
  value > 150 AS is_fraude,
  CASE WHEN event_id % 97 = 0 THEN NULL
       ELSE CAST(least(cents * (1 + user_id % 8), 20000) * 0.00005 AS DECIMAL(7,5)) END AS score_fraude,
  '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.1' AS ip_origem,
  'device-' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS device_id
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents,
        CASE event_type WHEN 'purchase' THEN 'pix' WHEN 'click' THEN 'debito' WHEN 'view' THEN 'credito'
             WHEN 'signup' THEN 'ted' WHEN 'error' THEN 'boleto' END AS tipo0,
        CASE event_type WHEN 'purchase' THEN 'aprovada' WHEN 'click' THEN 'aprovada' WHEN 'view' THEN 'negada'
             WHEN 'signup' THEN 'cancelada' WHEN 'error' THEN 'suspeita' END AS status0,
        CASE event_id % 7 WHEN 0 THEN 'app' WHEN 1 THEN 'app' WHEN 2 THEN 'app' WHEN 3 THEN 'web'
             WHEN 4 THEN 'pos' WHEN 5 THEN 'atm' ELSE 'agencia' END AS canal0
      FROM events) e""",

    "bronze_comerciantes": r"""
SELECT s.s_suppkey AS id_comerciante, s.s_name AS nome,
  CASE s.s_suppkey % 3 WHEN 0 THEN 'varejo' WHEN 1 THEN 'servicos' ELSE 'alimentacao' END AS categoria,
  n.n_name AS cidade, n.n_name AS estado,
  substr(lpad(CAST(s.s_suppkey AS VARCHAR), 14, '0'), 1, 2) || '.' ||
  substr(lpad(CAST(s.s_suppkey AS VARCHAR), 14, '0'), 3, 3) || '.' ||
  substr(lpad(CAST(s.s_suppkey AS VARCHAR), 14, '0'), 6, 3) || '/' ||
  substr(lpad(CAST(s.s_suppkey AS VARCHAR), 14, '0'), 9, 4) || '-' ||
  substr(lpad(CAST(s.s_suppkey AS VARCHAR), 14, '0'), 13, 2) AS cnpj
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",

    "bronze_categorias": r"""
SELECT * FROM (VALUES
  (1, 'alimentacao', 'debito'), (2, 'transporte', 'debito'), (3, 'saude', 'debito'),
  (4, 'educacao', 'debito'), (5, 'lazer', 'debito'), (6, 'compras', 'debito'),
  (7, 'servicos', 'debito'), (8, 'transferencia', 'debito'), (9, 'saque', 'debito'),
  (10, 'salario', 'credito'), (11, 'pix_recebido', 'credito'), (12, 'estorno', 'credito'),
  (13, 'investimento', 'credito'), (14, 'outros', 'debito')) v(id_categoria, nome, tipo)""",

    # Multi-account layout: one account per order, transactions are line items.
    "bronze_contas_o": r"""
SELECT o_orderkey AS id_conta, o_custkey AS id_cliente,
  lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS numero_conta,
  CASE o_orderkey % 4 WHEN 0 THEN 'corrente' WHEN 1 THEN 'poupanca' WHEN 2 THEN 'investimento'
       ELSE 'cartao' END AS tipo_conta,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) * 0.01 AS DECIMAL(15,2)) AS saldo,
  CAST(0 AS DECIMAL(15,2)) AS limite, o_orderdate AS data_abertura, TRUE AS ativa
FROM orders""",

    "bronze_transacoes_o": r"""
SELECT l_orderkey * 8 + l_linenumber AS id_transacao, l_orderkey AS id_conta,
  CAST(l_partkey % 14 + 1 AS INTEGER) AS id_categoria, l_suppkey AS id_comerciante,
  CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 0.01 AS DECIMAL(12,2)) AS valor,
  CASE l_linenumber % 6 WHEN 0 THEN 'debito' WHEN 1 THEN 'credito' WHEN 2 THEN 'pix' WHEN 3 THEN 'ted'
       WHEN 4 THEN 'doc' ELSE 'boleto' END AS tipo,
  CASE WHEN l_returnflag = 'R' THEN 'suspeita' WHEN l_returnflag = 'A' THEN 'negada' ELSE 'aprovada' END AS status,
  CASE l_partkey % 5 WHEN 0 THEN 'app' WHEN 1 THEN 'web' WHEN 2 THEN 'pos' WHEN 3 THEN 'atm'
       ELSE 'agencia' END AS canal,
  l_returnflag AS descricao, l_shipdate AS data_transacao, l_shipdate AS data_processamento,
  (l_returnflag = 'R' AND l_discount >= 0.07) AS is_fraude,
  CAST(CAST(round(l_discount * 100) AS BIGINT) * 0.1 AS DECIMAL(7,5)) AS score_fraude,
  '10.0.0.1' AS ip_origem, 'device-' || CAST(l_suppkey AS VARCHAR) AS device_id
FROM lineitem""",
}

# --------------------------------------------------------------- Silver

STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
TITLE = (r"array_to_string(list_transform(regexp_extract_all(lower({x}), '\p{{L}}+|\P{{L}}+'), "
         r"lambda r: upper(r[1]) || r[2:]), '')")


def strip_sql(x: str) -> str:
    return STRIP.format(x=x)


def title_sql(x: str) -> str:
    return TITLE.format(x=x)


def faixa_sql(v: str) -> str:
    return (f"CASE WHEN {v} <= 0 THEN NULL WHEN {v} <= 50 THEN 'micro' WHEN {v} <= 200 THEN 'pequeno' "
            f"WHEN {v} <= 500 THEN 'medio' WHEN {v} <= 1000 THEN 'alto' WHEN {v} <= 5000 THEN 'muito_alto' "
            f"WHEN {v} > 5000 THEN 'critico' END")


SILVER = {
    "silver_clientes": f"""
SELECT id_cliente, {title_sql(strip_sql('nome'))} AS nome,
  regexp_replace(cpf, '[.\\-]', '', 'g') AS cpf, lower({strip_sql('email')}) AS email,
  data_nascimento, genero, {title_sql(strip_sql('cidade'))} AS cidade, {strip_sql('upper(estado)')} AS estado,
  coalesce(CAST(score_credito AS DOUBLE), (SELECT median(score_credito) FROM bronze_clientes)) AS score_credito,
  data_cadastro, ativo
FROM bronze_clientes""",

    "silver_contas": f"""
SELECT id_conta, id_cliente, numero_conta, {strip_sql('lower(tipo_conta)')} AS tipo_conta,
  coalesce(saldo, CAST(0 AS DECIMAL(15,2))) AS saldo, limite, data_abertura, ativa
FROM bronze_contas""",

    "silver_transacoes": f"""
SELECT id_transacao, id_conta, id_categoria, id_comerciante, abs(valor) AS valor,
  {strip_sql('lower(tipo)')} AS tipo, {strip_sql('lower(status)')} AS status,
  {strip_sql('lower(canal)')} AS canal, descricao, dt AS data_transacao,
  TRY_CAST(data_processamento AS TIMESTAMP) AS data_processamento, is_fraude,
  coalesce(score_fraude, CAST(0 AS DECIMAL(7,5))) AS score_fraude, ip_origem, device_id,
  {faixa_sql('abs(valor)')} AS faixa_valor,
  NOT (extract(hour FROM dt) BETWEEN 8 AND 18) AS fora_horario_comercial
FROM (SELECT *, TRY_CAST(data_transacao AS TIMESTAMP) AS dt FROM bronze_transacoes) b
WHERE dt IS NOT NULL""",

    "silver_contas_o": f"""
SELECT id_conta, id_cliente, numero_conta, {strip_sql('lower(tipo_conta)')} AS tipo_conta,
  coalesce(saldo, CAST(0 AS DECIMAL(15,2))) AS saldo, limite, data_abertura, ativa
FROM bronze_contas_o""",

    "silver_transacoes_o": f"""
SELECT id_transacao, id_conta, id_categoria, id_comerciante, abs(valor) AS valor,
  {strip_sql('lower(tipo)')} AS tipo, {strip_sql('lower(status)')} AS status,
  {strip_sql('lower(canal)')} AS canal, descricao, data_transacao, data_processamento, is_fraude,
  coalesce(score_fraude, CAST(0 AS DECIMAL(7,5))) AS score_fraude, ip_origem, device_id,
  {faixa_sql('abs(valor)')} AS faixa_valor,
  NOT (extract(hour FROM data_transacao) BETWEEN 8 AND 18) AS fora_horario_comercial
FROM bronze_transacoes_o WHERE data_transacao IS NOT NULL""",

    "silver_comerciantes": "SELECT * FROM bronze_comerciantes",
    "silver_categorias": "SELECT * FROM bronze_categorias",
}

DEPENDS = {
    "silver_clientes": ["bronze_clientes"],
    "silver_contas": ["bronze_contas"],
    "silver_transacoes": ["bronze_transacoes"],
    "silver_contas_o": ["bronze_contas_o"],
    "silver_transacoes_o": ["bronze_transacoes_o"],
    "silver_comerciantes": ["bronze_comerciantes"],
    "silver_categorias": ["bronze_categorias"],
}

ALL_CTES = {**BRONZE, **SILVER}


def with_ctes(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding ``names`` (and their dependencies) followed by ``body``."""
    extra = extra or {}
    ordered: list[str] = []

    def add(n: str) -> None:
        if n in ordered:
            return
        for d in DEPENDS.get(n, []):
            add(d)
        ordered.append(n)

    for n in names:
        add(n)
    defs = {**ALL_CTES, **extra}
    parts = [f"{n} AS ({defs[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
