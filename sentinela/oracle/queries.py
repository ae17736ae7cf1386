"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

from sentinela.oracle.sql import ALL_CTES, strip_sql, title_sql, with_ctes

ORACLE: dict[str, str] = {}


def _avg(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / COUNT({x})"


# The marts are computed here from whole groups: every group's rows are gathered in a list ``r`` and each
# measure is a list expression over it, which shares nothing with the partial aggregates of the Spark plan.

def _pick(field: str, condition: str = "") -> str:
    """Non-NULL values of a field in the group's rows."""
    return f"[x.{field} FOR x IN r IF x.{field} IS NOT NULL{' AND ' + condition if condition else ''}]"


def _sum2(values: str) -> str:
    return f"CAST(round(list_sum({values}), 2) AS DOUBLE)"


def _mean(values: str, digits: int | None = None) -> str:
    mean = f"CAST(list_sum({values}) AS DOUBLE) / nullif(len({values}), 0)"
    return mean if digits is None else f"round({mean}, {digits})"


def _share(part: str, digits: int) -> str:
    return f"round({part} * 100.0 / len(r), {digits})"


FRAUDS = "len([1 FOR x IN r IF x.is_fraude])"
ACCOUNTS = "len(list_distinct(" + _pick("id_conta") + "))"
OFF_HOURS = "len([1 FOR x IN r IF x.fora_horario_comercial])"


def _facts(sfx: str, holder_fields: str) -> dict[str, str]:
    """Transactions with the account holder's columns."""
    return {"titular": f"SELECT id_conta, {holder_fields} FROM silver_contas{sfx} JOIN silver_clientes USING (id_cliente)",
            "fato": f"SELECT * FROM silver_transacoes{sfx} JOIN titular USING (id_conta)"}


def mart_estado(sfx: str = "") -> str:
    groups = {"grupos": "SELECT estado, list(fato) AS r FROM fato GROUP BY estado"}
    return with_ctes([f"silver_transacoes{sfx}", f"silver_contas{sfx}", "silver_clientes"], f"""
SELECT estado, len(r) AS total_transacoes, {FRAUDS} AS total_fraudes, {_share(FRAUDS, 2)} AS pct_fraude,
  {_sum2(_pick('valor'))} AS valor_total,
  coalesce({_sum2(_pick('valor', 'x.is_fraude'))}, 0.0) AS valor_fraudes,
  {_mean(_pick('score_fraude'), 4)} AS score_fraude_medio, {_mean(_pick('valor'), 2)} AS ticket_medio
FROM grupos""", {**_facts(sfx, "estado"), **groups})


def mart_hora(sfx: str = "") -> str:
    return with_ctes([f"silver_transacoes{sfx}"], f"""
SELECT hora_dia, len(r) AS total_transacoes, {FRAUDS} AS total_fraudes, {_mean(_pick('valor'), 2)} AS ticket_medio,
  {_sum2(_pick('valor'))} AS volume_total, {_share(FRAUDS, 2)} AS pct_fraude, {ACCOUNTS} AS contas_ativas
FROM grupos""", {"grupos": f"SELECT hour(data_transacao) AS hora_dia, list(t) AS r FROM silver_transacoes{sfx} t GROUP BY ALL"})


def mart_risco(sfx: str = "") -> str:
    score = _mean(_pick("score_fraude"))
    groups = {"grupos": "SELECT id_cliente, nome, estado, score_credito, list(fato) AS r FROM fato GROUP BY ALL",
              "medidas": f"SELECT *, {score} AS media, {FRAUDS} AS fraudes, {OFF_HOURS} AS fora FROM grupos"}
    return with_ctes([f"silver_transacoes{sfx}", f"silver_contas{sfx}", "silver_clientes"], f"""
SELECT id_cliente, nome, estado, score_credito, len(r) AS total_transacoes, fraudes AS total_fraudes,
  {_sum2(_pick('valor'))} AS volume_total, {_mean(_pick('valor'), 2)} AS ticket_medio,
  CAST(round(list_max({_pick('valor')}), 2) AS DOUBLE) AS maior_transacao, round(media, 4) AS score_fraude_medio,
  {ACCOUNTS} AS qtd_contas, fora AS transacoes_fora_horario,
  round(media * 40 + fraudes * 5 + fora * 0.5, 2) AS score_risco_composto,
  (['BAIXO', 'MEDIO', 'ALTO', 'CRITICO'])[1 + len([1 FOR b IN [0.2, 0.4, 0.7] IF media > b])] AS classificacao_risco
FROM medidas""", {**_facts(sfx, "id_cliente, nome, estado, score_credito"), **groups})


def mart_diario(sfx: str = "") -> str:
    def tally(counts: str, value: str) -> str:
        return f"CAST(coalesce({counts}['{value}'], 0) AS BIGINT)"
    return with_ctes([f"silver_transacoes{sfx}"], f"""
SELECT data, len(r) AS total_transacoes, {ACCOUNTS} AS contas_ativas, {_sum2(_pick('valor'))} AS volume_total,
  {_mean(_pick('valor'), 2)} AS ticket_medio, {FRAUDS} AS total_fraudes,
  {tally('por_status', 'aprovada')} AS aprovadas, {tally('por_status', 'negada')} AS negadas,
  {tally('por_status', 'cancelada')} AS canceladas, {tally('por_status', 'suspeita')} AS suspeitas,
  {tally('por_canal', 'app')} AS via_app, {tally('por_canal', 'web')} AS via_web, {tally('por_canal', 'pos')} AS via_pos,
  {_share(FRAUDS, 4)} AS taxa_fraude_pct
FROM grupos""", {"grupos": f"""
SELECT CAST(data_transacao AS DATE) AS data, list(t) AS r, histogram(status) AS por_status, histogram(canal) AS por_canal
FROM silver_transacoes{sfx} t GROUP BY ALL"""})


def _over(mart_sql: str, name: str, body: str) -> str:
    """Wrap a mart statement as a CTE named ``name`` and query it."""
    head, _, tail = mart_sql.rpartition("\nSELECT")
    return f"{head},\n{name} AS (SELECT{tail})\n{body}"


ORACLE["gold_fraude_estado"] = mart_estado()
ORACLE["gold_por_hora"] = mart_hora()
ORACLE["gold_perfil_risco"] = mart_risco()
ORACLE["gold_diario"] = mart_diario()
ORACLE["gold_fraude_estado_multi"] = mart_estado("_o")
ORACLE["gold_perfil_risco_multi"] = mart_risco("_o")
ORACLE["gold_diario_multi"] = mart_diario("_o")


def _first(order: str, n: int = 1) -> str:
    return f"QUALIFY row_number() OVER (ORDER BY {order}) <= {n}"


ORACLE["insight_top_estados"] = _over(mart_estado(), "m1", f"""
SELECT estado, pct_fraude, total_fraudes, valor_fraudes FROM m1 {_first('pct_fraude DESC, estado', 3)}""")
ORACLE["insight_hora_risco"] = _over(mart_hora(), "m2", f"""
SELECT hora_dia, pct_fraude, total_transacoes FROM m2 {_first('pct_fraude DESC, hora_dia')}""")
ORACLE["insight_criticos"] = _over(mart_risco(), "m3", """
SELECT len(s) AS clientes_criticos, round(list_avg(s), 2) AS score_medio
FROM (SELECT coalesce(list(score_risco_composto) FILTER (classificacao_risco = 'CRITICO'), []) AS s FROM m3)""")
ORACLE["insight_melhor_dia"] = _over(mart_diario(), "m4", f"""
SELECT data, volume_total, total_transacoes, taxa_fraude_pct FROM m4 {_first('volume_total DESC, data')}""")


# ------------------------------------------------------------------ cleaning

def _q(names, body, extra=None):
    return with_ctes(names, body, extra)


SILVER_T_COLS = ("id_transacao, id_conta, id_categoria, id_comerciante, valor, tipo, status, canal, descricao, "
                 "data_transacao, data_processamento, is_fraude, score_fraude, ip_origem, device_id, faixa_valor, "
                 "fora_horario_comercial")

ORACLE["clean_clientes"] = _q(["silver_clientes"], "SELECT * FROM silver_clientes")
ORACLE["clean_transacoes"] = _q(["silver_transacoes"], f"SELECT {SILVER_T_COLS} FROM silver_transacoes")
ORACLE["clean_contas"] = _q(["silver_contas"], "SELECT * FROM silver_contas")
ORACLE["clean_generic"] = _q(["silver_comerciantes"], "SELECT * FROM silver_comerciantes")
ORACLE["bronze_audit"] = _q(["bronze_clientes"], """
SELECT *, 'postgresql://financeiro_source' AS _fonte, 'clientes' AS _tabela_origem FROM bronze_clientes""")
ORACLE["scan_full_load"] = _q(["bronze_transacoes"], """
SELECT *, 'postgresql://financeiro_source' AS _fonte, 'transacoes' AS _tabela_origem FROM bronze_transacoes""")
ORACLE["drop_audit"] = _q(["bronze_contas"], "SELECT * FROM bronze_contas")
ORACLE["drop_invalid_dates"] = _q(["bronze_transacoes"], """
SELECT id_transacao, data_transacao FROM bronze_transacoes WHERE TRY_CAST(data_transacao AS TIMESTAMP) IS NULL""")
ORACLE["apply_defaults"] = _q(["bronze_contas"], """
SELECT id_conta, coalesce(saldo, CAST(0 AS DECIMAL(15,2))) AS saldo, coalesce(limite, CAST(0 AS DECIMAL(15,2))) AS limite,
  coalesce(ativa, TRUE) AS ativa FROM bronze_contas""")

# ------------------------------------------------------------------ quality


def _problems(*items: str) -> str:
    return "array_to_string(list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL), ' | ')"


def _problem(n: str, fmt: str, *extra: str) -> str:
    args = ", ".join([n, *extra])
    return f"CASE WHEN {n} > 0 THEN printf('{fmt}', {args}) END"


Q_CLIENTES = f"""
SELECT 'clientes' AS tabela, n AS total_original, n AS total_silver, CAST(0 AS BIGINT) AS removidos,
  {_problems(_problem('n_cpf', '%d CPFs com tamanho inválido'),
             _problem('n_null', '%d scores preenchidos com mediana (%d)', 'CAST(round_even(med, 0) AS BIGINT)'))}
    AS problemas,
  CAST(NULL AS BIGINT) AS fraudes, CAST(NULL AS DOUBLE) AS valor_total, CAST(NULL AS DOUBLE) AS valor_medio
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n,
        CAST(SUM(CASE WHEN coalesce(length(regexp_replace(cpf, '[.\\-]', '', 'g')), -1) <> 11 THEN 1 ELSE 0 END)
             AS BIGINT) AS n_cpf,
        CAST(SUM(CASE WHEN score_credito IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
        median(score_credito) AS med FROM bronze_clientes) q"""

Q_TRANSACOES = f"""
SELECT 'transacoes' AS tabela, n AS total_original, kept AS total_silver, n - kept AS removidos,
  {_problems(_problem('bad', '%d datas inválidas encontradas'),
             _problem('neg', '%d valores negativos convertidos para positivo'),
             _problem('zero', '%d transações com valor zero'))} AS problemas,
  fraudes, CAST(soma AS DOUBLE) AS valor_total, CAST(soma AS DOUBLE) / nv AS valor_medio
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n,
        CAST(SUM(CASE WHEN dt IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad,
        CAST(SUM(CASE WHEN dt IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS kept,
        CAST(SUM(CASE WHEN dt IS NOT NULL AND valor < 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg,
        CAST(SUM(CASE WHEN dt IS NOT NULL AND valor = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero,
        CAST(SUM(CASE WHEN dt IS NOT NULL AND is_fraude THEN 1 ELSE 0 END) AS BIGINT) AS fraudes,
        SUM(CASE WHEN dt IS NOT NULL THEN abs(valor) END) AS soma,
        COUNT(CASE WHEN dt IS NOT NULL THEN valor END) AS nv
      FROM (SELECT *, TRY_CAST(data_transacao AS TIMESTAMP) AS dt FROM bronze_transacoes) b) q"""

Q_CONTAS = f"""
SELECT 'contas' AS tabela, n AS total_original, n AS total_silver, CAST(0 AS BIGINT) AS removidos,
  {_problems(_problem('nulls', '%d saldos nulos preenchidos com 0'))} AS problemas,
  CAST(NULL AS BIGINT) AS fraudes, CAST(NULL AS DOUBLE) AS valor_total, CAST(NULL AS DOUBLE) AS valor_medio
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n,
        CAST(SUM(CASE WHEN saldo IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls FROM bronze_contas) q"""


def _q_generic(table: str, cte: str) -> str:
    return f"""
SELECT '{table}' AS tabela, CAST(COUNT(*) AS BIGINT) AS total_original, CAST(COUNT(*) AS BIGINT) AS total_silver,
  CAST(0 AS BIGINT) AS removidos, '' AS problemas, CAST(NULL AS BIGINT) AS fraudes,
  CAST(NULL AS DOUBLE) AS valor_total, CAST(NULL AS DOUBLE) AS valor_medio FROM {cte}"""


ORACLE["quality_clientes"] = _q(["bronze_clientes"], Q_CLIENTES)
ORACLE["quality_transacoes"] = _q(["bronze_transacoes"], Q_TRANSACOES)
ORACLE["quality_contas"] = _q(["bronze_contas"], Q_CONTAS)
ORACLE["quality_report"] = _q(
    ["bronze_clientes", "bronze_contas", "bronze_transacoes", "bronze_comerciantes", "bronze_categorias"],
    "\nUNION ALL\n".join([Q_CLIENTES, Q_CONTAS, Q_TRANSACOES, _q_generic("comerciantes", "bronze_comerciantes"),
                          _q_generic("categorias_transacao", "bronze_categorias")]))


def _count_rows(table: str, cte: str, checks: dict[str, str], value: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS tabela, '{col}' AS coluna, CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
        f" AS {value} FROM {cte}" for col, cond in checks.items())


def _in(col: str, values: list[str]) -> str:
    return f"{col} IS NOT NULL AND {col} NOT IN (" + ", ".join(f"'{v}'" for v in values) + ")"


ORACLE["audit_domains"] = _q(["silver_clientes", "silver_contas", "silver_categorias", "silver_transacoes"],
                             "\nUNION ALL\n".join([
    _count_rows("clientes", "silver_clientes", {
        "genero": _in("genero", ["M", "F", "O"]),
        "score_credito": "score_credito IS NOT NULL AND NOT (score_credito BETWEEN 0 AND 1000)"}, "violacoes"),
    _count_rows("contas", "silver_contas", {
        "tipo_conta": _in("tipo_conta", ["corrente", "poupanca", "investimento", "cartao"])}, "violacoes"),
    _count_rows("categorias_transacao", "silver_categorias", {"tipo": _in("tipo", ["debito", "credito"])},
                "violacoes"),
    _count_rows("transacoes", "silver_transacoes", {
        "tipo": _in("tipo", ["debito", "credito", "pix", "ted", "doc", "boleto"]),
        "status": _in("status", ["aprovada", "negada", "cancelada", "pendente", "suspeita"]),
        "canal": _in("canal", ["app", "web", "pos", "atm", "agencia"]),
        "score_fraude": "score_fraude IS NOT NULL AND NOT (score_fraude BETWEEN 0 AND 1)"}, "violacoes"),
]))

NOT_NULL_SQL = {
    ("clientes", "bronze_clientes"): ["id_cliente", "nome", "cpf", "email", "data_nascimento"],
    ("contas", "bronze_contas"): ["id_conta", "id_cliente", "numero_conta", "tipo_conta"],
    ("comerciantes", "bronze_comerciantes"): ["id_comerciante", "nome"],
    ("categorias_transacao", "bronze_categorias"): ["id_categoria", "nome", "tipo"],
    ("transacoes", "bronze_transacoes"): ["id_transacao", "id_conta", "valor", "tipo", "status", "data_transacao"],
}
ORACLE["audit_not_null"] = _q([cte for _, cte in NOT_NULL_SQL], "\nUNION ALL\n".join(
    _count_rows(t, cte, {c: f"{c} IS NULL" for c in cols}, "nulos") for (t, cte), cols in NOT_NULL_SQL.items()))

UNIQUE_SQL = {
    ("clientes", "silver_clientes"): ["id_cliente", "cpf", "email"],
    ("contas", "silver_contas"): ["id_conta", "numero_conta"],
    ("comerciantes", "silver_comerciantes"): ["id_comerciante", "cnpj"],
    ("categorias_transacao", "silver_categorias"): ["id_categoria", "nome"],
    ("transacoes", "silver_transacoes"): ["id_transacao"],
}
ORACLE["audit_unique"] = _q([cte for _, cte in UNIQUE_SQL], "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, '{c}' AS coluna, CAST(COUNT(*) AS BIGINT) AS chaves_duplicadas, "
    f"CAST(coalesce(SUM(n), 0) AS BIGINT) AS linhas_duplicadas FROM "
    f"(SELECT {c}, COUNT(*) AS n FROM {cte} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1) d"
    for (t, cte), cols in UNIQUE_SQL.items() for c in cols))

ORACLE["audit_unique_multi"] = _q(["silver_contas_o", "silver_transacoes_o"], "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, '{c}' AS coluna, CAST(COUNT(*) AS BIGINT) AS chaves_duplicadas, "
    f"CAST(coalesce(SUM(len(r)), 0) AS BIGINT) AS linhas_duplicadas FROM "
    f"(SELECT list({c}) AS r FROM silver_{t}_o WHERE {c} IS NOT NULL GROUP BY {c}) d WHERE len(r) > 1"
    for t, c in (("contas", "id_conta"), ("contas", "numero_conta"), ("transacoes", "id_transacao"))))

FK_SQL = [("contas", "id_cliente", "clientes", "id_cliente", "silver_contas", "silver_clientes"),
          ("transacoes", "id_conta", "contas", "id_conta", "silver_transacoes", "silver_contas"),
          ("transacoes", "id_categoria", "categorias_transacao", "id_categoria", "silver_transacoes",
           "silver_categorias"),
          ("transacoes", "id_comerciante", "comerciantes", "id_comerciante", "silver_transacoes",
           "silver_comerciantes")]
ORACLE["audit_fk_orphans"] = _q(
    ["silver_contas", "silver_clientes", "silver_transacoes", "silver_categorias", "silver_comerciantes"],
    "\nUNION ALL\n".join(
        f"SELECT '{ct}.{cc}->{pt}.{pc}' AS relacao, CAST(COUNT(DISTINCT c.{cc}) AS BIGINT) AS chaves_orfas, "
        f"CAST(COUNT(*) AS BIGINT) AS linhas_orfas FROM {ccte} c WHERE c.{cc} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {pcte} p WHERE p.{pc} = c.{cc})" for ct, cc, pt, pc, ccte, pcte in FK_SQL))

# ------------------------------------------------------------------ scalar functions

ORACLE["str_strip"] = _q(["bronze_clientes"], f"""
SELECT id_cliente, nome AS nome_bruto, {strip_sql('nome')} AS nome FROM bronze_clientes""")
ORACLE["str_title"] = _q(["bronze_clientes"], f"""
SELECT id_cliente, {title_sql(strip_sql('nome'))} AS nome, {title_sql(strip_sql('cidade'))} AS cidade
FROM bronze_clientes""")
ORACLE["str_case"] = _q(["bronze_clientes"], f"""
SELECT id_cliente, lower({strip_sql('email')}) AS email, {strip_sql('upper(estado)')} AS estado FROM bronze_clientes""")
ORACLE["str_cpf_digits"] = _q(["bronze_clientes"], """
SELECT id_cliente, cpf AS cpf_bruto, regexp_replace(cpf, '[.\\-]', '', 'g') AS cpf,
  coalesce(length(regexp_replace(cpf, '[.\\-]', '', 'g')), -1) <> 11 AS cpf_invalido FROM bronze_clientes""")
ORACLE["null_fill"] = _q(["silver_contas"], "SELECT id_conta, saldo FROM silver_contas")
ORACLE["median_fill"] = _q(["silver_clientes"], "SELECT id_cliente, score_credito FROM silver_clientes")
ORACLE["agg_median"] = _q(["bronze_clientes"], "SELECT median(score_credito) AS mediana_score FROM bronze_clientes")
ORACLE["ts_coerce"] = _q(["bronze_transacoes"], """
SELECT id_transacao, data_transacao AS texto, TRY_CAST(data_transacao AS TIMESTAMP) AS data_transacao
FROM bronze_transacoes""")
ORACLE["math_abs"] = _q(["bronze_transacoes"], """
SELECT id_transacao, valor AS valor_bruto, abs(valor) AS valor FROM bronze_transacoes""")
ORACLE["faixa_valor"] = _q(["silver_transacoes", "silver_transacoes_o"], """
SELECT 'events' AS layout, id_transacao, valor, faixa_valor FROM silver_transacoes
UNION ALL
SELECT 'orders' AS layout, id_transacao, valor, faixa_valor FROM silver_transacoes_o""")
ORACLE["fora_horario"] = _q(["silver_transacoes"], """
SELECT id_transacao, CAST(extract(hour FROM data_transacao) AS BIGINT) AS hora, fora_horario_comercial
FROM silver_transacoes""")
ORACLE["dk_round"] = """
SELECT event_id, ROUND(value / 7, 2) AS r2, ROUND(value / 7, 4) AS r4, ROUND(value * 1.005, 0) AS r0,
  ROUND(-value / 3, 1) AS rneg FROM events"""
ORACLE["partition_cols"] = _q(["silver_transacoes"], """
SELECT id_transacao, strftime(data_transacao, '%Y') AS ano, strftime(data_transacao, '%m') AS mes,
  strftime(data_transacao, '%d') AS dia FROM silver_transacoes""")
ORACLE["json_roundtrip"] = _q(["silver_transacoes"], """
SELECT lpad(CAST(id_transacao AS VARCHAR), 12, '0') AS evento_id, id_conta, CAST(valor AS DOUBLE) AS valor, tipo,
  status, CAST(score_fraude AS DOUBLE) AS score_fraude FROM silver_transacoes""")

# ------------------------------------------------------------------ aggregates

ORACLE["agg_count"] = _q(["silver_transacoes"], """
SELECT CAST(COUNT(*) AS BIGINT) AS linhas, CAST(COUNT(id_comerciante) AS BIGINT) AS com_comerciante
FROM silver_transacoes""")
ORACLE["count_fraudes"] = _q(["silver_transacoes"], """
SELECT CAST(COUNT(*) AS BIGINT) AS fraudes FROM silver_transacoes WHERE is_fraude = TRUE""")
ORACLE["agg_basic"] = _q(["silver_transacoes"], f"""
SELECT tipo, CAST(ROUND(SUM(valor), 2) AS DOUBLE) AS soma, ROUND({_avg('valor')}, 2) AS media,
  CAST(ROUND(MAX(valor), 2) AS DOUBLE) AS maximo FROM silver_transacoes GROUP BY tipo""")
ORACLE["agg_conditional"] = _q(["silver_transacoes"], """
SELECT canal, CAST(SUM(CASE WHEN is_fraude THEN 1 ELSE 0 END) AS BIGINT) AS fraudes,
  CAST(ROUND(SUM(CASE WHEN is_fraude THEN valor ELSE 0 END), 2) AS DOUBLE) AS valor_fraudes
FROM silver_transacoes GROUP BY canal""")
ORACLE["agg_distinct"] = _q(["silver_transacoes"], """
SELECT status, CAST(COUNT(*) AS BIGINT) AS linhas, CAST(COUNT(DISTINCT id_conta) AS BIGINT) AS contas
FROM silver_transacoes GROUP BY status""")
ORACLE["agg_ratio"] = _q(["silver_transacoes"], """
SELECT tipo, ROUND(SUM(CASE WHEN is_fraude THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS pct2,
  ROUND(SUM(CASE WHEN is_fraude THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 4) AS pct4
FROM silver_transacoes GROUP BY tipo""")
ORACLE["risk_score"] = _over(mart_risco(), "m3", "SELECT id_cliente, score_risco_composto FROM m3")
ORACLE["risk_class"] = _over(mart_risco(), "m3", "SELECT id_cliente, classificacao_risco FROM m3")
# Categories and merchants are looked up in maps, accounts in their holders' table.
ORACLE["vw_transacoes_completa"] = _q(
    ["silver_transacoes", "silver_contas", "silver_clientes", "silver_categorias", "silver_comerciantes"], """
SELECT id_transacao, data_transacao, valor, tipo, status, canal, is_fraude, score_fraude, numero_conta, tipo_conta,
  nome_cliente, cidade_cliente, estado_cliente, score_credito, categorias[id_categoria] AS categoria,
  comerciantes[id_comerciante] AS comerciante
FROM silver_transacoes JOIN titular USING (id_conta), nomes""", {
        "titular": """
SELECT id_conta, numero_conta, tipo_conta, nome AS nome_cliente, cidade AS cidade_cliente, estado AS estado_cliente,
  score_credito FROM silver_contas JOIN silver_clientes USING (id_cliente)""",
        "nomes": """
SELECT (SELECT map(list(id_categoria), list(nome)) FROM silver_categorias) AS categorias,
  (SELECT map(list(id_comerciante), list(nome)) FROM silver_comerciantes) AS comerciantes"""})

# ------------------------------------------------------------------ fraud rules

EVENTS_CTE = """
SELECT lpad(CAST(id_transacao AS VARCHAR), 12, '0') AS evento_id, data_transacao AS event_ts, id_conta,
  CAST(valor AS DOUBLE) AS valor, tipo, status, canal, is_fraude, CAST(score_fraude AS DOUBLE) AS score_fraude,
  ip_origem, device_id, descricao, id_comerciante FROM {src}"""


def _events_q(body: str, layout: str = "events", extra: dict | None = None) -> str:
    src = "silver_transacoes" if layout == "events" else "silver_transacoes_o"
    return with_ctes([src], body, {"ev": EVENTS_CTE.format(src=src), **(extra or {})})


SCORE_TXT = "printf('Score %s acima do limite 0.65', CAST(score_fraude AS VARCHAR))"
VALOR_TXT = "printf('Transação de R$ %s acima do limite', format('{:,.2f}', valor))"


def trailing_sql(key: str, seconds: int) -> str:
    w = seconds * 1_000_000 - 1
    return (f"COUNT(*) OVER (PARTITION BY {key} ORDER BY epoch_us(event_ts) RANGE BETWEEN {w} PRECEDING AND CURRENT ROW)"
            f" - COUNT(*) OVER (PARTITION BY {key}, epoch_us(event_ts))"
            f" + ROW_NUMBER() OVER (PARTITION BY {key}, epoch_us(event_ts) ORDER BY evento_id)")


ORACLE["rule_score"] = _events_q(f"SELECT evento_id, score_fraude, {SCORE_TXT} AS descricao FROM ev "
                                 "WHERE score_fraude > 0.65")
ORACLE["rule_valor"] = _events_q(f"SELECT evento_id, valor, {VALOR_TXT} AS descricao FROM ev WHERE valor > 5000.00",
                                 "orders")
ORACLE["rule_status"] = _events_q("SELECT evento_id, status FROM ev WHERE status = 'suspeita'")
ORACLE["filter_suspeitas"] = _events_q("SELECT evento_id, valor, score_fraude FROM ev "
                                       "WHERE score_fraude > 0.65 OR valor > 5000.00")
ORACLE["rule_descriptions"] = _events_q(f"SELECT evento_id, {SCORE_TXT} AS texto_score, {VALOR_TXT} AS texto_valor "
                                        "FROM ev", "orders")
ORACLE["velocity_trailing"] = _events_q(f"SELECT evento_id, descricao AS chave, {trailing_sql('descricao', 3600)} "
                                        "AS janela_n FROM ev")
ORACLE["rule_velocity"] = _events_q(f"""
SELECT evento_id, id_conta, janela_n, janela_n > 5 AS alerta
FROM (SELECT evento_id, id_conta, {trailing_sql('id_conta', 60)} AS janela_n FROM ev) v""")


def alerts_sql(key: str, seconds: int, sfx: str = "") -> dict:
    """CTEs producing one row per (alerting event, fired rule)."""
    return {
        "counted": f"SELECT *, {trailing_sql(key, seconds)} AS janela_n, ROW_NUMBER() OVER () AS linha FROM ev",
        "fired": f"""
SELECT linha, evento_id, id_conta, valor, tipo, score_fraude, id_comerciante, r.ordem0, r.regra, r.descricao, r.severidade
FROM counted, LATERAL (VALUES
  (1, CASE WHEN score_fraude > 0.65 THEN 'SCORE_FRAUDE_ALTO' END, {SCORE_TXT}, 'ALTA'),
  (2, CASE WHEN valor > 5000.00 THEN 'VALOR_SUSPEITO' END, {VALOR_TXT}, 'MEDIA'),
  (3, CASE WHEN janela_n > 5 THEN 'VELOCITY_CHECK' END,
      printf('Conta %d com %d transações no último minuto', id_conta, janela_n), 'ALTA'),
  (4, CASE WHEN status = 'suspeita' THEN 'STATUS_SUSPEITA' END,
      'Transação marcada como suspeita pelo sistema de origem', 'ALTA')) r(ordem0, regra, descricao, severidade)
WHERE r.regra IS NOT NULL""",
        "docs": """
SELECT f.*, cl.estado AS estado,
  CAST(ROW_NUMBER() OVER (PARTITION BY f.linha ORDER BY f.ordem0) - 1 AS BIGINT) AS ordem
FROM fired f
LEFT JOIN (SELECT co.id_conta, cl.estado FROM silver_contas{sfx} co JOIN silver_clientes cl
           ON co.id_cliente = cl.id_cliente) cl ON f.id_conta = cl.id_conta""".replace("{sfx}", sfx),
    }


def _alerts_q(body: str, key: str = "id_conta", seconds: int = 60, sfx: str = "") -> str:
    return with_ctes([f"silver_transacoes{sfx}", f"silver_contas{sfx}", "silver_clientes"], body,
                     {"ev": EVENTS_CTE.format(src=f"silver_transacoes{sfx}"), **alerts_sql(key, seconds, sfx)})


ALERT_COLS = "evento_id, id_conta, valor, tipo, estado, score_fraude, ordem, regra, descricao, severidade"
ORACLE["alert_documents"] = _alerts_q(f"SELECT {ALERT_COLS} FROM docs")
ORACLE["alert_velocity_by_type"] = _alerts_q(f"SELECT {ALERT_COLS} FROM docs", "descricao", 3600)
ORACLE["rule_names"] = _alerts_q("SELECT evento_id, string_agg(regra, ' | ' ORDER BY ordem) AS regras "
                                 "FROM docs GROUP BY evento_id")


# ------------------------------------------------------------------ lake I/O

ORACLE["write_read_roundtrip"] = _q(["silver_transacoes"], """
SELECT '2026' AS ano, '06' AS mes, '04' AS dia, 2 AS _versao, CAST(COUNT(*) AS BIGINT) AS linhas,
  CAST(ROUND(SUM(valor), 2) AS DOUBLE) AS valor_total FROM silver_transacoes
UNION ALL
SELECT '2026', '06', '05', 2, CAST(COUNT(*) AS BIGINT), CAST(ROUND(SUM(valor), 2) AS DOUBLE) FROM silver_transacoes""")
ORACLE["median_valor"] = _q(["bronze_transacoes_o"], """
SELECT median(CAST(valor AS DOUBLE)) AS mediana_valor FROM bronze_transacoes_o""")
ORACLE["backfill_days"] = _q(["silver_transacoes"], """
SELECT strftime(data_transacao, '%Y') AS ano, strftime(data_transacao, '%m') AS mes, strftime(data_transacao, '%d') AS dia,
  CASE WHEN dayofweek(data_transacao) IN (0, 6) THEN 2 ELSE 1 END AS _versao, CAST(COUNT(*) AS BIGINT) AS linhas,
  CAST(ROUND(SUM(valor), 2) AS DOUBLE) AS valor_total
FROM silver_transacoes GROUP BY ALL""")
ORACLE["incremental_estado"] = mart_estado()
ORACLE["incremental_hora"] = mart_hora()
ORACLE["incremental_risco_multi"] = mart_risco("_o")
ORACLE["incremental_diario_multi"] = mart_diario("_o")
ORACLE["gold_tables"] = mart_diario()
ORACLE["distinct_monthly"] = _q(["silver_transacoes_o"], """
SELECT strftime(data_transacao, '%Y-%m') AS mes, CAST(COUNT(DISTINCT id_conta) AS BIGINT) AS contas,
  CAST(COUNT(DISTINCT tipo) AS BIGINT) AS tipos
FROM silver_transacoes_o GROUP BY ALL""")
ORACLE["incremental_load"] = _q(["bronze_transacoes"], """
SELECT t.*, CASE WHEN id_transacao <= lo + (hi - lo) // 4 THEN '04' WHEN id_transacao <= lo + (hi - lo) * 3 // 4 THEN '05'
  ELSE '06' END AS dia
FROM bronze_transacoes t, (SELECT MIN(id_transacao) AS lo, MAX(id_transacao) AS hi FROM bronze_transacoes)""")
ORACLE["union_snapshots"] = _q(["bronze_clientes"], """
SELECT *, CAST(NULL AS INTEGER) AS _lote FROM bronze_clientes
UNION ALL
SELECT *, 2 AS _lote FROM bronze_clientes""")
ORACLE["latest_snapshot"] = _q(["bronze_contas"], "SELECT *, 2 AS _lote FROM bronze_contas")

_MANIFEST_PARTS = [("clientes", "bronze_clientes", 14), ("contas", "bronze_contas", 11),
                   ("comerciantes", "bronze_comerciantes", 9), ("categorias_transacao", "bronze_categorias", 6),
                   ("transacoes", "bronze_transacoes", 18)]
_MANIFEST = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, CAST(COUNT(*) AS BIGINT) AS linhas, {n} AS colunas, 'sucesso' AS status FROM {cte}"
    for t, cte, n in _MANIFEST_PARTS)
ORACLE["ingest_manifest"] = _q([c for _, c, _ in _MANIFEST_PARTS], _MANIFEST)
ORACLE["ingest_totals"] = _q([c for _, c, _ in _MANIFEST_PARTS], f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_tabelas,
  CAST(SUM(CASE WHEN status = 'sucesso' THEN 1 ELSE 0 END) AS BIGINT) AS total_sucesso,
  CAST(SUM(CASE WHEN status = 'erro' THEN 1 ELSE 0 END) AS BIGINT) AS total_erro,
  CAST(SUM(linhas) AS BIGINT) AS total_linhas FROM ({_MANIFEST}) m""")
ORACLE["silver_run_report"] = ORACLE["quality_report"]
ORACLE["gold_export_estado"] = ORACLE["gold_fraude_estado"]


def _gold_counts() -> str:
    parts = []
    for name, sql, ncols in [("gold_resumo_fraudes_por_estado", mart_estado(), 9),
                             ("gold_transacoes_por_hora", mart_hora(), 8),
                             ("gold_perfil_risco_cliente", mart_risco(), 15),
                             ("gold_resumo_executivo_diario", mart_diario(), 15)]:
        head, _, tail = sql.rpartition("\nSELECT")
        parts.append(f"SELECT '{name}' AS tabela, CAST(COUNT(*) AS BIGINT) AS linhas, "
                     f"CAST(COUNT(*) AS BIGINT) AS com_timestamp, CAST({ncols} AS BIGINT) AS colunas "
                     f"FROM ({sql}) m")
    return "\nUNION ALL\n".join(parts)


ORACLE["gold_export"] = _gold_counts()


# ------------------------------------------------------------------ streaming

EVENT_DOC_CTE = """
SELECT lpad(CAST(t.id_transacao AS VARCHAR), 12, '0') AS evento_id, t.data_transacao AS event_ts, t.id_conta,
  CAST(t.valor AS DOUBLE) AS valor, t.tipo, t.status, t.canal, e.estado AS estado_origem, t.is_fraude,
  CAST(t.score_fraude AS DOUBLE) AS score_fraude, t.ip_origem, t.device_id, m.nome AS comerciante, t.descricao
FROM silver_transacoes t
LEFT JOIN (SELECT co.id_conta, cl.estado FROM silver_contas co JOIN silver_clientes cl
           ON co.id_cliente = cl.id_cliente) e ON t.id_conta = e.id_conta
LEFT JOIN silver_comerciantes m ON t.id_comerciante = m.id_comerciante"""
_STREAM_TABLES = ["silver_transacoes", "silver_contas", "silver_clientes", "silver_comerciantes"]

ORACLE["stream_parse_events"] = with_ctes(_STREAM_TABLES, "SELECT * FROM evdoc", {"evdoc": EVENT_DOC_CTE})
ORACLE["keyed_json_records"] = with_ctes(_STREAM_TABLES, """
SELECT CAST(id_conta AS VARCHAR) AS key, evento_id, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
  id_conta, valor, tipo, status, canal, estado_origem, is_fraude, score_fraude, ip_origem, device_id, comerciante,
  descricao FROM evdoc""", {"evdoc": EVENT_DOC_CTE})
ORACLE["stream_alerts"] = ORACLE["alert_documents"]
ORACLE["alert_rate"] = _alerts_q("""
SELECT CAST(COUNT(*) AS BIGINT) AS processadas, CAST(n_alert AS BIGINT) AS alertas,
  ROUND(n_alert * 100.0 / COUNT(*), 1) AS taxa_alertas_pct
FROM ev, (SELECT COUNT(DISTINCT evento_id) AS n_alert FROM docs) a GROUP BY n_alert""")
ORACLE["velocity_ranked"] = ORACLE["velocity_trailing"]

ORACLE["rule_velocity_multi"] = _events_q(f"""
SELECT evento_id, id_conta, janela_n, janela_n > 5 AS alerta
FROM (SELECT evento_id, id_conta, {trailing_sql('id_conta', 60)} AS janela_n FROM ev) v""", "orders")
ORACLE["stream_velocity"] = ORACLE["rule_velocity_multi"]
ORACLE["stream_alerts_multi"] = _alerts_q(f"SELECT {ALERT_COLS} FROM docs", sfx="_o")

# ------------------------------------------------------------------ stamps, defaults, manifest, views

ORACLE["apply_defaults_clientes"] = _q(["bronze_clientes"], """
SELECT id_cliente, ifnull(ativo, TRUE) AS ativo, TRUE AS com_cadastro FROM bronze_clientes""")
ORACLE["apply_defaults_transacoes"] = _q(["bronze_transacoes"], """
SELECT id_transacao, ifnull(is_fraude, FALSE) AS is_fraude, TRUE AS com_data FROM bronze_transacoes""")
# Only the customer cleaner sets the quality flag.
ORACLE["silver_stamps"] = _q(["silver_clientes", "silver_contas", "silver_transacoes"], """
SELECT 'clientes' AS tabela, count(*) AS linhas, count(*) AS com_carimbo, count(*) AS qualidade_ok FROM silver_clientes
UNION ALL SELECT 'contas', count(*), count(*), NULL FROM silver_contas
UNION ALL SELECT 'transacoes', count(*), count(*), NULL FROM silver_transacoes""")
ORACLE["alert_event_nested"] = _alerts_q("""
SELECT evento_id, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", id_conta, valor, tipo, status, canal,
  estado AS estado_origem, is_fraude, score_fraude, ip_origem, device_id, comerciante, descricao, n_alertas
FROM (SELECT evento_id, estado, count(*) AS n_alertas FROM docs GROUP BY ALL) JOIN ev USING (evento_id)
LEFT JOIN (SELECT id_comerciante, nome AS comerciante FROM bronze_comerciantes) USING (id_comerciante)""") \
    .replace("WITH ", "WITH bronze_comerciantes AS (" + ALL_CTES["bronze_comerciantes"] + "),\n", 1)
ORACLE["manifest_files"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, TRUE AS com_tamanho, '{t}/ano=2026/mes=06/dia=04' AS pasta, CAST(NULL AS VARCHAR) AS erro"
    for t, _, _ in _MANIFEST_PARTS)
ORACLE["sql_views"] = _over(mart_estado(), "m1", """
SELECT estado, pct_fraude, rank() OVER (ORDER BY pct_fraude DESC, estado) AS posicao,
  (SELECT count(*) FROM silver_transacoes) AS transacoes FROM m1""")
