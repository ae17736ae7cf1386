"""Silver cleaning on small fixtures (names, e-mail, state, CPF, median, bands)."""

from pyspark.sql import functions as F

from sentinela.operators import clean, quality


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


def test_clientes_text_columns(clientes_bronze):
    out = by_id(clean.clean_clientes(clientes_bronze), "id_cliente")
    assert [out[i]["nome"] for i in (11, 12, 13)] == ["Marina D'Ávila", "Ítalo  Braga", "Zilda Noronha"]
    assert out[14]["nome"] == "Otávio Lemos-Prado" and out[14]["cidade"] == "São Luís" and out[13]["cidade"] == "Belém"
    assert out[11]["email"] == "marina@exemplo.org" and out[13]["email"] == "zilda@exemplo.org"
    assert {r["estado"] for r in out.values()} == {"RS", "PE", "PA", "MA"}
    assert out[11]["cpf"] == "02030405060" and {len(r["cpf"]) for r in out.values()} == {11, 12}


def test_score_median_fill(clientes_bronze):
    out = by_id(clean.clean_clientes(clientes_bronze), "id_cliente")
    assert out[13]["score_credito"] == 412.0          # median of 388, 412, 977
    assert out[12]["score_credito"] == 388.0


def test_audit_columns_dropped_and_stamps_set(clientes_bronze):
    df = clean.clean_clientes(clientes_bronze)
    assert not {"_ingestao_timestamp", "_fonte", "_tabela_origem"} & set(df.columns)
    assert df.filter("_qualidade_ok AND _silver_timestamp IS NOT NULL").count() == 4


def test_quality_clientes_messages(clientes_bronze):
    row = quality.quality_row("clientes", clientes_bronze).first()
    assert row["total_original"] == 4 and row["removidos"] == 0
    # Points and hyphens go, the slash of row 14 stays: 12 characters.
    wrong = [r for r in clientes_bronze.collect() if len(r["cpf"].replace(".", "").replace("-", "")) != 11]
    assert len(wrong) == 1
    assert row["problemas"] == ["1 CPFs com tamanho inválido", "1 scores preenchidos com mediana (412)"]


def test_transacoes_values_and_codes(transacoes_bronze):
    out = by_id(clean.clean_transacoes(transacoes_bronze), "id_transacao")
    assert out[22]["valor"] == abs(out[22]["valor"]) and float(out[22]["valor"]) == 730.10
    assert (out[21]["tipo"], out[21]["status"], out[21]["canal"]) == ("ted", "aprovada", "web")
    assert out[23]["score_fraude"] == 0.0 and out[22]["score_fraude"] == 0.9
    assert out[21]["fora_horario_comercial"] is True and out[22]["fora_horario_comercial"] is False
    # Bands end at 50, 200, 500, 1000 and 5000, ends included; zero lies in none.
    assert {i: out[i]["faixa_valor"] for i in out} == {21: "micro", 22: "alto", 23: None, 24: "critico", 25: "pequeno"}


def test_invalid_dates_dropped_and_counted(spark, transacoes_bronze):
    t = transacoes_bronze.withColumn(
        "data_transacao", F.when(F.col("id_transacao") == 24, F.lit("31/31")).otherwise(F.col("data_transacao").cast("string")))
    assert clean.clean_transacoes(t).count() == 4
    row = quality.quality_row("transacoes", t).first()
    assert row["removidos"] == 1 and row["total_silver"] == 4 and row["fraudes"] == 1
    assert row["problemas"] == ["1 datas inválidas encontradas", "1 valores negativos convertidos para positivo",
                                "1 transações com valor zero"]
    assert row["valor_total"] == 878.20


def test_contas_saldo_fill(spark):
    df = spark.createDataFrame([(1, " CORRENTE ", None), (2, "poupanca", 5.0)], "id_conta int, tipo_conta string, saldo double")
    out = by_id(clean.clean_contas(df), "id_conta")
    assert out[1]["tipo_conta"] == "corrente" and out[1]["saldo"] == 0.0
    assert quality.quality_row("contas", df).first()["problemas"] == ["1 saldos nulos preenchidos com 0"]
