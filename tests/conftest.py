import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sentinela.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
NOW = datetime(2026, 6, 5, 15, 57, 22)


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="sentinela-tests", shuffle_partitions=4)
    yield s


@pytest.fixture
def clientes_bronze(spark):
    """Own rows: padded, oddly cased and accented names, punctuated CPFs, one missing score."""
    rows = [
        (11, "\tmarina d\'ávila", "020.304.050-60", " Marina@Exemplo.ORG ", "F", "porto alegre", " rs", 412),
        (12, "ÍTALO  braga ", "11122233396", "italo@exemplo.org", "M", "RECIFE", "pe", 388),
        (13, "Zilda Noronha", "700.800.900-10", "ZILDA@exemplo.org", "F", " Belém", "PA", None),
        (14, "otávio lemos-prado", "44.555.666/7-77", "otavio@exemplo.org", "M", "são luís", "ma ", 977),
    ]
    df = spark.createDataFrame(rows, "id_cliente int, nome string, cpf string, email string, genero string, "
                                     "cidade string, estado string, score_credito int")
    from pyspark.sql import functions as F
    return df.withColumns({
        "data_nascimento": F.lit("1987-03-21").cast("date"),
        "data_cadastro": F.lit(NOW).cast("timestamp_ntz"),
        "ativo": F.lit(True),
        "_ingestao_timestamp": F.lit(NOW).cast("timestamp"),
        "_fonte": F.lit("postgresql"),
        "_tabela_origem": F.lit("clientes"),
    })


@pytest.fixture
def transacoes_bronze(spark):
    """Own rows: every value band's edge, a negative and a zero value, mixed-case codes, one missing score."""
    noite, manha = datetime(2026, 2, 3, 4, 10), datetime(2026, 2, 3, 9, 0)
    rows = [
        (21, 31, 1, 7, Decimal("48.20"), " Ted ", "Aprovada", "WEB", "lanche", noite, False, 0.05),
        (22, 32, 2, 7, Decimal("-730.10"), "PIX", "SUSPEITA", "app", "aluguel", manha, True, 0.9),
        (23, 33, 3, None, Decimal("0.00"), "boleto", "cancelada", "Pos", "estorno", manha, False, None),
        (24, 34, 4, 8, Decimal("12000.00"), "doc", "negada", "agencia", "carro", manha, False, 0.3),
        (25, 32, 5, 9, Decimal("99.90"), "credito", "aprovada", "ATM", "livro", noite, False, 0.8),
    ]
    df = spark.createDataFrame(rows, "id_transacao bigint, id_conta int, id_categoria int, id_comerciante int, "
                                     "valor decimal(12,2), tipo string, status string, canal string, "
                                     "descricao string, data_transacao timestamp_ntz, is_fraude boolean, "
                                     "score_fraude double")
    from pyspark.sql import functions as F
    return df.withColumns({
        "data_processamento": F.lit(NOW).cast("timestamp_ntz"),
        "ip_origem": F.lit("10.20.30.40"), "device_id": F.lit("aparelho-7"),
        "_ingestao_timestamp": F.lit(NOW).cast("timestamp"), "_fonte": F.lit("postgresql"),
        "_tabela_origem": F.lit("transacoes"),
    })


@pytest.fixture
def contas_silver(spark):
    return spark.createDataFrame([(20 + i, i, "corrente", 70.0 * i) for i in range(11, 15)],
                                 "id_conta int, id_cliente int, tipo_conta string, saldo double")
