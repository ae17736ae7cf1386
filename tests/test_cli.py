"""The command line drives the layer runs, the replay and the stream detector."""

import json

from sentinela.__main__ import main
from sentinela.session import scratch_path

SF = "/root/testdata/sf0.001"


def run(capsys, *args):
    main(list(args))
    return json.loads(capsys.readouterr().out)


def test_cli_end_to_end(spark, capsys):
    root = scratch_path(spark, "t-cli")
    manifest = run(capsys, "bronze", "--sf-dir", SF, "--root", f"{root}/lake")
    assert manifest["total_sucesso"] == 5 and manifest["total_linhas"] == 150 + 150 + 10 + 14 + 1000
    report = run(capsys, "silver", "--root", f"{root}/lake")
    assert {r["tabela"] for r in report} == {"clientes", "contas", "comerciantes", "categorias_transacao",
                                             "transacoes"}
    insights = run(capsys, "gold", "--root", f"{root}/lake", "--snapshot", "latest")
    assert len(insights["top_estados"]) == 3
    folders = run(capsys, "replay", "--sf-dir", SF, "--out", f"{root}/events", "--slices", "2")
    assert len(folders) == 2
    rate = run(capsys, "stream", "--source", f"{root}/events", "--out", f"{root}/alerts")
    silver_t = next(r for r in report if r["tabela"] == "transacoes")
    assert rate[0]["processadas"] == silver_t["total_silver"]
    assert 0 < rate[0]["alertas"] <= rate[0]["processadas"]


def test_relational_load_arguments(spark, capsys, monkeypatch):
    """URL, properties and key ranges reach the reader; no database is needed."""
    from sentinela.sources import lake, testdata

    seen = {}

    def source(session, url, properties, partitioning):
        seen.update(url=url, properties=properties, partitioning=partitioning)
        return lake.TableSource(lambda name: testdata.sources(spark, SF).as_dict()[name], url)

    monkeypatch.setattr(lake, "jdbc_source", source)
    root = scratch_path(spark, "t-jdbc")
    manifest = run(capsys, "bronze", "--jdbc-url", "jdbc:x://host/db", "--jdbc-property", "user=u", "--jdbc-property",
                   "password=a=b", "--key-range", "transacoes:id_transacao:1:1000:8", "--root", root, "--defaults")
    assert seen == {"url": "jdbc:x://host/db", "properties": {"user": "u", "password": "a=b"},
                    "partitioning": {"transacoes": ("id_transacao", 1, 1000, 8)}}
    assert manifest["total_sucesso"] == 5 and manifest["fonte"] == "jdbc:x://host/db"
    loaded = lake.read_snapshots(spark, lake.layer_path(root, "bronze", "clientes"))
    assert loaded.filter("ativo IS NULL").count() == 0
