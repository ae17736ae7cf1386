"""Incremental marts: stored additive partials per load date (A1-A4, K3).

Silver keeps one folder per load date. ``refresh`` reduces each load date that is
new, or was loaded again, to partials and leaves the others alone; ``marts_of``
builds the four Gold marts from the partials of every load date, so the work of
a load grows with the load and not with the history:

* ``por_conta``: per account, additive measures (fraud by state, risk profile);
* ``por_instante``: per date and hour, additive measures (hourly, daily);
* ``contas_ativas``: per date and hour, which accounts were active, as sparse
  bit sets (:mod:`sentinela.operators.distinct`), since distinct counts do not add up.

A load date is known by the names of its data files, which are new at every
write; they are kept in ``_cargas_2.json`` after the date's partials have all been
written. A run that dies between leaves its date pending, and the next run
replaces that date's partials whole. A load date that left Silver leaves the
partials too.

The marts equal those of ``snapshot="all"``: rows of several load dates all count.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.functions.timefn import hour_of_day
from sentinela.operators import distinct, marts
from sentinela.sources import folders, lake

# The state's number goes up when the form of a partial changes: all load dates are then pending again.
LAYER, STATE = "parciais", "_cargas_2.json"
BY_ACCOUNT, BY_INSTANT, ACCOUNTS = "por_conta", "por_instante", "contas_ativas"
PARTIALS = (BY_ACCOUNT, BY_INSTANT, ACCOUNTS)


def loads(spark: SparkSession, path: str) -> dict[str, str]:
    """Load date (``2026-06-04``) -> digest of the names of its data files, from the folder listing."""
    found = {}
    for y in folders.children(spark, path):
        for m in folders.children(spark, f"{path}/{y}") if y.startswith("ano=") else []:
            for d in folders.children(spark, f"{path}/{y}/{m}"):
                names = "\n".join(n for n in folders.files(spark, f"{path}/{y}/{m}/{d}") if n.startswith("part-"))
                day = "-".join(p.split("=", 1)[1] for p in (y, m, d))
                found[day] = hashlib.sha256(names.encode()).hexdigest()
    return found


def _state_path(root: str) -> str:
    return f"{root.rstrip('/')}/{LAYER}/{STATE}"


def _state(spark: SparkSession, root: str) -> dict[str, str]:
    return json.loads(folders.read_text(spark, _state_path(root)) or "{}")


def pending(spark: SparkSession, root: str) -> list[str]:
    """Load dates of Silver whose partials are missing or were made from other files."""
    done = _state(spark, root)
    return [day for day, files in sorted(loads(spark, lake.layer_path(root, "silver", "transacoes")).items())
            if done.get(day) != files]


def of_load(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The transactions of one load date: a partition filter, so only its folder is read."""
    df = lake.read_layer(spark, lake.layer_path(root, "silver", "transacoes"))
    for column, value in zip(lake.PARTITION_COLUMNS, day.split("-")):
        df = df.filter(F.col(column) == value)
    return df.drop(*lake.PARTITION_COLUMNS)


def partials_of(transacoes: DataFrame) -> dict[str, DataFrame]:
    """The three partials of some transactions."""
    instant = {"data": F.to_date("data_transacao"), "hora_dia": hour_of_day("data_transacao")}
    return {
        BY_ACCOUNT: marts.account_partials(transacoes),
        BY_INSTANT: transacoes.groupBy(*[v.alias(k) for k, v in instant.items()]).agg(*marts.instant_measures()),
        ACCOUNTS: distinct.partials(transacoes, instant, "id_conta", sparse=True),
    }


def refresh(spark: SparkSession, root: str) -> list[str]:
    """Bring the stored partials up to date with Silver; returns the load dates that were read."""
    silver = loads(spark, lake.layer_path(root, "silver", "transacoes"))
    done = _state(spark, root)
    todo = pending(spark, root)
    for day in todo:
        load_ts = datetime.strptime(day, "%Y-%m-%d")
        for name, part in partials_of(of_load(spark, root, day)).items():
            lake.write_partitioned(part, lake.layer_path(root, LAYER, name), load_ts)
        done[day] = silver[day]
        folders.write_text(spark, _state_path(root), json.dumps(done))
    for day in sorted(set(done) - set(silver)):
        for name in PARTIALS:
            folders.remove(spark, lake.day_folder(lake.layer_path(root, LAYER, name), datetime.strptime(day, "%Y-%m-%d")))
        del done[day]
        folders.write_text(spark, _state_path(root), json.dumps(done))
    return todo


def read_partials(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {n: lake.read_snapshots(spark, lake.layer_path(root, LAYER, n), "all") for n in PARTIALS}


def marts_of(parts: dict[str, DataFrame], contas: DataFrame, clientes: DataFrame) -> dict[str, DataFrame]:
    """The four marts from partials of any number of load dates."""
    per_account = marts.merge_account_partials(parts[BY_ACCOUNT])
    return {
        "gold_resumo_fraudes_por_estado": marts.estado_from_accounts(per_account, contas, clientes),
        "gold_transacoes_por_hora": marts.hora_from_groups(_instants(parts, "hora_dia")),
        "gold_perfil_risco_cliente": marts.risco_from_accounts(per_account, contas, clientes),
        "gold_resumo_executivo_diario": marts.diario_from_groups(_instants(parts, "data")),
    }


def _instants(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Measures and active accounts per ``key``; both sides hold one row per hour or per date."""
    sums = marts.merge_instants(parts[BY_INSTANT], key)
    active = distinct.counts(parts[ACCOUNTS], [key], "contas_ativas").withColumnRenamed(key, "k")
    return sums.join(active, sums[key].eqNullSafe(active["k"]), "left").drop("k")
