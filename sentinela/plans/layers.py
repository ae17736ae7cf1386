"""Lazy Bronze / Silver / Gold views over one scale-factor folder.

Nothing here triggers a Spark job: each accessor returns a DataFrame whose
plan starts at the parquet scans, so Catalyst can prune columns and push
filters from whichever query finally uses it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sentinela.operators import clean, marts
from sentinela.sources import testdata
from sentinela.sources.constants import categorias_df


class LazyTables(Mapping):
    """Read-only mapping that builds each table's DataFrame on first access.

    A query that touches one table pays for one plan, not five.
    """

    def __init__(self, factories: dict[str, Callable[[], DataFrame]]):
        self._factories, self._built = factories, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, layout: str = "events"):
        self.spark, self.sf_dir, self.layout = spark, sf_dir, layout

    @cached_property
    def bronze(self) -> Mapping[str, DataFrame]:
        sp, sf, lay = self.spark, self.sf_dir, self.layout
        return LazyTables({
            "clientes": lambda: testdata.clientes(sp, sf),
            "contas": lambda: testdata.contas(sp, sf, lay),
            "transacoes": lambda: testdata.transacoes(sp, sf, lay),
            "comerciantes": lambda: testdata.comerciantes(sp, sf),
            "categorias_transacao": lambda: categorias_df(sp),
        })

    @cached_property
    def silver(self) -> Mapping[str, DataFrame]:
        b = self.bronze
        return LazyTables({name: (lambda n=name: clean.CLEANERS[n](b[n], False)) for name in b})

    # Gold marts -------------------------------------------------------
    def mart_estado(self) -> DataFrame:
        s = self.silver
        return marts.gold_fraude_estado(s["transacoes"], s["contas"], s["clientes"])

    def mart_hora(self) -> DataFrame:
        return marts.gold_por_hora(self.silver["transacoes"])

    def mart_risco(self) -> DataFrame:
        s = self.silver
        return marts.gold_perfil_risco(s["transacoes"], s["contas"], s["clientes"])

    def mart_diario(self) -> DataFrame:
        return marts.gold_diario(self.silver["transacoes"])

    def gold(self) -> dict[str, DataFrame]:
        return {
            "gold_resumo_fraudes_por_estado": self.mart_estado(),
            "gold_transacoes_por_hora": self.mart_hora(),
            "gold_perfil_risco_cliente": self.mart_risco(),
            "gold_resumo_executivo_diario": self.mart_diario(),
        }
