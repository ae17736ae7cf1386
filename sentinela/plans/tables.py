"""Gold marts as catalog tables that are replaced while they are read (K3).

A table is external: every publication writes a new version folder and then
points the table at it (``ALTER TABLE ... SET LOCATION``), one step in the
catalog. A query planned before goes on reading the folder it was planned with,
one planned after reads the new one, and a publication that fails leaves the
table as it was. ``KEEP`` former versions stay for readers that still hold them.

Rows lie in the mart's presentation order, so files have narrow ranges of the
ordering columns. A publication with other columns replaces the table's
definition (dropped and created again, the former versions kept).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from sentinela.operators import marts
from sentinela.plans.medallion import GOLD_TABLES
from sentinela.sources import folders

#: Former versions that stay on disk.
KEEP = 1


def qualified(name: str, database: str) -> str:
    return f"`{database}`.`{name}`"


def versions(spark: SparkSession, base: str) -> list[str]:
    """Version folders of a table, oldest first."""
    return [n for n in folders.children(spark, base) if n.startswith("versao-")]


def publish(df: DataFrame, name: str, root: str, database: str = "default", keep: int = KEEP) -> str:
    """Make ``df`` the content of table ``name``; returns the folder that holds it."""
    spark, base = df.sparkSession, f"{root.rstrip('/')}/tabelas/{database}/{name}"
    folder = f"{base}/versao-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(folder)
    table = qualified(name, database)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    known = spark.catalog.tableExists(f"{database}.{name}")
    same = known and [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]
    if same:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    for old in versions(spark, base)[:-(keep + 1)]:
        folders.remove(spark, f"{base}/{old}")
    return folder


def publish_gold(built: dict[str, DataFrame], root: str, database: str = "default") -> list[str]:
    """The four marts as tables of ``database``, each in its presentation order."""
    for name in GOLD_TABLES:
        publish(marts.ordered(name, built[name]), name, root, database)
    return [f"{database}.{name}" for name in GOLD_TABLES]
