"""Lake I/O: full-load ingest, partitioned Parquet layers, snapshots, manifest.

Layout: ``<root>/<layer>/<table>/ano=YYYY/mes=MM/dia=DD/part-*.parquet`` with
the partition values taken from the *load* clock as zero-padded strings. A load
has one date, so it writes that day's folder itself: a same-day rerun replaces
it, also when the rerun has no rows, and keeps the others (K2).

The table's columns are kept in ``_schema.json`` beside the day folders, so
reads state the schema and open no footers; new columns are added to it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentinela.sources import folders

# Partition column names and the source URI recorded in Bronze.
PARTITION_COLUMNS = ["ano", "mes", "dia"]
FONTE = "postgresql://financeiro_source"
AUDIT_TS, AUDIT_FONTE, AUDIT_TABELA = "_ingestao_timestamp", "_fonte", "_tabela_origem"
TABELAS = ["clientes", "contas", "comerciantes", "categorias_transacao", "transacoes"]
# Upper bound on rows per written file (a large task rolls over to a new file).
MAX_RECORDS_PER_FILE = 20_000_000


def add_audit_columns(df: DataFrame, table: str, fonte: str = FONTE) -> DataFrame:
    """Bronze audit columns: load time, source URI and source table name."""
    return df.withColumns({
        AUDIT_TS: F.current_timestamp(),
        AUDIT_FONTE: F.lit(fonte),
        AUDIT_TABELA: F.lit(table),
    })


def partition_columns(ts: Column) -> list[Column]:
    """``ano``/``mes``/``dia`` strings of a timestamp, zero padded (K1)."""
    return [F.date_format(ts, "yyyy").alias("ano"), F.date_format(ts, "MM").alias("mes"),
            F.date_format(ts, "dd").alias("dia")]


@dataclass
class TableSource:
    """A relational source: ``read(table) -> DataFrame``."""
    read: Callable[[str], DataFrame]
    uri: str = FONTE


def jdbc_source(spark: SparkSession, url: str, properties: dict, partitioning: dict | None = None) -> TableSource:
    """A JDBC source read in parallel ranges of a numeric key.

    ``partitioning`` maps table -> (column, lower, upper, num_partitions), or
    (column, num_partitions) to have the database state the column's ends; each
    executor then reads one key range instead of one task reading the table.
    """
    partitioning = dict(partitioning or {})

    def ends(table: str, col: str) -> tuple:
        query = f"(SELECT min({col}) AS lo, max({col}) AS hi FROM {table}) pontas"
        lo, hi = spark.read.jdbc(url, query, properties=properties).first()
        return (0, 1) if lo is None else (lo, hi)      # an empty table has no ends

    def read(table: str) -> DataFrame:
        if table in partitioning:
            given = partitioning[table]
            col, lo, hi, n = given if len(given) == 4 else (given[0], *ends(table, given[0]), given[1])
            return spark.read.jdbc(url, table, column=col, lowerBound=lo, upperBound=hi,
                                   numPartitions=n, properties=properties)
        return spark.read.jdbc(url, table, properties=properties)

    return TableSource(read, url)


def full_load(source: TableSource, table: str) -> DataFrame:
    """Whole table with Bronze audit columns (``SELECT *``, no watermark)."""
    return add_audit_columns(source.read(table), table, source.uri)


MARKS_FILE = "_marcas.json"


def load_marks(spark: SparkSession, path: str) -> dict[str, dict]:
    """Load date -> ``{"de", "ate", "aberta"}``: the slice of the mark column that the date holds, ends as text."""
    return json.loads(folders.read_text(spark, f"{path}/{MARKS_FILE}") or "{}")


def slice_between(df: DataFrame, mark: str, low: str | None, high: str | None) -> DataFrame:
    """Rows with ``low < mark <= high``, the ends given as text and compared in the column's own type.

    Both are plain comparisons with literals, which Spark hands to the source (Parquet statistics, a database's WHERE).
    """
    kind, c = df.schema[mark].dataType, F.col(mark)
    if high is None:
        return df.filter(F.lit(False))
    within = c <= F.lit(high).cast(kind)
    return df.filter(within if low is None else within & (c > F.lit(low).cast(kind)))


def incremental_load(spark: SparkSession, source: TableSource, table: str, mark: str, path: str,
                     load_ts: datetime | None = None) -> dict:
    """Load the rows that came since the last load into this load date's folder (S1); returns the date's mark.

    ``mark`` is a column that grows: a row that comes later has a greater value (an id, a commit time). What a
    date holds is kept in ``_marcas.json`` as ``low < mark <= high``, the low end being the former date's high end.

    * A second run on the same date begins again at the date's low end and replaces its folder, so nothing is lost or doubled.
    * The slice is noted as open before the write and closed after it. A run on a later date removes the folder of
      an open date and loads its rows itself.
    * A load date before a date already loaded is refused, and so are rows without a mark, which no slice would hold.
    * Without new rows the date has an empty folder and the mark stays.
    """
    load_ts = load_ts or datetime.now()
    day, marks = f"{load_ts:%Y-%m-%d}", load_marks(spark, path)
    if any(d > day for d in marks):
        raise ValueError(f"{path} already holds load date {max(marks)}, later than {day}")
    for broken in [d for d, m in marks.items() if m["aberta"] and d < day]:
        folders.remove(spark, day_folder(path, datetime.strptime(broken, "%Y-%m-%d")))
        del marks[broken]
    low = marks[max(d for d in marks if d < day)]["ate"] if any(d < day for d in marks) else None
    rows = source.read(table)
    newest, unmarked = rows.agg(F.max(mark).cast("string"), F.count_if(F.col(mark).isNull())).first()
    if unmarked:
        raise ValueError(f"{unmarked} rows of {table} have no {mark}")
    fresh = slice_between(rows, mark, low, newest)
    marks[day] = {"de": low, "ate": low if newest is None else newest, "aberta": True}
    folders.write_text(spark, f"{path}/{MARKS_FILE}", json.dumps(marks))
    write_partitioned(add_audit_columns(fresh, table, source.uri), path, load_ts)
    marks[day]["aberta"] = False
    folders.write_text(spark, f"{path}/{MARKS_FILE}", json.dumps(marks))
    return marks[day]


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def day_folder(path: str, load_ts: datetime) -> str:
    return f"{path}/ano={load_ts:%Y}/mes={load_ts:%m}/dia={load_ts:%d}"


def write_partitioned(df: DataFrame, path: str, load_ts: datetime | None = None) -> str:
    """Write ``df`` as the load date's ``ano/mes/dia`` folder, replacing it; returns the folder.

    The rows are written beside the table first and then take the day's place, so
    a failed load leaves the old day readable. Files are capped at
    ``MAX_RECORDS_PER_FILE`` rows.
    """
    spark, folder = df.sparkSession, day_folder(path, load_ts or datetime.now())
    merged_schema(spark, path, df.schema)
    staged = _staging(path)
    df.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(staged)
    _keep_schema(spark, path, df.schema)
    folders.replace(spark, staged, folder)
    return folder


def write_days(df: DataFrame, path: str, ts: Column) -> list[str]:
    """Write rows of several dates in one job (a backfill): exactly the days that ``ts`` names are replaced (K2).

    Rows without a date are refused. Each day takes its place in one step, after all have been written.
    """
    spark = df.sparkSession
    merged_schema(spark, path, df.schema)
    staged = _staging(path)
    known = F.when(ts.isNull(), F.raise_error(F.lit("a row without a date cannot be placed in a day"))).otherwise(ts)
    dated = df.withColumns(dict(zip(PARTITION_COLUMNS, partition_columns(known))))
    dated.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*PARTITION_COLUMNS).parquet(staged)
    _keep_schema(spark, path, df.schema)
    days = [f"{y}/{m}/{d}" for y in _parts(spark, staged) for m in _parts(spark, f"{staged}/{y}")
            for d in _parts(spark, f"{staged}/{y}/{m}")]
    for day in days:
        folders.replace(spark, f"{staged}/{day}", f"{path}/{day}")
    folders.remove(spark, staged)
    return days


def _parts(spark: SparkSession, path: str) -> list[str]:
    return [n for n in folders.children(spark, path) if "=" in n]


def _staging(path: str) -> str:
    """A new folder beside the days; its name keeps readers of the table from seeing it."""
    return f"{path.rstrip('/')}/_carga-{uuid.uuid4().hex[:12]}"


SCHEMA_FILE = "_schema.json"


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of a lake table as kept beside it, or None."""
    text = folders.read_text(spark, f"{path}/{SCHEMA_FILE}")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def merged_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """The table's columns after a load with ``schema``; a column of another type than before is refused."""
    known = table_schema(spark, path)
    fields = {f.name: f for f in (known.fields if known else [])}
    for f in schema.fields:
        if f.name in PARTITION_COLUMNS:
            continue
        before = fields.get(f.name)
        if before is not None and before.dataType != f.dataType:
            raise ValueError(f"column {f.name} of {path} is {before.dataType.simpleString()}, the load has "
                             f"{f.dataType.simpleString()}: cast it, or load into another table")
        fields[f.name] = T.StructField(f.name, f.dataType, True)
    return T.StructType(list(fields.values()))


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Add new columns to the kept schema; read again after the write, so that a load beside this one is not lost."""
    for _ in range(10):
        merged = merged_schema(spark, path, schema)
        if merged == table_schema(spark, path):
            return
        folders.write_text(spark, f"{path}/{SCHEMA_FILE}", merged.json())


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Read a partitioned table with ``ano``/``mes``/``dia`` kept as strings.

    Partition discovery would turn ``"06"`` into the integer 6; stating the
    schema keeps the padding. A table written by others, without a kept schema,
    has it taken from its files.
    """
    known = table_schema(spark, path)
    if known is None:
        known = spark.read.option("mergeSchema", "true").parquet(path).schema
    fields = [f for f in known.fields if f.name not in PARTITION_COLUMNS]
    fields += [T.StructField(c, T.StringType(), True) for c in PARTITION_COLUMNS]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def newest_day(spark: SparkSession, path: str) -> dict[str, str]:
    """The newest load date of a table, from the folder listing: partition column -> value."""
    day: dict[str, str] = {}
    for column in PARTITION_COLUMNS:
        values = [n.split("=", 1)[1] for n in folders.children(spark, path) if n.startswith(f"{column}=")]
        if not values:
            raise FileNotFoundError(f"no {column}= folder below {path}")
        day[column] = max(values)
        path = f"{path}/{column}={day[column]}"
    return day


def read_snapshots(spark: SparkSession, path: str, snapshot: str = "all") -> DataFrame:
    """Read every load-date snapshot of a table.

    ``snapshot="all"`` unions all load dates with duplicates kept (the
    default behaviour); ``"latest"`` reads only the newest load date, one folder
    by a partition filter. Partition columns are dropped either way.
    """
    df = read_layer(spark, path)
    if snapshot == "latest":
        for column, value in newest_day(spark, path).items():
            df = df.filter(F.col(column) == value)
    return df.drop(*PARTITION_COLUMNS)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; missing columns become NULL, duplicates are kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def manifest_rows(spark: SparkSession, results: list[dict]) -> DataFrame:
    """Per-table load results as a DataFrame (K5)."""
    schema = ("tabela string, linhas bigint, colunas int, tamanho_mb double, arquivo string, "
              "status string, erro string")
    rows = [(r["tabela"], r.get("linhas"), r.get("colunas"), r.get("tamanho_mb"), r.get("arquivo"),
             r["status"], r.get("erro")) for r in results]
    return spark.createDataFrame(rows, schema)


def manifest_totals(rows: DataFrame) -> DataFrame:
    """``total_tabelas, total_sucesso, total_erro, total_linhas``."""
    return rows.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_tabelas"),
        F.count_if(F.col("status") == "sucesso").cast("bigint").alias("total_sucesso"),
        F.count_if(F.col("status") == "erro").cast("bigint").alias("total_erro"),
        F.coalesce(F.sum("linhas"), F.lit(0)).cast("bigint").alias("total_linhas"),
    )


def folder_size_mb(spark: SparkSession, path: str) -> DataFrame:
    """Total size of the Parquet files below ``path`` in MB, read as file metadata."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path).select("length"))
    return files.agg(F.round(F.coalesce(F.sum("length"), F.lit(0)) / (1024 * 1024), 2).alias("tamanho_mb"))
