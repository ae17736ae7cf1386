"""Helpers shared by the operators: table access, shipping code, Arrow batches.

Conventions that hold for every operator of this package
--------------------------------------------------------
* An operator reads only the columns it names (``id_col``, ``text_col`` ...),
  so other columns of the input, whatever their names, never clash.
* A null text counts as the empty text unless the operator says otherwise;
  an empty input gives an empty result with the same schema; repeated rows
  are each answered on their own.
"""

from __future__ import annotations

import ctypes
import functools
import os
import shutil
import tempfile
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sentinela
from sentinela.session import scratch_path, shared_root

#: Text bytes handled at a time inside a task, and the bytes of an Arrow batch that Spark hands to it.
CHUNK_BYTES = 8 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application.

    Task functions are pickled by reference, so a worker must be able to
    import ``sentinela`` wherever it runs. ``addPyFile`` distributes a zip of
    the package through Spark itself; no shared folder is needed.
    """
    sc = spark.sparkContext
    if getattr(sc, "_sentinela_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(sentinela.__file__))
    target = tempfile.mkdtemp(prefix="sentinela-code-")
    archive = shutil.make_archive(os.path.join(target, "sentinela_code"), "zip",
                                  root_dir=os.path.dirname(package), base_dir=os.path.basename(package))
    sc.addPyFile(archive)
    sc._sentinela_shipped = True


_slot: dict[Hashable, object] = {}


def worker_table(key: Hashable, build: Callable[[], object]):
    """A large table (automata, vocabularies) that a worker keeps between tasks: one at a time, whatever the operator."""
    if key not in _slot:
        _slot.clear()
        _slot[key] = build()
    return _slot[key]


def _give_back() -> None:
    """Return freed memory to the system, so that an idle worker holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim is not None:
        trim(0)


def _task(fn: Callable, keeps: Hashable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if keeps not in _slot:
        _slot.clear()
    try:
        yield from fn(batches)
    finally:
        _give_back()


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str, keeps: Hashable = None) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers and Arrow batches bounded by bytes.

    The session's bound on an Arrow batch is lowered to ``CHUNK_BYTES`` where it
    is larger. ``keeps`` names the :func:`worker_table` that the task uses; any
    other is dropped when the task starts.
    """
    spark = df.sparkSession
    ship(spark)
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_BYTES))
    if bound < 0 or bound > CHUNK_BYTES:
        spark.conf.set(BATCH_BYTES, str(CHUNK_BYTES))
    return df.mapInArrow(functools.partial(_task, fn, keeps), schema)


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in row slices whose ``column`` holds about ``limit`` bytes each.

    Rows are never cut: a text longer than the limit is a slice of its own.
    """
    if not batch.num_rows:
        return
    size = batch.column(batch.schema.get_field_index(column)).nbytes
    step = max(1, int(batch.num_rows * limit / max(size, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes, null as empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
    return [b"" if v is None else v for v in values]


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts, null as empty."""
    values = batch.column(batch.schema.get_field_index(column)).to_pylist()
    return ["" if v is None else v for v in values]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage with a copy that survives lost executors; the schema is
    given to the reader, so an empty table keeps its columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


__all__ = ["read_table", "ship", "map_batches", "pieces", "utf8", "strings", "materialise", "fresh",
           "text_or_empty", "shared_root", "CHUNK_BYTES"]
