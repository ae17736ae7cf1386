"""Folder operations through Spark's own file systems, so any store that Spark reads works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def make(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; none if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path``, sorted; none if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> bool:
    fs, p = _fs(spark, old)
    return fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(new))


def replace(spark: SparkSession, new: str, old: str) -> None:
    """Put folder ``new`` in the place of ``old`` (which may not exist); if that fails, ``old`` is put back."""
    aside = f"{new}-antes"
    fs, p = _fs(spark, old)
    fs.mkdirs(p.getParent())
    had = fs.exists(p)
    if had and not rename(spark, old, aside):
        raise OSError(f"could not move {old}")
    if not rename(spark, new, old):
        if had:
            rename(spark, aside, old)
        raise OSError(f"could not move {new} to {old}")
    if had:
        remove(spark, aside)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, or None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: under another name first, then renamed over the old one."""
    fs, p = _fs(spark, path)
    work = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}.tmp")
    stream = fs.create(work, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._jvm.java.lang.reflect.Array.newInstance(
        spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(work, p, options)
