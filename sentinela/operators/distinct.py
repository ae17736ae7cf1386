"""Mergeable exact distinct counts.

``COUNT(DISTINCT)`` of a month cannot be had from the counts of its days. Here a
group keeps *which* keys it has seen, so partials of days, load dates or hours
are merged by a union and counted at any coarser level, without the rows.

Integer keys are kept as bit sets: key ``k`` is bit ``k mod 32768`` of bucket
``floor(k / 32768)``, one row of 4 KB per (group, bucket), built by
``bitmap_construct_agg`` with a partial set per task and merged by
``bitmap_or_agg``. A hot group leaves a task as one row per bucket, however many
rows it has, and its buckets spread over the cluster. The form suits surrogate
ids, which are dense; a bucket with few keys still has 4 KB (mostly zeros, which
shuffle and Parquet compress).

Groups that are many and hold few of the keys each (days, hours) ask for ``sparse``
sets: 4 KB a bucket would be mostly zeros, and Spark sorts whole sets to merge
them. There a row holds one word, key ``k`` as bit ``k mod 64`` of word
``floor(k / 64)``, merged by ``bit_or`` in a hash aggregate. A set has no more rows
than different keys, so it grows no faster than the input.

Keys of any other type are kept as distinct (group, key) rows and merged by
another distinct.

NULL keys are not counted; a group with only NULL keys counts 0, like
``COUNT(DISTINCT)``; NULL is a group of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, BITS = "balde", "mapa"
WORD, WORD_BITS = "palavra", "bits"
KEY = "chave"
#: Bits of a set that ``bitmap_construct_agg`` builds; a power of two.
SET_BITS = 32_768
_SHIFT = SET_BITS.bit_length() - 1
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integer(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, INTEGERS)


def bucket_of(key: Column) -> Column:
    """Bucket of an integer key; an arithmetic shift, so negative keys have buckets of their own."""
    return F.shiftright(key.cast("bigint"), _SHIFT)


def bit_of(key: Column) -> Column:
    return key.cast("bigint").bitwiseAND(F.lit(SET_BITS - 1))


def partials(df: DataFrame, by: dict[str, Column] | list[str], key: str, sparse: bool = False) -> DataFrame:
    """The distinct keys of each group: ``by`` and (``balde``, ``mapa``) for integer keys, (``palavra``, ``bits``) if
    ``sparse``; else ``by`` and ``chave``."""
    named = {c: F.col(c) for c in by} if isinstance(by, list) else by
    groups = [v.alias(k) for k, v in named.items()]
    if not is_integer(df, key):
        return df.select(*groups, F.col(key).alias(KEY)).distinct()
    if sparse:
        k = F.col(key).cast("bigint")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), k.bitwiseAND(F.lit(63)).cast("int"))
        # A NULL key has no word: its row has no bits and keeps the group.
        return df.groupBy(*groups, F.shiftright(k, 6).alias(WORD)).agg(
            F.bit_or(F.coalesce(bit, F.lit(0).cast("bigint"))).alias(WORD_BITS))
    # A NULL key has no bucket: its row has an empty set and keeps the group.
    return df.groupBy(*groups, bucket_of(F.col(key)).alias(BUCKET)).agg(
        F.bitmap_construct_agg(bit_of(F.col(key))).alias(BITS))


def merge(parts: DataFrame, by: dict[str, Column] | list[str]) -> DataFrame:
    """Partials of coarser groups from partials (of several loads too), in the same form."""
    named = {c: F.col(c) for c in by} if isinstance(by, list) else by
    groups = [v.alias(k) for k, v in named.items()]
    if WORD_BITS in parts.columns:
        return parts.groupBy(*groups, WORD).agg(F.bit_or(WORD_BITS).alias(WORD_BITS))
    if BITS not in parts.columns:
        return parts.select(*groups, KEY).distinct()
    return parts.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counts(parts: DataFrame, by: dict[str, Column] | list[str], name: str) -> DataFrame:
    """Exact number of distinct keys of each group of ``by``, from partials of this or a finer level."""
    merged = merge(parts, by)
    if WORD_BITS in parts.columns:
        n = F.sum(F.bit_count(WORD_BITS))
    else:
        n = F.sum(F.bitmap_count(BITS)) if BITS in parts.columns else F.count(KEY)
    return merged.groupBy(*by).agg(n.cast("bigint").alias(name))


#: A column is dense enough for bit sets if its range holds at most this many numbers a row (a row then costs 8 bytes of bits at most).
SPARSE = 64


def dense_columns(columns: dict[str, tuple[DataFrame, str]]) -> list[str]:
    """Names (name -> frame, column) of integer columns whose values lie densely, by one job for all of them."""
    whole = {n: (df, c) for n, (df, c) in columns.items() if is_integer(df, c)}
    by_frame: dict[int, tuple[DataFrame, list]] = {}
    for n, (df, c) in whole.items():
        by_frame.setdefault(id(df), (df, []))[1].append((n, c))
    each = [df.agg(F.array(*[F.struct(F.lit(n).alias("name"), F.count(c).alias("n"), F.min(c).cast("bigint").alias("lo"),
                                      F.max(c).cast("bigint").alias("hi")) for n, c in mine]).alias("s"))
            for df, mine in by_frame.values()]
    if not each:
        return []
    rows = [x for r in reduce(DataFrame.unionAll, each).collect() for x in r["s"]]
    return [x["name"] for x in rows if x["n"] and (x["hi"] - x["lo"] + 1) <= SPARSE * x["n"]]


def repeating_buckets(keys: DataFrame) -> DataFrame:
    """(name, ``balde``) of the buckets of (name, ``chave`` integer) rows that have more rows than different keys.

    A row leaves its task as a bit, so keys that occur once are not shuffled.
    """
    return (keys.groupBy("name", bucket_of(F.col(KEY)).alias(BUCKET))
            .agg(F.count(KEY).alias("n"), F.bitmap_construct_agg(bit_of(F.col(KEY))).alias(BITS))
            .filter(F.col("n") > F.bitmap_count(BITS)).select("name", BUCKET))
