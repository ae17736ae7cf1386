"""Exact median of a column by distributed selection.

``percentile`` and ``median`` keep a map from value to count that ends in one task,
which grows with the number of different values. Here the rank's place is
narrowed down instead: each round counts the values of the open range in
``BUCKETS`` equal parts with a map-side partial aggregate (at most ``BUCKETS`` rows a
task) and keeps the part that holds the rank, with the least and greatest value
that really occur in it. Once at most ``SMALL`` values are left they are sorted.
No task or driver holds more than ``SMALL`` values or ``BUCKETS`` counts, whatever
the input; a range of one value, however often it occurs, ends the search.

NULL and NaN are no values; without values the median is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, SMALL = 4096, 10_000


def nth_values(df: DataFrame, column: str, ranks: list[int], low: float, high: float, small: int = SMALL) -> list[float]:
    """The values at ascending 0-based ``ranks`` among those of ``column`` within ``low``..``high``."""
    v = F.col("v")
    values = df.select(F.col(column).cast("double").alias("v"))
    within, before = values.filter(v.between(low, high)), 0
    while low < high:
        # Halves first, so that the width of a range of very large numbers does not overflow.
        place = F.least(F.floor((v / 2 - low / 2) / (high / 2 - low / 2) * BUCKETS), F.lit(BUCKETS - 1))
        parts = within.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        rows = sorted(parts.collect())
        holding, passed = {}, before
        for r in rows:
            for rank in ranks:
                if passed <= rank < passed + r["n"]:
                    holding.setdefault(r["b"], (passed, r, []))[2].append(rank)
            passed += r["n"]
        if len(holding) > 1:      # the two middle values lie in different parts: one search each
            return [x for start, r, mine in holding.values()
                    for x in nth_values(df.filter(F.col(column).cast("double").between(r["lo"], r["hi"])), column,
                                        [rank - start for rank in mine], r["lo"], r["hi"], small)]
        (before, r, _), = holding.values()
        low, high, within = r["lo"], r["hi"], values.filter(v.between(r["lo"], r["hi"]))
        if r["n"] <= small:
            kept = [x["v"] for x in within.orderBy("v").collect()]
            return [kept[rank - before] for rank in ranks]
    return [low] * len(ranks)


def exact_median(df: DataFrame, column: str, small: int = SMALL) -> float | None:
    """The exact median of ``column``; the mean of the two middle values where their number is even."""
    values = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    as_double = F.col(column).cast("double")
    n, low, high = values.agg(F.count(F.lit(1)), F.min(as_double), F.max(as_double)).first()
    if not n:
        return None
    ranks = sorted({(n - 1) // 2, n // 2})
    found = nth_values(values, column, ranks, low, high, small)
    return found[0] if len(found) == 1 else found[0] + (found[1] - found[0]) / 2
