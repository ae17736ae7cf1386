"""Numeric expressions: rounding, value bands, percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed value bands of the Silver ``faixa_valor`` column.
# (0,50] micro, (50,200] pequeno, (200,500] medio, (500,1000] alto,
# (1000,5000] muito_alto, (5000,inf) critico; 0, negatives and NULL get NULL.
FAIXA_BOUNDS = [(50, "micro"), (200, "pequeno"), (500, "medio"), (1000, "alto"), (5000, "muito_alto")]
FAIXA_TOP = "critico"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dk_round(col: Column | str, places: int) -> Column:
    """Round a double as the analytical SQL does: scale, round half away, unscale.

    ``round(x, p)`` in Spark rounds the decimal rendering of ``x`` (1.005 ->
    1.01); the marts were specified with ``round(x * 10^p) / 10^p`` on the
    binary value (1.005 * 100 = 100.49999999999999 -> 1.0). Rounding the
    already-scaled double to 0 places is exact half-away-from-zero, unlike
    ``floor(y + 0.5)``, which fails when ``y + 0.5`` itself rounds up.
    Exact decimal sums use ``round_money`` instead.
    """
    x = _c(col).cast("double")
    m = float(10 ** places)
    return F.round(x * m, 0) / m


def round_money(col: Column | str, places: int = 2) -> Column:
    """Exact HALF_UP rounding of a decimal sum, returned as double."""
    return F.round(_c(col), places).cast("double")


def pct(part: Column, whole: Column, places: int) -> Column:
    """``round(part * 100.0 / whole, places)`` computed in double (T4)."""
    return dk_round(part.cast("double") * 100.0 / whole.cast("double"), places)


def mean(total: Column, n: Column) -> Column:
    """Mean from an exact sum and a count, as double; NULL when ``n`` is 0."""
    return F.when(n > 0, total.cast("double") / n.cast("double"))


def faixa_valor(col: Column | str) -> Column:
    """Band a transaction value into the right-closed Silver bands."""
    v = _c(col)
    expr = F.when(v <= 0, F.lit(None).cast("string"))
    for upper, label in FAIXA_BOUNDS:
        expr = expr.when(v <= upper, F.lit(label))
    return expr.when(v > FAIXA_BOUNDS[-1][0], F.lit(FAIXA_TOP))
