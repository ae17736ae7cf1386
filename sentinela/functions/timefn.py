"""Time expressions.

All timestamps are kept as ``timestamp_ntz`` (the source columns carry no
zone), so hour/date extraction does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business hours are 08:00 to 18:59:59 (hour between 8 and 18).
BUSINESS_FIRST_HOUR = 8
BUSINESS_LAST_HOUR = 18


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def coerce_timestamp(col: Column | str) -> Column:
    """Parse text (or pass a timestamp through) to ``timestamp_ntz``; bad input -> NULL."""
    return _c(col).try_cast("timestamp_ntz")


def hour_of_day(col: Column | str) -> Column:
    """Hour 0–23 as bigint (the analytical SQL returns a 64-bit hour)."""
    return F.hour(_c(col)).cast("bigint")


def fora_horario(col: Column | str) -> Column:
    """True outside business hours: ``not (8 <= hour <= 18)``."""
    return ~F.hour(_c(col)).between(BUSINESS_FIRST_HOUR, BUSINESS_LAST_HOUR)


def epoch_micros(col: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz``, zone independent."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(col))
