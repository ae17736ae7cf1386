"""String cleaning expressions.

Python's ``str.strip``/``str.title`` semantics are rebuilt from Spark
built-ins so they run inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns of the cleaning step.
WHITESPACE_EDGES = r"(?U)^\s+|\s+$"          # Unicode whitespace at either end
CPF_PUNCTUATION = r"[.\-]"                    # removed from CPF numbers
LETTER_RUNS = r"\p{L}+|\P{L}+"                # alternating letter / non-letter runs
CPF_LENGTH = 11


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(col), WHITESPACE_EDGES, "")


def title_case(col: Column | str) -> Column:
    """Upper-case the first letter after any non-letter, lower-case the rest.

    ``initcap`` only capitalises after spaces (``D'avila``); this splits the
    lower-cased text into letter / non-letter runs and capitalises each run,
    so ``d'avila ana-maria`` becomes ``D'Avila Ana-Maria``.
    """
    runs = F.regexp_extract_all(F.lower(_c(col)), F.lit(LETTER_RUNS), 0)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))),
        "")


def digits_only(col: Column | str) -> Column:
    """Delete CPF punctuation (dots and dashes)."""
    return F.regexp_replace(_c(col), CPF_PUNCTUATION, "")


def cpf_invalid(col: Column | str) -> Column:
    """True when the CPF does not have 11 characters; a NULL CPF counts as invalid."""
    return F.coalesce(F.length(_c(col)), F.lit(-1)) != CPF_LENGTH
