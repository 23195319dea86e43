"""Text Column helpers (blank handling, booleans, set rendering)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermart.functions._util import col

# The truth sets used by the reference's boolean readers.
STRICT_TRUE = ("true", "1", "yes")
STRICT_FALSE = ("false", "0", "no")
LENIENT_TRUE = ("true", "1", "yes", "pass", "ready")

_EDGE_WS = r"^\s+|\s+$"


def strip_all(c) -> Column:
    """Strip every kind of leading/trailing whitespace (Python ``str.strip``)."""
    return F.regexp_replace(col(c), _EDGE_WS, "")


def blank_to_null(c, python_strip: bool = False) -> Column:
    """``nullif(trim(c), '')``; ``python_strip`` also strips tabs/newlines."""
    trimmed = strip_all(c) if python_strip else F.trim(col(c))
    return F.nullif(trimmed, F.lit(""))


def first_text(*cols) -> Column:
    """First non-blank value among several fields (API variants)."""
    return F.coalesce(*[blank_to_null(c, python_strip=True) for c in cols])


def is_synthetic(c, prefix: str = "fixture://") -> Column:
    """Prefix predicate marking synthetic rows."""
    return col(c).startswith(prefix)


def flag(c) -> Column:
    """Null-test flag."""
    return col(c).isNotNull()


def strict_bool(c, on_error: str = "null") -> Column:
    """Strict text boolean: true/1/yes, false/0/no; anything else is an error.

    ``on_error="raise"`` fails the job (fail-closed reader); ``"null"`` keeps the
    row with a null so a profile can report it.
    """
    norm = F.lower(strip_all(c))
    bad = F.lit(None).cast("boolean")
    if on_error == "raise":
        bad = F.raise_error(F.concat(F.lit("Invalid CSV boolean: "), F.coalesce(col(c), F.lit("NULL")))).cast("boolean")
    return (
        F.when(norm.isin(*STRICT_TRUE), F.lit(True))
        .when(norm.isin(*STRICT_FALSE), F.lit(False))
        .otherwise(bad)
    )


def lenient_bool(c) -> Column:
    """Lenient truth test used for readiness evidence."""
    return F.coalesce(F.lower(strip_all(col(c).cast("string"))).isin(*LENIENT_TRUE), F.lit(False))


def join_set(c, sep: str = "|") -> Column:
    """Aggregate: sorted distinct values joined by ``sep`` (``a|b|c``).

    Only for groups whose distinct values are bounded by a fixed domain.
    """
    return F.array_join(F.array_sort(F.collect_set(col(c))), sep)


def message_list(*conditions: tuple[Column, str], sep: str = "; ") -> Column:
    """Join the messages whose condition holds; null when none holds."""
    parts = [F.when(cond, F.lit(msg)) for cond, msg in conditions]
    return F.nullif(F.concat_ws(sep, *parts), F.lit(""))


def code_prefix(c, n: int) -> Column:
    """First ``n`` characters of a hierarchical code (class = 1, group = 2)."""
    return F.substring(col(c), 1, n)
