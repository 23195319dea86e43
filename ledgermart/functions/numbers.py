"""Numeric Column helpers: locale decimals, money, safe ratios, tolerances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermart.functions._util import col

MONEY = "decimal(38,2)"
MACRO = "decimal(38,10)"


def money(c) -> Column:
    """Exact two-decimal amount (cast before summing so totals are exact)."""
    return col(c).cast(MONEY)


def locale_decimal_text(c) -> Column:
    """Render an amount as ``1.234,56`` (dot thousands, comma decimals)."""
    us = F.format_number(col(c).cast(MONEY), 2)  # 1,234.56
    return F.translate(us, ",.", ".,")


def parse_locale_decimal(c, scale: int = 2) -> Column:
    """Parse ``1.234,56``: strip, drop every ``.``, ``,`` → ``.``, exact.

    Null when the text is not a finite decimal or carries more than ``scale``
    fraction digits (the cast would otherwise round silently).
    """
    norm = F.replace(F.replace(F.trim(col(c)), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    frac = F.regexp_extract(norm, r"\.(\d*)$", 1)
    ok = norm.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$") & (F.length(frac) <= scale)
    return F.when(ok, norm.try_cast(f"decimal(38,{scale})"))


def decimal_text(c) -> Column:
    """Lossless text of a decimal value."""
    return col(c).cast("string")


def safe_divide(a, b) -> Column:
    """Ratio as double; null when the denominator is 0 or null (DAX DIVIDE)."""
    return F.try_divide(col(a).cast("double"), F.nullif(col(b).cast("double"), F.lit(0.0)))


def growth(current, prior) -> Column:
    """``(cur − prior)/prior``: null prior → null; null current counts as 0."""
    cur = F.coalesce(col(current), F.lit(0).cast(MONEY))
    return F.when(col(prior).isNotNull(), safe_divide(cur - col(prior), col(prior)))


def differs(a, b, tolerance: float = 0.01) -> Column:
    """``abs(a − b) > tol`` with nulls read as 0."""
    zero = F.lit(0)
    return F.abs(F.coalesce(col(a), zero) - F.coalesce(col(b), zero)) > F.lit(tolerance)
