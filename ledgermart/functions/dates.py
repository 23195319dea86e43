"""Month and period Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermart.functions._util import col

# The earliest valid reporting year and the URL period pattern.
MIN_PERIOD_YEAR = 1988
BANK_URL_PERIOD = r"(?i)/(\d{6})BANCOS(\.[^/?#]+)+$"


def month_start(c, fmt: str | None = None, strict: bool = True) -> Column:
    """First day of the month.

    * ``fmt`` given (e.g. ``"yyyyMM"``): parse text; ``strict`` raises on bad
      text (ANSI), otherwise yields null so the row can be profiled.
    * no ``fmt``: truncate a date / timestamp / timestamp_ntz.
    """
    c = col(c)
    if fmt:
        parsed = F.to_date(c, fmt) if strict else F.try_to_date(c, fmt)
        return F.trunc(parsed, "month")
    return F.trunc(F.to_date(c), "month")


def month_from_parts(period_text) -> Column:
    """``'YYYYMM' || '01'`` parsed as a date (period string → date)."""
    return F.to_date(F.concat(col(period_text), F.lit("01")), "yyyyMMdd")


def month_key(c) -> Column:
    """``yyyyMM`` as an integer."""
    return F.date_format(col(c), "yyyyMM").cast("int")


def month_label(c) -> Column:
    """English ``Mon yyyy`` label."""
    return F.date_format(col(c), "MMM yyyy")


def quarter_start(c) -> Column:
    return F.trunc(col(c), "quarter")


def year_start(c) -> Column:
    return F.trunc(col(c), "year")


def add_months_(c, n: int) -> Column:
    return F.add_months(col(c), n)


def month_diff(earlier, later) -> Column:
    """Whole months from ``earlier`` to ``later`` (negative when later < earlier)."""
    a, b = col(earlier), col(later)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def valid_period(c) -> Column:
    """``YYYYMM``: six digits, year >= 1988, month 1-12."""
    c = col(c)
    year = F.substring(c, 1, 4).try_cast("int")
    month = F.substring(c, 5, 2).try_cast("int")
    return F.coalesce(
        c.rlike(r"^\d{6}$") & (year >= MIN_PERIOD_YEAR) & month.between(1, 12), F.lit(False)
    )


def period_text(c) -> Column:
    """Month date → ``YYYYMM`` text."""
    return F.date_format(col(c), "yyyyMM")


def period_from_url(c, pattern: str = BANK_URL_PERIOD) -> Column:
    """Period from a bank-file URL (case-insensitive, multi-extension)."""
    return F.nullif(F.regexp_extract(col(c), pattern, 1), F.lit(""))


def generated_date(c) -> Column:
    """Generation date in metadata text: ``dd/MM/yyyy`` first, else ISO."""
    c = col(c)
    dmy = F.nullif(F.regexp_extract(c, r"\b(\d{2}/\d{2}/\d{4})\b", 1), F.lit(""))
    iso = F.nullif(F.regexp_extract(c, r"\b(\d{4}-\d{2}-\d{2})\b", 1), F.lit(""))
    return F.coalesce(F.try_to_date(dmy, "dd/MM/yyyy"), F.try_to_date(iso, "yyyy-MM-dd"))
