"""Surrogate keys: lower-case hex md5 of ``|``-joined business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermart.functions._util import col


def surrogate_key(*cs, sep: str = "|") -> Column:
    """md5 of the keys joined by ``sep``; null if any key is null.

    ``concat`` (not ``concat_ws``) keeps the null-propagating ``||`` rule.
    Dates render ISO, numbers plain.
    """
    parts = []
    for i, c in enumerate(cs):
        if i:
            parts.append(F.lit(sep))
        parts.append(col(c).cast("string"))
    return F.md5(F.concat(*parts))
