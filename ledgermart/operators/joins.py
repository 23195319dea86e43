"""Joins and set comparisons.

No side is broadcast by a hint.  The planner and AQE broadcast a side whose
measured bytes stay below ``spark.sql.autoBroadcastJoinThreshold`` (inline
mappings and small dimensions do) and sort-merge or shuffle-hash anything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.functions._util import names
from ledgermart.functions.numbers import differs

def selected_rows(rows: DataFrame, manifest: DataFrame, on, flag: str | Column = "is_selected", carry=()) -> DataFrame:
    """Rows of selected files only (J1): a semi-join, or an inner join carrying columns."""
    cond = F.col(flag) if isinstance(flag, str) else flag
    sel = manifest.filter(cond).select(*names(on), *carry)
    if not carry:
        return rows.join(sel, names(on), "left_semi")
    return rows.join(sel, names(on), "inner")


def star_join(fact: DataFrame, dims) -> DataFrame:
    """Chain fact → dims; each dim is ``(df, on, how)``."""
    out = fact
    for dim, on, how in dims:
        out = out.join(dim, on, how)
    return out


def with_membership(df: DataFrame, members: DataFrame, on, flag_col: str) -> DataFrame:
    """Left join for a membership flag (J5).  Distinct keys: never fans out."""
    keys = names(on)
    m = members.select(*keys).distinct().withColumn("_member", F.lit(True))
    return df.join(m, keys, "left").withColumn(flag_col, F.col("_member").isNotNull()).drop("_member")


def with_scalar(df: DataFrame, one_row: DataFrame, columns=None) -> DataFrame:
    """Attach the values of a one-row frame (J6) as scalar subqueries (no join)."""
    cols = names(columns) if columns else one_row.columns
    return df.withColumns({c: one_row.select(c).scalar() for c in cols})


def set_compare(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Distinct rows of either side with ``in_expected`` / ``in_actual`` flags.

    Both sides are tagged, unioned and grouped on all columns: map-side
    partial aggregation de-duplicates, nulls group together (as in
    ``EXCEPT``), and the whole comparison is one shuffle.
    """
    cols = expected.columns
    tagged = expected.select(*cols, F.lit(True).alias("_e"), F.lit(False).alias("_a")).unionByName(
        actual.select(*cols, F.lit(False).alias("_e"), F.lit(True).alias("_a")))
    return tagged.groupBy(*cols).agg(F.bool_or("_e").alias("in_expected"), F.bool_or("_a").alias("in_actual"))


def set_diff(expected: DataFrame, actual: DataFrame, issue_col: str = "issue",
             missing: str = "missing", unexpected: str = "unexpected") -> DataFrame:
    """``(expected except actual) ∪ (actual except expected)`` labelled.

    One aggregation (:func:`set_compare`) instead of two anti-joins; a row
    seen on one side only is a difference.
    """
    seen = set_compare(expected, actual)
    return seen.filter(F.col("in_expected") != F.col("in_actual")).select(
        *expected.columns,
        F.when(F.col("in_expected"), F.lit(missing)).otherwise(F.lit(unexpected)).alias(issue_col))


def reconcile(expected: DataFrame, actual: DataFrame, keys, amount: str,
              tolerance: float = 0.01, expected_col: str = "expected_amount",
              actual_col: str = "actual_amount") -> DataFrame:
    """Full outer reconciliation on ``keys``.

    Every key present on either side is reported, with both amounts, the
    difference and a status: ``match``, ``mismatch``, ``missing_actual``,
    ``missing_expected``.
    """
    ks = names(keys)
    e = expected.select(*ks, F.col(amount).alias(expected_col)).withColumn("_e", F.lit(True))
    a = actual.select(*ks, F.col(amount).alias(actual_col)).withColumn("_a", F.lit(True))
    j = e.join(a, ks, "full_outer")
    status = (
        F.when(F.col("_a").isNull(), F.lit("missing_actual"))
        .when(F.col("_e").isNull(), F.lit("missing_expected"))
        .when(differs(expected_col, actual_col, tolerance), F.lit("mismatch"))
        .otherwise(F.lit("match"))
    )
    zero = F.lit(0)
    return j.select(
        *ks,
        F.col(expected_col),
        F.col(actual_col),
        (F.coalesce(F.col(actual_col), zero) - F.coalesce(F.col(expected_col), zero)).alias("difference"),
        status.alias("status"),
    )
