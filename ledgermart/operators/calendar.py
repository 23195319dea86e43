"""Calendar and time-series operators.

Windows here run only on de-duplicated (key, month) rows: a group then holds
at most one row per calendar month, whatever the raw row count of the key.
Missing months are produced from the gaps between consecutive observed months,
so the output is exactly the missing months (no full key × month grid).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermart.functions._util import names
from ledgermart.functions.dates import month_diff, month_key, month_label, period_text, quarter_start, year_start
from ledgermart.functions.numbers import safe_divide
from ledgermart.functions.text import message_list


def _one_month() -> Column:
    return F.expr("INTERVAL 1 MONTH")


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def month_sequence(start, end) -> Column:
    """Inclusive array of month starts."""
    return F.sequence(F.trunc(_lit_date(start), "month"), F.trunc(_lit_date(end), "month"), _one_month())


def month_range(spark: SparkSession, start, end, col: str = "month_start") -> DataFrame:
    """Inclusive months between two dates (C1) – a parameter table, not data."""
    return spark.range(1).select(F.explode(month_sequence(start, end)).alias(col))


def calendar(*month_frames: DataFrame, month_col: str = "report_month") -> DataFrame:
    """Calendar dimension over the observed months only."""
    months = None
    for f in month_frames:
        m = f.select(F.col(month_col).cast("date").alias("month_start"))
        months = m if months is None else months.union(m)
    months = months.distinct()
    return months.select(
        month_key("month_start").alias("month_key"),
        F.col("month_start"),
        F.year("month_start").alias("calendar_year"),
        F.quarter("month_start").alias("calendar_quarter"),
        F.month("month_start").alias("calendar_month"),
        month_label("month_start").alias("month_label"),
        quarter_start("month_start").alias("quarter_start"),
        year_start("month_start").alias("year_start"),
    )


def _distinct_months(df: DataFrame, key, month: str) -> DataFrame:
    return df.select(*names(key), F.trunc(F.to_date(month), "month").alias(month)).distinct()


def continuity_breaks(df: DataFrame, key, month: str, prev_col: str = "previous_month") -> DataFrame:
    """Months that do not follow the previous observed month of the key."""
    ks = names(key)
    m = _distinct_months(df, ks, month)
    w = Window.partitionBy(*ks).orderBy(month)
    s = m.withColumn(prev_col, F.lag(month).over(w))
    return s.filter(F.col(prev_col).isNotNull() & (F.col(month) != F.add_months(prev_col, 1))).withColumn(
        "gap_months", month_diff(prev_col, month).cast("int")
    )


def missing_months(df: DataFrame, key, month: str, out_col: str = "missing_month") -> DataFrame:
    """Internal missing months between each key's first and last month."""
    ks = names(key)
    gaps = continuity_breaks(df, ks, month, "_prev")
    return gaps.select(
        *ks,
        F.explode(F.sequence(F.add_months("_prev", 1), F.add_months(month, -1), _one_month())).alias(out_col),
    )


def coverage(df: DataFrame, member, month: str, expected_months: int | Column | None = None) -> DataFrame:
    """Months covered per member against the expected count.

    ``expected_months`` defaults to the distinct months of the whole frame
    (a scalar subquery, no member × month grid).
    """
    ms = names(member)
    m = _distinct_months(df, ms, month)
    if expected_months is None:
        expected_months = m.select(F.count_distinct(month)).scalar()
    elif not isinstance(expected_months, Column):
        expected_months = F.lit(expected_months)
    return m.groupBy(*ms).agg(
        F.count(F.lit(1)).alias("months_covered"),
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
    ).withColumn("months_expected", expected_months.cast("bigint")).withColumn(
        "is_complete", F.col("months_covered") == F.col("months_expected")
    )


def profile_series(
    obs: DataFrame,
    key: str,
    date_col: str,
    start,
    end,
    max_lag=None,
    registry: DataFrame | None = None,
) -> DataFrame:
    """Series profile (C2, C4): counts, bounds, duplicates, gaps, freshness, status.

    ``max_lag`` is a column name of ``registry`` or a number.  With a
    registry, every registered series gets a row; one without observations
    has status ``error``.
    """
    start_m = F.trunc(_lit_date(start), "month")
    end_m = F.trunc(_lit_date(end), "month")
    o = obs.select(F.col(key), F.to_date(date_col).alias("_d")).withColumn("_m", F.trunc("_d", "month"))
    # two levels, one distinct count at most per aggregate (no row expansion):
    # (key, date) multiplicities, then per key; the gaps read the same
    # per-day aggregate, so the observations are scanned and shuffled once
    per_day = o.groupBy(key, "_d", "_m").agg(F.count(F.lit(1)).alias("_n"))
    gaps = missing_months(per_day.select(key, "_m"), key, "_m", "_missing").groupBy(key).agg(
        F.count(F.lit(1)).alias("internal_missing_month_count"),
        F.array_join(F.array_sort(F.collect_list(period_text("_missing"))), "|").alias("internal_missing_months"),
    )
    prof = per_day.groupBy(key).agg(
        F.sum("_n").alias("row_count"),
        F.min("_d").alias("first_observation_date"),
        F.max("_d").alias("last_observation_date"),
        F.min("_m").alias("_first_m"),
        F.max("_m").alias("_last_m"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicate_observation_date_count"),
        (F.sum("_n") - F.count_distinct("_m")).alias("duplicate_report_month_count"),
    ).join(gaps, key, "left")
    if registry is not None:
        lag_col = F.col(max_lag) if isinstance(max_lag, str) else F.lit(max_lag)
        base = registry.select(F.col(key), lag_col.cast("bigint").alias("max_expected_lag_months"))
        prof = base.join(prof, key, "left")
    else:
        prof = prof.withColumn("max_expected_lag_months", F.lit(max_lag).cast("bigint"))
    lag = month_diff(F.col("_last_m"), end_m)
    missing_n = F.coalesce(F.col("internal_missing_month_count"), F.lit(0)).cast("bigint")
    errors = message_list(
        (F.col("_first_m") != start_m, "first month differs from requested start"),
        (F.col("duplicate_observation_date_count") > 0, "duplicate observation dates"),
        (F.col("duplicate_report_month_count") > 0, "duplicate report months"),
        (missing_n > 0, "internal missing months"),
        (lag < 0, "month after the requested end"),
        (lag > F.col("max_expected_lag_months"), "freshness lag exceeds expected"),
    )
    has_rows = F.coalesce(F.col("row_count"), F.lit(0)) > 0
    return prof.select(
        F.col(key),
        F.when(~has_rows, F.lit("error")).when(errors.isNull(), F.lit("complete")).otherwise(F.lit("invalid")).alias("status"),
        period_text(start_m).alias("requested_start_month"),
        period_text(end_m).alias("requested_end_month"),
        F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
        "first_observation_date",
        "last_observation_date",
        period_text("_first_m").alias("first_report_month"),
        period_text("_last_m").alias("last_report_month"),
        missing_n.alias("internal_missing_month_count"),
        F.coalesce(F.col("internal_missing_months"), F.lit("")).alias("internal_missing_months"),
        F.coalesce(F.col("duplicate_observation_date_count"), F.lit(0)).cast("bigint").alias("duplicate_observation_date_count"),
        F.coalesce(F.col("duplicate_report_month_count"), F.lit(0)).cast("bigint").alias("duplicate_report_month_count"),
        F.when(has_rows, lag).cast("bigint").alias("lag_months_to_requested_end"),
        "max_expected_lag_months",
        F.when(~has_rows, F.lit("no observations")).otherwise(errors).alias("error"),
    )


def derive_series(obs: DataFrame, key: str, month: str, value: str, derivation: str) -> DataFrame:
    """Registry-declared derivations (C8), computed on monthly series.

    ``derivation``: ``latest`` (value as is), ``rolling_12m`` (geometric
    compounding of 12 monthly % rates, null until 12 exact months exist),
    ``yoy_pct`` (% change vs the same month a year earlier), ``pp_change``
    (percentage-point change vs the previous month).  Prior months are matched
    by exact month, not by row offset.  One row per (key, month) is expected.
    """
    m = obs.select(F.col(key), F.trunc(F.to_date(month), "month").alias(month), F.col(value).cast("double").alias("_v"))
    if derivation == "latest":
        return m.withColumnRenamed("_v", "derived_value")
    if derivation in ("yoy_pct", "pp_change"):
        back = 12 if derivation == "yoy_pct" else 1
        prior = m.select(F.col(key), F.add_months(month, back).alias(month), F.col("_v").alias("_p"))
        j = m.join(prior, [key, month], "left")
        # a prior of zero has no percentage change: null
        expr = (safe_divide("_v", "_p") - 1) * 100 if derivation == "yoy_pct" else F.col("_v") - F.col("_p")
        return j.select(key, month, expr.alias("derived_value"))
    if derivation == "rolling_12m":
        # rows are one per month, so a 12-row frame spans exactly 12 months
        # only when its first month is 11 months back
        w = Window.partitionBy(key).orderBy(month).rowsBetween(-11, 0)
        r = m.withColumn("_factors", F.collect_list(F.col("_v") / 100 + 1).over(w)).withColumn(
            "_first", F.min(month).over(w)
        ).withColumn("_n", F.count_if(F.col("_v") > -100).over(w))
        # twelve rates above -100 %: a missing or impossible rate makes the product null; the
        # factors are multiplied in month order, so the result doesn't depend on how rows arrive
        ok = (F.col("_n") == 12) & (F.col("_first") == F.add_months(month, -11))
        product = F.aggregate("_factors", F.lit(1.0), lambda done, factor: done * factor)
        return r.select(key, month, F.when(ok, (product - 1) * 100).alias("derived_value"))
    raise ValueError(f"unknown derivation {derivation!r}")


# The registry's declared derivation texts and the derivation
# each one names.
DERIVATION_TEXTS = {
    "Latest level": "latest",
    "Rolling 12-month geometric compounding": "rolling_12m",
    "Year-over-year percentage change only": "yoy_pct",
    "Year-over-year percentage change": "yoy_pct",
    "Percentage-point change": "pp_change",
}


def derive_from_registry(obs: DataFrame, registry: DataFrame, key: str = "series_code", month: str = "report_month",
                         value: str = "value", declared: str = "derived_metric") -> DataFrame:
    """C8 driven by the registry: each series gets the derivation it declares.

    The series are split by derivation with a semi-join on the registry (the
    registry is a handful of rows), each group is derived, and the groups are
    unioned; series with an unknown declaration get no derived rows.
    """
    reg = registry.select(key, F.col(declared).alias("_declared"))
    out = None
    for kind in sorted(set(DERIVATION_TEXTS.values())):
        texts = [t for t, k in DERIVATION_TEXTS.items() if k == kind]
        members = reg.filter(F.col("_declared").isin(*texts)).select(key)
        part = derive_series(obs.join(members, key, "left_semi"), key, month, value, kind).withColumn(
            "derivation", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out
