"""Aggregations.

Everything is a hash aggregate with map-side partial aggregation, so a hot
group key costs one partial row per map task, not a third of the data in one
task.  Collections (``collect_set``) and exact medians are only used on groups
whose size is bounded by a fixed domain (mapped accounts, members).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions._util import names
from ledgermart.functions.text import join_set


def line_balance(
    rows: DataFrame,
    mapping: DataFrame,
    keys,
    account: str,
    amount: str,
    flag: str | Column | None = None,
    line: str = "reporting_line_key",
    version: str = "mapping_version",
    multiplier: str = "presentation_multiplier",
) -> DataFrame:
    """Mapped line balances per ``keys`` (D17: A4, A6, A9, A13).

    Output per (keys, line, version): ``reported_balance_amount`` (plain sum),
    ``presentation_balance_amount`` (signed sum), ``contributing_account_count``,
    ``contributing_account_codes`` (sorted, ``|``-joined) and ``all_flag``
    (``bool_and`` of ``flag``).

    The raw rows are first aggregated to the account grain; the mapping (which
    may fan one account out to several lines) is applied to that small table,
    so the fan-out never multiplies raw rows.  Sums are linear, the distinct
    count and code set are per account, ``bool_and`` is associative: the
    result equals joining raw rows to the mapping and grouping once.
    """
    ks = names(keys)
    flag_col = (F.col(flag) if isinstance(flag, str) else flag) if flag is not None else F.lit(True)
    per_account = rows.groupBy(*ks, account).agg(
        F.sum(amount).alias("_reported"),
        F.bool_and(flag_col).alias("_flag"),
    )
    fanned = per_account.join(mapping.select(account, line, version, multiplier), account, "inner")
    return fanned.groupBy(*ks, line, version).agg(
        F.sum("_reported").alias("reported_balance_amount"),
        F.sum(F.col("_reported") * F.col(multiplier)).alias("presentation_balance_amount"),
        F.count_distinct(account).cast("int").alias("contributing_account_count"),
        join_set(account).alias("contributing_account_codes"),
        F.bool_and("_flag").alias("all_flag"),
    )


def pivot_sums(df: DataFrame, keys, code: str, amount: str, codes: dict[str, object], extra=()) -> DataFrame:
    """Conditional-sum pivot in one pass (A7): ``sum(amount) filter (where code = v)``.

    ``extra`` aggregates (counts, totals) ride along in the same aggregate.
    """
    return df.groupBy(*names(keys)).agg(
        *[F.sum(F.when(F.col(code) == F.lit(v), F.col(amount))).alias(name) for name, v in codes.items()],
        *extra,
    )


def metrics_row(spark: SparkSession, metrics: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row of independent metrics (A10), each an uncorrelated scalar subquery.

    ``metrics = {name: (frame, aggregate Column)}``; Catalyst merges the
    subqueries that scan the same frame.
    """
    return spark.range(1).select(*[frame.select(agg).scalar().alias(name) for name, (frame, agg) in metrics.items()])


def peer_median(df: DataFrame, measure: str, by=(), out_col: str = "peer_median") -> DataFrame:
    """Exact median of ``measure`` across members per ``by`` group.

    Input is one row per member (already aggregated), so a group holds at most
    the member population; nulls drop out, an even count averages the middle
    pair.
    """
    g = df.groupBy(*names(by)) if by else df.groupBy()
    return g.agg(F.median(measure).alias(out_col))


def null_scan(df: DataFrame, cols=None, table: str | None = None) -> DataFrame:
    """Null count of every column in one pass (A17, Q1), one output row per column."""
    cs = names(cols) if cols else df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cs])
    long = wide.unpivot([], cs, "column_name", "null_count")
    if table:
        long = long.withColumn("table_name", F.lit(table))
    return long


def distinct_tuples(df: DataFrame, cols, out_col: str = "distinct_tuples") -> Column:
    """``count(distinct (a, b))`` over whole row values, nulls included (A5)."""
    return F.count_distinct(F.struct(*[F.col(c) for c in names(cols)])).alias(out_col)


def sorted_set(c: str) -> Column:
    """``array_agg(distinct c order by c)`` (A11) for bounded domains."""
    return F.array_sort(F.collect_set(F.col(c)))
