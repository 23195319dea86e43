"""Comparison population: per-(period, member) state, top-N freeze, coverage
(A15, A16, W3, O1, O2, C7, D20).

The raw rows are touched once, by one ``groupBy(period, member)`` with
map-side partial aggregation; everything after works on at most
members × periods rows.  The top-N cut uses ``orderBy().limit(n + 1)``
(TakeOrderedAndProject: each task keeps n + 1 rows), so the rank window only
ever sees n + 1 rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermart.functions._util import names


def member_period_state(
    rows: DataFrame,
    period: str,
    member: str,
    account: str,
    amount: str,
    accounts: dict[str, str],
    name: str | None = None,
    taxonomy: str | None = None,
) -> DataFrame:
    """Per (period, member): sum and row count for each listed account, and
    the representative name / taxonomy (greatest value, A15).

    ``accounts = {alias: account code}``.  A sum is null when the member has no
    row for that account in the period (presence is kept apart from zero).
    """
    aggs: list[Column] = []
    for alias, code in accounts.items():
        hit = F.col(account) == F.lit(code)
        aggs.append(F.sum(F.when(hit, F.col(amount))).alias(alias))
        aggs.append(F.count_if(hit).alias(f"{alias}_rows"))
    if name:
        aggs.append(F.max(name).alias("member_name"))
    if taxonomy:
        aggs.append(F.max(taxonomy).alias("taxonomy"))
    return rows.groupBy(period, member).agg(*aggs)


def top_members(
    df: DataFrame,
    member: str,
    amount: str,
    n: int,
    rank_col: str = "freeze_rank",
    gap_col: str = "cutoff_gap",
) -> DataFrame:
    """Top ``n`` members by ``amount`` desc, ``member`` asc.

    Adds the rank and the cutoff gap ``amount(n) − amount(n+1)`` (null when
    fewer than n + 1 candidates exist) to every selected row.  ``df`` is one row
    per member.
    """
    order = [F.col(amount).desc_nulls_last(), F.col(member).asc()]
    head = df.orderBy(*order).limit(n + 1)
    w = Window.orderBy(*order)
    ranked = head.withColumn(rank_col, F.row_number().over(w).cast("int"))
    # the frame holds at most n + 1 rows: a whole-frame window is bounded
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gap = (F.max(F.when(F.col(rank_col) == n, F.col(amount))).over(everything)
           - F.max(F.when(F.col(rank_col) == n + 1, F.col(amount))).over(everything))
    return ranked.withColumn(gap_col, gap).filter(F.col(rank_col) <= n)


def distinct_members_by(rows: DataFrame, keys, member: str, pivot: str, values: list[str]) -> DataFrame:
    """Distinct members per key and pivot value (A16), one column per value."""
    return rows.groupBy(*names(keys)).pivot(pivot, values).agg(F.count_distinct(member))


def document_scope(rows: DataFrame, period: str, member: str, document: str, documents: dict) -> DataFrame:
    """Distinct members per period and document, and by how many documents they are in.

    ``documents = {alias: document code}`` (62 at most).  One aggregate gives each
    (period, member) the set of its documents as bits, so the raw rows are counted
    without a distinct count per document (no ``Expand``).  Per period:
    ``{alias}_members``, ``any_members`` and ``all_members`` (in any or all listed
    documents), ``unlisted_members`` (in none of them) and ``blank_member_rows``
    (rows whose member is null or empty; they count as no member).
    """
    if not 0 < len(documents) <= 62:
        raise ValueError("document_scope takes 1 to 62 documents")
    bit = F.lit(0).cast("bigint")
    for i, code in enumerate(documents.values()):
        bit = F.when(F.col(document) == F.lit(code), F.lit(1 << i).cast("bigint")).otherwise(bit)
    scopes = rows.groupBy(period, member).agg(F.bit_or(bit).alias("_scope"), F.count(F.lit(1)).alias("_rows"))
    blank = F.coalesce(F.trim(F.col(member).cast("string")) == "", F.lit(True))
    inside = lambda mask: (F.col("_scope").bitwiseAND(F.lit(mask).cast("bigint")) == mask) & ~blank
    every = (1 << len(documents)) - 1
    return scopes.groupBy(period).agg(
        *[F.count_if(inside(1 << i)).alias(f"{alias}_members") for i, alias in enumerate(documents)],
        F.count_if((F.col("_scope") != 0) & ~blank).alias("any_members"),
        F.count_if(inside(every)).alias("all_members"),
        F.count_if((F.col("_scope") == 0) & ~blank).alias("unlisted_members"),
        F.coalesce(F.sum(F.when(blank, F.col("_rows"))), F.lit(0)).alias("blank_member_rows"),
    )


def member_history(monthly: DataFrame, member: str, components: list[str], difference: str | None = None,
                   tolerance: float = 1.00) -> DataFrame:
    """How complete each frozen member is over the periods.

    ``monthly`` is one row per (period, member) of the population, so a group holds
    one row per period.  ``difference`` names the reference difference, if there is one.
    """
    complete = F.lit(True)
    for c in components:
        complete = complete & F.col(c).isNotNull()
    aggs = [F.count(F.lit(1)).alias("periods_present"), F.count_if(complete).alias("component_complete_periods")]
    if difference:
        aggs += [F.count(difference).alias("reference_complete_periods"),
                 F.count_if(F.abs(F.col(difference)) <= F.lit(tolerance)).alias("reference_reconciled_periods")]
    return monthly.groupBy(member, "freeze_rank").agg(*aggs)


@dataclass
class Population:
    """Outputs of :func:`profile_population`."""

    period_profile: DataFrame
    members: DataFrame
    monthly: DataFrame
    state: DataFrame
    history: DataFrame


def profile_population(
    rows: DataFrame,
    period: str,
    member: str,
    account: str,
    amount: str,
    asset_accounts: dict[str, str],
    presence_account: str,
    freeze_period=None,
    n: int = 15,
    reference_total: str | None = None,
    reference_offset: str | None = None,
    tolerance: float = 1.00,
    name: str | None = None,
    taxonomy: str | None = None,
    document: str | None = None,
    documents: dict | None = None,
    ranking: str | None = None,
) -> Population:
    """Profile periods and freeze a top-``n`` population.

    * ``asset_accounts``: alias → account code of the components of the total
      (a missing component counts as 0 inside the total);
    * ``presence_account``: alias that must be present for a member to rank;
    * optional ``reference_total`` / ``reference_offset`` aliases: the
      reference total is ``total − offset`` and must agree within ``tolerance``.
    * optional ``document`` column, ``documents`` (alias → code) and the alias
      ``ranking`` of the one that members are ranked by: only its rows enter the
      state, and the period profile gains the columns of :func:`document_scope`,
      for periods without a row of the ranking document too.
    ``freeze_period`` defaults to the latest period.
    """
    accounts = dict(asset_accounts)
    scope = None
    if document:
        if not documents or ranking not in documents:
            raise ValueError("the ranking document must be one of documents")
        scope = document_scope(rows, period, member, document, documents)
        present = F.trim(F.col(member).cast("string")) != ""
        rows = rows.filter((F.col(document) == F.lit(documents[ranking])) & present)
    for extra in (reference_total, reference_offset):
        if extra and extra not in accounts:
            raise ValueError(f"{extra} must be listed in asset_accounts")
    state = member_period_state(rows, period, member, account, amount, accounts, name, taxonomy)
    components = [a for a in accounts if a not in (reference_total, reference_offset)]
    total = sum((F.coalesce(F.col(a), F.lit(0)) for a in components), F.lit(0))
    state = state.withColumn("total_amount", total)
    if reference_total:
        ref = F.col(reference_total) - F.coalesce(F.col(reference_offset), F.lit(0)) if reference_offset else F.col(reference_total)
        state = state.withColumn("reference_difference", F.col("total_amount") - ref)
    if freeze_period is not None:
        at_freeze = state.filter(F.col(period) == F.lit(freeze_period))
    else:  # latest period: an equi-join with the one-row aggregate
        at_freeze = state.join(state.agg(F.max(period).alias(period)), period, "inner")
    candidates = at_freeze.filter(F.col(presence_account).isNotNull())
    members = top_members(candidates.select(member, "total_amount", *([c for c in ("member_name", "taxonomy") if c in state.columns])),
                          member, "total_amount", n)
    monthly = state.join(members.select(member, "freeze_rank"), member, "inner")
    diff = F.abs(F.col("reference_difference")) if reference_total else None
    prof_aggs = [
        F.count(F.lit(1)).alias("members"),
        *[F.count_if(F.col(a).isNotNull()).alias(f"{a}_present") for a in components],
        F.sum("total_amount").alias("summed_total_amount"),
    ]
    if reference_total:
        prof_aggs += [
            F.count_if(F.col("reference_difference").isNotNull()).alias("reference_total_present"),
            F.count_if(diff <= F.lit(tolerance)).alias("reference_reconciled"),
            F.count_if(diff > F.lit(tolerance)).alias("reference_outliers"),
            F.max(diff).alias("max_abs_reference_difference"),
        ]
    period_profile = state.groupBy(period).agg(*prof_aggs)
    if scope is not None:
        counts = [c for c in period_profile.columns if c not in (period, "max_abs_reference_difference")]
        period_profile = scope.join(period_profile, period, "left").fillna(0, counts)
    history = member_history(monthly, member, components, "reference_difference" if reference_total else None, tolerance)
    return Population(period_profile=period_profile, members=members, monthly=monthly, state=state, history=history)
