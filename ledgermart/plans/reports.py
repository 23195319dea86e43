"""Report queries (R1–R8) as presets of the measure layer over the marts.

Each visual is one query: group keys = the visual's axes, measures = its
values, ``where`` = slicers.  Nothing here renders; every function returns a
DataFrame at the visual's grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.functions.dates import month_label
from ledgermart.operators.measures import MeasureModel, macro_value, trust_card

# The measures behind each card.
CARDS = {
    "pulse": ["total_assets", "credit_portfolio", "deposits", "equity"],
    "compare": ["total_assets", "population_share", "credit_share", "equity_to_assets"],
}


def model_from_marts(marts: dict[str, DataFrame]) -> MeasureModel:
    """Measure model over ``fact_reporting_line_balance`` with bank names attached."""
    fact = marts["fact_reporting_line_balance"].join(
        marts["dim_bank"].select("bank_key", F.col("institution_name").alias("bank_name")), "bank_key")
    return MeasureModel(fact, month="report_month", member="bank_key", line="reporting_line_code",
                        amount="presentation_balance_amount", date_dim=marts["dim_date"], date_month="month_start",
                        member_attributes=["bank_name"])


def cards(model: MeasureModel, page: str, where: Column | None = None, months=None, anchor: str = "fact") -> DataFrame:
    """Single-value cards (no group keys).

    Without a bank on the axis the population share is the selection's own
    share (1.0); a bank slicer in ``where`` narrows both parts alike.
    """
    return model.query(CARDS[page], where=where, months=months, anchor=anchor)


def assets_by_bank(model: MeasureModel, where: Column | None = None, months=None) -> DataFrame:
    """R2: total assets by bank, largest first."""
    return model.query(["total_assets"], by=["bank_key", "bank_name"], where=where, months=months).orderBy(
        F.col("total_assets").desc_nulls_last(), "bank_name")


def mix_table(model: MeasureModel, where: Column | None = None, months=None, anchor: str = "fact") -> DataFrame:
    """Bank mix: total assets, MoM growth and the three ratios."""
    return model.query(["total_assets", "mom_growth", "credit_share", "deposit_funding_share", "equity_to_assets"],
                       by=["bank_key", "bank_name"], where=where, months=months, anchor=anchor).orderBy(
        F.col("total_assets").desc_nulls_last())


def peer_table(model: MeasureModel, where: Column | None = None, months=None) -> DataFrame:
    """Peers: total assets, population share and ratios."""
    return model.query(["total_assets", "population_share", "credit_share", "deposit_funding_share",
                        "equity_to_assets"], by=["bank_key", "bank_name"], where=where, months=months).orderBy(
        F.col("total_assets").desc_nulls_last())


def macro_by_month(marts: dict[str, DataFrame], series: list[str] | None = None) -> DataFrame:
    """Macro value by month label × series."""
    ctx = marts["fact_monthly_economic_context"]
    if series:
        ctx = ctx.filter(F.col("series_code").isin(*series))
    ctx = ctx.withColumn("month_label", month_label("report_month"))
    return macro_value(ctx, "value", by=["report_month", "month_label", "series_code"]).orderBy("report_month", "series_code")


def credit_share_by_month(model: MeasureModel, where: Column | None = None) -> DataFrame:
    """Credit share by month × bank."""
    return model.query(["credit_share"], by=["report_month", "bank_key", "bank_name"], where=where).withColumn(
        "month_label", month_label("report_month")).orderBy("report_month", "bank_name")


def slicer(df: DataFrame, col: str) -> DataFrame:
    """Distinct member list for a slicer."""
    return df.select(col).distinct().orderBy(col)


def mapping_table(marts: dict[str, DataFrame]) -> DataFrame:
    """The governed mapping (line code, account code, component)."""
    return marts["bridge_account_reporting_line"].select(
        "reporting_line_code", "account_code", "component_name").orderBy("reporting_line_code", "account_code")


def source_file_table(marts: dict[str, DataFrame]) -> DataFrame:
    """Selected source files, oldest period first."""
    return marts["dim_source_file"].select(
        "source_period", "source_checksum", "declared_row_count", "source_generated_at", "retrieved_at_utc").orderBy(
        "source_period")


def trust_cards(marts: dict[str, DataFrame]) -> DataFrame:
    """M14–M16 on the trust page."""
    return trust_card(marts["dim_source_file"], marts["dim_date"])
