"""Canonical core and star schema of the balance domain.

Inputs are the landed tables (balance rows, file manifest, series metadata,
observations, fetch manifest) and the two seeds (reporting-line mapping,
frozen population).  Every model is one function returning a lazy DataFrame;
``build_marts`` wires them together.

Scale notes:

* the only big relations are the balance rows; they are touched by one
  semi-join to the selected manifest (D2), one partial aggregate each for
  D3 / D4 / D17, and one filtered projection for D16;
* D17 aggregates rows to (month, institution, document, file, account) before
  the mapping fan-out and before any dimension join (all dimension keys are
  group keys, so the joins commute with the aggregation);
* dims are bounded (members, months, accounts, lines, files) and are joined
  by the planner's size-checked broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermart.functions import (
    MACRO,
    MONEY,
    blank_to_null,
    is_synthetic,
    month_from_parts,
    month_start,
    surrogate_key,
)
from ledgermart.functions._util import values_frame
from ledgermart.operators.aggregates import line_balance
from ledgermart.operators.calendar import calendar
from ledgermart.operators.joins import selected_rows, with_membership
from ledgermart.operators.versioning import latest_by, select_version

# The analytical document, the asset accounts that make up total
# assets, and the document dimension rows.
RANKING_DOCUMENT = "4010"
ASSET_ACCOUNTS = ("1000000009", "2000000008")
DOCUMENTS = [
    ("4010", "Monthly individual balance sheet", True, "monthly"),
    ("4016", "Semiannual individual balance sheet", False, "semiannual"),
]


# -- staging (P1–P4) ---------------------------------------------------------
def stg_balance_rows(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("source_period").cast("string").alias("source_period"),
        month_start("source_period", "yyyyMM").alias("report_month"),
        F.col("documento").cast("string").alias("document_code"),
        F.col("cnpj").cast("string").alias("institution_cnpj"),
        blank_to_null("agencia").alias("agency_code"),
        F.col("nome_instituicao").cast("string").alias("institution_name"),
        blank_to_null("cod_congl").alias("conglomerate_code"),
        blank_to_null("nome_congl").alias("conglomerate_name"),
        blank_to_null("taxonomia").alias("taxonomy"),
        F.col("conta").cast("string").alias("account_code"),
        F.col("nome_conta").cast("string").alias("account_name"),
        F.col("saldo_raw").cast("string").alias("balance_raw"),
        F.col("saldo").cast(MONEY).alias("balance_amount"),
        F.col("source_url").cast("string").alias("source_url"),
        F.col("source_checksum").cast("string").alias("source_checksum"),
        F.col("source_generated_at").cast("date").alias("source_generated_at"),
        F.col("retrieved_at_utc").cast("timestamp").alias("retrieved_at_utc"),
        F.col("file_row_number").cast("bigint").alias("file_row_number"),
        is_synthetic("source_url").alias("is_fixture"),
    )


def stg_file_manifest(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("source_period").cast("string").alias("source_period"),
        month_start("source_period", "yyyyMM").alias("report_month"),
        "source_url", "source_checksum",
        F.col("source_generated_at").cast("date").alias("source_generated_at"),
        F.col("retrieved_at_utc").cast("timestamp").alias("retrieved_at_utc"),
        F.col("status").cast("string").alias("status"),
        F.col("is_active").cast("boolean").alias("source_is_active"),
        F.col("row_count").cast("bigint").alias("declared_row_count"),
        F.col("fixture").cast("boolean").alias("is_fixture"),
    )


def stg_series_metadata(raw: DataFrame) -> DataFrame:
    return raw.select(
        *[F.col(c).cast("string").alias(c) for c in (
            "series_code", "theme", "display_name", "official_title", "unit", "frequency")],
        F.col("source_start_date").cast("date").alias("source_start_date"),
        *[F.col(c).cast("string").alias(c) for c in (
            "observation_semantics", "monthly_alignment", "derived_metric")],
        F.col("max_expected_lag_months").cast("bigint").alias("max_expected_lag_months"),
        *[F.col(c).cast("string").alias(c) for c in ("revision_policy", "source_url", "metadata_url")],
    )


def stg_observation(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("series_code").cast("string").alias("series_code"),
        F.col("source_observation_date").cast("date").alias("source_observation_date"),
        month_start("report_month", "yyyyMM").alias("report_month"),
        F.col("value_raw").cast("string").alias("value_raw"),
        F.col("value").cast(MACRO).alias("value"),
        F.col("retrieved_at_utc").cast("timestamp").alias("retrieved_at_utc"),
        F.col("source_url").cast("string").alias("source_url"),
        F.col("fixture").cast("boolean").alias("is_fixture"),
    )


def stg_fetch_manifest(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("series_code").cast("string").alias("series_code"),
        F.col("requested_start_date").cast("date").alias("requested_start_date"),
        F.col("requested_end_date").cast("date").alias("requested_end_date"),
        F.col("retrieved_at_utc").cast("timestamp").alias("retrieved_at_utc"),
        F.col("status").cast("string").alias("status"),
        F.col("response_count").cast("bigint").alias("response_count"),
        F.col("fixture").cast("boolean").alias("is_fixture"),
    )


# -- core (D1–D7) ------------------------------------------------------------
def build_cosif_file_manifest(stg: DataFrame) -> DataFrame:
    """One selected complete version per period (W1; nulls first on desc)."""
    order = [
        (F.col("status") == "complete").desc_nulls_first(),
        F.col("source_is_active").desc_nulls_first(),
        F.col("source_generated_at").desc_nulls_first(),
        F.col("retrieved_at_utc").desc_nulls_first(),
        F.col("source_checksum").desc_nulls_first(),
    ]
    return select_version(stg, "source_period", order, "source_checksum", complete=F.col("status") == "complete")


def build_account_balance(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of the selected files, with the declared row count."""
    return selected_rows(rows, manifest, "source_checksum", "is_selected", carry=["declared_row_count"])


def build_bank_period(ab: DataFrame) -> DataFrame:
    """D3: month × institution over all documents."""
    return ab.groupBy("report_month", "institution_cnpj").agg(
        F.max("institution_name").alias("institution_name"),
        F.max("taxonomy").alias("taxonomy"),
        F.count(F.lit(1)).alias("account_row_count"),
        F.bool_and("is_fixture").alias("is_fixture"),
    ).select(surrogate_key("report_month", "institution_cnpj").alias("bank_period_key"), "*")


def build_cosif_account(ab: DataFrame) -> DataFrame:
    """Latest description per account code."""
    latest = latest_by(ab.select("account_code", "account_name", "taxonomy", "report_month", "is_fixture"),
                       "account_code", [F.col("report_month").desc_nulls_first(), F.col("account_name").desc_nulls_first()])
    return latest.select("account_code", "account_name", "taxonomy", "is_fixture")


def build_macro_series(stg_meta: DataFrame) -> DataFrame:
    """D5."""
    return stg_meta


def build_macro_observation(stg_obs: DataFrame, series: DataFrame) -> DataFrame:
    """Observations of registered series only."""
    return stg_obs.join(series.select("series_code"), "series_code", "left_semi")


def build_reporting_line_mapping(seed: DataFrame) -> DataFrame:
    """D7."""
    return seed.select(
        F.col("reporting_line_key").cast("string"), F.col("reporting_line_name").cast("string"),
        F.col("display_order").cast("int"), F.col("account_code").cast("string"),
        F.col("component_name").cast("string"), F.col("presentation_multiplier").cast("int"),
        F.col("mapping_version").cast("string"), F.col("status").cast("string"),
        F.col("source_url").cast("string"))


# -- marts (D8–D19) ------------------------------------------------------------
def build_dim_bank(population: DataFrame, bank_period: DataFrame, ab: DataFrame,
                   asset_accounts=ASSET_ACCOUNTS) -> DataFrame:
    """Frozen official members ∪ fixture members ranked at their latest month."""
    official = population.join(
        bank_period.filter(~F.col("is_fixture")).select("institution_cnpj", "report_month"),
        "institution_cnpj", "inner",
    ).groupBy("institution_cnpj", "institution_name", "taxonomy", "freeze_period", "freeze_rank").agg(
        F.min("report_month").alias("first_report_month"), F.max("report_month").alias("last_report_month"),
    ).select(
        surrogate_key("institution_cnpj").alias("bank_key"),
        F.col("institution_cnpj").cast("string"),
        F.col("institution_name").cast("string"),
        F.col("taxonomy").cast("string"),
        month_from_parts("freeze_period").alias("freeze_month"),
        F.col("freeze_rank").cast("int"),
        "first_report_month", "last_report_month",
        F.lit(False).alias("is_fixture"),
    )
    fixture_month = bank_period.filter("is_fixture").select(F.max("report_month")).scalar()
    totals = ab.filter(
        F.col("is_fixture") & (F.col("report_month") == fixture_month)
        & (F.col("document_code") == RANKING_DOCUMENT) & F.col("account_code").isin(*asset_accounts)
    ).groupBy("institution_cnpj").agg(F.sum("balance_amount").alias("total_assets"))
    # one row per member of the fixture population: a bounded window
    order = Window.orderBy(F.col("total_assets").desc_nulls_first(), F.col("institution_cnpj").asc())
    ranked = totals.select("institution_cnpj", F.row_number().over(order).alias("freeze_rank"))
    fixture = bank_period.filter("is_fixture").join(ranked, "institution_cnpj").groupBy(
        "institution_cnpj", "freeze_rank").agg(
        F.max("institution_name").alias("institution_name"),
        F.max("taxonomy").alias("taxonomy"),
        F.max("report_month").alias("freeze_month"),
        F.min("report_month").alias("first_report_month"),
        F.max("report_month").alias("last_report_month"),
    ).select(
        surrogate_key("institution_cnpj").alias("bank_key"), "institution_cnpj", "institution_name", "taxonomy",
        "freeze_month", F.col("freeze_rank").cast("int"), "first_report_month", "last_report_month",
        F.lit(True).alias("is_fixture"),
    )
    return official.unionByName(fixture)


def build_dim_cosif_account(account: DataFrame, mapping: DataFrame) -> DataFrame:
    """D9 (J5, P9)."""
    flagged = with_membership(account, mapping, "account_code", "is_reporting_line_component")
    return flagged.select(
        surrogate_key("account_code").alias("account_key"), "account_code", "account_name", "taxonomy",
        F.substring("account_code", 1, 1).alias("account_class"),
        F.substring("account_code", 1, 2).alias("account_group"),
        "is_reporting_line_component", "is_fixture",
    )


def build_dim_reporting_line(mapping: DataFrame) -> DataFrame:
    """D10 (A12)."""
    return mapping.select(
        surrogate_key("reporting_line_key").alias("reporting_line_key"),
        F.col("reporting_line_key").alias("reporting_line_code"),
        "reporting_line_name", "display_order",
        F.lit(1).alias("presentation_multiplier"), "mapping_version", "status",
    ).distinct()


def build_dim_document(spark: SparkSession) -> DataFrame:
    """D11 (X4)."""
    return values_frame(
        spark, DOCUMENTS, "document_code string, document_name string, analytical_allowed boolean, source_frequency string")


def build_dim_macro_series(series: DataFrame) -> DataFrame:
    """D12."""
    return series.select(surrogate_key("series_code").alias("macro_series_key"), *[
        c for c in series.columns if c != "source_start_date"])


def build_dim_date(bank_period: DataFrame, dim_bank: DataFrame, observations: DataFrame) -> DataFrame:
    """Observed months of member banks ∪ macro months."""
    bank_months = bank_period.join(dim_bank.select("institution_cnpj"), "institution_cnpj").select("report_month")
    return calendar(bank_months, observations.select("report_month"))


def build_dim_source_file(manifest: DataFrame) -> DataFrame:
    """Selected files only."""
    return manifest.filter("is_selected").select(surrogate_key("source_checksum").alias("source_file_key"), *manifest.columns)


def build_bridge(mapping: DataFrame, dim_account: DataFrame, dim_line: DataFrame) -> DataFrame:
    """D15 (J4)."""
    return mapping.join(dim_account.select("account_code", "account_key"), "account_code").join(
        dim_line.select("reporting_line_key", F.col("reporting_line_code").alias("_code")),
        F.col("_code") == mapping["reporting_line_key"],
    ).select(
        surrogate_key(mapping["account_code"], mapping["reporting_line_key"], mapping["mapping_version"]).alias(
            "account_reporting_line_key"),
        "account_key", dim_line["reporting_line_key"],
        mapping["account_code"], mapping["reporting_line_key"].alias("reporting_line_code"),
        "component_name", "presentation_multiplier", "mapping_version", mapping["status"], mapping["source_url"],
    )


def build_fact_account_balance(ab: DataFrame, dim_bank: DataFrame, dim_date: DataFrame, dim_account: DataFrame,
                               dim_source: DataFrame) -> DataFrame:
    """D16 (J3, F1)."""
    f = ab.filter(F.col("document_code") == RANKING_DOCUMENT)
    f = f.join(dim_bank.select("institution_cnpj", "is_fixture", "bank_key"), ["institution_cnpj", "is_fixture"])
    f = f.join(dim_date.select(F.col("month_start").alias("report_month"), "month_key"), "report_month")
    f = f.join(dim_account.select("account_code", "account_key"), "account_code")
    f = f.join(dim_source.select("source_checksum", "source_file_key"), "source_checksum")
    return f.select(
        surrogate_key("source_checksum", "file_row_number").alias("account_balance_key"),
        "bank_key", "month_key", "account_key", "source_file_key", "report_month", "document_code",
        "institution_cnpj", "account_code", "account_name", "balance_amount", "source_checksum",
        "file_row_number", "is_fixture",
    )


def build_fact_reporting_line_balance(ab: DataFrame, mapping: DataFrame, dim_bank: DataFrame, dim_date: DataFrame,
                                      dim_line: DataFrame, dim_source: DataFrame) -> DataFrame:
    """D17 (J4, J3, A4, A6, A9, A3, A13): aggregate first, then join dims."""
    rows = ab.filter(F.col("document_code") == RANKING_DOCUMENT)
    keys = ["report_month", "institution_cnpj", "document_code", "source_checksum", "is_fixture"]
    lb = line_balance(rows, mapping, keys, "account_code", "balance_amount", flag="is_fixture")
    f = lb.join(dim_bank.select("institution_cnpj", "is_fixture", "bank_key"), ["institution_cnpj", "is_fixture"])
    f = f.join(dim_date.select(F.col("month_start").alias("report_month"), "month_key"), "report_month")
    f = f.join(dim_line.select(F.col("reporting_line_code").alias("_line"), F.col("reporting_line_key").alias("_line_key")),
               F.col("_line") == F.col("reporting_line_key"))
    f = f.join(dim_source.select("source_checksum", "source_file_key"), "source_checksum")
    return f.select(
        surrogate_key("report_month", "institution_cnpj", "document_code", "reporting_line_key", "mapping_version").alias(
            "reporting_line_balance_key"),
        "bank_key", "month_key", F.col("_line_key").alias("reporting_line_key"), "source_file_key",
        "report_month", "document_code", "institution_cnpj",
        F.col("reporting_line_key").alias("reporting_line_code"), "mapping_version",
        "reported_balance_amount", "presentation_balance_amount", "contributing_account_count",
        "contributing_account_codes", F.col("all_flag").alias("is_fixture"),
    )


def build_fact_macro_observation(obs: DataFrame, dim_series: DataFrame, dim_date: DataFrame) -> DataFrame:
    """D18 (J3)."""
    f = obs.join(dim_series.select("series_code", "macro_series_key"), "series_code").join(
        dim_date.select(F.col("month_start").alias("report_month"), "month_key"), "report_month")
    return f.select(
        surrogate_key("series_code", "source_observation_date").alias("macro_observation_key"),
        "macro_series_key", "month_key", "series_code", "source_observation_date", "report_month", "value",
        "value_raw", "retrieved_at_utc", "source_url", "is_fixture")


def build_fact_monthly_economic_context(obs: DataFrame, dim_series: DataFrame, dim_date: DataFrame) -> DataFrame:
    """D19 (J3)."""
    f = obs.join(dim_series.select("series_code", "macro_series_key", "display_name", "unit", "derived_metric"),
                 "series_code").join(dim_date.select(F.col("month_start").alias("report_month"), "month_key"), "report_month")
    return f.select(
        surrogate_key("report_month", "series_code").alias("monthly_context_key"),
        "macro_series_key", "month_key", "report_month", "series_code", "display_name", "unit", "derived_metric",
        "value", "source_observation_date", "is_fixture")


class Marts(Mapping):
    """Models by name, built on first use and kept."""

    def __init__(self):
        self._builders: dict[str, Callable[[], DataFrame]] = {}
        self._built: dict[str, DataFrame] = {}

    def add(self, name: str, build: Callable[[], DataFrame]) -> None:
        self._builders[name] = build

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _made(frame: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    return frame() if callable(frame) else frame


def build_marts(spark: SparkSession, balance_rows: DataFrame, file_manifest: DataFrame, series_metadata: DataFrame,
                observations: DataFrame, mapping_seed: DataFrame, population_seed: DataFrame,
                landed: Callable[[DataFrame], DataFrame] = lambda df: df) -> Marts:
    """Every core model and mart, keyed by model name; a model is built when it is asked for.

    Inputs are frames, or functions that make them.  ``landed`` may write
    ``account_balance`` (D2), the big relation that eight models read, as a
    table and return that.
    """
    m = Marts()
    m.add("stg_cosif_balance_row", lambda: stg_balance_rows(_made(balance_rows)))
    m.add("stg_cosif_file_manifest", lambda: stg_file_manifest(_made(file_manifest)))
    m.add("stg_sgs_series_metadata", lambda: stg_series_metadata(_made(series_metadata)))
    m.add("stg_sgs_observation", lambda: stg_observation(_made(observations)))
    m.add("cosif_file_manifest", lambda: build_cosif_file_manifest(m["stg_cosif_file_manifest"]))
    m.add("account_balance", lambda: landed(build_account_balance(m["stg_cosif_balance_row"], m["cosif_file_manifest"])))
    m.add("bank_period", lambda: build_bank_period(m["account_balance"]))
    m.add("cosif_account", lambda: build_cosif_account(m["account_balance"]))
    m.add("macro_series", lambda: build_macro_series(m["stg_sgs_series_metadata"]))
    m.add("macro_observation", lambda: build_macro_observation(m["stg_sgs_observation"], m["macro_series"]))
    m.add("reporting_line_mapping", lambda: build_reporting_line_mapping(_made(mapping_seed)))
    m.add("dim_bank", lambda: build_dim_bank(_made(population_seed), m["bank_period"], m["account_balance"]))
    m.add("dim_cosif_account", lambda: build_dim_cosif_account(m["cosif_account"], m["reporting_line_mapping"]))
    m.add("dim_reporting_line", lambda: build_dim_reporting_line(m["reporting_line_mapping"]))
    m.add("dim_document", lambda: build_dim_document(spark))
    m.add("dim_macro_series", lambda: build_dim_macro_series(m["macro_series"]))
    m.add("dim_date", lambda: build_dim_date(m["bank_period"], m["dim_bank"], m["macro_observation"]))
    m.add("dim_source_file", lambda: build_dim_source_file(m["cosif_file_manifest"]))
    m.add("bridge_account_reporting_line", lambda: build_bridge(m["reporting_line_mapping"], m["dim_cosif_account"],
                                                      m["dim_reporting_line"]))
    m.add("fact_account_balance", lambda: build_fact_account_balance(
        m["account_balance"], m["dim_bank"], m["dim_date"], m["dim_cosif_account"], m["dim_source_file"]))
    m.add("fact_reporting_line_balance", lambda: build_fact_reporting_line_balance(
        m["account_balance"], m["reporting_line_mapping"], m["dim_bank"], m["dim_date"], m["dim_reporting_line"],
        m["dim_source_file"]))
    m.add("fact_macro_observation", lambda: build_fact_macro_observation(m["macro_observation"], m["dim_macro_series"], m["dim_date"]))
    m.add("fact_monthly_economic_context", lambda: build_fact_monthly_economic_context(
        m["macro_observation"], m["dim_macro_series"], m["dim_date"]))
    return m
