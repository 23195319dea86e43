"""Star-schema models on the hand-made fixtures (expected values by hand)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermart.operators.quality import (
    check_continuity,
    check_identity,
    check_one_selected,
    check_reconciles,
    check_row_count,
    check_unique,
)
from ledgermart.plans.models import build_marts
from tests import fixtures as fx


@pytest.fixture(scope="module")
def marts(spark):
    return build_marts(spark, **fx.frames(spark))


def _count(df):
    return df.count()


def test_row_counts(marts):
    assert _count(marts["cosif_file_manifest"]) == 2
    assert _count(marts["account_balance"]) == 24
    assert _count(marts["bank_period"]) == 6
    assert _count(marts["cosif_account"]) == 4
    assert _count(marts["dim_bank"]) == 3
    assert _count(marts["dim_source_file"]) == 2
    assert _count(marts["dim_date"]) == 3  # 202503 only through the series
    assert _count(marts["bridge_account_reporting_line"]) == 2
    assert _count(marts["fact_account_balance"]) == 24
    assert _count(marts["fact_reporting_line_balance"]) == 6
    assert _count(marts["fact_macro_observation"]) == 15
    assert _count(marts["fact_monthly_economic_context"]) == 15
    assert _count(marts["dim_reporting_line"]) == 4
    assert _count(marts["dim_document"]) == 2


def test_total_assets_by_bank(marts):
    rows = marts["fact_reporting_line_balance"].select(
        F.date_format("report_month", "yyyyMM").alias("p"), "institution_cnpj", "presentation_balance_amount",
        "contributing_account_count", "contributing_account_codes", "is_fixture").collect()
    got = {(r.p, r.institution_cnpj): r.presentation_balance_amount for r in rows}
    assert got[("202501", "00000001")] == Decimal("1000.00")
    assert got[("202501", "00000002")] == Decimal("800.00")
    assert got[("202501", "00000003")] == Decimal("600.00")
    assert got[("202502", "00000001")] == Decimal("1050.00")
    assert got[("202502", "00000002")] == Decimal("785.00")
    assert got[("202502", "00000003")] == Decimal("635.00")
    assert {r.contributing_account_codes for r in rows} == {f"{fx.C1}|{fx.C2}"}
    assert all(r.contributing_account_count == 2 and r.is_fixture for r in rows)


def test_fixture_ranks_and_keys(marts):
    bank = {r.institution_cnpj: r for r in marts["dim_bank"].collect()}
    assert [bank[c].freeze_rank for c in ("00000001", "00000002", "00000003")] == [1, 2, 3]
    assert all(r.is_fixture for r in bank.values())
    import hashlib
    assert bank["00000001"].bank_key == hashlib.md5(b"00000001").hexdigest()


def test_dim_date_and_labels(marts):
    rows = sorted(marts["dim_date"].collect(), key=lambda r: r.month_key)
    assert [r.month_key for r in rows] == [202501, 202502, 202503]
    assert rows[0].month_label == "Jan 2025"
    assert rows[2].calendar_quarter == 1


def test_singular_checks_pass(marts):
    ab = marts["account_balance"]
    assert check_unique(ab, ["source_checksum", "file_row_number"]).count() == 0
    assert check_row_count(ab, "source_checksum", "declared_row_count").count() == 0
    assert check_one_selected(marts["cosif_file_manifest"], "source_period").count() == 0
    assert check_identity(ab, ["report_month", "institution_cnpj"], "account_code", "balance_amount",
                          ["class_1", "class_2"], ("total_general", "class_3"),
                          {"class_1": fx.C1, "class_2": fx.C2, "class_3": fx.C3, "total_general": fx.TG}).count() == 0
    assert check_continuity(marts["macro_observation"], "series_code", "report_month").count() == 0
    assert check_unique(marts["fact_account_balance"],
                        ["report_month", "institution_cnpj", "document_code", "account_code", "source_checksum"]).count() == 0


def test_reconciles_to_source(marts, spark):
    ab = marts["account_balance"].filter("document_code = '4010'")
    mapping = marts["reporting_line_mapping"]
    expected = ab.join(mapping, "account_code").groupBy(
        "report_month", "institution_cnpj", "document_code",
        F.col("reporting_line_key").alias("reporting_line_code"), "mapping_version").agg(
        F.sum(F.col("balance_amount") * F.col("presentation_multiplier")).alias("amount"))
    actual = marts["fact_reporting_line_balance"].select(
        "report_month", "institution_cnpj", "document_code", "reporting_line_code", "mapping_version",
        F.col("presentation_balance_amount").alias("amount"))
    assert check_reconciles(expected, actual).count() == 0


def test_identity_fails_on_missing_component(spark):
    rows = fx.balance_rows(skip={("202502", "00000002", fx.C2)})
    df = spark.createDataFrame(rows, fx.BALANCE_SCHEMA).withColumnRenamed("conta", "account_code")
    bad = check_identity(df, ["source_period", "cnpj"], "account_code", "saldo", ["class_1", "class_2"],
                         ("total_general", "class_3"),
                         {"class_1": fx.C1, "class_2": fx.C2, "class_3": fx.C3, "total_general": fx.TG})
    assert [(r.source_period, r.cnpj) for r in bad.collect()] == [("202502", "00000002")]


def test_incomplete_newest_version_is_not_selected(spark):
    import datetime as dt
    m = fx.manifest_rows()
    newer = ("202502", "fixture://cosif/202502b", "fixture-202502b", "failed", dt.date(2025, 4, 1),
             dt.datetime(2025, 4, 2), True, True, 0)
    frames = fx.frames(spark, manifest=m + [newer])
    marts = build_marts(spark, **frames)
    sel = {r.source_checksum: r.is_selected for r in marts["cosif_file_manifest"].collect()}
    assert sel == {"fixture-202501": True, "fixture-202502": True, "fixture-202502b": False}


def test_only_incomplete_versions_select_nothing(spark):
    m = [r[:3] + ("failed",) + r[4:] if r[0] == "202502" else r for r in fx.manifest_rows()]
    marts = build_marts(spark, **fx.frames(spark, manifest=m))
    sel = {r.source_period: r.is_selected for r in marts["cosif_file_manifest"].collect()}
    assert sel == {"202501": True, "202502": False}
    assert marts["account_balance"].count() == 12
    assert check_one_selected(marts["cosif_file_manifest"], "source_period").count() == 1
