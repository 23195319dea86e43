"""Measure semantics × filter context (hand-computed expectations)."""

import pytest
from pyspark.sql import functions as F

from ledgermart.plans import reports
from ledgermart.plans.models import build_marts
from tests import fixtures as fx

A, B, C = "00000001", "00000002", "00000003"


@pytest.fixture(scope="module")
def model(spark):
    marts = build_marts(spark, **fx.frames(spark))
    m = reports.model_from_marts(marts)
    m.fact = m.fact.cache()
    return m


def _by_bank(df):
    import hashlib
    inv = {hashlib.md5(k.encode()).hexdigest(): k for k in (A, B, C)}
    return {inv[r.bank_key]: r for r in df.collect()}


def test_total_is_closing_balance(model):
    r = model.query(["total_assets", "credit_portfolio", "deposits", "equity"]).first()
    assert float(r.total_assets) == 2470.0  # latest month, not the sum of months
    assert r.credit_portfolio is None and r.deposits is None and r.equity is None  # blank, not zero


def test_month_filter(model):
    r = model.query(["total_assets"], months=("2025-01-01", "2025-01-01")).first()
    assert float(r.total_assets) == 2400.0


def test_peer_median_and_share(model):
    assert model.query(["peer_median"]).first().peer_median == 785.0
    got = _by_bank(model.query(["total_assets", "population_share"], by=["bank_key"]))
    assert got[A].population_share == pytest.approx(1050 / 2470)
    assert sum(r.population_share for r in got.values()) == pytest.approx(1.0)


def test_mom_by_bank_and_total(model):
    feb = ("2025-02-01", "2025-02-01")
    got = _by_bank(model.query(["mom_growth"], by=["bank_key"], months=feb))
    assert got[A].mom_growth == pytest.approx(0.05)
    assert got[B].mom_growth == pytest.approx(-0.01875)
    assert got[C].mom_growth == pytest.approx(35 / 600)
    assert model.query(["mom_growth"], months=feb).first().mom_growth == pytest.approx(70 / 2400)


def test_mom_anchor_date_dim(model):
    # the calendar ends at 202503 (series only): current month 202503, prior 202502 = current value
    assert model.query(["mom_growth"], anchor="date_dim").first().mom_growth == pytest.approx(0.0)
    # filtered to the series-only month: blank current acts as 0 against a present prior
    r = model.query(["mom_growth"], months=("2025-03-01", "2025-03-01"), anchor="date_dim").first()
    assert r.mom_growth == pytest.approx(-1.0)
    # the sound anchor compares the last fact month with its predecessor
    assert model.query(["mom_growth"]).first().mom_growth == pytest.approx(70 / 2400)


def test_yoy_blank(model):
    assert model.query(["yoy_growth"]).first().yoy_growth is None
    assert all(r.yoy_growth is None for r in model.query(["yoy_growth"], by=["bank_key"]).collect())


def test_line_filter_intersects(model):
    r = model.query(["total_assets"], where=F.col("reporting_line_code") == "deposits").first()
    assert r.total_assets is None


def test_member_ending_early_breaks_additivity(spark):
    import datetime as dt
    from decimal import Decimal

    from ledgermart.operators.measures import MeasureModel

    jan, feb = dt.date(2025, 1, 1), dt.date(2025, 2, 1)
    fact = spark.createDataFrame([
        (jan, A, "total_assets", Decimal("1000.00")), (feb, A, "total_assets", Decimal("1050.00")),
        (jan, B, "total_assets", Decimal("800.00")), (feb, B, "total_assets", Decimal("785.00")),
        (jan, C, "total_assets", Decimal("600.00")),  # gamma ends one month early
    ], "report_month date, bank_key string, reporting_line_code string, presentation_balance_amount decimal(38,2)")
    m = MeasureModel(fact)
    total = float(m.query(["total_assets"]).first().total_assets)
    per = {r.bank_key: r for r in m.query(["total_assets", "population_share"], by=["bank_key"]).collect()}
    assert total == 1050 + 785  # overall last month 202502 has no gamma row
    assert sum(float(r.total_assets) for r in per.values()) == 1050 + 785 + 600  # gamma closes at 202501
    assert per[C].population_share == pytest.approx(600 / 1835)


def test_line_missing_in_last_month_is_blank(spark):
    import datetime as dt
    from decimal import Decimal

    from ledgermart.operators.measures import MeasureModel

    jan, feb = dt.date(2025, 1, 1), dt.date(2025, 2, 1)
    fact = spark.createDataFrame([
        (jan, A, "total_assets", Decimal("1000.00")), (jan, A, "credit_portfolio", Decimal("300.00")),
        (feb, A, "credit_portfolio", Decimal("10.00")),  # total assets missing in the last month
    ], "report_month date, bank_key string, reporting_line_code string, presentation_balance_amount decimal(38,2)")
    r = MeasureModel(fact).query(["total_assets", "credit_portfolio", "credit_share"], by=["bank_key"]).first()
    assert r.total_assets is None  # no fall-back to 202501
    assert float(r.credit_portfolio) == 10.0
    assert r.credit_share is None


def test_report_presets(model, spark):
    marts = build_marts(spark, **fx.frames(spark))
    assert [r.total_assets for r in reports.assets_by_bank(model).collect()] == sorted(
        [r.total_assets for r in reports.assets_by_bank(model).collect()], reverse=True)
    assert reports.mix_table(model).count() == 3
    assert reports.peer_table(model).count() == 3
    assert reports.macro_by_month(marts).count() == 15
    assert reports.credit_share_by_month(model).count() == 6
    assert reports.slicer(marts["dim_bank"], "institution_name").count() == 3
    assert reports.mapping_table(marts).count() == 2
    assert reports.source_file_table(marts).count() == 2
    t = reports.trust_cards(marts).first()
    assert (t.latest_source_period, t.selected_source_files, t.months_covered) == ("202502", 2, 3)
    c = reports.cards(model, "compare").first()
    assert c.population_share == pytest.approx(1.0)
