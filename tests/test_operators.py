"""Operators under skew, against brute-force answers; controls with seeded defects."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermart.operators import (
    coverage,
    distributed_row_number,
    latest_by,
    missing_months,
    null_scan,
    pivot_sums,
    reconcile,
    select_version,
    set_diff,
    top_members,
    version_ordinal,
)
from ledgermart.operators.aggregates import line_balance
from ledgermart.operators.calendar import derive_series
from ledgermart.operators.population import profile_population
from ledgermart.operators.quality import Control, build_controls, check_schema, duplicate_detail, failing_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of all rows; ties in the sort column."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 300)}"
        rows.append((i, key, rnd.randint(0, 50), rnd.choice(["F", "O"])))
    return spark.createDataFrame(rows, "id int, key string, v int, status string")


def test_distributed_row_number_matches_window(skewed):
    pdf = skewed.toPandas().sort_values(["key", "v", "id"], ascending=[True, False, True])
    pdf["rn"] = pdf.groupby("key").cumcount() + 1
    pdf["n"] = pdf.groupby("key")["id"].transform("count")
    exp = {(r.id, r.rn, r.n) for r in pdf.itertuples()}
    for slices in (1, 8):
        got = distributed_row_number(skewed, ["key"], [F.col("v").desc(), F.col("id")], "rn", "n", slices=slices)
        assert dict(got.dtypes)["rn"] == "bigint"
        assert {(r.id, r.rn, r.n) for r in got.collect()} == exp


def test_distributed_row_number_keeps_null_keys(skewed):
    nulled = skewed.withColumn("key", F.when(F.col("key") != "hot", F.col("key")))
    got = distributed_row_number(nulled, ["key"], [F.col("id")], "rn", "n", slices=8).collect()
    assert len(got) == 3000
    nulls = sorted((r.id, r.rn, r.n) for r in got if r.key is None)
    assert nulls == [(3 * i, i + 1, 1000) for i in range(1000)]


def test_global_rank_without_partition(skewed):
    got = distributed_row_number(skewed, [], [F.col("v").desc(), F.col("id")], "rn", slices=5)
    pdf = skewed.toPandas().sort_values(["v", "id"], ascending=[False, True]).reset_index(drop=True)
    assert {(r.id, r.rn) for r in got.collect()} == {(int(i), k + 1) for k, i in enumerate(pdf["id"])}


def test_version_ordinal_and_selection(skewed):
    v = {r.id: (r.period_version, r.is_active)
         for r in version_ordinal(skewed, "key", [F.col("id")]).collect()}
    hot = sorted(i for i in range(0, 3000, 3))
    assert v[hot[0]] == (1, False) and v[hot[-1]] == (1000, True)
    sel = select_version(skewed, "key", [(F.col("status") == "F").desc(), F.col("v").desc(), F.col("id").desc()],
                         "id", complete=F.col("status") == "F")
    pdf = skewed.toPandas()
    pdf["f"] = pdf.status == "F"
    best = pdf.sort_values(["key", "f", "v", "id"], ascending=[True, False, False, False]).groupby("key").head(1)
    exp = set(best[best.status == "F"].id)
    assert {r.id for r in sel.filter("is_selected").collect()} == exp
    assert sel.count() == 3000
    lat = latest_by(skewed, "key", [F.col("v").desc(), F.col("id").desc()])
    assert lat.count() == pdf.key.nunique()


def test_line_balance_fans_out_after_aggregation(spark):
    rows = spark.createDataFrame([
        ("m1", "b1", "A", Decimal("10.00")), ("m1", "b1", "A", Decimal("5.00")), ("m1", "b1", "B", Decimal("1.00")),
        ("m1", "b2", "C", Decimal("7.00")),
    ], "m string, b string, acct string, amt decimal(38,2)")
    mapping = spark.createDataFrame([("L1", "A", 1, "v1"), ("L1", "B", -1, "v1"), ("L2", "A", 1, "v1")],
                                    "reporting_line_key string, acct string, presentation_multiplier int, mapping_version string")
    got = {(r.b, r.reporting_line_key): r for r in line_balance(rows, mapping, ["m", "b"], "acct", "amt").collect()}
    assert got[("b1", "L1")].presentation_balance_amount == Decimal("14.00")
    assert got[("b1", "L1")].reported_balance_amount == Decimal("16.00")
    assert got[("b1", "L1")].contributing_account_codes == "A|B"
    assert got[("b1", "L2")].contributing_account_count == 1
    assert ("b2", "L1") not in got  # unmapped account drops out (inner join)


def test_top_members_cutoff_gap_and_tie(spark):
    df = spark.createDataFrame([(f"m{i}", Decimal(v)) for i, v in enumerate([50, 40, 30, 30, 10])], "m string, a decimal(38,2)")
    top = top_members(df, "m", "a", 3).orderBy("freeze_rank").collect()
    assert [r.m for r in top] == ["m0", "m1", "m2"]
    assert top[0].cutoff_gap == Decimal("0.00")  # a tie at the cut: the gap control must fail
    assert top_members(df, "m", "a", 2).first().cutoff_gap == Decimal("10.00")


def test_profile_population(spark):
    rows = []
    for period in ("202501", "202502"):
        for m in range(5):
            rows.append((period, f"{m:08d}", "1", Decimal(100 + m)))
            if m != 4 or period == "202501":
                rows.append((period, f"{m:08d}", "2", Decimal(10)))
            rows.append((period, f"{m:08d}", "T", Decimal(110 + m) if m != 2 else Decimal(999)))
    df = spark.createDataFrame(rows, "period string, cnpj string, acct string, amt decimal(38,2)")
    pop = profile_population(df, "period", "cnpj", "acct", "amt", {"c1": "1", "c2": "2", "tg": "T"}, "c1", n=3,
                             reference_total="tg", tolerance=1.0)
    members = [r.cnpj for r in pop.members.orderBy("freeze_rank").collect()]
    assert members == ["00000003", "00000002", "00000001"]  # member 4 lacks class 2 in 202502: total 104
    prof = {r.period: r for r in pop.period_profile.collect()}
    assert prof["202502"].c2_present == 4 and prof["202502"].reference_outliers == 2
    assert pop.monthly.count() == 6


def test_calendar_ops(spark):
    df = spark.createDataFrame([("a", dt.date(2025, 1, 5)), ("a", dt.date(2025, 4, 1)), ("b", dt.date(2025, 2, 1))],
                               "k string, d date")
    assert sorted(r.missing_month for r in missing_months(df, "k", "d").collect()) == [dt.date(2025, 2, 1), dt.date(2025, 3, 1)]
    cov = {r.k: (r.months_covered, r.months_expected) for r in coverage(df, "k", "d").collect()}
    assert cov == {"a": (2, 3), "b": (1, 3)}
    s = spark.createDataFrame([("x", dt.date(2024, m, 1), 1.0) for m in range(1, 13)] +
                              [("x", dt.date(2025, 1, 1), 2.0)], "k string, m date, v double")
    r12 = {r.m: r.derived_value for r in derive_series(s, "k", "m", "v", "rolling_12m").collect()}
    assert r12[dt.date(2024, 11, 1)] is None
    assert r12[dt.date(2024, 12, 1)] == pytest.approx((1.01 ** 12 - 1) * 100)
    yoy = {r.m: r.derived_value for r in derive_series(s, "k", "m", "v", "yoy_pct").collect()}
    assert yoy[dt.date(2025, 1, 1)] == pytest.approx(100.0)


def test_sets_reconcile_and_pivot(spark):
    e = spark.createDataFrame([("a", Decimal("1.00")), ("b", Decimal("2.00"))], "k string, amt decimal(38,2)")
    a = spark.createDataFrame([("a", Decimal("1.00")), ("c", Decimal("3.00")), ("b", Decimal("2.50"))], "k string, amt decimal(38,2)")
    st = {r.k: r.status for r in reconcile(e, a, "k", "amt").collect()}
    assert st == {"a": "match", "b": "mismatch", "c": "missing_expected"}
    d = {(r.k, r.issue) for r in set_diff(e.select("k"), a.select("k")).collect()}
    assert d == {("c", "unexpected")}
    p = pivot_sums(a, [], "k", "amt", {"a_amt": "a", "z_amt": "z"}).first()
    assert p.a_amt == Decimal("1.00") and p.z_amt is None


def test_controls_fail_closed(spark):
    good = spark.createDataFrame([(1,), (2,)], "k int")
    bad = spark.createDataFrame([(1,), (1,)], "k int")
    t = build_controls(spark, [
        failing_rows("unique_good", good.groupBy("k").count().filter("count > 1")),
        Control("row_count", good, F.count(F.lit(1)), 2),
    ]).orderBy("control_order").collect()
    assert [r.passed for r in t] == [True, True, True]
    t = build_controls(spark, [
        failing_rows("unique_bad", bad.groupBy("k").count().filter("count > 1")),
        Control("row_count", good, F.count(F.lit(1)), 2),
    ]).orderBy("control_order").collect()
    assert [r.passed for r in t] == [False, True, False]  # the roll-up fails when any control fails
    assert t[-1].actual == "1/2"
    assert [r.detail for r in duplicate_detail(bad, "k").collect()] == ["1×2"]


def test_null_scan_and_schema_contract(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    assert {(r.column_name, r.null_count) for r in null_scan(df).collect()} == {("a", 1), ("b", 1)}
    assert check_schema(df, [("a", "integer"), ("b", "text")]) == []
    assert check_schema(df, [("b", "text"), ("a", "integer")])[0]["position"] == 1


def test_sorted_set(spark):
    from ledgermart.operators import sorted_set
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", "z"), ("b", None)], "k string, v string")
    got = {r.k: r.s for r in df.groupBy("k").agg(sorted_set("v").alias("s")).collect()}
    assert got == {"a": ["b", "z"], "b": []}


def test_schema_contract_sees_precision_and_scale(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([], "a decimal(5,0), b string")
    wanted = T.StructType([T.StructField("a", T.DecimalType(38, 10)), T.StructField("b", T.StringType())])
    assert check_schema(df, wanted) == [{"position": 1, "expected": ("a", "numeric(38,10)"), "actual": ("a", "numeric(5,0)")}]
    assert check_schema(df, [("a", "numeric"), ("b", "text")]) == []
    assert check_schema(df, [("a", "numeric(5,0)"), ("b", "text")]) == []


def test_member_attributes_and_ended_groups(spark):
    """Shares clear all attributes of a member; a member without a value this month has lost all of it."""
    from ledgermart.operators.measures import MeasureModel

    rows = [("2025-01-01", "a", "A", 25.0), ("2025-01-01", "b", "B", 75.0), ("2025-02-01", "b", "B", 80.0)]
    fact = spark.createDataFrame([(m, k, n, "total_assets", v) for m, k, n, v in rows],
                                 "m string, k string, n string, line string, v double").withColumn("m", F.to_date("m")).withColumn(
        "v", F.col("v").cast("decimal(38,2)"))
    model = MeasureModel(fact, month="m", member="k", line="line", amount="v", member_attributes=["n"])
    share = {r.k: r.population_share for r in model.query(["population_share"], by=["k", "n"], months=("2025-01-01", "2025-01-31")).collect()}
    assert share == {"a": 0.25, "b": 0.75}
    growth = {(str(r.m), r.k): r.mom_growth for r in model.query(["total_assets", "mom_growth"], by=["m", "k"]).collect()}
    assert growth[("2025-02-01", "a")] == -1.0 and growth[("2025-01-01", "a")] is None and len(growth) == 4
