"""Column helpers against hand-computed values."""

import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermart import functions as L


def _one(spark, col, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(col).collect()]


def test_locale_decimal(spark):
    vals = ["1.234,56", " 10,5 ", "1.5", "abc", "1,005", "-0,01", ""]
    got = _one(spark, L.parse_locale_decimal("x"), [(v,) for v in vals])
    assert got == [Decimal("1234.56"), Decimal("10.50"), Decimal("15.00"), None, None, Decimal("-0.01"), None]
    assert _one(spark, L.locale_decimal_text("x"), [(1234567.5,)], "x double") == ["1.234.567,50"]


def test_periods_and_months(spark):
    vals = ["202501", "198712", "202513", "20250", "abcdef", None]
    assert _one(spark, L.valid_period("x"), [(v,) for v in vals]) == [True, False, False, False, False, False]
    d = dt.date(2025, 5, 17)
    row = spark.createDataFrame([(d,)], "d date").select(
        L.month_key("d"), L.month_label("d"), L.quarter_start("d"), L.year_start("d"),
        L.month_start("d"), L.month_diff(F.lit(dt.date(2024, 11, 1)), "d"), L.period_text("d")).first()
    assert tuple(row) == (202505, "May 2025", dt.date(2025, 4, 1), dt.date(2025, 1, 1), dt.date(2025, 5, 1), 6, "202505")
    assert _one(spark, L.month_start("x", "yyyyMM", strict=False), [("202502",), ("2025xx",)]) == [dt.date(2025, 2, 1), None]
    assert _one(spark, L.month_from_parts("x"), [("202503",)]) == [dt.date(2025, 3, 1)]


def test_url_period_and_generated_date(spark):
    urls = ["https://x/a/202501BANCOS.csv.zip", "https://x/202502bancos.ZIP", "https://x/202503BANCOS",
            "https://x/202504BANCOS.zip?x=1"]
    assert _one(spark, L.period_from_url("x"), [(u,) for u in urls]) == ["202501", "202502", None, None]
    texts = ["Gerado em 05/03/2025 às 10h", "generated 2025-03-06", "nothing"]
    assert _one(spark, L.generated_date("x"), [(t,) for t in texts]) == [dt.date(2025, 3, 5), dt.date(2025, 3, 6), None]


def test_text_helpers(spark):
    assert _one(spark, L.blank_to_null("x"), [(" a ",), ("  ",), (None,)]) == ["a", None, None]
    assert _one(spark, L.blank_to_null("x", python_strip=True), [("\t\n",)]) == [None]
    assert _one(spark, L.strict_bool("x"), [("Yes",), ("0",), ("maybe",)]) == [True, False, None]
    assert _one(spark, L.lenient_bool("x"), [("PASS",), ("ready ",), ("no",), (None,)]) == [True, True, False, False]
    assert _one(spark, L.is_synthetic("x"), [("fixture://a",), ("https://a",)]) == [True, False]
    row = spark.createDataFrame([(None, " ", "b")], "a string, b string, c string").select(L.first_text("a", "b", "c")).first()
    assert row[0] == "b"


def test_surrogate_key_matches_md5_and_propagates_null(spark):
    df = spark.createDataFrame([("2025-01-01", "00000001"), (None, "x")], "m string, c string")
    got = [r[0] for r in df.select(L.surrogate_key(F.col("m").cast("date"), "c")).collect()]
    assert got[0] == hashlib.md5(b"2025-01-01|00000001").hexdigest()
    assert got[1] is None


def test_safe_divide_growth_differs(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("0.00")), (None, Decimal("5.00")), (Decimal("6.00"), None)],
                               "a decimal(38,2), b decimal(38,2)")
    rows = df.select(L.safe_divide("a", "b"), L.growth("a", "b"), L.differs("a", "b", 0.01)).collect()
    assert rows[0][0] is None
    assert rows[1][1] == -1.0  # current blank, prior present
    assert rows[2][1] is None  # prior blank
    assert [r[2] for r in rows] == [True, True, True]


def test_type_names():
    from pyspark.sql import types as T
    assert L.type_name(T.StringType()) == "text"
    assert L.type_name(T.DecimalType(38, 2)) == "numeric"
    assert L.contract_type("numeric(38,10)") == T.DecimalType(38, 10)
    assert L.contract_type("varchar(6)") == T.StringType()


def test_stage_and_prefix(spark):
    df = spark.createDataFrame([("1600000007", "202501")], "conta string, p string")
    out = L.stage(df, {"account_code": F.col("conta"), "report_month": L.month_start("p", "yyyyMM"),
                       "account_class": L.code_prefix("conta", 1), "account_group": L.code_prefix("conta", 2)}).first()
    assert tuple(out) == ("1600000007", dt.date(2025, 1, 1), "1", "16")


def test_measure_query_function(spark):
    from ledgermart.operators import measure_query
    fact = spark.createDataFrame([(dt.date(2025, 1, 1), "a", "total_assets", Decimal("5.00"))],
                                 "m date, b string, l string, v decimal(38,2)")
    r = measure_query(fact, ["total_assets"], month="m", member="b", line="l", amount="v").first()
    assert r.total_assets == Decimal("5.00")
