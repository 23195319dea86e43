"""Pairing, guards, sinks and the generic window helpers."""

import datetime as dt
import math
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermart.operators.calendar import derive_series, profile_series
from ledgermart.operators.measures import at_last_month, prior_period, share_of_selection
from ledgermart.operators.population import distinct_members_by
from ledgermart.operators.quality import check_coverage_gate
from ledgermart.sources.catalog import active_files
from ledgermart.sources.evidence import pair_manifest_profile
from ledgermart.sources.landing import write_evidence
from ledgermart.sources.series import pair_series

MAN = "sha256 string, status string, period string, source_url string, retrieved_at_utc string, compressed_bytes long"
PROF = ("sha256 string, period string, source_url string, compressed_bytes long, malformed_row_count long, "
        "period_matches boolean, source_generated_at date, row_count long, columns string, encoding string")


def _prof(sha="a", period="202501", url="u1", size=10, malformed=0, match=True, gen=dt.date(2025, 3, 1)):
    return (sha, period, url, size, malformed, match, gen, 12, "A|B", "cp1252")


def test_manifest_profile_pairing(spark):
    man = spark.createDataFrame([("a", "complete", "202501", "u1", "t", 10)], MAN)
    failed = spark.createDataFrame([("a", "complete", "202501", "u1", "t", 10), ("b", "failed", "202502", "u2", "t", 0)], MAN)
    with pytest.raises(Exception, match="incomplete download"):
        pair_manifest_profile(failed, spark.createDataFrame([_prof()], PROF)).collect()
    ok = pair_manifest_profile(man, spark.createDataFrame([_prof()], PROF)).collect()
    assert [(r.sha256, r.row_count) for r in ok] == [("a", 12)]
    for bad, msg in [
        ([_prof(size=11)], "byte count differs"),
        ([_prof(malformed=1)], "malformed rows"),
        ([_prof(match=False)], "declared period differs"),
        ([_prof(), _prof()], "duplicate profile checksum"),
        ([_prof(), _prof(sha="z")], "profile without a download"),
        ([], "download without a profile"),
    ]:
        with pytest.raises(Exception, match=msg):
            pair_manifest_profile(man, spark.createDataFrame(bad, PROF)).collect()


def test_pair_series(spark):
    reg = spark.createDataFrame([("433",), ("4189",)], "series_code string")
    stamp = dt.datetime(2025, 4, 1)
    obs = spark.createDataFrame([("433", dt.date(2025, 1, 31), stamp), ("4189", dt.date(2025, 1, 1), stamp)],
                                "series_code string, source_observation_date date, retrieved_at_utc timestamp")
    prof = spark.createDataFrame([("433", "complete", 1), ("4189", "complete", 1)],
                                 "series_code string, status string, row_count long")
    _, o, f = pair_series(reg, obs, prof, "2025-01-01", "2025-01-31")
    assert o.count() == 2 and f.count() == 2
    bad = spark.createDataFrame([("433", "complete", 2), ("4189", "complete", 1)], "series_code string, status string, row_count long")
    with pytest.raises(Exception, match="does not pair"):
        pair_series(reg, obs, bad, "2025-01-01", "2025-01-31")[1].collect()


def test_active_files_guard(spark):
    cat = spark.createDataFrame([("202501", True), ("202501", True)], "period string, is_active boolean")
    with pytest.raises(Exception, match="exactly one active"):
        active_files(cat).collect()


def test_write_evidence_refuses_empty(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    write_evidence(df, str(tmp_path / "ok"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "ok")).count() == 1
    with pytest.raises(ValueError):
        write_evidence(df.filter("a > 1"), str(tmp_path / "empty"))


def test_distinct_members_pivot(spark):
    rows = spark.createDataFrame([("202501", "4010", "a"), ("202501", "4010", "a"), ("202501", "4016", "b"),
                                  ("202501", "4010", "c")], "p string, doc string, cnpj string")
    r = distinct_members_by(rows, "p", "cnpj", "doc", ["4010", "4016"]).first()
    assert (r["4010"], r["4016"]) == (2, 1)


def test_window_helpers(spark):
    df = spark.createDataFrame([
        (dt.date(2025, 1, 1), "a", Decimal("10")), (dt.date(2025, 2, 1), "a", Decimal("12")),
        (dt.date(2025, 1, 1), "b", Decimal("5")),
    ], "m date, k string, v decimal(38,2)")
    last = {r.k: r.m for r in at_last_month(df, "m", ["k"]).collect()}
    assert last == {"a": dt.date(2025, 2, 1), "b": dt.date(2025, 1, 1)}
    assert at_last_month(df, "m").count() == 1
    prior = {(r.k, r.m): r.prior_value for r in prior_period(df, "m", 1, ["k"], "v").collect()}
    assert prior[("a", dt.date(2025, 2, 1))] == Decimal("10.00") and prior[("b", dt.date(2025, 1, 1))] is None
    share = {r.k: r.share for r in share_of_selection(df.filter(F.col("m") == dt.date(2025, 1, 1)), "v").collect()}
    assert share["a"] == pytest.approx(10 / 15)
    per_month = {(r.k, r.m): r.share for r in share_of_selection(df, "v", by=["m"]).collect()}
    assert per_month[("a", dt.date(2025, 2, 1))] == pytest.approx(1.0)


def test_derivations_latest_and_pp(spark):
    s = spark.createDataFrame([("x", dt.date(2025, 1, 1), 10.0), ("x", dt.date(2025, 2, 1), 10.5),
                               ("x", dt.date(2025, 4, 1), 11.0)], "k string, m date, v double")
    pp = {r.m: r.derived_value for r in derive_series(s, "k", "m", "v", "pp_change").collect()}
    assert pp[dt.date(2025, 2, 1)] == pytest.approx(0.5) and pp[dt.date(2025, 4, 1)] is None  # exact month, not row offset
    assert derive_series(s, "k", "m", "v", "latest").count() == 3
    with pytest.raises(ValueError):
        derive_series(s, "k", "m", "v", "unknown")


def test_coverage_gate(spark):
    metrics = spark.createDataFrame([(0, 1), (15, 14), (15, 15)], "bank_count int, month_count int")
    gate = check_coverage_gate(metrics, F.col("bank_count") > 0, F.col("month_count") == 15)
    assert [(r.bank_count, r.month_count) for r in gate.collect()] == [(15, 14)]


def test_series_profile_freshness(spark):
    obs = spark.createDataFrame([("433", dt.date(2024, m, 1)) for m in range(1, 13)], "series_code string, d date")
    p = profile_series(obs, "series_code", "d", "2024-01-01", "2025-03-31", max_lag=1).first()
    assert p.lag_months_to_requested_end == 3 and p.status == "invalid"
    assert "freshness" in p.error


def test_derive_from_registry(spark):
    from ledgermart.operators.calendar import derive_from_registry
    obs = spark.createDataFrame([(c, dt.date(2024, m, 1), float(m)) for c in ("433", "4189", "21082", "9") for m in range(1, 13)]
                                + [(c, dt.date(2025, 1, 1), 13.0) for c in ("433", "4189", "21082", "9")],
                                "series_code string, report_month date, value double")
    reg = spark.createDataFrame([("433", "Rolling 12-month geometric compounding"), ("4189", "Latest level"),
                                 ("21082", "Percentage-point change"), ("9", "something else")],
                                "series_code string, derived_metric string")
    got = {(r.series_code, r.report_month): (r.derivation, r.derived_value)
           for r in derive_from_registry(obs, reg).collect()}
    assert got[("4189", dt.date(2025, 1, 1))] == ("latest", 13.0)
    assert got[("21082", dt.date(2025, 1, 1))] == ("pp_change", 1.0)
    assert got[("433", dt.date(2024, 11, 1))] == ("rolling_12m", None)
    assert got[("433", dt.date(2024, 12, 1))][1] == pytest.approx(
        (math.prod(1 + m / 100 for m in range(1, 13)) - 1) * 100)
    assert not any(k[0] == "9" for k in got)


def test_star_join_scalar_and_simple_checks(spark):
    from ledgermart.operators import star_join, with_scalar
    from ledgermart.operators.quality import check_exact_set, check_not_null
    fact = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "z", 30)], "id int, k string, v int")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, name string")
    dim2 = spark.createDataFrame([(1, True)], "id int, flag boolean")
    joined = star_join(fact, [(dim, "k", "inner"), (dim2, "id", "left")])
    assert sorted((r.id, r.name, r.flag) for r in joined.collect()) == [(1, "A", True), (2, "B", None)]
    total = fact.agg(F.sum("v").alias("total_v"), F.max("id").alias("max_id"))
    got = with_scalar(fact, total).orderBy("id").collect()
    assert [(r.total_v, r.max_id) for r in got] == [(60, 3)] * 3
    assert check_not_null(joined, ["flag"]).count() == 1
    exp = spark.createDataFrame([("a",), ("c",)], "k string")
    issues = {(r.k, r.issue) for r in check_exact_set(exp, fact.select("k")).collect()}
    assert issues == {("c", "missing"), ("b", "unexpected"), ("z", "unexpected")}


def test_read_table_adds_no_shuffle_and_checkpoint_dir(spark):
    from ledgermart.session import checkpoint_dir, cut_lineage
    from ledgermart.sources.tables import read_table
    path = "/root/testdata/sf0.001/orders.parquet"
    if not os.path.exists(path):
        pytest.skip("driver tables not present")
    plain = read_table(spark, path)
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    folder = checkpoint_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert cut_lineage(spark.range(5)).count() == 5
