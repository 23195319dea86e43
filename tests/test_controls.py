"""Named control sets: all pass on clean fixtures, one seeded defect fails one control."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermart.functions.types import sized_type_name
from ledgermart.operators.population import document_scope, profile_population
from ledgermart.operators.quality import live_contract
from ledgermart.operators.calendar import profile_series
from ledgermart.plans.controls import (
    fixture_landing_controls,
    mart_controls,
    population_controls,
    readiness_controls,
    warehouse_controls,
)
from ledgermart.plans.models import build_marts
from ledgermart.sources.series import derive_fetches
from tests import fixtures as fx


def _failed(table):
    return sorted(r.control_name for r in table.collect() if not r.passed)


@pytest.fixture(scope="module")
def marts(spark):
    return build_marts(spark, **fx.frames(spark))


def _mapping(spark, rows=fx.MAPPING):
    return spark.createDataFrame([(m[0], m[3]) for m in rows], "reporting_line_key string, account_code string")


def test_mart_controls(spark, marts):
    t = mart_controls(spark, marts, _mapping(spark), members=3, months=2, lines=1, series=5, official=False,
                      expected_counts={"dim_date": 3, "fact_account_balance": 24})
    assert _failed(t) == []
    drift = _mapping(spark, fx.MAPPING[:-1] + [("equity", "", 0, "6000000005", "", 1)])
    assert _failed(mart_controls(spark, marts, drift, 3, 2, 1, 5, official=False)) == [
        "reporting_line_mapping_frozen", "reporting_marts_certified"]
    # fixture rows in what should be official marts
    assert "marts_are_fixture_free" in _failed(mart_controls(spark, marts, _mapping(spark), 3, 2, 1, 5))


def test_warehouse_controls(spark, marts):
    t = warehouse_controls(spark, marts, {"account_balance": 24}, periods=2, series=5,
                           replay_counts=({"rows": 24}, {"rows": 24}))
    assert _failed(t) == ["official_rows_are_fixture_free", "official_warehouse_certified"]
    t = warehouse_controls(spark, marts, {"account_balance": 24}, 2, 5, replay_counts=({"rows": 24}, {"rows": 48}))
    assert "landing_replay_idempotent" in _failed(t)


def test_fixture_landing_controls(spark):
    f = fx.frames(spark)
    obs = f["observations"]
    man = f["file_manifest"]
    t = fixture_landing_controls(spark, f["balance_rows"], man, obs, derive_fetches(obs), 2, 5)
    assert _failed(t) == []
    short = man.withColumn("row_count", man.row_count + 1)
    assert _failed(fixture_landing_controls(spark, f["balance_rows"], short, obs, derive_fetches(obs), 2, 5)) == [
        "fixture_landing_verified", "rows_match_declared_counts"]


def _pop_rows(spark, tie=False):
    rows = []
    for period in ("202501", "202502"):
        for m in range(5):
            c1 = Decimal(100 + m) if not (tie and m == 2) else Decimal(101)
            for acct, amt in (("1", c1), ("2", Decimal(10)), ("T", c1 + 10)):
                rows.append((period, f"{m:08d}", "4010", acct, f"name {acct}", f"BANK {m}", amt))
    return spark.createDataFrame(rows, "period string, cnpj string, doc string, acct string, acct_name string, "
                                       "bank string, amt decimal(38,2)")


def _pop_controls(spark, rows):
    pop = profile_population(rows, "period", "cnpj", "acct", "amt", {"c1": "1", "c2": "2", "tg": "T"}, "c1", n=3,
                             reference_total="tg", tolerance=1.0, name="bank")
    return population_controls(spark, rows, pop, "period", "cnpj", "acct", "acct_name", "doc", "202502", 3,
                               ["c1", "c2"])


def test_population_controls_and_tie(spark):
    assert _failed(_pop_controls(spark, _pop_rows(spark))) == []
    # member 2 ties member 1 at the cut (rank 3 vs 4): the cutoff is ambiguous
    assert _failed(_pop_controls(spark, _pop_rows(spark, tie=True))) == ["cutoff_is_unambiguous", "population_ready"]


def test_readiness_controls(spark):
    man = spark.createDataFrame([("202501", "complete", "a"), ("202502", "complete", "b")],
                                "period string, status string, sha256 string")
    prof = spark.createDataFrame([("a", 0, True), ("b", 0, True)], "sha256 string, malformed_row_count int, period_matches boolean")
    obs = spark.createDataFrame([(c, dt.date(2025, m, 1)) for c in ("433", "4189") for m in (1, 2)], "series_code string, d date")
    reg = spark.createDataFrame([("433", 1), ("4189", 1)], "series_code string, lag long")
    sp = profile_series(obs, "series_code", "d", "2025-01-01", "2025-02-28", "lag", reg)
    t = readiness_controls(spark, man, prof, sp, ["433", "4189"], "2025-01-01", "2025-02-01")
    assert _failed(t) == []
    t = readiness_controls(spark, man, prof, sp, ["433", "4189"], "2025-01-01", "2025-03-01")
    assert "manifest_period_coverage" in _failed(t)


def test_source_decision_controls(spark):
    from ledgermart.plans.controls import source_decision_controls
    periods = ["202501", "202502"]
    catalog = spark.createDataFrame([(p, True) for p in periods] + [("202502", False)], "period string, is_active boolean")
    manifest = spark.createDataFrame([(p, "complete") for p in periods], "period string, status string")
    files = spark.createDataFrame([(p, 0, True) for p in periods], "period string, malformed_row_count int, period_matches boolean")
    obs = spark.createDataFrame([(c, p) for c in ("433", "4189") for p in periods], "series_code string, report_month string")
    sp = spark.createDataFrame([(c, "complete", "202501", "202502", 0, 0) for c in ("433", "4189")],
                               "series_code string, status string, requested_start_month string, requested_end_month string, "
                               "internal_missing_month_count long, duplicate_report_month_count long")
    passed = spark.createDataFrame([(True,), (True,)], "passed boolean")
    members = spark.createDataFrame([("a", 1), ("b", 2)], "institution_cnpj string, freeze_rank int")
    monthly = spark.createDataFrame([(m, p) for m in ("a", "b") for p in periods], "institution_cnpj string, period string")
    args = dict(catalog=catalog, manifest=manifest, file_profiles=files, observations=obs, series_profiles=sp,
                readiness_table=passed, population_table=passed, members=members, monthly=monthly,
                series_codes=["433", "4189"], start="2025-01-01", end="2025-02-01", n=2)
    assert _failed(source_decision_controls(spark, **args)) == []
    args["monthly"] = monthly.filter("not (institution_cnpj = 'b' and period = '202502')")
    args["observations"] = obs.filter("not (series_code = '433' and report_month = '202501')")
    assert _failed(source_decision_controls(spark, **args)) == [
        "macro_runtime_and_profile_ready", "population_monthly_coverage", "source_profile_decision"]


def test_warehouse_top_member_reconciliation(spark, marts):
    from decimal import Decimal
    top = spark.createDataFrame([("00000001", dt.date(2025, 2, 1), Decimal("1050.00")),
                                 ("00000002", dt.date(2025, 2, 1), Decimal("785.00"))],
                                "institution_cnpj string, report_month date, amount decimal(38,2)")
    t = warehouse_controls(spark, marts, {}, 2, 5, top_members=top)
    assert "top_total_assets_reconciliation" not in _failed(t)
    off = top.withColumn("amount", top.amount + 2)
    assert "top_total_assets_reconciliation" in _failed(warehouse_controls(spark, marts, {}, 2, 5, top_members=off))


def test_source_decision_fails_closed(spark):
    from ledgermart.plans.controls import source_contract, source_decision_controls
    periods = ["202506", "202507"]
    catalog = spark.createDataFrame([(p, True) for p in periods], "period string, is_active boolean")
    archives = [(p, "complete", f"sha-{p}", f"/in/{p}.zip", None) for p in periods]
    schema = "period string, status string, sha256 string, archive_path string, error string"
    manifest = spark.createDataFrame(archives, schema)
    files = spark.createDataFrame([(p, 0, True, 5) for p in periods], "period string, malformed_row_count int, period_matches boolean, row_count int")
    obs = spark.createDataFrame([("433", p) for p in periods], "series_code string, report_month string")
    sp = spark.createDataFrame([("433", "complete", "202506", "202507", 0, 0)], "series_code string, status string, requested_start_month string, "
                               "requested_end_month string, internal_missing_month_count long, duplicate_report_month_count long")
    passed = spark.createDataFrame([(True,)], "passed boolean")
    members = spark.createDataFrame([("a", 1, "202507", "4010"), ("b", 2, "202507", "4010")], "institution_cnpj string, freeze_rank int, freeze_period string, document_code string")
    monthly = spark.createDataFrame([(m, p, "4010") for m in ("a", "b") for p in periods], "institution_cnpj string, period string, document_code string")
    scope = spark.createDataFrame([("202506", 3, 3), ("202507", 3, 0)], "period string, document_4010_institutions int, document_4016_institutions int")
    lines = spark.createDataFrame([("total_assets", "certified", "sum of two classes"), ("equity", "draft", "open")], "reporting_line string, status string, rationale string")
    args = dict(catalog=catalog, manifest=manifest, file_profiles=files, observations=obs, series_profiles=sp, readiness_table=passed, population_table=passed,
                members=members, monthly=monthly, series_codes=["433"], start="2025-06-01", end="2025-07-01", n=2, period_profiles=scope,
                reporting_lines=lines, expected_lines=lines.drop("rationale"), boundary={"start": ("202506", "202506")})
    clean = source_decision_controls(spark, **args)
    assert _failed(clean) == [] and clean.count() == 12
    contract = [tuple(r) for r in source_contract(spark, clean, {"size": ("2", "frozen", "")}).orderBy("contract_order").collect()]
    assert [r[1:3] for r in contract] == [("size", "2"), ("implementation_decision", "ready_for_official_warehouse_certification"),
                                          ("warehouse_status", "not_certified"), ("mart_status", "not_built")]

    def broken(control, **changed):
        table = source_decision_controls(spark, **{**args, **changed})
        assert _failed(table) == sorted([control, "source_profile_decision"]), changed
        return table

    broken("population_monthly_coverage", monthly=monthly.limit(0))
    broken("population_monthly_coverage", monthly=monthly.filter("institution_cnpj = 'a'"))
    broken("population_monthly_coverage", monthly=monthly.unionByName(spark.createDataFrame([("z", "202506", "4010")], monthly.schema)))
    broken("population_monthly_coverage", monthly=monthly.unionByName(monthly.limit(1)))
    broken("population_contract_frozen", members=members.withColumn("freeze_period", members.institution_cnpj))
    for place, value in ((1, "failed"), (2, " "), (3, None), (4, "cut off")):
        bad = [archives[0], tuple(value if i == place else v for i, v in enumerate(archives[1]))]
        broken("cosif_runtime_and_profile_ready", manifest=spark.createDataFrame(bad, schema))
    broken("cosif_runtime_and_profile_ready", manifest=manifest.unionByName(manifest.limit(1)))
    broken("cosif_runtime_and_profile_ready", file_profiles=files.withColumn("row_count", files.row_count * 0))
    broken("document_scope_disclosed", period_profiles=scope.withColumn("document_4016_institutions", scope.document_4010_institutions))
    broken("reporting_line_draft_bounded", reporting_lines=lines.withColumn("status", lines.reporting_line))
    broken("reporting_line_draft_bounded", reporting_lines=lines.filter("status = 'draft'"))
    broken("source_boundary_complete", boundary={"start": ("202506", "202501")})
    blocked = broken("acquisition_readiness_retained", readiness_table=passed.limit(0))
    assert source_contract(spark, blocked, {}).filter("value = 'blocked'").count() == 1


def test_replay_compare_finds_what_counts_miss(spark):
    from ledgermart.operators.quality import replay_compare
    rows = [(1, "x", Decimal("1.00")), (2, "y", None), (2, "y", None), (3, None, Decimal("2.00"))]
    schema = "k int, name string, amount decimal(10,2)"
    df = spark.createDataFrame(rows, schema)

    def same(other, one=df):
        return [r.identical for r in replay_compare({"t": one}, {"t": other}).collect()] == [True]

    assert same(df.repartition(5)) and same(df.select("amount", "k", "name")) and same(df.limit(0), df.limit(0))
    assert not same(spark.createDataFrame([(1, "y", Decimal("1.00")), (2, "x", None), *rows[2:]], schema))  # values swapped between rows
    assert not same(spark.createDataFrame([rows[0], rows[0], rows[2], rows[3]], schema))  # another row repeated
    assert not same(spark.createDataFrame([*rows[:3], (3, "2.00", None)], schema)) and not same(df.limit(3))
    assert not same(df.withColumn("k", df.k.cast("bigint"))) and not same(df.withColumnRenamed("name", "title"))
    only = {r.relation: r.identical for r in replay_compare({"a": df}, {"a": df, "b": df.limit(0)}).collect()}
    assert only == {"a": True, "b": False}


def test_warehouse_replay_loads_and_run(spark, marts):
    ab = marts["account_balance"]
    loads = spark.createDataFrame([(s, "success") for s in ("cosif", "cosif", "macro", "macro")], "source string, status string")
    built = spark.createDataFrame([("a", True)], "control_name string, passed boolean")
    run = ("123e4567-e89b-12d3-a456-426614174000", "success")
    good = dict(replay=({"ab": ab}, {"ab": ab.repartition(3)}), loads=loads, raw={"account_balance": ab}, model_controls=built, run=run)
    known = ["official_rows_are_fixture_free", "official_warehouse_certified"]  # the fixtures are no official rows
    assert _failed(warehouse_controls(spark, marts, {}, 2, 5, **good)) == known

    def broken(control, **changed):
        assert _failed(warehouse_controls(spark, marts, {}, 2, 5, **{**good, **changed})) == sorted([control, *known]), control

    broken("replayed_rows_identical", replay=({"ab": ab}, {"ab": ab.withColumn("balance_amount", -ab.balance_amount)}))
    broken("loads_succeeded_twice", loads=loads.filter("source = 'cosif'").unionByName(spark.createDataFrame([("macro", "success")], loads.schema)))
    broken("loads_succeeded_twice", loads=loads.unionByName(spark.createDataFrame([("macro", "failed")], loads.schema)))
    broken("sources_loaded", loads=loads.limit(0))
    broken("raw_core_identities_account_balance", raw={"account_balance": ab.unionByName(ab.limit(1))})
    broken("model_build_passed", model_controls=built.limit(0))
    broken("run_recorded", run=(run[0], "failed"))


def test_duplicate_text(spark):
    from ledgermart.operators.quality import duplicate_text
    rows = [(None,)] * 3 + [(f"v{i:02d}",) for i in range(12) for _ in range(1 + i % 3)]
    one = duplicate_text(spark.createDataFrame(rows, "k string"), "k", most=4).collect()
    assert [tuple(r) for r in one] == [(9, "<null>×3, v02×3, v05×3, v08×3, +5 more")]
    assert [tuple(r) for r in duplicate_text(spark.createDataFrame([("a",)], "k string"), "k").collect()] == [(0, "")]


def test_document_scope_matches_brute_force(spark):
    rows = [(p, m, d) for p in ("202501", "202502", "202503") for m, ds in
            (("a", "XY"), ("b", "X"), ("c", "Z"), ("", "X"), (None, "Y"), ("d", "XYZ")) for d in ds
            if not (p == "202503" and d == "X")]
    rows += rows[:5]  # repeated rows count once, as members
    got = {r["period"]: r for r in document_scope(
        spark.createDataFrame(rows, "period string, cnpj string, doc string"), "period", "cnpj", "doc", {"x": "X", "y": "Y"}).collect()}
    assert sorted(got) == ["202501", "202502", "202503"]
    for period, r in got.items():
        by = {}
        for p, m, d in rows:
            if p == period and m:
                by.setdefault(m, set()).add(d)
        want = [sum("X" in s for s in by.values()), sum("Y" in s for s in by.values()), sum(bool(s & {"X", "Y"}) for s in by.values()),
                sum(s >= {"X", "Y"} for s in by.values()), sum(not s & {"X", "Y"} for s in by.values()),
                sum(p == period and not m for p, m, _ in rows)]
        assert [r[c] for c in ("x_members", "y_members", "any_members", "all_members", "unlisted_members", "blank_member_rows")] == want
    with pytest.raises(ValueError):
        document_scope(spark.createDataFrame(rows, "period string, cnpj string, doc string"), "period", "cnpj", "doc", {})


def test_population_ranks_within_its_document(spark):
    rows = _pop_rows(spark)
    # another document with far larger amounts, and a period that only it has
    other = rows.withColumns({"doc": F.lit("4016"), "amt": F.col("amt") * 1000, "cnpj": F.concat(F.lit("9"), "cnpj")})
    late = other.filter("period = '202502'").withColumn("period", F.lit("202503"))
    blank = rows.limit(1).withColumn("cnpj", F.lit(""))
    pop = profile_population(rows.unionByName(other).unionByName(late).unionByName(blank), "period", "cnpj", "acct", "amt",
                             {"c1": "1", "c2": "2", "tg": "T"}, "c1", freeze_period="202502", n=3, reference_total="tg", name="bank",
                             document="doc", documents={"monthly": "4010", "closing": "4016"}, ranking="monthly")
    assert [r.cnpj for r in pop.members.orderBy("freeze_rank").collect()] == ["00000004", "00000003", "00000002"]
    got = {r.period: (r.monthly_members, r.closing_members, r.any_members, r.members, r.reference_reconciled, r.blank_member_rows)
           for r in pop.period_profile.collect()}
    assert got == {"202501": (5, 5, 10, 5, 5, 1), "202502": (5, 5, 10, 5, 5, 0), "202503": (0, 5, 5, 0, 0, 0)}
    assert {(r.cnpj, r.periods_present, r.component_complete_periods, r.reference_reconciled_periods) for r in pop.history.collect()} == {
        (m, 2, 2, 2) for m in ("00000002", "00000003", "00000004")}


def test_live_contract_finds_each_kind_of_drift(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None)], "id bigint, name string, note string")
    good = [("id", "bigint", True), ("name", "text", False), ("note", "text", False)]
    assert all(r.passed for r in live_contract(spark, {"t": df}, {"t": good}).collect())
    bad = {
        "nulls": [("id", "bigint", True), ("name", "text", True), ("note", "text", False)],
        "type": [("id", "integer", True), ("name", "text", False), ("note", "text", False)],
        "order": [("name", "text", False), ("id", "bigint", True), ("note", "text", False)],
        "missing": good + [("more", "text", True)],
        "unexpected": good[:2],
    }
    for kind, contract in bad.items():
        failed = [r.column_name for r in live_contract(spark, {"t": df}, {"t": contract}).collect() if not r.passed]
        assert failed == {"nulls": ["name"], "type": ["id"], "order": ["name", "id"], "missing": ["more"], "unexpected": ["note"]}[kind]
    assert [r.relation for r in live_contract(spark, {"t": df}, {"u": good}).collect() if not r.passed] == ["t"] * 3 + ["u"] * 3
    assert all(r.passed for r in live_contract(spark, {"t": df.limit(0)}, {"t": bad["nulls"]}).collect())


def test_mart_controls_whole_set(spark, marts):
    f_line = marts["fact_reporting_line_balance"]
    one = f_line.select("reporting_line_code").distinct().count()
    evidence = f_line.filter("reporting_line_code = 'total_assets'").select("institution_cnpj", "report_month", F.col("presentation_balance_amount").alias("amount"))
    version = marts["reporting_line_mapping"].first().mapping_version
    contract = {"dim_bank": [(f.name, sized_type_name(f.dataType), False) for f in marts["dim_bank"].schema.fields]}
    args = dict(members=3, months=2, lines=one, series=5, official=False, isolated=True, mapping_version=version, population=evidence,
                live=contract, stated=("marts", "1", version), agreed=("marts", "1", version),
                model_controls=spark.createDataFrame([("a", True)], "control_name string, passed boolean"),
                run=("123e4567-e89b-12d3-a456-426614174000", "success"))
    base = _failed(mart_controls(spark, marts, _mapping(spark), **args))
    assert set(base) <= {"macro_context_rows", "reporting_marts_certified"}
    for change, name in (
        (dict(isolated=False), "isolated_official_database"),
        (dict(mapping_version="other"), "reporting_line_mapping_certified"),
        (dict(population=evidence.withColumn("amount", F.col("amount") + 1)), "top_total_assets_reconciliation"),
        (dict(population=evidence.limit(1)), "population_evidence_rows"),
        (dict(live={"dim_bank": contract["dim_bank"][:-1]}), "live_contract_matches"),
        (dict(stated=("marts", "2", version)), "contract_is_the_agreed_one"),
        (dict(model_controls=spark.createDataFrame([], "control_name string, passed boolean")), "model_build_passed"),
        (dict(run=("no", "success")), "run_recorded"),
    ):
        assert set(_failed(mart_controls(spark, marts, _mapping(spark), **{**args, **change}))) - set(base) - {"reporting_marts_certified"} == {name}


def test_fixture_landing_identity(spark):
    f = fx.frames(spark)
    rows, obs, man = f["balance_rows"], f["observations"], f["file_manifest"]
    codes = {"class_1": fx.C1, "class_2": fx.C2, "class_3": fx.C3, "total_general": fx.TG}
    run = lambda balance: _failed(fixture_landing_controls(spark, balance, man, obs, derive_fetches(obs), 2, 5, identity=codes))
    assert run(rows) == []
    off = rows.withColumn("saldo", F.when((F.col("conta") == fx.C1) & (F.col("cnpj") == "00000001"), F.col("saldo") + 1).otherwise(F.col("saldo")))
    assert run(off) == ["accounting_identity", "fixture_landing_verified"]
    # a component that isn't there is no failure of the identity
    assert "accounting_identity" not in run(rows.filter(~((F.col("conta") == fx.C2) & (F.col("cnpj") == "00000001"))))
