"""Named control sets (Q14–Q19) built on ``operators.quality.build_controls``.

Each set returns one control table ``(control_order, control_name, passed,
expected, actual, detail)`` whose last row is the fail-closed roll-up.  Every
control value is one aggregate over a DataFrame (a scalar subquery); nothing
is collected to the driver.  Facts about the runtime (run ids, orchestrator
status, database names) are plain parameters.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions._util import values_frame
from ledgermart.operators.aggregates import distinct_tuples
from ledgermart.operators.calendar import month_range
from ledgermart.operators.joins import reconcile, set_diff
from ledgermart.operators.population import Population
from ledgermart.operators.quality import (
    Control,
    build_controls,
    check_identity,
    check_row_count,
    check_schema,
    check_stable_membership,
    check_unique,
    failing_rows,
    live_contract,
    replay_compare,
)


#: The form of a run id.
UUID = "[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"


def _flag(spark: SparkSession, name: str, value: bool, detail: str = "") -> Control:
    """A control on a parameter (runtime facts that are not data)."""
    return Control(name, spark.range(1).select(F.lit(value).alias("v")), F.min("v"), True, "==", detail)


# -- Q15 population ---------------------------------------------------------
def population_controls(
    spark: SparkSession,
    rows: DataFrame,
    pop: Population,
    period: str,
    member: str,
    account: str,
    account_name: str | None,
    document: str | None,
    freeze_period,
    n: int,
    components: list[str],
    tolerance: float = 1.00,
) -> DataFrame:
    """Population freeze controls; ``rows`` are the rows the profile used.

    Controls whose inputs a table does not have (document, account names,
    member names, a reference total) are left out.
    """
    state, monthly = pop.state, pop.monthly
    periods = state.select(F.count_distinct(period)).scalar()
    coverage_gaps = monthly.groupBy(member).agg(F.count_distinct(period).alias("_p")).filter(F.col("_p") != periods)
    names = [c for c in ("member_name",) if c in monthly.columns]
    dup_rows = state.filter(F.greatest(*[F.col(f"{c}_rows") for c in components]) > 1)
    missing = monthly.filter(F.greatest(*[F.col(c).isNull() for c in components]))
    controls = [Control("freeze_period_is_latest", state, F.max(period), freeze_period)]
    if document:
        controls.append(Control("document_scope_is_single", rows, F.count_distinct(document), 1))
    if account_name:
        controls.append(failing_rows("asset_account_contract", rows.groupBy(account).agg(
            F.count_distinct(account_name).alias("_n")).filter("_n > 1")))
    controls += [
        failing_rows("relevant_account_rows_are_unique", dup_rows),
        Control("population_size", pop.members, F.count(F.lit(1)), n),
        Control("cutoff_is_unambiguous", pop.members, F.min("cutoff_gap"), 0, ">"),
        failing_rows("stable_population_period_coverage", coverage_gaps),
        failing_rows("population_components_are_explicit", missing),
    ]
    if names:
        controls.append(failing_rows("population_names_are_stable", monthly.groupBy(member).agg(
            F.count_distinct("member_name").alias("_n")).filter("_n > 1")))
    if "reference_difference" in monthly.columns:
        controls.append(failing_rows("population_reference_reconciliation", monthly.filter(
            F.col("reference_difference").isNull() | (F.abs("reference_difference") > F.lit(tolerance)))))
    return build_controls(spark, controls, "population_ready")


# -- Q16 load readiness -------------------------------------------------------
def readiness_controls(spark: SparkSession, manifest: DataFrame, profiles: DataFrame, series_profiles: DataFrame,
                       series_codes, start: str, end: str) -> DataFrame:
    """Is a bounded load ready?  Manifest, file profiles and series profiles.

    ``manifest``: period, status, sha256 · ``profiles``: sha256, malformed_row_count,
    period_matches · ``series_profiles``: the output of ``profile_series``.
    """
    expected = month_range(spark, start, end).select(F.date_format("month_start", "yyyyMM").alias("period"))
    complete = manifest.filter(F.col("status") == "complete")
    codes = values_frame(spark, [(c,) for c in series_codes], "series_code string")
    sp = series_profiles
    start_p, end_p = start[:7].replace("-", ""), end[:7].replace("-", "")
    controls = [
        failing_rows("manifest_period_coverage", set_diff(expected, manifest.select("period").distinct())),
        failing_rows("all_downloads_complete", manifest.filter(F.col("status") != "complete")),
        failing_rows("profile_matches_complete_downloads",
                     set_diff(complete.select("sha256").distinct(), profiles.select("sha256").distinct())),
        failing_rows("all_profiles_valid", profiles.filter(
            (F.col("malformed_row_count") > 0) | ~F.coalesce(F.col("period_matches"), F.lit(False)))),
        failing_rows("exact_series_coverage", set_diff(codes, sp.select("series_code").distinct())),
        failing_rows("all_series_complete", sp.filter(F.col("status") != "complete")),
        failing_rows("requested_window_matches", sp.filter(
            (F.col("requested_start_month") != start_p) | (F.col("requested_end_month") != end_p))),
        failing_rows("all_series_have_observations", sp.filter(F.col("row_count") <= 0)),
    ]
    return build_controls(spark, controls, "bounded_load_ready")


# -- Q14 fixture landing --------------------------------------------------------
def fixture_landing_controls(spark: SparkSession, balance: DataFrame, manifest: DataFrame, observations: DataFrame,
                             fetches: DataFrame, expected_manifests: int, expected_series: int,
                             identity: dict[str, str] | None = None) -> DataFrame:
    """Synthetic landing: counts, identities, the (lenient) accounting identity.

    ``identity``: account codes of ``class_1``, ``class_2``, ``class_3`` and
    ``total_general``; a member's month that lacks one of them doesn't fail.
    """
    per_file = check_row_count(balance.join(manifest.select("source_checksum", F.col("row_count").alias("_declared")),
                                            "source_checksum"), "source_checksum", "_declared")
    obs_per_series = observations.groupBy("series_code").agg(F.count(F.lit(1)).alias("_n"))
    fetch_mismatch = fetches.join(obs_per_series, "series_code", "full_outer").filter(
        F.coalesce(F.col("response_count"), F.lit(-1)) != F.coalesce(F.col("_n"), F.lit(-2)))
    controls = [
        Control("manifest_count", manifest, F.count(F.lit(1)), expected_manifests),
        failing_rows("rows_match_declared_counts", per_file),
        failing_rows("landing_identity_unique", check_unique(balance, ["source_checksum", "file_row_number"])),
        failing_rows("balance_rows_are_synthetic", balance.filter(~F.col("source_url").startswith("fixture://"))),
        Control("series_count", observations, F.count_distinct("series_code"), expected_series),
        Control("observation_grain_unique", observations,
                F.count(F.lit(1)) - distinct_tuples(observations, ["series_code", "source_observation_date"]), 0),
        failing_rows("fetches_match_observations", fetch_mismatch),
        failing_rows("observations_are_synthetic", observations.filter(~F.col("fixture"))),
    ]
    if identity:
        bad = check_identity(balance, ["source_period", "cnpj"], "conta", "saldo", ["class_1", "class_2"],
                             ("total_general", "class_3"), identity, lenient=True)
        controls.append(failing_rows("accounting_identity", bad))
    return build_controls(spark, controls, "fixture_landing_verified")


# -- Q18 warehouse certification ----------------------------------------------
def warehouse_controls(spark: SparkSession, marts: dict[str, DataFrame], expected_counts: dict[str, int],
                       periods: int, series: int, replay_counts: tuple[dict, dict] | None = None,
                       top_members: DataFrame | None = None, isolated: bool = True,
                       replay: tuple[dict[str, DataFrame], dict[str, DataFrame]] | None = None,
                       loads: DataFrame | None = None, raw: dict[str, DataFrame] | None = None,
                       model_controls: DataFrame | None = None, run: tuple[str, str] | None = None) -> DataFrame:
    """Official core certification: counts, coverage, fixture-free, replay, reconciliations.

    ``replay``: relations before and after a second load, compared row by row as
    multisets · ``loads``: (source, status) of every load, of which each source needs
    two that succeeded and none that failed · ``raw``: relation → the landed rows that
    it must preserve in number · ``model_controls``: the retained control table of the
    model build, empty fails · ``run``: (run id, status), a UUID and ``success``.
    A control whose input isn't given is left out.
    """
    ab, man = marts["account_balance"], marts["cosif_file_manifest"]
    controls = [_flag(spark, "isolated_official_database", isolated)]
    for rel, n in expected_counts.items():
        controls.append(Control(f"rows_{rel}", marts[rel], F.count(F.lit(1)), n))
    controls += [
        Control("cosif_period_coverage", man.filter("is_selected"), F.count_distinct("source_period"), periods),
        Control("macro_series_coverage", marts["macro_observation"], F.count_distinct("series_code"), series),
        failing_rows("official_rows_are_fixture_free", ab.filter("is_fixture")),
        failing_rows("raw_core_row_reconciliation", check_row_count(ab, "source_checksum", "declared_row_count")),
    ]
    if replay_counts is not None:
        before, after = replay_counts
        controls.append(_flag(spark, "landing_replay_idempotent", before == after, f"{before} -> {after}"))
    if replay is not None:
        controls.append(failing_rows("replayed_rows_identical", replay_compare(*replay).filter(~F.col("identical"))))
    if loads is not None:
        bad_loads = loads.groupBy("source").agg(F.count_if(F.col("status") == "success").alias("_good"), F.count(F.lit(1)).alias("_all"))
        controls += [
            Control("sources_loaded", loads, F.count_distinct("source"), 0, ">"),
            failing_rows("loads_succeeded_twice", bad_loads.filter((F.col("_good") < 2) | (F.col("_good") < F.col("_all")))),
        ]
    for rel, landed in (raw or {}).items():
        kept = marts[rel].select(F.lit(1).alias("sign")).unionByName(landed.select(F.lit(-1).alias("sign")))
        controls.append(Control(f"raw_core_identities_{rel}", kept, F.coalesce(F.sum("sign"), F.lit(0)), 0))
    if model_controls is not None:
        controls.append(Control("model_build_passed", model_controls, F.coalesce(F.bool_and(F.coalesce("passed", F.lit(False))), F.lit(False)), True))
    if run is not None:
        controls.append(_flag(spark, "run_recorded", bool(re.fullmatch(UUID, run[0] or "")) and run[1] == "success", "|".join(str(r) for r in run)))
    if top_members is not None:
        ta = ab.filter((F.col("document_code") == "4010") & F.col("account_code").isin("1000000009", "2000000008"))
        got = ta.groupBy("institution_cnpj", "report_month").agg(F.sum("balance_amount").alias("amount"))
        bad = reconcile(top_members.select("institution_cnpj", "report_month", "amount"),
                        got.join(top_members.select("institution_cnpj", "report_month"),
                                 ["institution_cnpj", "report_month"], "left_semi"),
                        ["institution_cnpj", "report_month"], "amount", 0.01).filter(F.col("status") != "match")
        controls.append(failing_rows("top_total_assets_reconciliation", bad))
    return build_controls(spark, controls, "official_warehouse_certified")


# -- Q19 mart certification -----------------------------------------------------
def mart_controls(spark: SparkSession, marts: dict[str, DataFrame], expected_mapping: DataFrame,
                  members: int, months: int, lines: int, series: int,
                  contract: dict | None = None, expected_counts: dict[str, int] | None = None,
                  official: bool = True, isolated: bool | None = None, mapping_version: str | None = None,
                  population: DataFrame | None = None, live: dict[str, list[tuple]] | None = None,
                  stated: tuple[str, str, str] | None = None, agreed: tuple[str, str, str] | None = None,
                  model_controls: DataFrame | None = None, run: tuple[str, str] | None = None) -> DataFrame:
    """Reporting-mart certification (fixture-free, coverage, reconciliations, contract).

    ``mapping_version``: the one version of the mapping, all of it certified ·
    ``population``: (institution_cnpj, report_month, amount) that the total-assets
    line must reproduce, each row of it · ``live``: the contract of the marts as
    they are, see ``live_contract`` · ``stated`` and ``agreed``: name, version and
    mapping version in the contract and as agreed · ``model_controls`` and ``run``
    as in ``warehouse_controls``.  With ``population`` or ``live`` the marts must
    have a row for each member, month, line and series too.  A control whose input
    isn't given is left out.
    """
    f_line, f_acct = marts["fact_reporting_line_balance"], marts["fact_account_balance"]
    ctx = marts["fact_monthly_economic_context"]
    controls = [] if isolated is None else [_flag(spark, "isolated_official_database", isolated)]
    for rel, n in (expected_counts or {}).items():
        controls.append(Control(f"rows_{rel}", marts[rel], F.count(F.lit(1)), n))
    actual_mapping = marts["reporting_line_mapping"].select("reporting_line_key", "account_code")
    controls.append(failing_rows("reporting_line_mapping_frozen", set_diff(expected_mapping, actual_mapping)))
    if mapping_version:
        settled = (F.col("mapping_version") == mapping_version) & (F.col("status") == "certified")
        controls.append(failing_rows("reporting_line_mapping_certified", marts["reporting_line_mapping"].filter(~F.coalesce(settled, F.lit(False)))))
    if official:
        fixtures = f_line.select("is_fixture").unionByName(f_acct.select("is_fixture")).filter("is_fixture")
        controls.append(failing_rows("marts_are_fixture_free", fixtures))
    ta = f_line.filter(F.col("reporting_line_code") == "total_assets")
    controls += [
        Control("population_members", marts["dim_bank"], F.count(F.lit(1)), members),
        failing_rows("stable_population_coverage", check_stable_membership(ta, "institution_cnpj", "report_month", months)),
        Control("reporting_line_coverage", f_line, F.count_distinct("reporting_line_code"), lines),
    ]
    mapping = marts["reporting_line_mapping"]
    expected = f_acct.join(mapping, "account_code").groupBy(
        "report_month", "institution_cnpj", F.col("reporting_line_key").alias("reporting_line_code")).agg(
        F.sum(F.col("balance_amount") * F.col("presentation_multiplier")).alias("amount"))
    actual = f_line.select("report_month", "institution_cnpj", "reporting_line_code",
                           F.col("presentation_balance_amount").alias("amount"))
    recon = reconcile(expected, actual, ["report_month", "institution_cnpj", "reporting_line_code"], "amount")
    controls.append(failing_rows("reporting_line_account_reconciliation", recon.filter(F.col("status") != "match")))
    controls.append(Control("monthly_macro_context_coverage", ctx,
                            F.count(F.lit(1)) - F.count_distinct("series_code", "report_month"), 0))
    controls.append(Control("macro_series_in_context", ctx, F.count_distinct("series_code"), series))
    if population is not None or live:
        controls += [
            Control("total_asset_rows", ta, F.count(F.lit(1)), members * months),
            Control("reporting_rows", f_line, F.count(F.lit(1)), members * months * lines),
            Control("macro_context_rows", ctx, F.count(F.lit(1)), series * months),
        ]
    if population is not None:
        keys = ["institution_cnpj", "report_month"]
        got = ta.select(*keys, F.col("presentation_balance_amount").alias("amount"))
        # the evidence is read once: two reads of one that isn't fixed (limit) may differ
        off = reconcile(population.select(*keys, "amount"), got, keys, "amount", 0.01).filter(F.col("status") != "missing_expected")
        controls += [
            Control("population_evidence_rows", population, F.count(F.lit(1)), members * months),
            failing_rows("top_total_assets_reconciliation", off.filter(F.col("status") != "match")),
        ]
    if live:
        evidence = live_contract(spark, {name: marts[name] for name in live if name in marts}, live)
        controls.append(failing_rows("live_contract_matches", evidence.filter(~F.col("passed"))))
    if stated is not None:
        controls.append(_flag(spark, "contract_is_the_agreed_one", stated == agreed, "|".join(str(x) for x in stated)))
    if model_controls is not None:
        controls.append(Control("model_build_passed", model_controls, F.coalesce(F.bool_and(F.coalesce("passed", F.lit(False))), F.lit(False)), True))
    if run is not None:
        controls.append(_flag(spark, "run_recorded", bool(re.fullmatch(UUID, run[0] or "")) and run[1] == "success", "|".join(str(r) for r in run)))
    if contract:
        issues = sum(len(check_schema(marts[name], spec["schema"])) for name, spec in contract.items() if name in marts)
        controls.append(Control("mart_contract_matches", spark.range(1).select(F.lit(issues).alias("v")), F.max("v"), 0))
    return build_controls(spark, controls, "reporting_marts_certified")


# -- Q17 source decision ----------------------------------------------------------
def source_decision_controls(
    spark: SparkSession,
    catalog: DataFrame,
    manifest: DataFrame,
    file_profiles: DataFrame,
    observations: DataFrame,
    series_profiles: DataFrame,
    readiness_table: DataFrame,
    population_table: DataFrame,
    members: DataFrame,
    monthly: DataFrame,
    series_codes,
    start: str,
    end: str,
    n: int,
    period_profiles: DataFrame | None = None,
    reporting_lines: DataFrame | None = None,
    expected_lines: DataFrame | None = None,
    boundary: dict[str, tuple[object, object]] | None = None,
) -> DataFrame:
    """Final fail-closed decision over the retained evidence (Q17).

    An empty input, a member without monthly rows, rows of anyone else, and an archive
    without checksum or path or with an error all fail.  ``period_profiles``: period and
    the institutions of the monthly and of the half-yearly document · ``reporting_lines``
    and ``expected_lines``: rows of the same columns, exactly equal, plus a ``rationale``
    on the former · ``boundary``: name → (decided, actual).  Their controls are left out
    where they aren't given.  A column of the evidence that says more than its table has
    (checksum, path, error, freeze period, document) is checked where it is there.

    Key-set equality against the expected (series × month) and
    (member × month) grids is checked without building the grid: per key,
    the distinct months inside the window must equal the window length and
    nothing may fall outside it; the key sets themselves are compared with
    set differences.
    """
    periods = month_range(spark, start, end).select(F.date_format("month_start", "yyyyMM").alias("period"))
    n_periods = periods.select(F.count(F.lit(1))).scalar()
    lo, hi = start[:7].replace("-", ""), end[:7].replace("-", "")
    in_window = F.col("period").between(lo, hi)
    active = catalog.filter(F.col("is_active") & in_window)
    dup_active = active.groupBy("period").count().filter("count > 1").select("period")
    codes = series_codes if isinstance(series_codes, DataFrame) else values_frame(spark, [(c,) for c in series_codes], "series_code string")
    obs = observations.select("series_code", F.col("report_month").alias("period"))
    series_gaps = obs.groupBy("series_code").agg(
        F.count_distinct(F.when(in_window, F.col("period"))).alias("_in"), F.count_if(~in_window).alias("_out"),
        F.count(F.lit(1)).alias("_rows"),
    ).filter((F.col("_in") != n_periods) | (F.col("_out") > 0) | (F.col("_rows") != F.col("_in")))
    bad_profiles = series_profiles.filter(
        (F.col("status") != "complete") | (F.col("requested_start_month") != lo) | (F.col("requested_end_month") != hi)
        | (F.col("internal_missing_month_count") != 0) | (F.col("duplicate_report_month_count") != 0))
    listed = members.select("institution_cnpj").distinct().withColumn("_months", F.lit(n_periods)).withColumn("_rows", F.lit(n_periods))
    seen = monthly.groupBy("institution_cnpj").agg(
        F.count_distinct(F.when(in_window, F.col("period"))).alias("_months"), F.count(F.lit(1)).alias("_rows"))
    member_gaps = set_diff(listed, seen.select(*listed.columns))
    archives = manifest.filter((F.col("status") == "complete") & _stated(manifest, "sha256", "archive_path") & _without(manifest, "error"))
    profiled = file_profiles.filter((F.col("malformed_row_count") == 0) & F.col("period_matches") & _stated(file_profiles, "sha256") & _counted(file_profiles))
    frozen = members.filter(_is(members, "freeze_period", hi) & _is(members, "document_code", ANALYTICAL_DOCUMENT))
    controls = [
        failing_rows("catalog_active_period_coverage",
                     set_diff(periods, active.select("period").distinct()).select("period").unionByName(dup_active)),
        failing_rows("cosif_runtime_and_profile_ready", _uncovered(periods, manifest, archives).unionByName(_uncovered(periods, file_profiles, profiled))),
        failing_rows("macro_runtime_and_profile_ready",
                     set_diff(codes, obs.select("series_code").distinct()).select("series_code")
                     .unionByName(series_gaps.select("series_code")).unionByName(bad_profiles.select("series_code"))),
        Control("acquisition_readiness_retained", readiness_table, F.bool_and("passed"), True),
        Control("population_controls_retained", population_table, F.bool_and("passed"), True),
        Control("population_contract_frozen", frozen,
                (F.count(F.lit(1)) == n) & (F.count_distinct("institution_cnpj") == n)
                & (F.min("freeze_rank") == 1) & (F.max("freeze_rank") == n)
                & (F.count_distinct("freeze_rank") == n), True),
        failing_rows("population_monthly_coverage", member_gaps),
    ]
    if "document_code" in monthly.columns:
        controls.append(failing_rows("population_monthly_document", monthly.filter(~_is(monthly, "document_code", ANALYTICAL_DOCUMENT))))
    if period_profiles is not None:
        half_yearly = F.col("period").substr(5, 2).isin("06", "12")
        disclosed = period_profiles.filter(
            (F.coalesce("document_4010_institutions", F.lit(0)) > 0)
            & ((F.coalesce("document_4016_institutions", F.lit(0)) > 0) == half_yearly))
        controls.append(failing_rows("document_scope_disclosed", _uncovered(periods, period_profiles, disclosed)))
    if reporting_lines is not None:
        stated = reporting_lines.filter(F.trim("rationale") != "").select(*expected_lines.columns)
        repeated = check_unique(reporting_lines, [expected_lines.columns[0]]).select(F.col(expected_lines.columns[0]).cast("string").alias("line"))
        differ = set_diff(expected_lines, stated).select(F.col(expected_lines.columns[0]).cast("string").alias("line"))
        controls.append(failing_rows("reporting_line_draft_bounded", differ.unionByName(repeated)))
    if boundary is not None:
        differing = [k for k, (decided, actual) in boundary.items() if decided != actual]
        controls.append(_flag(spark, "source_boundary_complete", bool(boundary) and not differing, "|".join(f"{k}={a}" for k, (_, a) in boundary.items())))
    return build_controls(spark, controls, "source_profile_decision")


# Fixed value: the document of the monthly ranking and trend.
ANALYTICAL_DOCUMENT = "4010"


def _stated(df: DataFrame, *columns: str):
    """Every one of ``columns`` that ``df`` has holds something."""
    out = F.lit(True)
    for c in set(columns) & set(df.columns):
        out = out & F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    return out


def _without(df: DataFrame, column: str):
    return F.coalesce(F.trim(column) == "", F.lit(True)) if column in df.columns else F.lit(True)


def _counted(df: DataFrame):
    return F.coalesce(F.col("row_count") > 0, F.lit(False)) if "row_count" in df.columns else F.lit(True)


def _is(df: DataFrame, column: str, value: str):
    return F.coalesce(F.col(column) == value, F.lit(False)) if column in df.columns else F.lit(True)


def _uncovered(periods: DataFrame, rows: DataFrame, good: DataFrame) -> DataFrame:
    """(period) of the periods without a good row, the rows of other periods, and the periods with more rows than one or a bad one."""
    bad = rows.groupBy("period").agg(F.count(F.lit(1)).alias("_n")).join(good.groupBy("period").agg(F.count(F.lit(1)).alias("_good")), "period", "left")
    bad = bad.filter((F.col("_n") != 1) | F.col("_good").isNull()).select("period")
    return set_diff(periods, rows.select("period").distinct()).select("period").unionByName(bad)


def source_contract(spark: SparkSession, decision: DataFrame, decided: dict[str, tuple[str, str, str]]) -> DataFrame:
    """The contract that the decision freezes (Q17): ``(contract_item, value, status, note)``.

    ``decided``: item → (value, status, note), in order.  The last three rows follow from
    ``decision`` (the table of ``source_decision_controls``): the outcome, which is
    ``blocked`` unless its roll-up passed, and what stays open whatever it says.
    """
    passed = decision.agg(F.coalesce(F.bool_and(F.coalesce("passed", F.lit(False))), F.lit(False))).scalar()
    rows = [(i, item, *facts) for i, (item, facts) in enumerate(decided.items())]
    end = len(rows)
    rows += [(end, "implementation_decision", "", "decision", "Outcome of the source decision."),
             (end + 1, "warehouse_status", "not_certified", "pending", "The decision certifies no warehouse."),
             (end + 2, "mart_status", "not_built", "pending", "Marts follow once the warehouse is certified.")]
    frame = values_frame(spark, rows, "contract_order int, contract_item string, value string, status string, note string")
    outcome = F.when(passed, "ready_for_official_warehouse_certification").otherwise("blocked")
    return frame.withColumn("value", F.when(F.col("contract_item") == "implementation_decision", outcome).otherwise(F.col("value")))


def identity_control(rows: DataFrame, codes: dict[str, str], tolerance: float = 0.01) -> Control:
    """Accounting identity class1 + class2 = total − class3 as a control (Q7)."""
    bad = check_identity(rows, ["report_month", "institution_cnpj"], "account_code", "balance_amount",
                         ["class_1", "class_2"], ("total_general", "class_3"), codes, tolerance)
    return failing_rows("accounting_identity", bad)


__all__ = [
    "population_controls", "readiness_controls", "source_decision_controls", "fixture_landing_controls", "warehouse_controls",
    "mart_controls", "identity_control", "source_contract",
]
