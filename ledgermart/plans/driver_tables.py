"""The library's operators applied to the driver's star-schema tables.

Domain mapping (balance domain → driver tables):

* reporting month  → month of ``o_orderdate``
* institution      → customer nation (``c_nationkey``; 25 members)
* account code     → part type (``p_type``)
* balance amount   → ``l_extendedprice`` as an exact ``decimal(38,2)``
* file version     → an order of a customer (status ``F`` = complete)
* series           → a customer's monthly order series

Each recipe reads whole tables (filters are the feature's own parameters,
e.g. the freeze month) and returns a DataFrame; ``SQL`` holds the equivalent
DuckDB query over the same tables, with the same column names and types.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions import (
    blank_to_null,
    flag,
    locale_decimal_text,
    money,
    month_key,
    month_start,
    parse_locale_decimal,
    period_text,
    stage,
    surrogate_key,
    valid_period,
)
from ledgermart.functions._util import values_frame
from ledgermart.functions.text import first_text
from ledgermart.functions.dates import month_label
from ledgermart.operators import MeasureModel, account_amount, calendar, macro_value
from ledgermart.operators.aggregates import distinct_tuples, line_balance, metrics_row, null_scan, peer_median, pivot_sums
from ledgermart.operators.calendar import continuity_breaks, coverage, missing_months, profile_series, derive_series
from ledgermart.operators.joins import (
    reconcile,
    selected_rows,
    set_compare,
    set_diff,
    with_membership,
    with_scalar,
)
from ledgermart.operators.measures import prior_period, share_of_selection, trust_card
from ledgermart.operators.population import document_scope, profile_population, top_members
from ledgermart.operators.quality import Control, build_controls, check_accepted_values, check_row_count, check_unique, failing_rows, live_contract
from ledgermart.operators.versioning import latest_by, select_version, version_ordinal
from ledgermart.plans.controls import population_controls
from ledgermart.sources.catalog import classify_probes
from ledgermart.session import scratch_path
from ledgermart.sources.landing import table_exists, upsert_frames, write_table
from ledgermart.sources.tables import read_table

# Reporting-line mapping of part types (line, name, order,
# account, component, multiplier), its version, the freeze month, the
# population size and the accepted / expected code sets.
MAPPING_ROWS = [
    ("total_assets", "Total assets", 1, "STANDARD", "Standard goods", 1),
    ("total_assets", "Total assets", 1, "SMALL", "Small goods", 1),
    ("total_assets", "Total assets", 1, "MEDIUM", "Medium goods", 1),
    ("total_assets", "Total assets", 1, "LARGE", "Large goods", 1),
    ("total_assets", "Total assets", 1, "PROMO", "Promotional goods", 1),
    ("credit_portfolio", "Credit portfolio", 2, "SMALL", "Small goods", 1),
    ("credit_portfolio", "Credit portfolio", 2, "MEDIUM", "Medium goods", 1),
    ("deposits", "Deposits", 3, "STANDARD", "Standard goods", 1),
    ("equity", "Equity", 4, "PROMO", "Promotional goods", 1),
    ("equity", "Equity", 4, "LARGE", "Large goods", -1),
]
MAPPING_VERSION = "v1"
FREEZE_MONTH = "2001-07-01"
POPULATION_SIZE = 15
ACCEPTED_STATUSES = ("F", "O", "P")
EXPECTED_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "RETAIL")
SERIES_START = "1995-01-01"
SERIES_END = "2001-08-01"
SERIES_MAX_LAG = 3
PROBE_STATUS = {"view": 200, "click": 206, "signup": 404, "purchase": 503}

MART_INPUTS = ("lineitem", "orders", "customer", "part")
#: Bytes of these files for each shuffle partition of a mart's build, and its partitions at most.
PARTITION_BYTES, MOST_PARTITIONS = 16 << 20, 20_000
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, f"{d}/{name}.parquet")


def mapping_df(spark: SparkSession) -> DataFrame:
    rows = [(*r, MAPPING_VERSION, "certified") for r in MAPPING_ROWS]
    return values_frame(
        spark, rows,
        "reporting_line_key string, reporting_line_name string, display_order int, p_type string, "
        "component_name string, presentation_multiplier int, mapping_version string, status string",
    )


def _month(c: str):
    return month_start(c)


def _in_month(c: str, month: str):
    """Range predicate on the raw column (pushed into the Parquet scan)."""
    start = dt.date.fromisoformat(month)
    end = (start.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return (F.col(c) >= F.lit(start).cast("timestamp_ntz")) & (F.col(c) < F.lit(end).cast("timestamp_ntz"))


# ---------------------------------------------------------------------------
# Shared relations
# ---------------------------------------------------------------------------
# Marts reused by many report queries are tables below the shared checkpoint
# folder, written once per application and version of their input files.
def session_mart(spark: SparkSession, d: str, name: str, build) -> DataFrame:
    path = scratch_path(spark, f"marts/{spark.sparkContext.applicationId}/{input_version(spark, d)}/{name}")
    if not table_exists(spark, f"{path}/_SUCCESS"):
        with shuffles_for(spark, d):
            write_table(build(), path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def shuffles_for(spark: SparkSession, d: str):
    """As many shuffle partitions as the inputs ask for, at least the session's: what a task sorts
    or groups doesn't grow with the tables. AQE coalesces them where little is left."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), min(MOST_PARTITIONS, -(-input_bytes(spark, d) // PARTITION_BYTES)))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def input_bytes(spark: SparkSession, d: str) -> int:
    """Bytes of the files of the tables a mart is built from."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f"{d}/{name}.parquet") for name in MART_INPUTS]
    return sum(path.getFileSystem(conf).getContentSummary(path).getLength() for path in paths)


def input_version(spark: SparkSession, d: str) -> str:
    """A name for the tables a mart is built from: changes when one of them is rewritten."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    stamps = []
    for name in MART_INPUTS:
        path = jvm.org.apache.hadoop.fs.Path(f"{d}/{name}.parquet")
        status = path.getFileSystem(conf).getFileStatus(path)
        stamps.append(f"{path}:{status.getModificationTime()}:{status.getLen()}")
    return hashlib.md5("|".join(stamps).encode()).hexdigest()


def member_account_month(spark: SparkSession, d: str) -> DataFrame:
    """Balance at (month, member, account) grain – the account-level mart.

    Bounded by months × members × accounts whatever the raw size; the line
    fact, the population profile and the account amounts all read it.
    """
    return session_mart(spark, d, "member_account_month", lambda: build_member_account_month(spark, d))


def build_member_account_month(spark: SparkSession, d: str) -> DataFrame:
    """Each order gets its member before the line items join, so that the map-side partial
    aggregation holds months × members × accounts groups, however many customers there are.
    Prices are typed after the joins: a raw one is a third of the size."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", _month("o_orderdate").alias("report_month"),
        (F.col("o_orderstatus") == "F").alias("is_final"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    p = table(spark, d, "part").select("p_partkey", "p_type")
    owned = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "report_month", "c_nationkey", "is_final")
    rows = li.join(owned, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("report_month", "c_nationkey", "p_type").agg(
        F.sum(money("l_extendedprice")).alias("amount"), F.count(F.lit(1)).alias("line_count"), F.bool_and("is_final").alias("is_final"))


def line_fact(spark: SparkSession, d: str) -> DataFrame:
    """Mapped line balances per (month, nation, line) – the D17 analogue (a mart)."""
    return session_mart(spark, d, "line_fact", lambda: build_line_fact(spark, d))


def build_line_fact(spark: SparkSession, d: str) -> DataFrame:
    lb = line_balance(member_account_month(spark, d), mapping_df(spark), ["report_month", "c_nationkey"],
                      "p_type", "amount", flag="is_final")
    return lb.select(
        surrogate_key("report_month", "c_nationkey", "reporting_line_key", "mapping_version").alias("reporting_line_balance_key"),
        "report_month",
        "c_nationkey",
        F.col("reporting_line_key").alias("reporting_line_code"),
        "mapping_version",
        "reported_balance_amount",
        "presentation_balance_amount",
        "contributing_account_count",
        "contributing_account_codes",
        F.col("all_flag").alias("is_complete"),
    )


def date_dim(spark: SparkSession, d: str) -> DataFrame:
    """The calendar dimension as a session mart (one row per observed month)."""
    return session_mart(spark, d, "month_calendar", lambda: month_calendar(spark, d))


def measures(spark: SparkSession, d: str) -> MeasureModel:
    return MeasureModel(line_fact(spark, d), month="report_month", member="c_nationkey",
                        line="reporting_line_code", amount="presentation_balance_amount",
                        date_dim=date_dim(spark, d), date_month="month_start")


def _orders_versioned(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return select_version(
        o, "o_custkey",
        [(F.col("o_orderstatus") == "F").desc(), F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
        "o_orderkey", complete=F.col("o_orderstatus") == "F")


def _nation_month_totals(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", _month("o_orderdate").alias("report_month"),
                                        money("o_totalprice").alias("amount"))
    per_cust = o.groupBy("o_custkey", "report_month").agg(F.sum("amount").alias("amount"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return per_cust.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("report_month", "c_nationkey").agg(
        F.sum("amount").alias("total_amount"))


def _freeze(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter(_in_month("o_orderdate", FREEZE_MONTH)).select(
        "o_custkey", money("o_totalprice").alias("amount"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    totals = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(
        F.sum("amount").alias("total_amount"))
    return top_members(totals, "c_nationkey", "total_amount", POPULATION_SIZE)


# ---------------------------------------------------------------------------
# Recipes
# ---------------------------------------------------------------------------
def staging_orders(spark, d):
    o = table(spark, d, "orders")
    return stage(o, {
        "order_key": F.col("o_orderkey"),
        "customer_key": F.col("o_custkey"),
        "status": blank_to_null("o_orderstatus"),
        "priority": blank_to_null("o_orderpriority"),
        "report_month": _month("o_orderdate"),
        "month_key": month_key(_month("o_orderdate")),
        "source_period": period_text("o_orderdate"),
        "is_valid_period": valid_period(period_text("o_orderdate")),
        "amount": money("o_totalprice"),
        "is_urgent": F.col("o_orderpriority").startswith("1-"),
        "has_priority": flag(blank_to_null("o_orderpriority")),
    })


def month_calendar(spark, d):
    o = table(spark, d, "orders").select(_month("o_orderdate").alias("report_month"))
    li = table(spark, d, "lineitem").select(_month("l_shipdate").alias("report_month"))
    return calendar(o, li)


def surrogate_keys(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        surrogate_key("l_orderkey", "l_linenumber").alias("line_key"),
        surrogate_key("l_partkey", "l_suppkey").alias("part_supplier_key"),
        surrogate_key(_month("l_shipdate"), "l_orderkey").alias("ship_month_order_key"),
        surrogate_key("l_partkey").alias("part_key"),
    )


def url_fields(spark, d):
    p = table(spark, d, "pages")
    u = F.col("url")
    lang = F.regexp_extract(u, r"^[a-z]+://[^/]+/([a-z]{2})/", 1)
    query_page = F.regexp_extract(u, r"[?&]page=(\d+)", 1)
    fragment = F.regexp_extract(u, r"#(.*)$", 1)
    return p.select(
        "page_id",
        F.regexp_extract(u, r"^([a-z]+)://", 1).alias("scheme"),
        F.regexp_extract(u, r"^[a-z]+://([^/?#]+)", 1).alias("host"),
        blank_to_null(lang).alias("lang"),
        F.nullif(F.regexp_extract(u, r"^[a-z]+://[^/]+/[a-z]{2}/(\d+)", 1), F.lit("")).cast("bigint").alias("page_number"),
        F.regexp_extract(u, r"(?i)\.(html?)$", 1).alias("extension"),
        first_text(fragment, query_page, lang).alias("first_locator"),
        F.regexp_extract(u, r"(?i)^https?://(blog|www|m)\.", 1).alias("subdomain"),
    )


def event_json(spark, d):
    e = table(spark, d, "events")
    parsed = F.from_json("props", "k INT")
    return e.select(
        "event_id", "event_type",
        parsed.getField("k").alias("k"),
        parsed.getField("k").isNotNull().alias("has_k"),
        F.to_date("ts").alias("event_date"),
        month_start("ts").alias("report_month"),
    )


def locale_decimal(spark, d):
    """Render amounts as ``1.234,56`` and parse them back, in one projection."""
    o = table(spark, d, "orders")
    text = locale_decimal_text("o_totalprice")
    return o.select("o_orderkey", text.alias("amount_text"), money("o_totalprice").alias("_orig")).select(
        "o_orderkey", "amount_text", parse_locale_decimal("amount_text").alias("amount"), "_orig").select(
        "o_orderkey", "amount_text", "amount", (F.col("amount") == F.col("_orig")).alias("roundtrip_ok"))


def latest_version(spark, d):
    return _orders_versioned(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus", "is_selected")


def version_ordinal_q(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                        _month("o_orderdate").alias("report_month"))
    v = version_ordinal(o, ["o_custkey", "report_month"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return v.select("o_orderkey", "o_custkey", "report_month", "period_version", "is_active")


def recent_attribute(spark, d):
    o = table(spark, d, "orders")
    latest = latest_by(o, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderpriority").desc()])
    return latest.select("o_custkey", F.col("o_orderpriority").alias("latest_priority"),
                         F.to_date("o_orderdate").alias("latest_order_date"))


def selected_rows_q(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                           money("l_extendedprice").alias("amount"))
    sel = _orders_versioned(spark, d).withColumnRenamed("o_orderkey", "l_orderkey")
    return selected_rows(li, sel, "l_orderkey", "is_selected")


def entity_period(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus",
                                        _month("o_orderdate").alias("report_month"))
    g = o.groupBy("report_month", "o_custkey").agg(
        F.max("o_orderpriority").alias("priority"),
        F.count(F.lit(1)).alias("order_count"),
        F.bool_and(F.col("o_orderstatus") == "F").alias("all_final"),
    )
    return g.select(surrogate_key("report_month", "o_custkey").alias("entity_period_key"), "*")


def account_dim(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    m = mapping_df(spark).select("p_type")
    out = with_membership(p, m, "p_type", "is_reporting_line_component")
    return out.select(
        surrogate_key("p_partkey").alias("account_key"), "p_partkey", "p_name", "p_type",
        F.substring("p_type", 1, 1).alias("account_class"),
        F.substring("p_type", 1, 2).alias("account_group"),
        "is_reporting_line_component",
    )


def line_balance_q(spark, d):
    return line_fact(spark, d)


def class_pivot(spark, d):
    """Conditional sums and counts per ship month in one aggregate."""
    li = table(spark, d, "lineitem").select(_month("l_shipdate").alias("report_month"), "l_returnflag",
                                           "l_linestatus", money("l_extendedprice").alias("amount"))
    flags = {"accepted_amount": "A", "none_amount": "N", "returned_amount": "R"}
    j = pivot_sums(li, "report_month", "l_returnflag", "amount", flags, extra=[
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.count(F.lit(1)).alias("line_count"),
        F.sum("amount").alias("total_amount")])
    parts = sum((F.coalesce(F.col(k), F.lit(0)) for k in flags), F.lit(0))
    return j.withColumn("identity_ok", F.abs(parts - F.col("total_amount")) <= F.lit(0.01))


def top15_freeze(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    f = _freeze(spark, d)
    return f.join(n, "c_nationkey").select(
        "freeze_rank", "c_nationkey", "n_name", "total_amount", "cutoff_gap")


def population_monthly(spark, d):
    members = _freeze(spark, d).select("c_nationkey", "freeze_rank")
    return _nation_month_totals(spark, d).join(members, "c_nationkey").select(
        "report_month", "c_nationkey", "freeze_rank", "total_amount")


def population_coverage(spark, d):
    monthly = _nation_month_totals(spark, d)
    members = _freeze(spark, d).select("c_nationkey")
    expected = monthly.select(F.count_distinct("report_month")).scalar()
    cov = coverage(monthly.join(members, "c_nationkey", "left_semi"), "c_nationkey", "report_month", expected)
    return cov.select("c_nationkey", "months_covered", "months_expected", "first_month", "last_month", "is_complete")


def period_profile(spark, d):
    """Per-month profile of orders (S4, A15, A16) in two aggregation levels.

    Six distinct counts in one aggregate would make Spark expand every input
    row seven-fold.  Instead: (month, customer) partials carry the row counts
    and per-status flags, so distinct customers become plain counts; the
    (month, status, priority) combinations (a bounded domain) give the
    distinct priorities and the status set.
    """
    o = table(spark, d, "orders").select(_month("o_orderdate").alias("report_month"), "o_custkey",
                                        "o_orderstatus", "o_orderpriority", money("o_totalprice").alias("amount"))
    st = F.col("o_orderstatus")
    per_cust = o.groupBy("report_month", "o_custkey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(blank_to_null("o_orderpriority").isNull()).alias("_blank"),
        F.sum("amount").alias("_amount"),
        *[F.bool_or(st == s).alias(f"_has_{s.lower()}") for s in ACCEPTED_STATUSES],
    )
    by_cust = per_cust.groupBy("report_month").agg(
        F.sum("_n").alias("order_count"),
        F.sum("_blank").alias("blank_priority_rows"),
        F.count(F.lit(1)).alias("customers"),
        *[F.count_if(f"_has_{s.lower()}").alias(f"customers_{s.lower()}") for s in ACCEPTED_STATUSES],
        F.sum("_amount").alias("summed_amount"),
    )
    codes = o.groupBy("report_month", "o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("_n"))
    by_code = codes.groupBy("report_month").agg(
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), "|").alias("statuses"),
    )
    return by_cust.join(by_code, "report_month").select(
        "report_month", "order_count", "blank_priority_rows", "customers", "priorities", "statuses",
        "customers_f", "customers_o", "customers_p", "summed_amount")


def series_profile(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate")
    return profile_series(o, "o_custkey", "o_orderdate", SERIES_START, SERIES_END, max_lag=SERIES_MAX_LAG)


def missing_periods(spark, d):
    o = table(spark, d, "orders").select("o_custkey", _month("o_orderdate").alias("report_month"))
    return missing_months(o, "o_custkey", "report_month")


def continuity(spark, d):
    o = table(spark, d, "orders").select("o_custkey", _month("o_orderdate").alias("report_month"))
    return continuity_breaks(o, "o_custkey", "report_month").select(
        "o_custkey", "report_month", "previous_month", "gap_months")


def balance_last(spark, d):
    return measures(spark, d).query(["total_assets", "credit_portfolio", "deposits", "equity"], by=["c_nationkey"])


def balance_total(spark, d):
    return measures(spark, d).query(["total_assets", "credit_portfolio", "deposits", "equity"])


def balance_by_month(spark, d):
    return measures(spark, d).query(["total_assets", "credit_portfolio", "deposits", "equity"],
                                    by=["report_month", "c_nationkey"])


def ratios(spark, d):
    return measures(spark, d).query(["credit_share", "deposit_funding_share", "equity_to_assets"], by=["c_nationkey"])


def population_share(spark, d):
    return measures(spark, d).query(["total_assets", "population_share"], by=["c_nationkey"])


def peer_median_q(spark, d):
    return measures(spark, d).query(["peer_median"], by=["report_month"])


def mom_growth(spark, d):
    return measures(spark, d).query(["total_assets", "mom_growth"], by=["report_month", "c_nationkey"])


def yoy_growth(spark, d):
    return measures(spark, d).query(["total_assets", "yoy_growth"], by=["report_month", "c_nationkey"])


def mix_table(spark, d):
    return measures(spark, d).query(
        ["total_assets", "mom_growth", "credit_share", "deposit_funding_share", "equity_to_assets"], by=["c_nationkey"])


def peer_table(spark, d):
    return measures(spark, d).query(
        ["total_assets", "population_share", "credit_share", "deposit_funding_share", "equity_to_assets"],
        by=["c_nationkey"])


# The context of the named tables (months, a member that ends early).
NAMED_MONTHS = ("1996-01-01", "2001-05-01")
ENDED_MEMBER, ENDED_AFTER = 3, "2000-11-01"


def _named_measures(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    ended = (F.col("c_nationkey") == ENDED_MEMBER) & (F.col("report_month") > F.lit(ENDED_AFTER).cast("date"))
    return MeasureModel(line_fact(spark, d).join(n, "c_nationkey").filter(~ended), month="report_month",
                        member="c_nationkey", line="reporting_line_code", amount="presentation_balance_amount",
                        date_dim=date_dim(spark, d), date_month="month_start", member_attributes=["n_name"])


def peer_table_named(spark, d):
    """Shares by member and its name over a month range; one member ends early."""
    return _named_measures(spark, d).query(["total_assets", "population_share", "credit_share"],
                                           by=["c_nationkey", "n_name"], months=NAMED_MONTHS)


def mix_table_named(spark, d):
    """R3 / M9 by member and its name: growth looks beyond the month range, not beyond the member's end."""
    return _named_measures(spark, d).query(["total_assets", "mom_growth", "equity_to_assets"],
                                           by=["c_nationkey", "n_name"], months=NAMED_MONTHS)


def growth_card(spark, d):
    """Cards without filters, both anchors (the date dimension ends later)."""
    m = measures(spark, d)
    fact = m.query(["total_assets", "mom_growth", "yoy_growth"])
    dd = m.query(["mom_growth", "yoy_growth"], anchor="date_dim").select(F.struct("mom_growth", "yoy_growth")).scalar()
    both = fact.withColumn("_dd", dd)
    return both.select(*fact.columns, F.col("_dd.mom_growth").alias("mom_growth_date_dim"),
                       F.col("_dd.yoy_growth").alias("yoy_growth_date_dim"))


def trust_table(spark, d):
    files = _orders_versioned(spark, d).filter("is_selected").select(period_text("o_orderdate").alias("source_period"))
    return trust_card(files, date_dim(spark, d))


def _expected_lines(spark, d):
    """Line sums from line items by a route of their own: part and customer first,
    an aggregate at (month, member, account), then the mapping's fan-out."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", money("l_extendedprice").alias("amount"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", _month("o_orderdate").alias("report_month"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    p = table(spark, d, "part").select("p_partkey", "p_type")
    m = mapping_df(spark)
    rows = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
            .join(o.join(c, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("report_month", "c_nationkey", "p_type").agg(F.sum("amount").alias("amount"))
            .join(m, "p_type"))
    return rows.groupBy("report_month", "c_nationkey", F.col("reporting_line_key").alias("reporting_line_code"),
                        "mapping_version").agg(
        F.sum(F.col("amount") * F.col("presentation_multiplier")).alias("amount"))


def reconcile_full(spark, d):
    exp = _expected_lines(spark, d)
    act = line_fact(spark, d).select("report_month", "c_nationkey", "reporting_line_code", "mapping_version",
                                     F.col("presentation_balance_amount").alias("amount"))
    return reconcile(exp, act, ["report_month", "c_nationkey", "reporting_line_code", "mapping_version"], "amount")


def symmetric_diff(spark, d):
    """X3 / Q10 summary: both difference directions and both row counts from
    one tagged aggregation (line keys are unique on each side)."""
    exp = _expected_lines(spark, d)
    act = line_fact(spark, d).select("report_month", "c_nationkey", "reporting_line_code", "mapping_version",
                                     F.col("presentation_balance_amount").alias("amount"))
    seen = set_compare(exp, act)
    e, a = F.col("in_expected"), F.col("in_actual")
    return seen.agg(
        F.count_if(e & ~a).alias("expected_only"),
        F.count_if(a & ~e).alias("actual_only"),
        F.count_if(e).alias("expected_rows"),
        F.count_if(a).alias("actual_rows"),
    )


def code_set_diff(spark, d):
    expected = values_frame(spark, [(s,) for s in EXPECTED_SEGMENTS], "c_mktsegment string")
    actual = table(spark, d, "customer").select("c_mktsegment").distinct()
    return set_diff(expected, actual)


def dup_grain(spark, d):
    """Q4: grain check in one grouped pass (rows, duplicated keys, their rows)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    per_key = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").alias("row_count"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


def null_scan_q(spark, d):
    o = null_scan(table(spark, d, "orders"), table="orders")
    li = null_scan(table(spark, d, "lineitem"), table="lineitem")
    return o.unionByName(li).select("table_name", "column_name", "null_count")


def accepted_values(spark, d):
    o = table(spark, d, "orders")
    return check_accepted_values(o, "o_orderstatus", ("F", "O"))


def row_count_match(spark, d):
    """Q5: declared (max line number) vs actual rows per order, one grouped pass."""
    li = table(spark, d, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("_declared"),
                                             F.count(F.lit(1)).alias("_actual"))
    return per_order.agg(F.count(F.lit(1)).alias("orders_checked"),
                         F.count_if(F.col("_declared") != F.col("_actual")).alias("mismatched_orders"))


def control_table(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    versions = _orders_versioned(spark, d)
    exp = _expected_lines(spark, d)
    act = line_fact(spark, d).select("report_month", "c_nationkey", "reporting_line_code", "mapping_version",
                                     F.col("presentation_balance_amount").alias("amount"))
    freeze = _freeze(spark, d)
    one_selected = versions.groupBy("o_custkey").agg(F.count_if("is_selected").alias("n")).filter("n > 1")
    controls = [
        failing_rows("lineitem_grain_unique", check_unique(li, ["l_orderkey", "l_linenumber"])),
        failing_rows("order_status_accepted", check_accepted_values(o, "o_orderstatus", ACCEPTED_STATUSES)),
        failing_rows("order_keys_not_null", o.filter(F.col("o_orderkey").isNull() | F.col("o_custkey").isNull())),
        failing_rows("at_most_one_selected_version", one_selected),
        failing_rows("line_balance_reconciles", set_diff(exp, act)),
        Control("population_size", freeze, F.count(F.lit(1)), POPULATION_SIZE),
        Control("cutoff_gap_positive", freeze, F.min("cutoff_gap"), 0, ">"),
    ]
    return build_controls(spark, controls)


def distinct_tuple(spark, d):
    """``count(distinct (a, b))`` (A5) next to a one-column distinct count.

    Grouping by the pair first leaves one row per pair to the distinct counts.
    """
    o = table(spark, d, "orders")
    pairs = o.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("_n"))
    return pairs.agg(
        distinct_tuples(pairs, ["o_custkey", "o_orderstatus"], "distinct_customer_status"),
        F.count_distinct("o_custkey").alias("distinct_customers"),
        F.sum("_n").alias("order_rows"),
    )


def metrics_row_q(spark, d):
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    f = line_fact(spark, d)
    rows = F.count(F.lit(1))
    return metrics_row(spark, {
        "lineitem_rows": (li, rows),
        "order_rows": (o, rows),
        "order_months": (o.select(_month("o_orderdate").alias("m")), F.count_distinct("m")),
        "line_fact_rows": (f, rows),
        "reporting_lines": (f, F.count_distinct("reporting_line_code")),
        "members": (f, F.count_distinct("c_nationkey")),
    })


def idempotent_upsert(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("amount"))
    changed = o.filter(F.col("o_orderstatus") == "O").withColumn("amount", (F.col("amount") + 1).cast("decimal(38,2)"))
    # the same keys once more with another value, and keys that are new
    again = changed.filter(F.col("o_orderkey") % 3 == 0).withColumn("amount", (F.col("amount") + 5).cast("decimal(38,2)"))
    new = o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderkey", -F.col("o_orderkey"))
    batch = changed.unionByName(again).unionByName(new)
    once = upsert_frames(o, batch, "o_orderkey")
    return upsert_frames(once, batch, "o_orderkey")


def probe_status(spark, d):
    e = table(spark, d, "events")
    code = F.lit(None).cast("int")
    for t, c in reversed(list(PROBE_STATUS.items())):
        code = F.when(F.col("event_type") == t, F.lit(c)).otherwise(code)
    log = e.select("event_id", code.alias("status_code"),
                   F.from_json("props", "k INT").getField("k").cast("string").alias("content_length"),
                   F.lit(None).cast("string").alias("content_range"),
                   F.when(F.col("event_type") == "error", F.lit("connection failed")).alias("request_error"))
    return classify_probes(log, "status_code", "content_range", "content_length", "request_error").select(
        "event_id", "status_code", "is_available", "size_bytes", "error")


def segment_yoy(spark, d):
    o = table(spark, d, "orders").select("o_custkey", _month("o_orderdate").alias("report_month"),
                                        money("o_totalprice").alias("amount"))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    monthly = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "report_month").agg(
        F.sum("amount").alias("amount"))
    return derive_series(monthly, "c_mktsegment", "report_month", "amount", "yoy_pct")


def _segment_rates(spark, d):
    """A monthly percentage per market segment, with months left out and zeros."""
    o = table(spark, d, "orders").select("o_custkey", _month("o_orderdate").alias("report_month"))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    monthly = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "report_month").agg(
        F.count(F.lit(1)).alias("_n"))
    return monthly.filter((F.col("c_mktsegment") != "BUILDING") | (F.month("report_month") != 5)).select(
        "c_mktsegment", "report_month", ((F.col("_n") % 5) * 0.5 - 0.5).alias("rate"))


def segment_rolling(spark, d):
    """Twelve monthly rates compounded; null over a gap."""
    return derive_series(_segment_rates(spark, d), "c_mktsegment", "report_month", "rate", "rolling_12m")


def segment_pp(spark, d):
    """Change against the previous month in percentage points."""
    return derive_series(_segment_rates(spark, d), "c_mktsegment", "report_month", "rate", "pp_change")


def segment_rate_yoy(spark, d):
    """Change against a year earlier in per cent; null where that was zero."""
    return derive_series(_segment_rates(spark, d), "c_mktsegment", "report_month", "rate", "yoy_pct")


def member_month_shares(spark, d):
    """A member's month with the month before, its share of the month and the best month of all."""
    nm = _nation_month_totals(spark, d)
    prior = prior_period(nm, "report_month", 1, ["c_nationkey"], "total_amount", "prior_amount")
    shared = share_of_selection(prior, "total_amount", ["report_month"], "month_share")
    return with_scalar(shared, nm.agg(F.max("total_amount").alias("best_amount")))


def month_medians(spark, d):
    """Median of the members' totals per month, over integer cents."""
    nm = _nation_month_totals(spark, d).select("report_month", (F.col("total_amount") * 100).cast("bigint").alias("cents"))
    return peer_median(nm, "cents", ["report_month"], "median_cents")


def repeated_order_days(spark, d):
    """Q2 / Q4: customers with more than one order on a day."""
    o = table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("order_date"))
    return check_unique(o, ["o_custkey", "order_date"])


def incomplete_orders(spark, d):
    """Q5: orders whose highest line number isn't their number of lines."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return check_row_count(li, "l_orderkey", "l_linenumber")


def assets_by_member(spark, d):
    """R2: total assets by member (closing balance), largest first."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return measures(spark, d).query(["total_assets"], by=["c_nationkey"]).join(n, "c_nationkey").orderBy(
        F.col("total_assets").desc_nulls_last(), "n_name").select("c_nationkey", "n_name", "total_assets")


def credit_share_by_month(spark, d):
    """Credit share by month × member."""
    return measures(spark, d).query(["credit_share"], by=["report_month", "c_nationkey"]).withColumn(
        "month_label", month_label("report_month"))


def member_slicer(spark, d):
    """The distinct members present in the line fact."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return line_fact(spark, d).select("c_nationkey").distinct().join(n, "c_nationkey").select("n_name").distinct()


def value_by_month(spark, d):
    """A stream's value by month label × series (event type)."""
    e = table(spark, d, "events").select(month_start("ts").alias("report_month"), F.col("event_type").alias("series_code"),
                                        money("value").alias("value"))
    ctx = e.withColumn("month_label", month_label("report_month"))
    return macro_value(ctx, "value", by=["report_month", "month_label", "series_code"])


def mapping_table(spark, d):
    """Mapping rows whose account occurs and whose line exists."""
    m = mapping_df(spark)
    accounts = table(spark, d, "part").select("p_type").distinct()
    return m.join(accounts, "p_type", "left_semi").select(
        surrogate_key("p_type", "reporting_line_key", "mapping_version").alias("account_reporting_line_key"),
        F.col("reporting_line_key").alias("reporting_line_code"), "p_type", "component_name",
        "presentation_multiplier", "mapping_version")


def account_balance_amount(spark, d):
    """Account balance amount (plain sum) by member × account."""
    return account_amount(member_account_month(spark, d), "amount", by=["c_nationkey", "p_type"])


# Asset components of the population total (alias → part type)
# and the component whose presence makes a member eligible.
POPULATION_COMPONENTS = {"standard": "STANDARD", "small": "SMALL", "medium": "MEDIUM", "large": "LARGE",
                         "promo": "PROMO"}
PRESENCE_COMPONENT = "standard"


def _population(spark, d):
    rows = member_account_month(spark, d)
    return profile_population(rows, "report_month", "c_nationkey", "p_type", "amount", POPULATION_COMPONENTS,
                              PRESENCE_COMPONENT, freeze_period=dt.date.fromisoformat(FREEZE_MONTH),
                              n=POPULATION_SIZE)


def population_profile(spark, d):
    """Per-month profile of the (month, member) state."""
    return _population(spark, d).period_profile


def population_members(spark, d):
    """Members frozen on their component totals at the freeze month."""
    return _population(spark, d).members.select("freeze_rank", "c_nationkey", "total_amount", "cutoff_gap")


def population_history(spark, d):
    """Months that each frozen member has, and has all components in."""
    return _population(spark, d).history


# Order states taken as documents (alias → state).
ORDER_DOCUMENTS = {"final": "F", "open": "O", "partial": "P"}


def order_scope(spark, d):
    """Customers per month by the order states that they have."""
    o = table(spark, d, "orders").select(month_start("o_orderdate").alias("report_month"), "o_custkey", "o_orderstatus")
    return document_scope(o, "report_month", "o_custkey", "o_orderstatus", ORDER_DOCUMENTS)


# A contract of two tables, as (column, type, required); the last column isn't there.
TABLE_CONTRACT = {
    "orders": [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "text", True),
               ("o_totalprice", "double precision", True), ("o_orderdate", "timestamp with time zone", False)],
    "documents": [("doc_id", "bigint", True), ("text", "text", True), ("lang", "text", True), ("source", "text", False),
                  ("n_chars", "integer", True), ("checked", "boolean", True)],
}


def table_contract(spark, d):
    """Q13 / Q19: evidence of a live contract, with a column too many, one of another type and one that is missing."""
    return live_contract(spark, {name: table(spark, d, name) for name in TABLE_CONTRACT}, TABLE_CONTRACT)


def population_control_set(spark, d):
    """Q15 / Q20: the population control set on the frozen nation population."""
    rows = member_account_month(spark, d)
    pop = _population(spark, d)
    return population_controls(spark, rows, pop, "report_month", "c_nationkey", "p_type", None, None,
                               dt.date.fromisoformat(FREEZE_MONTH), POPULATION_SIZE, list(POPULATION_COMPONENTS))


RECIPES = {
    "staging_orders": staging_orders,
    "month_calendar": month_calendar,
    "surrogate_keys": surrogate_keys,
    "url_fields": url_fields,
    "event_json": event_json,
    "locale_decimal": locale_decimal,
    "latest_version": latest_version,
    "version_ordinal": version_ordinal_q,
    "recent_attribute": recent_attribute,
    "selected_rows": selected_rows_q,
    "entity_period": entity_period,
    "account_dim": account_dim,
    "line_balance": line_balance_q,
    "class_pivot": class_pivot,
    "top15_freeze": top15_freeze,
    "population_monthly": population_monthly,
    "population_coverage": population_coverage,
    "period_profile": period_profile,
    "series_profile": series_profile,
    "missing_periods": missing_periods,
    "continuity": continuity,
    "balance_last": balance_last,
    "balance_total": balance_total,
    "balance_by_month": balance_by_month,
    "ratios": ratios,
    "population_share": population_share,
    "peer_median": peer_median_q,
    "mom_growth": mom_growth,
    "yoy_growth": yoy_growth,
    "mix_table": mix_table,
    "peer_table": peer_table,
    "peer_table_named": peer_table_named,
    "mix_table_named": mix_table_named,
    "growth_card": growth_card,
    "trust_table": trust_table,
    "reconcile_full": reconcile_full,
    "symmetric_diff": symmetric_diff,
    "code_set_diff": code_set_diff,
    "dup_grain": dup_grain,
    "null_scan": null_scan_q,
    "accepted_values": accepted_values,
    "row_count_match": row_count_match,
    "control_table": control_table,
    "distinct_tuple": distinct_tuple,
    "metrics_row": metrics_row_q,
    "idempotent_upsert": idempotent_upsert,
    "probe_status": probe_status,
    "segment_yoy": segment_yoy,
    "segment_rolling": segment_rolling,
    "segment_pp": segment_pp,
    "segment_rate_yoy": segment_rate_yoy,
    "member_month_shares": member_month_shares,
    "month_medians": month_medians,
    "repeated_order_days": repeated_order_days,
    "incomplete_orders": incomplete_orders,
    "assets_by_member": assets_by_member,
    "credit_share_by_month": credit_share_by_month,
    "member_slicer": member_slicer,
    "value_by_month": value_by_month,
    "mapping_table": mapping_table,
    "account_balance_amount": account_balance_amount,
    "population_profile": population_profile,
    "population_members": population_members,
    "population_control_set": population_control_set,
    "population_history": population_history,
    "order_scope": order_scope,
    "table_contract": table_contract,
}
