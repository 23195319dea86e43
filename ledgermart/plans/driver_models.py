"""The core models and marts (D1–D19) built from the driver's tables.

The tables are projected into the raw landing schemas and ``build_marts`` does
the rest, so every registered query runs the library's own models:

* a file        = the orders of one month with one status (``F`` is the active
  version, ``P`` an incomplete one);
* balance rows  = line items, by order's file, customer's nation (institution)
  and part type (account);
* a series      = the events of one type, one observation per month;
* nations from ``FIRST_FIXTURE`` on are marked as synthetic.

``account_balance`` (D2) is the one big relation that many models read; it is
a table written once (``session_mart``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions import money, month_start
from ledgermart.functions._util import values_frame
from ledgermart.plans import models
from ledgermart.plans.driver_tables import FREEZE_MONTH, MAPPING_ROWS, MAPPING_VERSION, POPULATION_SIZE, session_mart, table
from ledgermart.operators.population import top_members
from ledgermart.operators.relationships import MART_RELATIONSHIPS, Measure, Relationships

# Account codes of the part types and the first synthetic nation.
ACCOUNT_CODES = {"STANDARD": "1000000009", "SMALL": "2000000008", "MEDIUM": "3000000007", "LARGE": "4000000006",
                 "PROMO": "5000000005", "ECONOMY": "6000000004"}
FIRST_FIXTURE = 20


def _files(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their file: period, checksum, generation date and retrieval time."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", month_start("o_orderdate").alias("_m"))
    period = F.date_format("_m", "yyyyMM")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", period.alias("source_period"),
        F.concat(period, F.lit("-"), F.col("o_orderstatus")).alias("source_checksum"),
        F.date_add("_m", 40).alias("source_generated_at"),
        F.date_add("_m", 41).cast("timestamp").alias("retrieved_at_utc"))


def file_manifest(spark: SparkSession, d: str) -> DataFrame:
    f = _files(spark, d).groupBy("source_period", "source_checksum", "o_orderstatus", "source_generated_at", "retrieved_at_utc").agg(
        F.count(F.lit(1)).alias("row_count"))
    return f.select(
        "source_period", F.concat(F.lit("driver://orders/"), F.col("source_checksum")).alias("source_url"),
        "source_checksum", "source_generated_at", "retrieved_at_utc",
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("complete").alias("status"),
        (F.col("o_orderstatus") == "F").alias("is_active"), "row_count", F.lit(False).alias("fixture"))


def balance_rows(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag",
                                            money("l_extendedprice").alias("saldo"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    p = table(spark, d, "part").select("p_partkey", "p_type")
    rows = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
            .join(_files(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    code = F.col("p_type")
    for name, account in ACCOUNT_CODES.items():
        code = F.when(F.col("p_type") == name, F.lit(account)).otherwise(code)
    prefix = F.when(F.col("c_nationkey") >= FIRST_FIXTURE, "fixture://").otherwise("driver://")
    nothing = F.lit(None).cast("string")
    return rows.select(
        "source_period", F.when(F.col("l_returnflag") == "R", "4016").otherwise("4010").alias("documento"),
        F.lpad(F.col("c_nationkey").cast("string"), 8, "0").alias("cnpj"), nothing.alias("agencia"),
        F.col("n_name").alias("nome_instituicao"), nothing.alias("cod_congl"), nothing.alias("nome_congl"),
        F.lit("b1").alias("taxonomia"), code.alias("conta"), F.lower("p_type").alias("nome_conta"),
        F.col("saldo").cast("string").alias("saldo_raw"), "saldo",
        F.concat(prefix, F.col("source_checksum")).alias("source_url"), "source_checksum", "source_generated_at",
        "retrieved_at_utc", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("file_row_number"))


def series_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The registry: a monthly series for each type of event that occurs."""
    code = F.col("series_code")
    about = F.concat(F.lit("https://series.invalid/"), code)
    text = {"theme": F.lit("events"), "display_name": F.initcap(code), "official_title": F.concat(F.lit("Events of type "), code),
            "unit": F.lit("value"), "frequency": F.lit("monthly"), "source_start_date": F.lit(None).cast("date"),
            "observation_semantics": F.lit("sum"), "monthly_alignment": F.lit("calendar month"), "derived_metric": F.lit("Latest level"),
            "max_expected_lag_months": F.lit(1).cast("bigint"), "revision_policy": F.lit("none"), "source_url": about,
            "metadata_url": F.concat(about, F.lit("/about"))}
    codes = table(spark, d, "events").select(F.col("event_type").alias("series_code")).distinct()
    return codes.select("series_code", *[c.alias(n) for n, c in text.items()])


def observations(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy("event_type", month_start("ts").alias("_m")).agg(F.sum(money("value")).alias("_v"))
    return e.select(
        F.col("event_type").alias("series_code"), F.col("_m").alias("source_observation_date"),
        F.date_format("_m", "yyyyMM").alias("report_month"), F.col("_v").cast("string").alias("value_raw"),
        F.col("_v").alias("value"), F.date_add("_m", 41).cast("timestamp").alias("retrieved_at_utc"),
        F.concat(F.lit("driver://events/"), F.col("event_type")).alias("source_url"), F.lit(False).alias("fixture"))


def mapping_seed(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the part types that occur."""
    rows = [(k, name, order, account, ACCOUNT_CODES[account], part, sign, MAPPING_VERSION, "certified", "driver://mapping")
            for k, name, order, account, part, sign in MAPPING_ROWS]
    known = values_frame(spark, rows, "reporting_line_key string, reporting_line_name string, display_order int, p_type string, "
                         "account_code string, component_name string, presentation_multiplier int, "
                         "mapping_version string, status string, source_url string")
    return known.join(table(spark, d, "part").select("p_type").distinct(), "p_type", "left_semi").drop("p_type")


def population_seed(spark: SparkSession, d: str) -> DataFrame:
    """The top members by order totals of the freeze month."""
    period = FREEZE_MONTH[:7].replace("-", "")
    o = table(spark, d, "orders").filter(F.date_format("o_orderdate", "yyyyMM") == period).select(
        "o_custkey", money("o_totalprice").alias("amount"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    totals = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("amount").alias("amount"))
    top = top_members(totals, "c_nationkey", "amount", POPULATION_SIZE).join(n, "c_nationkey")
    return top.select(F.lit(period).alias("freeze_period"), F.col("freeze_rank").cast("int").alias("freeze_rank"),
                      F.lpad(F.col("c_nationkey").cast("string"), 8, "0").alias("institution_cnpj"),
                      F.col("n_name").alias("institution_name"), F.lit("b1").alias("taxonomy"))


def driver_marts(spark: SparkSession, d: str) -> models.Marts:
    later = lambda make: lambda: make(spark, d)
    return models.build_marts(
        spark, later(balance_rows), later(file_manifest), later(series_metadata), later(observations),
        later(mapping_seed), later(population_seed),
        landed=lambda df: session_mart(spark, d, "account_balance", lambda: df))


# Columns of each registered model (what the oracle compares).
COLUMNS = {
    "cosif_file_manifest": "source_period source_checksum status source_is_active declared_row_count is_selected",
    "account_balance": "source_checksum file_row_number report_month document_code institution_cnpj account_code balance_amount declared_row_count is_fixture",
    "bank_period": "bank_period_key report_month institution_cnpj institution_name taxonomy account_row_count is_fixture",
    "cosif_account": "account_code account_name taxonomy",
    "macro_series": "series_code display_name derived_metric max_expected_lag_months",
    "macro_observation": "series_code source_observation_date report_month value",
    "reporting_line_mapping": "reporting_line_key account_code presentation_multiplier mapping_version status",
    "dim_bank": "bank_key institution_cnpj institution_name freeze_month freeze_rank first_report_month last_report_month is_fixture",
    "dim_cosif_account": "account_key account_code account_class account_group is_reporting_line_component",
    "dim_reporting_line": "reporting_line_key reporting_line_code reporting_line_name display_order mapping_version",
    "dim_document": "document_code analytical_allowed source_frequency",
    "dim_macro_series": "macro_series_key series_code display_name",
    "dim_date": "month_key month_start calendar_year calendar_month",
    "dim_source_file": "source_file_key source_period source_checksum declared_row_count",
    "bridge_account_reporting_line": "account_reporting_line_key account_key reporting_line_key account_code presentation_multiplier",
    "fact_account_balance": "account_balance_key bank_key month_key account_key source_file_key account_code balance_amount",
    "fact_reporting_line_balance": "reporting_line_balance_key bank_key month_key reporting_line_key source_file_key presentation_balance_amount reported_balance_amount contributing_account_count contributing_account_codes",
    "fact_macro_observation": "macro_observation_key macro_series_key month_key value",
    "fact_monthly_economic_context": "monthly_context_key macro_series_key month_key display_name value",
}


def _recipe(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        marts = driver_marts(spark, d)
        found = marts[name]
        if name == "dim_document":  # those that the balances have
            found = found.join(marts["account_balance"].select("document_code").distinct(), "document_code", "left_semi")
        return found.select(*COLUMNS[name].split())

    run.__name__ = f"model_{name}"
    run.__doc__ = f"The model ``{name}`` built from the driver's tables."
    return run


RECIPES = {f"model_{name}": _recipe(name) for name in COLUMNS}


# -- relationships (J13) -------------------------------------------------------
def _graph(spark: SparkSession, d: str) -> Relationships:
    return Relationships(driver_marts(spark, d), MART_RELATIONSHIPS)


def relationship_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line balances by columns of three dimensions, filtered on a fourth."""
    balance = "fact_reporting_line_balance"
    return _graph(spark, d).query(
        {"presentation": Measure(balance, "sum", "presentation_balance_amount"), "balances": Measure(balance, "count", "presentation_balance_amount"),
         "smallest": Measure(balance, "min", "reported_balance_amount"), "files": Measure(balance, "count_distinct", "source_file_key")},
        by=["dim_bank.institution_name", "dim_date.calendar_year", "dim_reporting_line.reporting_line_name"],
        where={"dim_source_file": F.col("declared_row_count") > 1})


def relationship_facts(spark: SparkSession, d: str) -> DataFrame:
    """Two facts by shared dimensions; the filter on accounts reaches the one that leads there."""
    return _graph(spark, d).query(
        {"account_balance": Measure("fact_account_balance", "sum", "balance_amount"), "accounts": Measure("fact_account_balance", "count_distinct", "account_code"),
         "line_balance": Measure("fact_reporting_line_balance", "sum", "presentation_balance_amount")},
        by=["dim_date.calendar_year", "dim_bank.institution_name"],
        where={"dim_cosif_account": F.col("account_class").isin("1", "2"), "dim_document": F.col("analytical_allowed")})


def relationship_context(spark: SparkSession, d: str) -> DataFrame:
    """Series by year, and the bridge by line and account class."""
    graph = _graph(spark, d)
    series = graph.query({"value": Measure("fact_monthly_economic_context", "sum", "value"), "largest": Measure("fact_monthly_economic_context", "max", "value")},
                         by=["dim_macro_series.display_name", "dim_date.calendar_year"])
    bridge = graph.query({"links": Measure("bridge_account_reporting_line", "count", "account_key"), "sign": Measure("bridge_account_reporting_line", "sum", "presentation_multiplier")},
                         by=["dim_reporting_line.reporting_line_name", "dim_cosif_account.account_class"])
    return series.select(F.lit("context").alias("part"), F.col("display_name").alias("label"), F.col("calendar_year").cast("string").alias("detail"), F.col("value").cast("decimal(38,10)").alias("total"), F.col("largest").cast("decimal(38,10)").alias("other")).unionByName(
        bridge.select(F.lit("bridge").alias("part"), F.col("reporting_line_name").alias("label"), F.col("account_class").alias("detail"), F.col("links").cast("decimal(38,10)").alias("total"), F.col("sign").cast("decimal(38,10)").alias("other")))


def relationship_controls(spark: SparkSession, d: str) -> DataFrame:
    """Orphans and repeated keys of all thirteen relationships."""
    return _graph(spark, d).controls()


RECIPES |= {q.__name__: q for q in (relationship_lines, relationship_facts, relationship_context, relationship_controls)}


# -- oracle ------------------------------------------------------------------
def _values(rows) -> str:
    text = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows) + ")"


#: The files (orders by month and status) and the accounts of part types, for oracle SQL.
ORACLE_FILES = f"""files AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y%m') AS source_period,
         strftime(o_orderdate, '%Y%m') || '-' || o_orderstatus AS source_checksum,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month
  FROM orders),
accounts(p_type, account_code) AS {_values(ACCOUNT_CODES.items())}"""

_BASE = f"""WITH {ORACLE_FILES},
manifest AS (
  SELECT source_period, source_checksum, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'complete' END AS status,
         o_orderstatus = 'F' AS source_is_active, COUNT(*) AS declared_row_count
  FROM files GROUP BY ALL),
chosen AS (
  SELECT *, status = 'complete' AND row_number() OVER (
    PARTITION BY source_period ORDER BY status = 'complete' DESC, source_is_active DESC, source_checksum DESC) = 1 AS is_selected
  FROM manifest),
ab AS (
  SELECT f.source_checksum, l.l_orderkey * 10 + l.l_linenumber AS file_row_number, f.report_month,
         CASE WHEN l.l_returnflag = 'R' THEN '4016' ELSE '4010' END AS document_code,
         lpad(CAST(c.c_nationkey AS VARCHAR), 8, '0') AS institution_cnpj, n.n_name AS institution_name, 'b1' AS taxonomy,
         a.account_code, lower(p.p_type) AS account_name, CAST(l.l_extendedprice AS DECIMAL(38,2)) AS balance_amount,
         m.declared_row_count, c.c_nationkey >= {FIRST_FIXTURE} AS is_fixture
  FROM lineitem l JOIN files f ON l.l_orderkey = f.o_orderkey JOIN customer c ON f.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey JOIN accounts a ON a.p_type = p.p_type
  JOIN chosen m ON m.source_checksum = f.source_checksum AND m.is_selected),
bp AS (
  SELECT report_month, institution_cnpj, MAX(institution_name) AS institution_name, MAX(taxonomy) AS taxonomy,
         COUNT(*) AS account_row_count, bool_and(is_fixture) AS is_fixture
  FROM ab GROUP BY 1, 2),
lines(reporting_line_key, reporting_line_name, display_order, p_type, component_name, presentation_multiplier) AS
  {_values([(k, name, order, account, part, sign) for k, name, order, account, part, sign in MAPPING_ROWS])},
mapping AS (SELECT lines.*, account_code FROM lines JOIN accounts USING (p_type) WHERE p_type IN (SELECT p_type FROM part)),
series AS (SELECT DISTINCT event_type AS series_code FROM events),
mo AS (
  SELECT event_type AS series_code, CAST(date_trunc('month', ts) AS DATE) AS report_month,
         CAST(SUM(CAST(value AS DECIMAL(38,2))) AS DECIMAL(38,10)) AS value
  FROM events WHERE event_type IN (SELECT series_code FROM series) GROUP BY 1, 2),
seed AS (
  SELECT * FROM (
    SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 8, '0') AS institution_cnpj, n.n_name AS institution_name,
           row_number() OVER (ORDER BY SUM(CAST(o.o_totalprice AS DECIMAL(38,2))) DESC, c.c_nationkey) AS freeze_rank
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE date_trunc('month', o.o_orderdate) = DATE '{FREEZE_MONTH}' GROUP BY c.c_nationkey, n.n_name)
  WHERE freeze_rank <= {POPULATION_SIZE}),
fm AS (SELECT MAX(report_month) AS m FROM bp WHERE is_fixture),
ranked AS (
  SELECT institution_cnpj, row_number() OVER (ORDER BY SUM(balance_amount) DESC, institution_cnpj) AS freeze_rank
  FROM ab WHERE is_fixture AND report_month = (SELECT m FROM fm) AND document_code = '4010'
    AND account_code IN {tuple(models.ASSET_ACCOUNTS)} GROUP BY institution_cnpj),
dim_bank AS (
  SELECT s.institution_cnpj, s.institution_name, DATE '{FREEZE_MONTH}' AS freeze_month, s.freeze_rank,
         MIN(bp.report_month) AS first_report_month, MAX(bp.report_month) AS last_report_month, FALSE AS is_fixture
  FROM seed s JOIN bp ON bp.institution_cnpj = s.institution_cnpj AND NOT bp.is_fixture
  GROUP BY s.institution_cnpj, s.institution_name, s.freeze_rank
  UNION ALL
  SELECT bp.institution_cnpj, MAX(bp.institution_name), MAX(bp.report_month), r.freeze_rank, MIN(bp.report_month),
         MAX(bp.report_month), TRUE
  FROM bp JOIN ranked r ON r.institution_cnpj = bp.institution_cnpj WHERE bp.is_fixture GROUP BY bp.institution_cnpj, r.freeze_rank),
dim_date AS (
  SELECT DISTINCT m AS month_start FROM (
    SELECT report_month AS m FROM bp WHERE institution_cnpj IN (SELECT institution_cnpj FROM dim_bank)
    UNION ALL SELECT report_month FROM mo)),
lb AS (
  SELECT ab.report_month, ab.institution_cnpj, ab.document_code, ab.source_checksum, ab.is_fixture, m.reporting_line_key,
         SUM(balance_amount) AS reported, SUM(balance_amount * m.presentation_multiplier) AS presentation,
         CAST(COUNT(DISTINCT ab.account_code) AS INTEGER) AS n_accounts,
         array_to_string(list_sort(list(DISTINCT ab.account_code)), '|') AS codes
  FROM ab JOIN mapping m ON m.account_code = ab.account_code WHERE ab.document_code = '4010' GROUP BY 1, 2, 3, 4, 5, 6)"""

_KEY = "CAST(strftime({0}, '%Y%m') AS INTEGER) AS month_key"

SQL = {
    "cosif_file_manifest": "SELECT * FROM chosen",
    "account_balance": "SELECT source_checksum, file_row_number, report_month, document_code, institution_cnpj, account_code, "
                       "balance_amount, declared_row_count, is_fixture FROM ab",
    "bank_period": "SELECT md5(CAST(report_month AS VARCHAR) || '|' || institution_cnpj) AS bank_period_key, * FROM bp",
    "cosif_account": "SELECT DISTINCT account_code, account_name, taxonomy FROM ab",
    "macro_series": "SELECT series_code, upper(series_code[1]) || series_code[2:] AS display_name, 'Latest level' AS derived_metric, "
                    "CAST(1 AS BIGINT) AS max_expected_lag_months FROM series",
    "macro_observation": "SELECT series_code, report_month AS source_observation_date, report_month, value FROM mo",
    "reporting_line_mapping": f"SELECT reporting_line_key, account_code, presentation_multiplier, '{MAPPING_VERSION}' AS mapping_version, "
                              "'certified' AS status FROM mapping",
    "dim_bank": "SELECT md5(institution_cnpj) AS bank_key, institution_cnpj, institution_name, freeze_month, "
                "CAST(freeze_rank AS INTEGER) AS freeze_rank, first_report_month, last_report_month, is_fixture FROM dim_bank",
    "dim_cosif_account": "SELECT DISTINCT md5(account_code) AS account_key, account_code, account_code[1:1] AS account_class, "
                         "account_code[1:2] AS account_group, account_code IN (SELECT account_code FROM mapping) AS is_reporting_line_component FROM ab",
    "dim_reporting_line": "SELECT DISTINCT md5(reporting_line_key) AS reporting_line_key, reporting_line_key AS reporting_line_code, "
                          f"reporting_line_name, display_order, '{MAPPING_VERSION}' AS mapping_version FROM mapping",
    "dim_document": "SELECT * FROM (VALUES ('4010', TRUE, 'monthly'), ('4016', FALSE, 'semiannual')) "
                    "t(document_code, analytical_allowed, source_frequency) WHERE document_code IN (SELECT document_code FROM ab)",
    "dim_macro_series": "SELECT md5(series_code) AS macro_series_key, series_code, upper(series_code[1]) || series_code[2:] AS display_name FROM series",
    "dim_date": f"SELECT {_KEY.format('month_start')}, month_start, CAST(year(month_start) AS INTEGER) AS calendar_year, "
                "CAST(month(month_start) AS INTEGER) AS calendar_month FROM dim_date",
    "dim_source_file": "SELECT md5(source_checksum) AS source_file_key, source_period, source_checksum, declared_row_count FROM chosen WHERE is_selected",
    "bridge_account_reporting_line": f"SELECT md5(account_code || '|' || reporting_line_key || '|{MAPPING_VERSION}') AS account_reporting_line_key, "
        "md5(account_code) AS account_key, md5(reporting_line_key) AS reporting_line_key, account_code, presentation_multiplier "
        "FROM mapping WHERE account_code IN (SELECT account_code FROM ab)",
    "fact_account_balance": "SELECT md5(source_checksum || '|' || CAST(file_row_number AS VARCHAR)) AS account_balance_key, "
        f"md5(ab.institution_cnpj) AS bank_key, {_KEY.format('report_month')}, md5(account_code) AS account_key, "
        "md5(source_checksum) AS source_file_key, account_code, balance_amount FROM ab JOIN dim_bank b "
        "ON b.institution_cnpj = ab.institution_cnpj AND b.is_fixture = ab.is_fixture WHERE document_code = '4010'",
    "fact_reporting_line_balance": "SELECT md5(CAST(report_month AS VARCHAR) || '|' || lb.institution_cnpj || '|' || document_code || '|' || "
        f"reporting_line_key || '|{MAPPING_VERSION}') AS reporting_line_balance_key, md5(lb.institution_cnpj) AS bank_key, "
        f"{_KEY.format('report_month')}, md5(reporting_line_key) AS reporting_line_key, md5(source_checksum) AS source_file_key, "
        "presentation AS presentation_balance_amount, reported AS reported_balance_amount, n_accounts AS contributing_account_count, "
        "codes AS contributing_account_codes FROM lb JOIN dim_bank b ON b.institution_cnpj = lb.institution_cnpj AND b.is_fixture = lb.is_fixture",
    "fact_macro_observation": "SELECT md5(series_code || '|' || CAST(report_month AS VARCHAR)) AS macro_observation_key, "
        f"md5(series_code) AS macro_series_key, {_KEY.format('report_month')}, value FROM mo",
    "fact_monthly_economic_context": "SELECT md5(CAST(report_month AS VARCHAR) || '|' || series_code) AS monthly_context_key, "
        f"md5(series_code) AS macro_series_key, {_KEY.format('report_month')}, upper(series_code[1]) || series_code[2:] AS display_name, value FROM mo",
}
ORACLE = {f"model_{name}": f"{_BASE}\nSELECT {', '.join(COLUMNS[name].split())} FROM ({sql})" for name, sql in SQL.items()}


def _model(name: str) -> str:
    """The model as a relation; the month key and the document of the account fact are there as well."""
    if name == "fact_account_balance":
        return f"(SELECT *, '4010' AS document_code FROM ({SQL[name]}))"
    return f"({SQL[name]})"


ORACLE |= {
    "relationship_lines": f"""{_BASE}
SELECT b.institution_name, dd.calendar_year, r.reporting_line_name, SUM(f.presentation_balance_amount) AS presentation, COUNT(*) AS balances,
       MIN(f.reported_balance_amount) AS smallest, COUNT(DISTINCT f.source_file_key) AS files
FROM {_model("fact_reporting_line_balance")} f JOIN {_model("dim_source_file")} s ON s.source_file_key = f.source_file_key AND s.declared_row_count > 1
LEFT JOIN {_model("dim_bank")} b ON b.bank_key = f.bank_key LEFT JOIN {_model("dim_date")} dd ON dd.month_key = f.month_key
LEFT JOIN {_model("dim_reporting_line")} r ON r.reporting_line_key = f.reporting_line_key GROUP BY 1, 2, 3""",
    "relationship_facts": f"""{_BASE},
x AS (
  SELECT dd.calendar_year, b.institution_name, SUM(f.balance_amount) AS account_balance, COUNT(DISTINCT f.account_code) AS accounts
  FROM {_model("fact_account_balance")} f JOIN {_model("dim_cosif_account")} a ON a.account_key = f.account_key AND a.account_class IN ('1', '2')
  JOIN {_model("dim_document")} o ON o.document_code = f.document_code AND o.analytical_allowed
  LEFT JOIN {_model("dim_date")} dd ON dd.month_key = f.month_key LEFT JOIN {_model("dim_bank")} b ON b.bank_key = f.bank_key GROUP BY 1, 2),
y AS (
  SELECT dd.calendar_year, b.institution_name, SUM(f.presentation_balance_amount) AS line_balance
  FROM {_model("fact_reporting_line_balance")} f LEFT JOIN {_model("dim_date")} dd ON dd.month_key = f.month_key
  LEFT JOIN {_model("dim_bank")} b ON b.bank_key = f.bank_key GROUP BY 1, 2)
SELECT calendar_year, institution_name, account_balance, accounts, line_balance FROM x FULL JOIN y USING (calendar_year, institution_name)""",
    "relationship_context": f"""{_BASE}
SELECT 'context' AS part, display_name AS label, CAST(month_key // 100 AS VARCHAR) AS detail, CAST(SUM(value) AS DECIMAL(38,10)) AS total, CAST(MAX(value) AS DECIMAL(38,10)) AS other
FROM {_model("fact_monthly_economic_context")} GROUP BY 1, 2, 3
UNION ALL
SELECT 'bridge', r.reporting_line_name, a.account_class, CAST(COUNT(*) AS DECIMAL(38,10)), CAST(SUM(g.presentation_multiplier) AS DECIMAL(38,10))
FROM {_model("bridge_account_reporting_line")} g JOIN {_model("dim_cosif_account")} a ON a.account_key = g.account_key
JOIN {_model("dim_reporting_line")} r ON r.reporting_line_key = g.reporting_line_key GROUP BY 1, 2, 3""",
    "relationship_controls": _BASE + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{r.name}' AS relationship, TRUE AS active, (SELECT COUNT(*) FROM {_model(r.many)}) AS many_rows, "
        f"(SELECT COUNT(*) FROM {_model(r.many)} WHERE {r.many_col} NOT IN (SELECT {r.one_col} FROM {_model(r.one)})) AS orphan_rows, "
        f"(SELECT COUNT(*) FROM (SELECT {r.one_col} FROM {_model(r.one)} GROUP BY 1 HAVING COUNT(*) > 1)) AS repeated_keys, "
        f"(SELECT COUNT(*) FROM {_model(r.many)} WHERE {r.many_col} NOT IN (SELECT {r.one_col} FROM {_model(r.one)})) = 0 "
        f"AND (SELECT COUNT(*) FROM (SELECT {r.one_col} FROM {_model(r.one)} GROUP BY 1 HAVING COUNT(*) > 1)) = 0 AS passed" for r in MART_RELATIONSHIPS),
}
