"""File formats, versioned landing and period rebuild over the driver's tables.

Each query lays the tables down as the files or batches that the operator is
for (below the shared checkpoint folder), runs the operator over all of them
and returns its whole result:

* archives: the orders of one month with one status are one zip of balance rows;
* catalogs: one JSON file a year that lists these archives, and an item that is none;
* series: one JSON file an event type, with its monthly totals;
* merges: all orders, then changed and new ones, then that batch once more;
* rebuild: all archives but the final ones of ``LATE_YEAR``, then those;
* certification: the merged orders before and after a replay, and tables with values swapped or rows lost;
* decision: the source decision over the evidence of ``LATE_YEAR``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions import money, month_start
from ledgermart.operators.quality import build_controls, duplicate_text, failing_rows, replay_compare
from ledgermart.plans import driver_models
from ledgermart.plans.controls import source_decision_controls
from ledgermart.plans.driver_tables import input_version, table
from ledgermart.session import scratch_path
from ledgermart.sources import formats
from ledgermart.sources.archives import land_raw, landing_rows, profile_files
from ledgermart.sources.landing import table_exists
from ledgermart.sources.versions import history, merge
from ledgermart.streaming.rebuild import core_table, rebuild

# The header of a balance file and the year whose final files come late.
HEADER = "#Balancetes\r\n#Gerado em 10/02/2025\r\n#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;NOME_CONTA;SALDO"
LATE_YEAR = "1997"


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"driver-files/{spark.sparkContext.applicationId}/{name}")


def archive_folder(spark: SparkSession, d: str) -> tuple[str, str]:
    """The zips of the driver's balance rows and their manifest, written once per application and input."""
    path = _folder(spark, f"archives-{input_version(spark, d)}")
    if not table_exists(spark, f"{path}/manifest/_SUCCESS"):
        rows = driver_models.balance_rows(spark, d)
        number = F.replace(F.col("saldo").cast("string"), F.lit("."), F.lit(","))
        fields = ["source_period", "documento", "cnpj", "nome_instituicao", "conta", "nome_conta", number]
        name = F.concat(F.col("source_period"), F.lit("BANCOS-"), F.substring_index("source_checksum", "-", -1), F.lit(".zip"))
        formats.write_archives(rows, f"{path}/files", name, fields, ["file_row_number", "conta", "documento", "saldo"], HEADER, mode="overwrite")
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(f"{path}/files").select(
            F.col("path").alias("archive_path"), F.sha2("content", 256).alias("sha256"),
            F.regexp_extract("path", r"(\d{6})BANCOS", 1).alias("period"))
        found.write.mode("overwrite").json(f"{path}/manifest")
    return f"{path}/files", f"{path}/manifest"


def archive_scan(spark: SparkSession, d: str) -> DataFrame:
    """Zips → raw records, checksums against the manifest → typed landing rows."""
    files, manifest = archive_folder(spark, d)
    raw = land_raw(formats.scan_archives(spark, files, manifest).drop("period"))
    listed = spark.read.schema("archive_path string, sha256 string, period string").json(manifest)
    records = listed.select(F.col("sha256").alias("source_checksum"), "period", F.element_at(F.split("archive_path", "/"), -1).alias("source_url"),
                            F.lit("2025-03-01 00:00:00").alias("retrieved_at_utc"))
    rows = landing_rows(raw, records)
    return rows.select("source_period", "documento", "cnpj", "nome_instituicao", "conta", "nome_conta", "saldo", "source_url", "source_generated_at", "file_row_number")


def archive_profile(spark: SparkSession, d: str) -> DataFrame:
    """S4 over the archive format: the profile of each zip of one year; a filter on the period leaves other zips unread."""
    files, manifest = archive_folder(spark, d)
    raw = formats.scan_archives(spark, files, manifest).filter(F.col("period").startswith(LATE_YEAR))
    prof = profile_files(raw.drop("period"))
    return prof.select(F.element_at(F.split("source_path", "/"), -1).alias("archive"), "encoding", "header_line_number", "row_count", "malformed_row_count",
                       "document_count", "institution_count", "account_count", "declared_periods", "source_generated_at")


def catalog_scan(spark: SparkSession, d: str) -> DataFrame:
    """Yearly catalogs of the archives → items with versions per period; other items keep an error."""
    path = _folder(spark, f"catalogs-{uuid.uuid4().hex}")
    files = driver_models.file_manifest(spark, d)
    status = F.substring_index("source_checksum", "-", -1)
    items = files.select(
        F.concat(F.substring("source_period", 1, 4), F.lit(".json")).alias("name"), "source_checksum",
        F.struct(F.concat(F.lit("Balances "), "source_period").alias("Titulo"),
                 F.concat(F.lit("/files/"), F.lower(status), F.lit("/"), "source_period", F.lit("BANCOS.ZIP")).alias("Url"),
                 F.col("source_generated_at").cast("string").alias("DataDocumento")).alias("item"))
    other = items.groupBy("name").agg(F.lit("~").alias("source_checksum"), F.struct(
        F.concat(F.lit("Notes "), F.first("name")).alias("Titulo"), F.lit(None).cast("string").alias("Url"),
        F.lit(None).cast("string").alias("DataDocumento")).alias("item"))
    formats.write_json(items.unionByName(other), path, "ledger_catalog", F.col("name"), "item", ["source_checksum"], member="conteudo")
    return formats.scan_catalog(spark, path).select("item_index", "period", "title", "source_url", "document_date", "period_version", "is_active", "error")


def series_scan(spark: SparkSession, d: str) -> DataFrame:
    """Observation files of the event types → typed observations."""
    path = _folder(spark, f"series-{uuid.uuid4().hex}")
    e = table(spark, d, "events").groupBy("event_type", month_start("ts").alias("m")).agg(F.sum(money("value")).alias("v"))
    item = F.struct(F.date_format("m", "dd/MM/yyyy").alias("data"), F.replace(F.col("v").cast("string"), F.lit("."), F.lit(",")).alias("valor"))
    formats.write_json(e, path, "ledger_series", F.concat("event_type", F.lit(".json")), item, ["m"])
    return formats.scan_series(spark, path).select("series_code", "source_observation_date", "report_month", "value", "value_raw")


def _merged(spark: SparkSession, d: str):
    path = _folder(spark, f"orders-{uuid.uuid4().hex}")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("amount"))
    late = o.filter(F.col("o_orderstatus") == "P").withColumn("amount", (F.col("amount") + 1).cast("decimal(38,2)"))
    new = late.filter(F.col("o_orderkey") % 2 == 0).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    batch = late.unionByName(new)
    merge(spark, path, o, "o_orderkey", buckets=16, batch_id="first")
    merge(spark, path, batch, "o_orderkey", batch_id="second")
    merge(spark, path, batch, "o_orderkey", batch_id="second")  # known to the log
    return merge(spark, path, batch, "o_orderkey", batch_id="again")  # differs in nothing


def incremental_merge(spark: SparkSession, d: str) -> DataFrame:
    """Keyed merge into hash buckets; the rows after three batches."""
    return _merged(spark, d).read()


def merge_history(spark: SparkSession, d: str) -> DataFrame:
    """The version log; batches that change nothing write no version."""
    return history(_merged(spark, d)).select("version", "batch", "inserted", "updated")


def late_file_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """After late files, exactly their periods are rewritten (``version`` 2)."""
    core, landed = _folder(spark, f"core-{uuid.uuid4().hex}"), _folder(spark, f"landed-{uuid.uuid4().hex}")
    rows, manifest = driver_models.balance_rows(spark, d), driver_models.file_manifest(spark, d)
    late = F.col("source_period").startswith(LATE_YEAR) & F.col("source_checksum").endswith("-F")
    periods = lambda f: [r[0] for r in f.select("source_period").distinct().collect()]  # noqa: E731  one row a period
    rows.filter(~late).write.partitionBy("source_checksum").parquet(landed)
    rebuild(spark, landed, manifest.filter(~late), core, periods(manifest.filter(~late)), "first")
    rows.filter(late).write.mode("append").partitionBy("source_checksum").parquet(landed)
    touched = periods(manifest.filter(late))
    rebuild(spark, landed, manifest, core, touched, "late")
    rebuild(spark, landed, manifest, core, touched, "late")  # delivered again
    held = core_table(spark, core, "account_balance").read(version_col="version")
    return held.groupBy("source_period", "source_checksum", "version").agg(F.count(F.lit(1)).alias("row_count"), F.sum("balance_amount").alias("amount"))


def replay_certification(spark: SparkSession, d: str) -> DataFrame:
    """Q18: are relations the same rows after a replay?  Two that are, and two that a row count takes for the same or a sum does."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    held = _merged(spark, d)
    swapped = lines.withColumns({"l_discount": F.col("l_tax"), "l_tax": F.col("l_discount")})
    before = {"orders": orders, "merged_orders": held.read(version=2), "swapped_lines": lines, "status_counts": orders.select("o_orderstatus", "o_orderpriority")}
    after = {"orders": orders.repartition(7, "o_custkey"), "merged_orders": held.read(), "swapped_lines": swapped,
             "status_counts": orders.filter(F.col("o_orderkey") % 2 == 0).select("o_orderstatus", "o_orderpriority")}
    return replay_compare(before, after)


def duplicate_customers(spark: SparkSession, d: str) -> DataFrame:
    """Q21: how many customers have several orders, and the ten with the most as one text."""
    return duplicate_text(table(spark, d, "orders"), "o_custkey")


def source_decision(spark: SparkSession, d: str) -> DataFrame:
    """Q17: the source decision over ``LATE_YEAR``: archives of the orders, monthly series of the events, nations by final orders."""
    files = driver_models.file_manifest(spark, d).filter(F.col("source_period").startswith(LATE_YEAR)).withColumn("period", F.col("source_period"))
    complete = files.filter(F.col("status") == "complete").withColumn("sha256", F.col("source_checksum"))
    profiles = files.groupBy("period").agg(F.sum("row_count").alias("row_count"), F.count_if(F.col("status") == "failed").alias("malformed_row_count")).withColumn("period_matches", F.lit(True))
    events = table(spark, d, "events").select(F.col("event_type").alias("series_code"), F.concat(F.lit(LATE_YEAR), F.date_format("ts", "MM")).alias("report_month"))
    observations = events.distinct()
    series = events.groupBy("series_code").agg((F.lit(12) - F.count_distinct("report_month")).alias("internal_missing_month_count")).select(
        "series_code", F.lit("complete").alias("status"), F.lit(f"{LATE_YEAR}01").alias("requested_start_month"), F.lit(f"{LATE_YEAR}12").alias("requested_end_month"),
        "internal_missing_month_count", F.lit(0).alias("duplicate_report_month_count"))
    c = table(spark, d, "customer").select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 8, "0").alias("institution_cnpj"))
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("period")).filter(F.col("period").startswith(LATE_YEAR))
    monthly = o.groupBy("o_custkey", "period", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    monthly = monthly.groupBy("institution_cnpj", "period").agg(F.sum("n").alias("n"))
    nations = table(spark, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 8, "0").alias("institution_cnpj"), (F.col("n_nationkey") + 1).alias("freeze_rank"))
    passed = check_table(spark, d)
    return source_decision_controls(
        spark, files, complete, profiles, observations, series, passed, passed, nations, monthly, observations.select("series_code").distinct(),
        f"{LATE_YEAR}-01-01", f"{LATE_YEAR}-12-01", 25, boundary={"start": (f"{LATE_YEAR}01", f"{LATE_YEAR}01"), "population": (25, 25)})


def check_table(spark: SparkSession, d: str) -> DataFrame:
    """A retained control table: line items have an order key and a known flag."""
    li = table(spark, d, "lineitem")
    return build_controls(spark, [failing_rows("keys", li.filter(F.col("l_orderkey").isNull())), failing_rows("flags", li.filter(~F.col("l_returnflag").isin("A", "N", "R")))])


RECIPES = {q.__name__: q for q in (archive_scan, archive_profile, catalog_scan, series_scan, incremental_merge, merge_history, late_file_rebuild,
                                   replay_certification, duplicate_customers, source_decision)}

_ROWS = f"""WITH {driver_models.ORACLE_FILES},
balances AS (
  SELECT f.source_period, CASE WHEN l.l_returnflag = 'R' THEN '4016' ELSE '4010' END AS documento,
         lpad(CAST(c.c_nationkey AS VARCHAR), 8, '0') AS cnpj, n.n_name AS nome_instituicao, a.account_code AS conta,
         lower(p.p_type) AS nome_conta, CAST(l.l_extendedprice AS DECIMAL(38,2)) AS saldo, f.source_checksum, f.o_orderstatus,
         f.source_period || 'BANCOS-' || f.o_orderstatus || '.zip' AS source_url, l.l_orderkey * 10 + l.l_linenumber AS place
  FROM lineitem l JOIN files f ON l.l_orderkey = f.o_orderkey JOIN customer c ON f.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey JOIN accounts a ON a.p_type = p.p_type)"""

ORACLE = {
    "archive_scan": f"""{_ROWS}
SELECT source_period, documento, cnpj, nome_instituicao, conta, nome_conta, saldo, source_url, DATE '2025-02-10' AS source_generated_at,
       row_number() OVER (PARTITION BY source_url ORDER BY place, conta, documento, saldo) AS file_row_number FROM balances""",
    "archive_profile": f"""{_ROWS}
SELECT source_url AS archive, 'utf-8-sig' AS encoding, 3 AS header_line_number, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS malformed_row_count,
       COUNT(DISTINCT documento) AS document_count, COUNT(DISTINCT cnpj) AS institution_count, COUNT(DISTINCT conta) AS account_count,
       source_period AS declared_periods, DATE '2025-02-10' AS source_generated_at
FROM balances WHERE source_period LIKE '{LATE_YEAR}%' GROUP BY source_url, source_period""",
    "catalog_scan": f"""WITH {driver_models.ORACLE_FILES},
f AS (SELECT DISTINCT source_period, source_checksum, lower(o_orderstatus) AS s, CAST(report_month + 40 AS VARCHAR) AS document_date FROM files),
items AS (
  SELECT source_period AS period, 'Balances ' || source_period AS title, 'https://www.bcb.gov.br/files/' || s || '/' || source_period || 'BANCOS.ZIP' AS source_url,
         document_date, source_period[1:4] AS y, source_checksum FROM f
  UNION ALL SELECT DISTINCT NULL, 'Notes ' || source_period[1:4] || '.json', NULL, NULL, source_period[1:4], '~' FROM f)
SELECT CAST(row_number() OVER (PARTITION BY y ORDER BY source_checksum) - 1 AS INTEGER) AS item_index, period, title, source_url, document_date,
       CASE WHEN period IS NOT NULL THEN row_number() OVER (PARTITION BY period ORDER BY document_date, source_url) END AS period_version,
       CASE WHEN period IS NOT NULL THEN row_number() OVER (PARTITION BY period ORDER BY document_date DESC, source_url DESC) = 1 END AS is_active,
       CASE WHEN period IS NULL THEN 'Unrecognized or missing bank file URL' END AS error
FROM items""",
    "series_scan": """
SELECT event_type AS series_code, CAST(date_trunc('month', ts) AS DATE) AS source_observation_date, strftime(date_trunc('month', ts), '%Y%m') AS report_month,
       CAST(SUM(CAST(value AS DECIMAL(38,2))) AS DECIMAL(38,10)) AS value, replace(CAST(SUM(CAST(value AS DECIMAL(38,2))) AS VARCHAR), '.', ',') AS value_raw
FROM events GROUP BY 1, 2, 3""",
    "incremental_merge": """
WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(38,2)) AS amount FROM orders)
SELECT o_orderkey, o_orderstatus, CAST(amount + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS DECIMAL(38,2)) AS amount FROM o
UNION ALL SELECT -o_orderkey - 1, o_orderstatus, CAST(amount + 1 AS DECIMAL(38,2)) FROM o WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0""",
    "merge_history": """
SELECT CAST(1 AS BIGINT) AS version, 'first' AS batch, COUNT(*) AS inserted, CAST(0 AS BIGINT) AS updated FROM orders
UNION ALL SELECT 2, 'second', COUNT(*) FILTER (o_orderkey % 2 = 0), COUNT(*) FROM orders WHERE o_orderstatus = 'P'""",
    "late_file_rebuild": f"""{_ROWS},
complete AS (SELECT DISTINCT source_period, source_checksum, o_orderstatus FROM files WHERE o_orderstatus <> 'P'),
chosen AS (
  SELECT *, row_number() OVER (PARTITION BY source_period ORDER BY o_orderstatus = 'F' DESC, source_checksum DESC) AS k FROM complete)
SELECT source_period, source_checksum, CAST(CASE WHEN o_orderstatus = 'F' AND source_period LIKE '{LATE_YEAR}%' THEN 2 ELSE 1 END AS BIGINT) AS version,
       COUNT(*) AS row_count, SUM(saldo) AS amount
FROM balances JOIN chosen USING (source_period, source_checksum, o_orderstatus) WHERE k = 1 GROUP BY 1, 2, 3""",
    "replay_certification": """
WITH o AS (SELECT o_orderstatus, o_orderpriority, o_orderkey % 2 = 0 AS kept FROM orders),
merged AS (SELECT (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0) AS n),
swapped AS (
  SELECT COUNT(*) AS n FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem EXCEPT ALL SELECT l_orderkey, l_linenumber, l_partkey, l_tax, l_discount FROM lineitem))
SELECT 'orders' AS relation, COUNT(*) AS rows_before, COUNT(*) AS rows_after, TRUE AS identical FROM orders
UNION ALL SELECT 'merged_orders', n, n, TRUE FROM merged
UNION ALL SELECT 'swapped_lines', COUNT(*), COUNT(*), (SELECT n FROM swapped) = 0 FROM lineitem
UNION ALL SELECT 'status_counts', COUNT(*), COUNT(*) FILTER (kept), COUNT(*) FILTER (NOT kept) = 0 FROM o""",
    "duplicate_customers": """
WITH d AS (SELECT CAST(o_custkey AS VARCHAR) AS v, COUNT(*) AS n FROM orders GROUP BY 1 HAVING COUNT(*) > 1),
t AS (SELECT * FROM d ORDER BY n DESC, v LIMIT 10)
SELECT (SELECT COUNT(*) FROM d) AS duplicates,
       (SELECT string_agg(v || '×' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, v) FROM t)
       || CASE WHEN (SELECT COUNT(*) FROM d) > 10 THEN ', +' || CAST((SELECT COUNT(*) FROM d) - 10 AS VARCHAR) || ' more' ELSE '' END AS detail""",
    "source_decision": f"""
WITH {driver_models.ORACLE_FILES},
p AS (SELECT '{LATE_YEAR}' || lpad(CAST(m AS VARCHAR), 2, '0') AS period FROM range(1, 13) t(m)),
a AS (SELECT DISTINCT source_period AS period, source_checksum, o_orderstatus AS s FROM files WHERE source_period LIKE '{LATE_YEAR}%'),
per AS (
  SELECT p.period, COUNT(*) FILTER (s = 'F') AS active, COUNT(*) FILTER (s <> 'P') AS complete, COUNT(s) AS files, COUNT(*) FILTER (s = 'P') AS bad
  FROM p LEFT JOIN a USING (period) GROUP BY p.period),
e AS (SELECT event_type, COUNT(DISTINCT month(ts)) AS months FROM events GROUP BY 1),
mon AS (
  SELECT c_nationkey, COUNT(DISTINCT month(o_orderdate)) AS months
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = {LATE_YEAR} GROUP BY 1),
li AS (SELECT (COUNT(*) FILTER (l_orderkey IS NULL) + COUNT(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R'))) = 0 AS good FROM lineitem),
gaps AS (
  SELECT (SELECT COUNT(*) FROM nation LEFT JOIN mon ON n_nationkey = c_nationkey WHERE months IS DISTINCT FROM 12)
       + (SELECT COUNT(*) FROM mon WHERE months <> 12 OR c_nationkey NOT IN (SELECT n_nationkey FROM nation)) AS n),
c AS (
  SELECT 1 AS k, 'catalog_active_period_coverage' AS name, COUNT(*) FILTER (active <> 1) AS n FROM per
  UNION ALL SELECT 2, 'cosif_runtime_and_profile_ready', COUNT(*) FILTER (complete <> 1) + COUNT(*) FILTER (files = 0 OR bad > 0) FROM per
  UNION ALL SELECT 3, 'macro_runtime_and_profile_ready', 2 * COUNT(*) FILTER (months <> 12) FROM e
  UNION ALL SELECT 7, 'population_monthly_coverage', n FROM gaps),
t AS (
  SELECT k, name, n = 0 AS passed, '== 0' AS expected, CAST(n AS VARCHAR) AS actual FROM c
  UNION ALL SELECT 4, 'acquisition_readiness_retained', good, '== True', CAST(good AS VARCHAR) FROM li
  UNION ALL SELECT 5, 'population_controls_retained', good, '== True', CAST(good AS VARCHAR) FROM li
  UNION ALL SELECT 6, 'population_contract_frozen', COUNT(*) = 25, '== True', CAST(COUNT(*) = 25 AS VARCHAR) FROM nation
  UNION ALL SELECT 8, 'source_boundary_complete', TRUE, '== True', 'true')
SELECT CAST(k AS INTEGER) AS control_order, name AS control_name, passed, expected, actual,
       CASE WHEN k = 8 THEN 'start={LATE_YEAR}01|population=25' ELSE '' END AS detail FROM t
UNION ALL
SELECT 9, 'source_profile_decision', COUNT(*) FILTER (passed) = 8, 'all prior controls pass', CAST(COUNT(*) FILTER (passed) AS VARCHAR) || '/8', 'fail-closed roll-up' FROM t""",
}
