"""DuckDB oracle SQL for every recipe in :mod:`ledgermart.plans.driver_tables`.

The SQL is written the plain way (join everything, then group), which is
also how the reference states its models; the Spark plans pre-aggregate and
split hot groups, so agreement checks those rewrites too.
"""

from __future__ import annotations

from ledgermart.plans.driver_tables import (
    ACCEPTED_STATUSES,
    ENDED_AFTER,
    ENDED_MEMBER,
    EXPECTED_SEGMENTS,
    FREEZE_MONTH,
    MAPPING_ROWS,
    MAPPING_VERSION,
    NAMED_MONTHS,
    ORDER_DOCUMENTS,
    POPULATION_SIZE,
    POPULATION_COMPONENTS,
    PRESENCE_COMPONENT,
    PROBE_STATUS,
    SERIES_END,
    SERIES_MAX_LAG,
    SERIES_START,
)

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


MAPPING_CTE = "mapping(reporting_line_key, p_type, presentation_multiplier, mapping_version) AS (VALUES " + ", ".join(
    f"({_q(k)}, {_q(acct)}, {mult}, {_q(MAPPING_VERSION)})" for k, _, _, acct, _, mult in MAPPING_ROWS) + ")"

MAPPING_FULL_CTE = ("mapping(reporting_line_key, p_type, component_name, presentation_multiplier, mapping_version) "
                    "AS (VALUES " + ", ".join(
                        f"({_q(k)}, {_q(acct)}, {_q(comp)}, {mult}, {_q(MAPPING_VERSION)})"
                        for k, _, _, acct, comp, mult in MAPPING_ROWS) + ")")

MONTH = "CAST(date_trunc('month', {c}) AS DATE)"

ROWS_CTE = f"""rows AS (
  SELECT {MONTH.format(c='o.o_orderdate')} AS report_month, c.c_nationkey, p.p_type,
         CAST(l.l_extendedprice AS DECIMAL(38,2)) AS amount, o.o_orderstatus = 'F' AS is_final
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

LF_CTE = """lf AS (
  SELECT md5(CAST(r.report_month AS VARCHAR) || '|' || CAST(r.c_nationkey AS VARCHAR) || '|' ||
             m.reporting_line_key || '|' || m.mapping_version) AS reporting_line_balance_key,
         r.report_month, r.c_nationkey, m.reporting_line_key AS reporting_line_code, m.mapping_version,
         SUM(r.amount) AS reported_balance_amount,
         SUM(r.amount * m.presentation_multiplier) AS presentation_balance_amount,
         CAST(COUNT(DISTINCT r.p_type) AS INTEGER) AS contributing_account_count,
         string_agg(DISTINCT r.p_type, '|' ORDER BY r.p_type) AS contributing_account_codes,
         bool_and(r.is_final) AS is_complete
  FROM rows r JOIN mapping m ON r.p_type = m.p_type
  GROUP BY r.report_month, r.c_nationkey, m.reporting_line_key, m.mapping_version)"""

LINE_BASE = f"WITH {MAPPING_CTE},\n{ROWS_CTE},\n{LF_CTE}"


def _lines(alias: str = "lf") -> str:
    return ",\n  ".join(
        f"SUM(CASE WHEN {alias}.reporting_line_code = {_q(k)} THEN {alias}.presentation_balance_amount END) AS {k}"
        for k in ("total_assets", "credit_portfolio", "deposits", "equity"))


def _div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def _growth(cur: str, prior: str) -> str:
    return f"CASE WHEN {prior} IS NOT NULL THEN {_div(f'(COALESCE({cur}, 0) - {prior})', prior)} END"


# member values at each member's last month
MEMBER_LAST = f"""last AS (SELECT c_nationkey, MAX(report_month) AS lm FROM lf GROUP BY c_nationkey),
vals AS (
  SELECT lf.c_nationkey, {_lines()}
  FROM lf JOIN last ON lf.c_nationkey = last.c_nationkey AND lf.report_month = last.lm
  GROUP BY lf.c_nationkey)"""

TOTAL_LAST = f"""tot AS (
  SELECT {_lines()}
  FROM lf WHERE lf.report_month = (SELECT MAX(report_month) FROM lf))"""

# the context of the named tables: a month range, and a member that ends early
ENDED_FILTER = f"NOT (c_nationkey = {ENDED_MEMBER} AND report_month > DATE '{ENDED_AFTER}')"
NAMED_FILTER = f"report_month BETWEEN DATE '{NAMED_MONTHS[0]}' AND DATE '{NAMED_MONTHS[1]}' AND {ENDED_FILTER}"

VERSIONED = """versioned AS (
  SELECT *, (row_number() OVER (PARTITION BY o_custkey
             ORDER BY (o_orderstatus = 'F') DESC, o_orderdate DESC, o_orderkey DESC) = 1
             AND o_orderstatus = 'F') AS is_selected
  FROM orders)"""

def _freeze_ctes() -> str:
    start = FREEZE_MONTH
    y, m, _ = (int(x) for x in start.split("-"))
    end = f"{y + (m == 12):04d}-{(m % 12) + 1:02d}-01"
    return f"""ft AS (
  SELECT c.c_nationkey, SUM(CAST(o.o_totalprice AS DECIMAL(38,2))) AS total_amount
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderdate >= TIMESTAMP '{start}' AND o.o_orderdate < TIMESTAMP '{end}'
  GROUP BY c.c_nationkey),
fr AS (SELECT *, CAST(row_number() OVER (ORDER BY total_amount DESC, c_nationkey) AS INTEGER) AS freeze_rank FROM ft),
members AS (
  SELECT freeze_rank, c_nationkey, total_amount,
         (SELECT MAX(total_amount) FROM fr WHERE freeze_rank = {POPULATION_SIZE})
         - (SELECT MAX(total_amount) FROM fr WHERE freeze_rank = {POPULATION_SIZE + 1}) AS cutoff_gap
  FROM fr WHERE freeze_rank <= {POPULATION_SIZE})"""


NATION_MONTH = f"""nm AS (
  SELECT {MONTH.format(c='o.o_orderdate')} AS report_month, c.c_nationkey,
         SUM(CAST(o.o_totalprice AS DECIMAL(38,2))) AS total_amount
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2)"""

SEGMENT_RATES = f"""rates AS (
  SELECT c.c_mktsegment, {MONTH.format(c='o.o_orderdate')} AS report_month, (COUNT(*) % 5) * 0.5 - 0.5 AS rate
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_mktsegment <> 'BUILDING' OR month(o.o_orderdate) <> 5
  GROUP BY 1, 2)"""

SERIES_CTES = f"""o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, {MONTH.format(c='o_orderdate')} AS m FROM orders),
dm AS (SELECT DISTINCT o_custkey, m FROM o),
sq AS (SELECT o_custkey, m, lag(m) OVER (PARTITION BY o_custkey ORDER BY m) AS prev FROM dm),
gp AS (SELECT o_custkey, prev, m FROM sq WHERE prev IS NOT NULL AND m <> CAST(prev + INTERVAL 1 MONTH AS DATE)),
miss AS (SELECT o_custkey,
                CAST(unnest(generate_series(prev + INTERVAL 1 MONTH, m - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS mm
         FROM gp)"""


def _null_scan(table: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {_q(table)} AS table_name, {_q(c)} AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {table}"
        for c in cols)


def _probe_code() -> str:
    whens = " ".join(f"WHEN {_q(t)} THEN {c}" for t, c in PROBE_STATUS.items())
    return f"CASE event_type {whens} END"


POPULATION_STATE = "state AS (\n  SELECT report_month, c_nationkey,\n         " + ",\n         ".join(
    f"SUM(amount) FILTER (WHERE p_type = {_q(t)}) AS {a}" for a, t in POPULATION_COMPONENTS.items()) + ",\n         " + " + ".join(
    f"COALESCE(SUM(amount) FILTER (WHERE p_type = {_q(t)}), 0)" for t in POPULATION_COMPONENTS.values()) + \
    " AS total_amount\n  FROM rows GROUP BY report_month, c_nationkey)"

EXPECTED_LINES = f"""exp AS (
  SELECT r.report_month, r.c_nationkey, m.reporting_line_key AS reporting_line_code, m.mapping_version,
         SUM(r.amount * m.presentation_multiplier) AS amount
  FROM rows r JOIN mapping m ON r.p_type = m.p_type
  GROUP BY 1, 2, 3, 4),
act AS (SELECT report_month, c_nationkey, reporting_line_code, mapping_version,
               presentation_balance_amount AS amount FROM lf)"""

MONTHS_UNION = f"""months AS (
  SELECT {MONTH.format(c='o_orderdate')} AS m FROM orders
  UNION
  SELECT {MONTH.format(c='l_shipdate')} FROM lineitem)"""


SQL: dict[str, str] = {
    "staging_orders": r"""
SELECT o_orderkey AS order_key, o_custkey AS customer_key,
       NULLIF(trim(o_orderstatus), '') AS status, NULLIF(trim(o_orderpriority), '') AS priority,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month,
       CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month_key,
       strftime(o_orderdate, '%Y%m') AS source_period,
       (regexp_matches(strftime(o_orderdate, '%Y%m'), '^\d{6}$')
        AND CAST(substr(strftime(o_orderdate, '%Y%m'), 1, 4) AS INTEGER) >= 1988
        AND CAST(substr(strftime(o_orderdate, '%Y%m'), 5, 2) AS INTEGER) BETWEEN 1 AND 12) AS is_valid_period,
       CAST(o_totalprice AS DECIMAL(38,2)) AS amount,
       starts_with(o_orderpriority, '1-') AS is_urgent,
       NULLIF(trim(o_orderpriority), '') IS NOT NULL AS has_priority
FROM orders""",
    "month_calendar": f"""
WITH {MONTHS_UNION}
SELECT CAST(strftime(m, '%Y%m') AS INTEGER) AS month_key, m AS month_start,
       CAST(year(m) AS INTEGER) AS calendar_year, CAST(quarter(m) AS INTEGER) AS calendar_quarter,
       CAST(month(m) AS INTEGER) AS calendar_month, strftime(m, '%b %Y') AS month_label,
       CAST(date_trunc('quarter', m) AS DATE) AS quarter_start, CAST(date_trunc('year', m) AS DATE) AS year_start
FROM months""",
    "surrogate_keys": """
SELECT l_orderkey, l_linenumber,
       md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)) AS line_key,
       md5(CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR)) AS part_supplier_key,
       md5(CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) || '|' || CAST(l_orderkey AS VARCHAR)) AS ship_month_order_key,
       md5(CAST(l_partkey AS VARCHAR)) AS part_key
FROM lineitem""",
    "url_fields": r"""
WITH u AS (
  SELECT page_id, url,
         regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) AS lang_raw,
         regexp_extract(url, '[?&]page=(\d+)', 1) AS query_page,
         regexp_extract(url, '#(.*)$', 1) AS fragment
  FROM pages)
SELECT page_id,
       regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
       regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
       NULLIF(trim(lang_raw), '') AS lang,
       CAST(NULLIF(regexp_extract(url, '^[a-z]+://[^/]+/[a-z]{2}/(\d+)', 1), '') AS BIGINT) AS page_number,
       regexp_extract(url, '(?i)\.(html?)$', 1) AS extension,
       COALESCE(NULLIF(regexp_replace(fragment, '^\s+|\s+$', '', 'g'), ''),
                NULLIF(regexp_replace(query_page, '^\s+|\s+$', '', 'g'), ''),
                NULLIF(regexp_replace(lang_raw, '^\s+|\s+$', '', 'g'), '')) AS first_locator,
       regexp_extract(url, '(?i)^https?://(blog|www|m)\.', 1) AS subdomain
FROM u""",
    "event_json": """
SELECT event_id, event_type,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL AS has_k,
       CAST(ts AS DATE) AS event_date,
       CAST(date_trunc('month', ts) AS DATE) AS report_month
FROM events""",
    "locale_decimal": """
WITH t AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(38,2)) AS orig,
         translate(format('{:,.2f}', CAST(o_totalprice AS DECIMAL(38,2))), ',.', '.,') AS amount_text
  FROM orders),
p AS (SELECT *, TRY_CAST(replace(replace(trim(amount_text), '.', ''), ',', '.') AS DECIMAL(38,2)) AS amount FROM t)
SELECT o_orderkey, amount_text, amount, amount = orig AS roundtrip_ok FROM p""",
    "latest_version": f"""
WITH {VERSIONED}
SELECT o_orderkey, o_custkey, o_orderstatus, is_selected FROM versioned""",
    "version_ordinal": f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, {MONTH.format(c='o_orderdate')} AS report_month FROM orders)
SELECT o_orderkey, o_custkey, report_month,
       row_number() OVER w AS period_version,
       row_number() OVER w = COUNT(*) OVER (PARTITION BY o_custkey, report_month) AS is_active
FROM o
WINDOW w AS (PARTITION BY o_custkey, report_month ORDER BY o_orderdate, o_orderkey)""",
    "recent_attribute": """
SELECT o_custkey, o_orderpriority AS latest_priority, CAST(o_orderdate AS DATE) AS latest_order_date
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC) AS rn
      FROM orders)
WHERE rn = 1""",
    "selected_rows": f"""
WITH {VERSIONED}
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(38,2)) AS amount
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM versioned WHERE is_selected)""",
    "entity_period": f"""
SELECT md5(CAST(report_month AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR)) AS entity_period_key,
       report_month, o_custkey, MAX(o_orderpriority) AS priority, COUNT(*) AS order_count,
       bool_and(o_orderstatus = 'F') AS all_final
FROM (SELECT *, {MONTH.format(c='o_orderdate')} AS report_month FROM orders)
GROUP BY report_month, o_custkey""",
    "account_dim": f"""
WITH {MAPPING_CTE}
SELECT md5(CAST(p_partkey AS VARCHAR)) AS account_key, p_partkey, p_name, p_type,
       substr(p_type, 1, 1) AS account_class, substr(p_type, 1, 2) AS account_group,
       COALESCE(p_type IN (SELECT p_type FROM mapping), FALSE) AS is_reporting_line_component
FROM part""",
    "line_balance": f"""
{LINE_BASE}
SELECT * FROM lf""",
    "class_pivot": f"""
WITH li AS (SELECT {MONTH.format(c='l_shipdate')} AS report_month, l_returnflag, l_linestatus,
                   CAST(l_extendedprice AS DECIMAL(38,2)) AS amount FROM lineitem),
g AS (
  SELECT report_month,
         SUM(amount) FILTER (WHERE l_returnflag = 'A') AS accepted_amount,
         SUM(amount) FILTER (WHERE l_returnflag = 'N') AS none_amount,
         SUM(amount) FILTER (WHERE l_returnflag = 'R') AS returned_amount,
         COUNT(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
         COUNT(*) AS line_count,
         SUM(amount) AS total_amount
  FROM li GROUP BY report_month)
SELECT *, abs(COALESCE(accepted_amount, 0) + COALESCE(none_amount, 0) + COALESCE(returned_amount, 0)
              - total_amount) <= 0.01 AS identity_ok
FROM g""",
    "top15_freeze": f"""
WITH {_freeze_ctes()}
SELECT m.freeze_rank, m.c_nationkey, n.n_name, m.total_amount, m.cutoff_gap
FROM members m JOIN nation n ON m.c_nationkey = n.n_nationkey""",
    "population_monthly": f"""
WITH {_freeze_ctes()},
{NATION_MONTH}
SELECT nm.report_month, nm.c_nationkey, members.freeze_rank, nm.total_amount
FROM nm JOIN members ON nm.c_nationkey = members.c_nationkey""",
    "population_coverage": f"""
WITH {_freeze_ctes()},
{NATION_MONTH},
expected AS (SELECT COUNT(DISTINCT report_month) AS n FROM nm)
SELECT c_nationkey, COUNT(DISTINCT report_month) AS months_covered, (SELECT n FROM expected) AS months_expected,
       MIN(report_month) AS first_month, MAX(report_month) AS last_month,
       COUNT(DISTINCT report_month) = (SELECT n FROM expected) AS is_complete
FROM nm WHERE c_nationkey IN (SELECT c_nationkey FROM members)
GROUP BY c_nationkey""",
    "period_profile": f"""
SELECT report_month, COUNT(*) AS order_count,
       COUNT(*) FILTER (WHERE NULLIF(trim(o_orderpriority), '') IS NULL) AS blank_priority_rows,
       COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT o_orderpriority) AS priorities,
       string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS statuses,
       COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS customers_f,
       COUNT(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS customers_o,
       COUNT(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS customers_p,
       SUM(CAST(o_totalprice AS DECIMAL(38,2))) AS summed_amount
FROM (SELECT *, {MONTH.format(c='o_orderdate')} AS report_month FROM orders)
GROUP BY report_month""",
    "series_profile": f"""
WITH {SERIES_CTES},
gaps AS (SELECT o_custkey, COUNT(*) AS n, string_agg(strftime(mm, '%Y%m'), '|' ORDER BY mm) AS txt
         FROM miss GROUP BY o_custkey),
pf AS (SELECT o_custkey, COUNT(*) AS row_count, MIN(d) AS first_d, MAX(d) AS last_d, MIN(m) AS first_m, MAX(m) AS last_m,
              COUNT(*) - COUNT(DISTINCT d) AS dup_d, COUNT(*) - COUNT(DISTINCT m) AS dup_m
       FROM o GROUP BY o_custkey),
j AS (SELECT pf.*, COALESCE(gaps.n, 0) AS miss_n, COALESCE(gaps.txt, '') AS miss_txt,
             (year(DATE '{SERIES_END}') - year(last_m)) * 12 + (month(DATE '{SERIES_END}') - month(last_m)) AS lag
      FROM pf LEFT JOIN gaps ON pf.o_custkey = gaps.o_custkey),
e AS (SELECT *, NULLIF(concat_ws('; ',
          CASE WHEN first_m <> DATE '{SERIES_START}' THEN 'first month differs from requested start' END,
          CASE WHEN dup_d > 0 THEN 'duplicate observation dates' END,
          CASE WHEN dup_m > 0 THEN 'duplicate report months' END,
          CASE WHEN miss_n > 0 THEN 'internal missing months' END,
          CASE WHEN lag < 0 THEN 'month after the requested end' END,
          CASE WHEN lag > {SERIES_MAX_LAG} THEN 'freshness lag exceeds expected' END), '') AS err
      FROM j)
SELECT o_custkey,
       CASE WHEN row_count = 0 THEN 'error' WHEN err IS NULL THEN 'complete' ELSE 'invalid' END AS status,
       strftime(DATE '{SERIES_START}', '%Y%m') AS requested_start_month,
       strftime(DATE '{SERIES_END}', '%Y%m') AS requested_end_month,
       row_count, first_d AS first_observation_date, last_d AS last_observation_date,
       strftime(first_m, '%Y%m') AS first_report_month, strftime(last_m, '%Y%m') AS last_report_month,
       CAST(miss_n AS BIGINT) AS internal_missing_month_count, miss_txt AS internal_missing_months,
       dup_d AS duplicate_observation_date_count, dup_m AS duplicate_report_month_count,
       CAST(lag AS BIGINT) AS lag_months_to_requested_end, CAST({SERIES_MAX_LAG} AS BIGINT) AS max_expected_lag_months,
       err AS error
FROM e""",
    "missing_periods": f"""
WITH {SERIES_CTES}
SELECT o_custkey, mm AS missing_month FROM miss""",
    "continuity": f"""
WITH {SERIES_CTES}
SELECT o_custkey, m AS report_month, prev AS previous_month,
       CAST((year(m) - year(prev)) * 12 + (month(m) - month(prev)) AS INTEGER) AS gap_months
FROM gp""",
    "balance_last": f"""
{LINE_BASE},
{MEMBER_LAST}
SELECT * FROM vals""",
    "balance_total": f"""
{LINE_BASE},
{TOTAL_LAST}
SELECT * FROM tot""",
    "balance_by_month": f"""
{LINE_BASE}
SELECT lf.report_month, lf.c_nationkey, {_lines()}
FROM lf GROUP BY lf.report_month, lf.c_nationkey""",
    "ratios": f"""
{LINE_BASE},
{MEMBER_LAST}
SELECT c_nationkey, {_div('credit_portfolio', 'total_assets')} AS credit_share,
       {_div('deposits', 'total_assets')} AS deposit_funding_share,
       {_div('equity', 'total_assets')} AS equity_to_assets
FROM vals""",
    "population_share": f"""
{LINE_BASE},
{MEMBER_LAST},
{TOTAL_LAST}
SELECT vals.c_nationkey, vals.total_assets, {_div('vals.total_assets', 'tot.total_assets')} AS population_share
FROM vals, tot""",
    "peer_median": f"""
{LINE_BASE},
mv AS (SELECT lf.report_month, lf.c_nationkey, {_lines()} FROM lf GROUP BY lf.report_month, lf.c_nationkey)
SELECT report_month, median(CAST(total_assets * 100 AS DOUBLE)) / 100 AS peer_median
FROM mv GROUP BY report_month""",
    "mom_growth": f"""
{LINE_BASE},
cur AS (SELECT lf.report_month, lf.c_nationkey, {_lines()} FROM lf GROUP BY lf.report_month, lf.c_nationkey),
pr AS (SELECT CAST(report_month + INTERVAL 1 MONTH AS DATE) AS report_month, c_nationkey,
              SUM(presentation_balance_amount) AS prior
       FROM lf WHERE reporting_line_code = 'total_assets' GROUP BY 1, 2)
SELECT report_month, c_nationkey, cur.total_assets, {_growth('cur.total_assets', 'pr.prior')} AS mom_growth
FROM cur FULL JOIN (SELECT * FROM pr WHERE report_month IN (SELECT report_month FROM lf)) pr USING (report_month, c_nationkey)""",
    "yoy_growth": f"""
{LINE_BASE},
cur AS (SELECT lf.report_month, lf.c_nationkey, {_lines()} FROM lf GROUP BY lf.report_month, lf.c_nationkey),
pr AS (SELECT CAST(report_month + INTERVAL 12 MONTH AS DATE) AS report_month, c_nationkey,
              SUM(presentation_balance_amount) AS prior
       FROM lf WHERE reporting_line_code = 'total_assets' GROUP BY 1, 2)
SELECT report_month, c_nationkey, cur.total_assets, {_growth('cur.total_assets', 'pr.prior')} AS yoy_growth
FROM cur FULL JOIN (SELECT * FROM pr WHERE report_month IN (SELECT report_month FROM lf)) pr USING (report_month, c_nationkey)""",
    "mix_table": f"""
{LINE_BASE},
{MEMBER_LAST},
pr AS (SELECT lf.c_nationkey, SUM(lf.presentation_balance_amount) AS prior
       FROM lf JOIN last ON lf.c_nationkey = last.c_nationkey
                        AND lf.report_month = CAST(last.lm - INTERVAL 1 MONTH AS DATE)
       WHERE lf.reporting_line_code = 'total_assets' GROUP BY lf.c_nationkey)
SELECT vals.c_nationkey, vals.total_assets, {_growth('vals.total_assets', 'pr.prior')} AS mom_growth,
       {_div('credit_portfolio', 'vals.total_assets')} AS credit_share,
       {_div('deposits', 'vals.total_assets')} AS deposit_funding_share,
       {_div('equity', 'vals.total_assets')} AS equity_to_assets
FROM vals LEFT JOIN pr ON vals.c_nationkey = pr.c_nationkey""",
    "peer_table": f"""
{LINE_BASE},
{MEMBER_LAST},
{TOTAL_LAST}
SELECT vals.c_nationkey, vals.total_assets, {_div('vals.total_assets', 'tot.total_assets')} AS population_share,
       {_div('vals.credit_portfolio', 'vals.total_assets')} AS credit_share,
       {_div('vals.deposits', 'vals.total_assets')} AS deposit_funding_share,
       {_div('vals.equity', 'vals.total_assets')} AS equity_to_assets
FROM vals, tot""",
    "peer_table_named": f"""
{LINE_BASE},
sel AS (SELECT * FROM lf WHERE {NAMED_FILTER}),
last AS (SELECT c_nationkey, MAX(report_month) AS lm FROM sel GROUP BY c_nationkey),
vals AS (
  SELECT sel.c_nationkey, {_lines('sel')}
  FROM sel JOIN last ON sel.c_nationkey = last.c_nationkey AND sel.report_month = last.lm
  GROUP BY sel.c_nationkey),
tot AS (SELECT {_lines('sel')} FROM sel WHERE sel.report_month = (SELECT MAX(report_month) FROM sel))
SELECT vals.c_nationkey, n.n_name, vals.total_assets,
       {_div('vals.total_assets', 'tot.total_assets')} AS population_share,
       {_div('vals.credit_portfolio', 'vals.total_assets')} AS credit_share
FROM vals JOIN nation n ON vals.c_nationkey = n.n_nationkey, tot""",
    "mix_table_named": f"""
{LINE_BASE},
sel AS (SELECT * FROM lf WHERE {NAMED_FILTER}),
last AS (SELECT c_nationkey, MAX(report_month) AS lm FROM sel GROUP BY c_nationkey),
vals AS (
  SELECT sel.c_nationkey, {_lines('sel')}
  FROM sel JOIN last ON sel.c_nationkey = last.c_nationkey AND sel.report_month = last.lm
  GROUP BY sel.c_nationkey),
ended AS (SELECT * FROM lf WHERE {ENDED_FILTER}),
pr AS (
  SELECT ended.c_nationkey, SUM(ended.presentation_balance_amount) AS prior
  FROM ended JOIN last ON ended.c_nationkey = last.c_nationkey
                      AND ended.report_month = CAST(last.lm - INTERVAL 1 MONTH AS DATE)
  WHERE ended.reporting_line_code = 'total_assets' GROUP BY ended.c_nationkey)
SELECT vals.c_nationkey, n.n_name, vals.total_assets, {_growth('vals.total_assets', 'pr.prior')} AS mom_growth,
       {_div('vals.equity', 'vals.total_assets')} AS equity_to_assets
FROM vals JOIN nation n ON vals.c_nationkey = n.n_nationkey
LEFT JOIN pr ON vals.c_nationkey = pr.c_nationkey""",
    "growth_card": f"""
{LINE_BASE},
{TOTAL_LAST},
{MONTHS_UNION},
fm AS (SELECT MAX(report_month) AS m FROM lf),
dd AS (SELECT MAX(m) AS m FROM months),
ta AS (SELECT report_month, SUM(presentation_balance_amount) AS v FROM lf
       WHERE reporting_line_code = 'total_assets' GROUP BY report_month)
SELECT tot.total_assets,
       {_growth('tot.total_assets', "(SELECT v FROM ta WHERE report_month = CAST((SELECT m FROM fm) - INTERVAL 1 MONTH AS DATE))")} AS mom_growth,
       {_growth('tot.total_assets', "(SELECT v FROM ta WHERE report_month = CAST((SELECT m FROM fm) - INTERVAL 12 MONTH AS DATE))")} AS yoy_growth,
       {_growth('tot.total_assets', "(SELECT v FROM ta WHERE report_month = CAST((SELECT m FROM dd) - INTERVAL 1 MONTH AS DATE))")} AS mom_growth_date_dim,
       {_growth('tot.total_assets', "(SELECT v FROM ta WHERE report_month = CAST((SELECT m FROM dd) - INTERVAL 12 MONTH AS DATE))")} AS yoy_growth_date_dim
FROM tot""",
    "trust_table": f"""
WITH {VERSIONED},
{MONTHS_UNION}
SELECT MAX(strftime(o_orderdate, '%Y%m')) AS latest_source_period, COUNT(*) AS selected_source_files,
       (SELECT COUNT(DISTINCT CAST(strftime(m, '%Y%m') AS INTEGER)) FROM months) AS months_covered
FROM versioned WHERE is_selected""",
    "reconcile_full": f"""
{LINE_BASE},
{EXPECTED_LINES}
SELECT COALESCE(exp.report_month, act.report_month) AS report_month,
       COALESCE(exp.c_nationkey, act.c_nationkey) AS c_nationkey,
       COALESCE(exp.reporting_line_code, act.reporting_line_code) AS reporting_line_code,
       COALESCE(exp.mapping_version, act.mapping_version) AS mapping_version,
       exp.amount AS expected_amount, act.amount AS actual_amount,
       COALESCE(act.amount, 0) - COALESCE(exp.amount, 0) AS difference,
       CASE WHEN act.report_month IS NULL THEN 'missing_actual'
            WHEN exp.report_month IS NULL THEN 'missing_expected'
            WHEN abs(COALESCE(exp.amount, 0) - COALESCE(act.amount, 0)) > 0.01 THEN 'mismatch'
            ELSE 'match' END AS status
FROM exp FULL OUTER JOIN act
  ON exp.report_month = act.report_month AND exp.c_nationkey = act.c_nationkey
 AND exp.reporting_line_code = act.reporting_line_code AND exp.mapping_version = act.mapping_version""",
    "symmetric_diff": f"""
{LINE_BASE},
{EXPECTED_LINES}
SELECT (SELECT COUNT(*) FROM (SELECT * FROM exp EXCEPT SELECT * FROM act)) AS expected_only,
       (SELECT COUNT(*) FROM (SELECT * FROM act EXCEPT SELECT * FROM exp)) AS actual_only,
       (SELECT COUNT(*) FROM exp) AS expected_rows,
       (SELECT COUNT(*) FROM act) AS actual_rows""",
    "code_set_diff": f"""
WITH expected(c_mktsegment) AS (VALUES {", ".join(f"({_q(s)})" for s in EXPECTED_SEGMENTS)}),
actual AS (SELECT DISTINCT c_mktsegment FROM customer)
SELECT c_mktsegment, 'missing' AS issue FROM (SELECT * FROM expected EXCEPT SELECT * FROM actual)
UNION ALL
SELECT c_mktsegment, 'unexpected' AS issue FROM (SELECT * FROM actual EXCEPT SELECT * FROM expected)""",
    "dup_grain": """
WITH d AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
           GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
SELECT (SELECT COUNT(*) FROM lineitem) AS row_count,
       (SELECT COUNT(*) FROM d) AS duplicate_keys,
       CAST((SELECT COALESCE(SUM(row_count), 0) FROM d) AS BIGINT) AS duplicate_rows""",
    "null_scan": _null_scan("orders", ORDERS_COLS) + "\nUNION ALL\n" + _null_scan("lineitem", LINEITEM_COLS),
    "accepted_values": """
SELECT o_orderstatus, COUNT(*) AS row_count FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')
GROUP BY o_orderstatus""",
    "row_count_match": """
WITH bad AS (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING MAX(l_linenumber) <> COUNT(*))
SELECT COUNT(DISTINCT l_orderkey) AS orders_checked, (SELECT COUNT(*) FROM bad) AS mismatched_orders
FROM lineitem""",
    "control_table": f"""
{LINE_BASE},
{EXPECTED_LINES},
{VERSIONED},
{_freeze_ctes()},
c AS (
  SELECT 1 AS control_order, 'lineitem_grain_unique' AS control_name,
         (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)) AS v, 0 AS e, '==' AS op
  UNION ALL
  SELECT 2, 'order_status_accepted',
         (SELECT COUNT(*) FROM (SELECT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL
                                  AND o_orderstatus NOT IN ({", ".join(_q(s) for s in ACCEPTED_STATUSES)})
                                GROUP BY o_orderstatus)), 0, '=='
  UNION ALL
  SELECT 3, 'order_keys_not_null',
         (SELECT COUNT(*) FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL), 0, '=='
  UNION ALL
  SELECT 4, 'at_most_one_selected_version',
         (SELECT COUNT(*) FROM (SELECT o_custkey FROM versioned GROUP BY o_custkey
                                HAVING COUNT(*) FILTER (WHERE is_selected) > 1)), 0, '=='
  UNION ALL
  SELECT 5, 'line_balance_reconciles',
         (SELECT COUNT(*) FROM ((SELECT * FROM exp EXCEPT SELECT * FROM act)
                                UNION ALL (SELECT * FROM act EXCEPT SELECT * FROM exp))), 0, '=='
  UNION ALL
  SELECT 6, 'population_size', (SELECT COUNT(*) FROM members), {POPULATION_SIZE}, '=='),
cd AS (
  SELECT control_order, control_name, v = e AS passed, op || ' ' || CAST(e AS VARCHAR) AS expected,
         CAST(v AS VARCHAR) AS actual, '' AS detail FROM c
  UNION ALL
  SELECT 7, 'cutoff_gap_positive', COALESCE((SELECT MIN(cutoff_gap) FROM members) > 0, FALSE), '> 0',
         CAST((SELECT MIN(cutoff_gap) FROM members) AS VARCHAR), '')
SELECT * FROM cd
UNION ALL
SELECT 8, 'all_controls_pass', COALESCE(bool_and(passed), FALSE), 'all prior controls pass',
       CAST(COUNT(*) FILTER (WHERE passed) AS VARCHAR) || '/' || CAST(COUNT(*) AS VARCHAR), 'fail-closed roll-up'
FROM cd""",
    "distinct_tuple": """
SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)) AS distinct_customer_status,
       COUNT(DISTINCT o_custkey) AS distinct_customers, COUNT(*) AS order_rows
FROM orders""",
    "metrics_row": f"""
{LINE_BASE}
SELECT (SELECT COUNT(*) FROM lineitem) AS lineitem_rows,
       (SELECT COUNT(*) FROM orders) AS order_rows,
       (SELECT COUNT(DISTINCT {MONTH.format(c='o_orderdate')}) FROM orders) AS order_months,
       (SELECT COUNT(*) FROM lf) AS line_fact_rows,
       (SELECT COUNT(DISTINCT reporting_line_code) FROM lf) AS reporting_lines,
       (SELECT COUNT(DISTINCT c_nationkey) FROM lf) AS members""",
    "idempotent_upsert": """
WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(38,2)) AS amount FROM orders),
b AS (
  SELECT o_orderkey, o_orderstatus,
         CAST(amount + CASE WHEN o_orderkey % 3 = 0 THEN 6 ELSE 1 END AS DECIMAL(38,2)) AS amount
  FROM o WHERE o_orderstatus = 'O'
  UNION ALL SELECT -o_orderkey, o_orderstatus, amount FROM o WHERE o_orderstatus = 'P')
SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL
SELECT * FROM b""",
    "probe_status": f"""
WITH e AS (SELECT event_id, event_type, props, {_probe_code()} AS status_code FROM events)
SELECT event_id, status_code,
       CASE WHEN status_code IN (200, 206) THEN TRUE WHEN status_code = 404 THEN FALSE END AS is_available,
       CAST(NULLIF(trim(CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR)), '') AS BIGINT) AS size_bytes,
       COALESCE(CASE WHEN event_type = 'error' THEN 'connection failed' END,
                CASE WHEN status_code IS NOT NULL AND status_code NOT IN (200, 206, 404)
                     THEN 'HTTP ' || CAST(status_code AS VARCHAR) END) AS error
FROM e""",
    "segment_yoy": f"""
WITH m AS (
  SELECT c.c_mktsegment, {MONTH.format(c='o.o_orderdate')} AS report_month,
         SUM(CAST(o.o_totalprice AS DECIMAL(38,2))) AS amount
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)
SELECT a.c_mktsegment, a.report_month,
       (CAST(a.amount AS DOUBLE) / CAST(p.amount AS DOUBLE) - 1) * 100 AS derived_value
FROM m a LEFT JOIN m p ON a.c_mktsegment = p.c_mktsegment
                      AND p.report_month = CAST(a.report_month - INTERVAL 12 MONTH AS DATE)""",
    "segment_rolling": f"""
WITH {SEGMENT_RATES}
SELECT a.c_mktsegment, a.report_month,
       CASE WHEN COUNT(*) = 12 AND MIN(b.rate) > -100 THEN (list_reduce(list(b.rate / 100 + 1 ORDER BY b.report_month), lambda x, y: x * y) - 1) * 100 END AS derived_value
FROM rates a JOIN rates b ON b.c_mktsegment = a.c_mktsegment AND b.report_month <= a.report_month
                         AND b.report_month > a.report_month - INTERVAL 12 MONTH
GROUP BY 1, 2""",
    "segment_pp": f"""
WITH {SEGMENT_RATES}
SELECT a.c_mktsegment, a.report_month, a.rate - p.rate AS derived_value
FROM rates a LEFT JOIN rates p ON a.c_mktsegment = p.c_mktsegment
                              AND p.report_month = CAST(a.report_month - INTERVAL 1 MONTH AS DATE)""",
    "segment_rate_yoy": f"""
WITH {SEGMENT_RATES}
SELECT a.c_mktsegment, a.report_month, (a.rate / NULLIF(p.rate, 0) - 1) * 100 AS derived_value
FROM rates a LEFT JOIN rates p ON a.c_mktsegment = p.c_mktsegment
                              AND p.report_month = CAST(a.report_month - INTERVAL 12 MONTH AS DATE)""",
    "member_month_shares": f"""
WITH {NATION_MONTH},
t AS (SELECT report_month, SUM(total_amount) AS total FROM nm GROUP BY 1)
SELECT nm.report_month, nm.c_nationkey, nm.total_amount, p.total_amount AS prior_amount,
       {_div('nm.total_amount', 't.total')} AS month_share, (SELECT MAX(total_amount) FROM nm) AS best_amount
FROM nm JOIN t USING (report_month)
LEFT JOIN nm p ON p.c_nationkey = nm.c_nationkey AND p.report_month = CAST(nm.report_month - INTERVAL 1 MONTH AS DATE)""",
    "month_medians": f"""
WITH {NATION_MONTH}
SELECT report_month, median(CAST(total_amount * 100 AS BIGINT)) AS median_cents FROM nm GROUP BY 1""",
    "repeated_order_days": """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS row_count
FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "incomplete_orders": """
SELECT l_orderkey, MAX(l_linenumber) AS declared_row_count, COUNT(*) AS actual_row_count
FROM lineitem GROUP BY 1 HAVING MAX(l_linenumber) <> COUNT(*)""",
    "assets_by_member": f"""
{LINE_BASE},
{MEMBER_LAST}
SELECT vals.c_nationkey, n.n_name, vals.total_assets
FROM vals JOIN nation n ON vals.c_nationkey = n.n_nationkey""",
    "credit_share_by_month": f"""
{LINE_BASE},
mv AS (SELECT lf.report_month, lf.c_nationkey, {_lines()} FROM lf GROUP BY lf.report_month, lf.c_nationkey)
SELECT report_month, c_nationkey, {_div('credit_portfolio', 'total_assets')} AS credit_share,
       strftime(report_month, '%b %Y') AS month_label
FROM mv""",
    "member_slicer": f"""
{LINE_BASE}
SELECT DISTINCT n.n_name FROM lf JOIN nation n ON lf.c_nationkey = n.n_nationkey""",
    "value_by_month": """
SELECT CAST(date_trunc('month', ts) AS DATE) AS report_month, strftime(ts, '%b %Y') AS month_label,
       event_type AS series_code, SUM(CAST(value AS DECIMAL(38,2))) AS macro_value
FROM events GROUP BY 1, 2, 3""",
    "mapping_table": f"""
WITH {MAPPING_FULL_CTE}
SELECT md5(m.p_type || '|' || m.reporting_line_key || '|' || m.mapping_version) AS account_reporting_line_key,
       m.reporting_line_key AS reporting_line_code, m.p_type, m.component_name, m.presentation_multiplier,
       m.mapping_version
FROM mapping m WHERE m.p_type IN (SELECT p_type FROM part)""",
    "account_balance_amount": """
SELECT c.c_nationkey, p.p_type, SUM(CAST(l.l_extendedprice AS DECIMAL(38,2))) AS account_balance_amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY c.c_nationkey, p.p_type""",
    "population_profile": f"""
WITH {ROWS_CTE},
{POPULATION_STATE}
SELECT report_month, COUNT(*) AS members,
       {", ".join(f"COUNT({a}) AS {a}_present" for a in POPULATION_COMPONENTS)},
       SUM(total_amount) AS summed_total_amount
FROM state GROUP BY report_month""",
    "population_members": f"""
WITH {ROWS_CTE},
{POPULATION_STATE},
cand AS (SELECT c_nationkey, total_amount FROM state
         WHERE report_month = DATE '{FREEZE_MONTH}' AND {PRESENCE_COMPONENT} IS NOT NULL),
fr AS (SELECT *, CAST(row_number() OVER (ORDER BY total_amount DESC, c_nationkey) AS INTEGER) AS freeze_rank FROM cand)
SELECT freeze_rank, c_nationkey, total_amount,
       (SELECT MAX(total_amount) FROM fr WHERE freeze_rank = {POPULATION_SIZE})
       - (SELECT MAX(total_amount) FROM fr WHERE freeze_rank = {POPULATION_SIZE + 1}) AS cutoff_gap
FROM fr WHERE freeze_rank <= {POPULATION_SIZE}""",
    "population_history": f"""
WITH {ROWS_CTE},
{POPULATION_STATE},
cand AS (SELECT c_nationkey, total_amount FROM state
         WHERE report_month = DATE '{FREEZE_MONTH}' AND {PRESENCE_COMPONENT} IS NOT NULL),
fr AS (SELECT *, CAST(row_number() OVER (ORDER BY total_amount DESC, c_nationkey) AS INTEGER) AS freeze_rank FROM cand)
SELECT c_nationkey, freeze_rank, COUNT(*) AS periods_present,
       COUNT(*) FILTER (WHERE {" AND ".join(f"{a} IS NOT NULL" for a in POPULATION_COMPONENTS)}) AS component_complete_periods
FROM state JOIN fr USING (c_nationkey) WHERE freeze_rank <= {POPULATION_SIZE} GROUP BY 1, 2""",
    "order_scope": f"""
WITH o AS (SELECT {MONTH.format(c='o_orderdate')} AS report_month, o_custkey, o_orderstatus FROM orders),
listed AS (SELECT * FROM o WHERE o_orderstatus IN ({", ".join(_q(s) for s in ORDER_DOCUMENTS.values())})),
whole AS (SELECT report_month, COUNT(*) AS n FROM (
  SELECT report_month, o_custkey FROM listed GROUP BY 1, 2 HAVING COUNT(DISTINCT o_orderstatus) = {len(ORDER_DOCUMENTS)}) GROUP BY 1),
others AS (SELECT report_month, COUNT(*) AS n FROM (
  SELECT DISTINCT report_month, o_custkey FROM o EXCEPT SELECT report_month, o_custkey FROM listed)
  WHERE o_custkey IS NOT NULL GROUP BY 1)
SELECT o.report_month,
       {", ".join(f"COUNT(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = {_q(s)}) AS {a}_members" for a, s in ORDER_DOCUMENTS.items())},
       COUNT(DISTINCT o_custkey) FILTER (WHERE o_orderstatus IN ({", ".join(_q(s) for s in ORDER_DOCUMENTS.values())})) AS any_members,
       COALESCE(ANY_VALUE(whole.n), 0) AS all_members, COALESCE(ANY_VALUE(others.n), 0) AS unlisted_members,
       COUNT(*) FILTER (WHERE o_custkey IS NULL) AS blank_member_rows
FROM o LEFT JOIN whole USING (report_month) LEFT JOIN others USING (report_month) GROUP BY 1""",
    "table_contract": """
WITH kinds(duck, kind) AS (VALUES ('BIGINT', 'bigint'), ('VARCHAR', 'text'), ('DOUBLE', 'double precision'), ('TIMESTAMP', 'timestamp with time zone')),
held AS (
"""
    + "\nUNION ALL ".join(
        f"SELECT {_q(t)} AS relation, {_q(c)} AS column_name, split_part(ANY_VALUE(typeof({c})), '_', 1) AS duck, COUNT(*) - COUNT({c}) AS nulls FROM {t}"
        for t, cs in {"orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "documents": "doc_id text lang source n_chars"}.items()
        for c in cs.split())
    + """),
places(relation, position, column_name, expected, required, present) AS (VALUES
  ('orders', 1, 'o_orderkey', 'o_orderkey bigint', true, true), ('orders', 2, 'o_custkey', 'o_custkey bigint', true, true),
  ('orders', 3, 'o_orderstatus', 'o_orderstatus text', true, true), ('orders', 4, 'o_totalprice', 'o_totalprice double precision', true, true),
  ('orders', 5, 'o_orderdate', 'o_orderdate timestamp with time zone', false, true), ('orders', 6, 'o_orderpriority', 'missing', false, true),
  ('documents', 1, 'doc_id', 'doc_id bigint', true, true), ('documents', 2, 'text', 'text text', true, true),
  ('documents', 3, 'lang', 'lang text', true, true), ('documents', 4, 'source', 'source text', false, true),
  ('documents', 5, 'n_chars', 'n_chars integer', true, true), ('documents', 6, 'checked', 'checked boolean', true, false)),
found AS (
  SELECT relation, position, column_name, expected, CASE WHEN present THEN column_name || ' ' || kind ELSE 'missing' END AS actual,
         CASE WHEN required AND present THEN nulls END AS null_rows
  FROM places LEFT JOIN held USING (relation, column_name) LEFT JOIN kinds USING (duck))
SELECT *, expected = actual AND COALESCE(null_rows, 0) = 0 AS passed FROM found""",
    "population_control_set": f"""
WITH cam AS (
  SELECT {MONTH.format(c='o.o_orderdate')} AS report_month, o.o_custkey, p.p_type,
         SUM(CAST(l.l_extendedprice AS DECIMAL(38,2))) AS amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2, 3),
rows AS (SELECT cam.report_month, c.c_nationkey, cam.p_type, SUM(cam.amount) AS amount
         FROM cam JOIN customer c ON cam.o_custkey = c.c_custkey GROUP BY 1, 2, 3),
state AS (
  SELECT report_month, c_nationkey,
         {", ".join(f"SUM(amount) FILTER (WHERE p_type = {_q(t)}) AS {a}, COUNT(*) FILTER (WHERE p_type = {_q(t)}) AS {a}_rows" for a, t in POPULATION_COMPONENTS.items())},
         {" + ".join(f"COALESCE(SUM(amount) FILTER (WHERE p_type = {_q(t)}), 0)" for t in POPULATION_COMPONENTS.values())} AS total_amount
  FROM rows GROUP BY report_month, c_nationkey),
cand AS (SELECT c_nationkey, total_amount FROM state
         WHERE report_month = DATE '{FREEZE_MONTH}' AND {PRESENCE_COMPONENT} IS NOT NULL),
fr AS (SELECT *, row_number() OVER (ORDER BY total_amount DESC, c_nationkey) AS freeze_rank FROM cand),
members AS (
  SELECT c_nationkey, (SELECT MAX(total_amount) FROM fr WHERE freeze_rank = {POPULATION_SIZE})
         - (SELECT MAX(total_amount) FROM fr WHERE freeze_rank = {POPULATION_SIZE + 1}) AS cutoff_gap
  FROM fr WHERE freeze_rank <= {POPULATION_SIZE}),
monthly AS (SELECT state.* FROM state JOIN members ON state.c_nationkey = members.c_nationkey),
c AS (
  SELECT 1 AS control_order, 'freeze_period_is_latest' AS control_name,
         COALESCE((SELECT MAX(report_month) FROM state) = DATE '{FREEZE_MONTH}', FALSE) AS passed,
         '== {FREEZE_MONTH}' AS expected, CAST((SELECT MAX(report_month) FROM state) AS VARCHAR) AS actual
  UNION ALL
  SELECT 2, 'relevant_account_rows_are_unique', v = 0, '== 0', CAST(v AS VARCHAR)
  FROM (SELECT COUNT(*) AS v FROM state WHERE greatest({", ".join(f"{a}_rows" for a in POPULATION_COMPONENTS)}) > 1)
  UNION ALL
  SELECT 3, 'population_size', v = {POPULATION_SIZE}, '== {POPULATION_SIZE}', CAST(v AS VARCHAR)
  FROM (SELECT COUNT(*) AS v FROM members)
  UNION ALL
  SELECT 4, 'cutoff_is_unambiguous', COALESCE(v > 0, FALSE), '> 0', CAST(v AS VARCHAR)
  FROM (SELECT MIN(cutoff_gap) AS v FROM members)
  UNION ALL
  SELECT 5, 'stable_population_period_coverage', v = 0, '== 0', CAST(v AS VARCHAR)
  FROM (SELECT COUNT(*) AS v FROM (SELECT c_nationkey FROM monthly GROUP BY c_nationkey
                                   HAVING COUNT(DISTINCT report_month) <> (SELECT COUNT(DISTINCT report_month) FROM state)))
  UNION ALL
  SELECT 6, 'population_components_are_explicit', v = 0, '== 0', CAST(v AS VARCHAR)
  FROM (SELECT COUNT(*) AS v FROM monthly WHERE {" OR ".join(f"{a} IS NULL" for a in POPULATION_COMPONENTS)}))
SELECT control_order, control_name, passed, expected, actual, '' AS detail FROM c
UNION ALL
SELECT 7, 'population_ready', COALESCE(bool_and(passed), FALSE), 'all prior controls pass',
       CAST(COUNT(*) FILTER (WHERE passed) AS VARCHAR) || '/' || CAST(COUNT(*) AS VARCHAR), 'fail-closed roll-up'
FROM c""",
}
