"""Hand-made balance-domain fixtures (our own values).

Two months × three institutions × four accounts in one document, plus five
monthly series over three months (first-day and month-end dates mixed).
Component values are chosen so that class 1 + class 2 = total − class 3.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

# account codes: class 1, class 2, class 3 (compensation), total general
C1, C2, C3, TG = "1000000009", "2000000008", "3000000007", "3999999009"
BANKS = {"00000001": "BANK ALPHA", "00000002": "BANK BETA", "00000003": "BANK GAMMA"}
# (period, cnpj) -> (class1, class2, class3, total general)
BALANCES = {
    ("202501", "00000001"): ("700.00", "300.00", "40.00", "1040.00"),
    ("202501", "00000002"): ("500.00", "300.00", "0.00", "800.00"),
    ("202501", "00000003"): ("450.00", "150.00", "25.00", "625.00"),
    ("202502", "00000001"): ("720.00", "330.00", "10.00", "1060.00"),
    ("202502", "00000002"): ("480.00", "305.00", "15.00", "800.00"),
    ("202502", "00000003"): ("500.00", "135.00", "5.00", "640.00"),
}
ACCOUNT_NAMES = {C1: "CIRCULANTE E REALIZAVEL", C2: "PERMANENTE", C3: "COMPENSACAO", TG: "TOTAL GERAL DO ATIVO"}
SERIES = ["4189", "433", "24363", "20539", "21082"]

BALANCE_SCHEMA = (
    "source_period string, documento string, cnpj string, agencia string, nome_instituicao string, "
    "cod_congl string, nome_congl string, taxonomia string, conta string, nome_conta string, saldo_raw string, "
    "saldo decimal(38,2), source_url string, source_checksum string, source_generated_at date, "
    "retrieved_at_utc timestamp, file_row_number long"
)
MANIFEST_SCHEMA = (
    "source_period string, source_url string, source_checksum string, status string, source_generated_at date, "
    "retrieved_at_utc timestamp, is_active boolean, fixture boolean, row_count long"
)
META_SCHEMA = (
    "series_code string, theme string, display_name string, official_title string, unit string, frequency string, "
    "source_start_date date, observation_semantics string, monthly_alignment string, derived_metric string, "
    "max_expected_lag_months long, revision_policy string, source_url string, metadata_url string"
)
OBS_SCHEMA = (
    "series_code string, source_observation_date date, report_month string, value_raw string, value decimal(38,10), "
    "retrieved_at_utc timestamp, source_url string, fixture boolean"
)
MAPPING_SCHEMA = (
    "reporting_line_key string, reporting_line_name string, display_order int, account_code string, "
    "component_name string, presentation_multiplier int, mapping_version string, status string, source_url string"
)
POPULATION_SCHEMA = "freeze_period string, freeze_rank int, institution_cnpj string, institution_name string, taxonomy string"

RETRIEVED = dt.datetime(2025, 3, 10, 12, 0, 0)


def _locale(v: str) -> str:
    ip, fp = v.split(".")
    ip = f"{int(ip):,}".replace(",", ".")
    return f"{ip},{fp}"


def balance_rows(skip=(), periods=("202501", "202502")):
    rows = []
    for period in periods:
        checksum = f"fixture-{period}"
        n = 0
        for cnpj, name in BANKS.items():
            vals = BALANCES[(period, cnpj)]
            for acct, v in zip((C1, C2, C3, TG), vals):
                n += 1
                if (period, cnpj, acct) in skip:
                    continue
                rows.append((period, "4010", cnpj, "", name, "", None, "BANCOS MULTIPLOS", acct, ACCOUNT_NAMES[acct],
                             _locale(v), Decimal(v), f"fixture://cosif/{period}", checksum,
                             dt.date(int(period[:4]), int(period[4:]), 1) + dt.timedelta(days=40), RETRIEVED, n))
    return rows


def manifest_rows(periods=("202501", "202502")):
    return [(p, f"fixture://cosif/{p}", f"fixture-{p}", "complete",
             dt.date(int(p[:4]), int(p[4:]), 1) + dt.timedelta(days=40), RETRIEVED, True, True, 12) for p in periods]


def metadata_rows():
    return [(c, "theme", f"Series {c}", f"Official title {c}", "unit", "monthly", dt.date(2000, 1, 1),
             "semantics", "alignment", "Latest level", 1, "replace on revision", f"https://example.invalid/{c}",
             f"https://example.invalid/{c}/meta") for c in SERIES]


def observation_rows():
    rows = []
    for i, c in enumerate(SERIES):
        for m in (1, 2, 3):
            # alternate first-day and month-end native dates
            d = dt.date(2025, m, 1) if (i + m) % 2 else (dt.date(2025, m + 1, 1) - dt.timedelta(days=1))
            v = Decimal(f"{(i + 1) * 0.1 + m * 0.01:.10f}")
            rows.append((c, d, f"2025{m:02d}", str(v), v, RETRIEVED, f"fixture://sgs/{c}", True))
    return rows


# The governed reporting-line mapping (line, account) pairs.
MAPPING = [
    ("total_assets", "Total assets", 1, C1, "Realizable assets", 1),
    ("total_assets", "Total assets", 1, C2, "Permanent assets", 1),
    ("credit_portfolio", "Credit portfolio", 2, "1600000007", "Credit operations", 1),
    ("credit_portfolio", "Credit portfolio", 2, "1700000000", "Leasing operations", 1),
    ("credit_portfolio", "Credit portfolio", 2, "1810000000", "Other credit-granting operations", 1),
    ("deposits", "Deposits", 3, "4100000009", "Deposits", 1),
    ("equity", "Equity", 4, "6000000004", "Equity", 1),
]


def mapping_rows():
    return [(*m, "v1", "certified", "https://example.invalid/mapping") for m in MAPPING]


def population_rows():
    return [("202603", 1, "99999999", "OFFICIAL BANK", "BANCOS MULTIPLOS")]


def frames(spark, balance=None, manifest=None):
    return dict(
        balance_rows=spark.createDataFrame(balance if balance is not None else balance_rows(), BALANCE_SCHEMA),
        file_manifest=spark.createDataFrame(manifest if manifest is not None else manifest_rows(), MANIFEST_SCHEMA),
        series_metadata=spark.createDataFrame(metadata_rows(), META_SCHEMA),
        observations=spark.createDataFrame(observation_rows(), OBS_SCHEMA),
        mapping_seed=spark.createDataFrame(mapping_rows(), MAPPING_SCHEMA),
        population_seed=spark.createDataFrame(population_rows(), POPULATION_SCHEMA),
    )
