"""Archives → profile → pairing → landing → marts → measures → controls."""

import datetime as dt
import hashlib
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgermart.plans import reports
from ledgermart.plans.controls import mart_controls
from ledgermart.plans.models import build_marts
from ledgermart.sources.archives import land_raw, landing_rows, profile_files, read_archives
from ledgermart.sources.evidence import pair_manifest_profile
from ledgermart.sources.landing import land_partitions
from tests import fixtures as fx

HEADER = "#DATA_BASE;DOCUMENTO;CNPJ;AGENCIA;NOME_INSTITUICAO;COD_CONGL;NOME_CONGL;TAXONOMIA;CONTA;NOME_CONTA;SALDO"


def _write_archive(folder, period):
    lines = ["#Balancetes", f"#Gerado em 10/{int(period[4:]) + 1:02d}/2025", "#Fonte", HEADER]
    for cnpj, name in fx.BANKS.items():
        for acct, value in zip((fx.C1, fx.C2, fx.C3, fx.TG), fx.BALANCES[(period, cnpj)]):
            lines.append(f"{period};4010;{cnpj};;{name};;;BANCOS MULTIPLOS;{acct};{fx.ACCOUNT_NAMES[acct]};"
                         f"{fx._locale(value)}")
    path = os.path.join(folder, f"{period}BANCOS.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(f"{period}BANCOS.CSV", "\r\n".join(lines).encode("cp1252"))
    with open(path, "rb") as fh:
        data = fh.read()
    return path, hashlib.sha256(data).hexdigest(), len(data)


def test_archives_to_certified_marts(spark, tmp_path):
    folder = str(tmp_path / "landing")
    os.makedirs(folder)
    downloads = []
    for period in ("202501", "202502"):
        path, sha, size = _write_archive(folder, period)
        downloads.append((sha, "complete", period, f"fixture://cosif/{period}", "2025-04-01 09:00:00", size, path))
    man = spark.createDataFrame(downloads, "sha256 string, status string, period string, source_url string, "
                                           "retrieved_at_utc string, compressed_bytes long, archive_path string")
    raw = land_raw(read_archives(spark, folder, man))  # checksums re-verified before any row
    paths = man.select(F.concat(F.lit("file:"), "archive_path").alias("source_path"), "period")
    prof = profile_files(raw, paths).withColumn("sha256", F.col("source_checksum")).join(
        man.select("sha256", "source_url", "compressed_bytes"), "sha256")
    paired = pair_manifest_profile(man, prof)
    assert paired.count() == 2
    records = man.select(F.col("sha256").alias("source_checksum"), "period", "source_url", "retrieved_at_utc")
    landed = str(tmp_path / "raw_balance_rows")
    land_partitions(landing_rows(raw, records, prof), landed, "source_checksum")  # land, then build from the table
    rows = spark.read.parquet(landed)
    assert rows.count() == 24

    file_manifest = paired.select(
        F.col("period").alias("source_period"), "source_url", F.col("sha256").alias("source_checksum"),
        F.lit("complete").alias("status"), "source_generated_at", F.col("retrieved_at_utc").cast("timestamp"),
        F.lit(True).alias("is_active"), F.lit(True).alias("fixture"), "row_count")
    frames = fx.frames(spark)
    marts = build_marts(spark, rows, file_manifest, frames["series_metadata"], frames["observations"],
                        frames["mapping_seed"], frames["population_seed"])
    assert marts["fact_reporting_line_balance"].count() == 6
    model = reports.model_from_marts(marts)
    assert float(model.query(["total_assets"]).first().total_assets) == 2470.0
    jan = model.query(["total_assets"], months=("2025-01-01", "2025-01-01")).first()
    assert float(jan.total_assets) == 2400.0
    generated = {r.source_period: r.source_generated_at for r in marts["dim_source_file"].collect()}
    assert generated == {"202501": dt.date(2025, 2, 10), "202502": dt.date(2025, 3, 10)}

    expected_mapping = spark.createDataFrame([(m[0], m[3]) for m in fx.MAPPING],
                                             "reporting_line_key string, account_code string")
    controls = mart_controls(spark, marts, expected_mapping, members=3, months=2, lines=1, series=5, official=False)
    assert [r.control_name for r in controls.collect() if not r.passed] == []
