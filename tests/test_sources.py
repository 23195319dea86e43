"""Readers, landing and streaming on small hand-made files."""

import datetime as dt
import hashlib
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgermart.sources.archives import landing_rows, member_encoding, profile_files, read_archives
from ledgermart.sources.catalog import active_files, classify_probes, read_catalog
from ledgermart.sources.evidence import derive_manifest, load_contract, read_typed_csv, summarise_runs
from ledgermart.sources.landing import assert_schema, land_partitions, SchemaDrift, upsert
from ledgermart.sources.series import derive_fetches, read_series, registry_violations
from ledgermart.streaming.landing import start_landing_stream

HEADER = "#DATA_BASE;DOCUMENTO;CNPJ;AGENCIA;NOME_INSTITUICAO;COD_CONGL;NOME_CONGL;TAXONOMIA;CONTA;NOME_CONTA;SALDO"


def make_zip(path, period, rows, malformed=False, encoding="cp1252"):
    lines = ["#Balancetes e balanços", "#Data de geração: 15/03/2025", "#Fonte: teste", HEADER]
    for cnpj, acct, saldo in rows:
        lines.append(f"{period};4010;{cnpj};;BANCO AÇÚCAR;;;BANCOS MULTIPLOS;{acct};ATIVO;{saldo}")
    lines.insert(6, "")  # a blank record keeps its number
    if malformed:
        lines.append(f"{period};4010;00000001;1")
    data = "\r\n".join(lines).encode(encoding)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(f"{period}BANCOS.CSV", data)
    with open(path, "rb") as fh:
        return hashlib.sha256(fh.read()).hexdigest()


ROWS = [("00000001", "1000000009", "1.234,56"), ("00000001", "2000000008", "10,00"), ("00000002", "1000000009", "0,01")]


def test_archive_scan_profile_and_landing(spark, tmp_path):
    d = tmp_path / "arch"
    d.mkdir()
    sha = make_zip(str(d / "202501BANCOS.zip"), "202501", ROWS)
    raw = read_archives(spark, str(d))
    prof = profile_files(raw, spark.createDataFrame([(f"file:{d}/202501BANCOS.zip", "202501")],
                                                    "source_path string, period string")).first()
    assert prof.source_checksum == sha
    assert prof.encoding == "cp1252"
    assert prof.header_line_number == 4 and prof.metadata_line_count == 3
    assert (prof.row_count, prof.malformed_row_count) == (3, 0)
    assert (prof.institution_count, prof.account_count, prof.document_count) == (2, 2, 1)
    assert prof.declared_periods == "202501" and prof.period_matches
    assert prof.source_generated_at == dt.date(2025, 3, 15)
    records = spark.createDataFrame([(sha, "202501", "https://example.invalid/202501BANCOS.csv.zip",
                                      "2025-03-20 10:00:00")],
                                    "source_checksum string, period string, source_url string, retrieved_at_utc string")
    rows = landing_rows(raw, records).orderBy("file_row_number").collect()
    assert [r.file_row_number for r in rows] == [1, 2, 4]  # blank record 3 skipped, numbering kept
    assert str(rows[0].saldo) == "1234.56" and rows[0].agencia is None
    assert rows[0].nome_instituicao == "BANCO AÇÚCAR"


def test_malformed_row_is_profiled_and_blocks_landing(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    sha = make_zip(str(d / "202502BANCOS.zip"), "202502", ROWS, malformed=True)
    raw = read_archives(spark, str(d))
    assert profile_files(raw).first().malformed_row_count == 1
    records = spark.createDataFrame([(sha, "202502", "u", "2025-03-20 10:00:00")],
                                    "source_checksum string, period string, source_url string, retrieved_at_utc string")
    with pytest.raises(Exception, match="changed shape"):
        landing_rows(raw, records).collect()


def test_checksum_mismatch_fails(spark, tmp_path):
    d = tmp_path / "sum"
    d.mkdir()
    make_zip(str(d / "202501BANCOS.zip"), "202501", ROWS)
    manifest = spark.createDataFrame([(f"{d}/202501BANCOS.zip", "0" * 64)], "archive_path string, sha256 string")
    with pytest.raises(Exception, match="checksum mismatch"):
        read_archives(spark, str(d), manifest).count()


def test_encoding_detection():
    assert member_encoding(["AÇÚCAR".encode("utf-8")]) == "utf-8-sig"
    assert member_encoding(["AÇÚCAR".encode("cp1252")]) == "cp1252"
    # a character cut by a chunk's end, and a byte far behind that only one encoding has
    cut = ("x" * 65535 + "É").encode("utf-8")
    assert member_encoding([cut[:65536], cut[65536:]]) == "utf-8-sig"
    assert member_encoding([b"x" * (1 << 20), b"\xc9"]) == "cp1252"
    assert member_encoding([b"x" * (1 << 20), b"\x81"]) == "iso-8859-1"


def test_catalog_versions_and_errors(spark, tmp_path):
    payload = {"conteudo": [
        {"Titulo": "Bancos 202501", "DataDocumento": "2025-03-01", "Url": "/content/202501BANCOS.ZIP"},
        {"Titulo": "Bancos 202501 rev", "DataDocumento": "2025-04-01", "Url": "/content/202501BANCOS.zip.csv.zip"},
        {"Titulo": "Other", "Url": "/content/readme.pdf"},
        "not an object",
        {"Nome": " Bancos 202502 ", "DataPublicacao": "2025-04-10", "Url": "https://x.invalid/a/202502BANCOS.csv"},
    ]}
    p = tmp_path / "catalog.json"
    p.write_text(json.dumps(payload))
    cat = read_catalog(spark, str(p), "2025-05-01T00:00:00Z")
    rows = {(r.period, r.period_version): r for r in cat.collect()}
    assert rows[("202501", 1)].is_active is False and rows[("202501", 2)].is_active is True
    assert rows[("202501", 1)].source_url == "https://www.bcb.gov.br/content/202501BANCOS.ZIP"
    assert rows[("202502", 1)].title == "Bancos 202502"
    errors = sorted(r.error for r in cat.filter("period is null").collect())
    assert errors == ["Catalog item is not an object", "Unrecognized or missing bank file URL"]
    assert active_files(cat).count() == 2


def test_series_json(spark, tmp_path):
    good = tmp_path / "433.json"
    good.write_text(json.dumps([{"data": "31/01/2025", "valor": "0,16"}, {"data": "01/02/2025", "valor": "1.31"}]))
    obs = read_series(spark, str(good)).orderBy("source_observation_date").collect()
    assert [o.report_month for o in obs] == ["202501", "202502"]
    assert str(obs[0].value) == "0.1600000000" and obs[0].series_code == "433"
    bad = tmp_path / "bad" / "4189.json"
    bad.parent.mkdir()
    bad.write_text(json.dumps([{"data": "31/01/2025", "valor": "NaN"}]))
    with pytest.raises(Exception, match="non-finite"):
        read_series(spark, str(bad)).collect()
    lenient = read_series(spark, str(bad), strict=False).first()
    assert lenient.value is None and lenient.error
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "433.json").write_text(json.dumps([{"data": "31/01/2025", "valor": "0,16"}]))
    (empty / "4189.json").write_text("[]")
    with pytest.raises(Exception, match="without observations"):
        read_series(spark, str(empty)).collect()


def test_series_profile_flags_gap_and_duplicate(spark):
    from ledgermart.operators.calendar import profile_series
    obs = spark.createDataFrame([
        ("433", dt.date(2025, 1, 31)), ("433", dt.date(2025, 1, 1)), ("433", dt.date(2025, 3, 31)),
        ("24363", dt.date(2025, 1, 1)), ("24363", dt.date(2025, 2, 1)), ("24363", dt.date(2025, 3, 1)),
    ], "series_code string, d date")
    reg = spark.createDataFrame([("433", 1), ("24363", 1), ("21082", 1)], "series_code string, lag long")
    prof = {r.series_code: r for r in profile_series(obs, "series_code", "d", "2025-01-01", "2025-03-31", "lag", reg).collect()}
    assert prof["433"].status == "invalid"
    assert prof["433"].internal_missing_months == "202502" and prof["433"].duplicate_report_month_count == 1
    assert prof["24363"].status == "complete" and prof["24363"].lag_months_to_requested_end == 0
    assert prof["21082"].status == "error"


def test_registry_rules(spark):
    cols = ("series_code theme display_name official_title unit frequency source_start_date observation_semantics "
            "monthly_alignment derived_metric max_expected_lag_months revision_policy source_url metadata_url").split()
    base = ["t", "d", "o", "u", "monthly", "2000-01-01", "s", "a", "m", "1", "r", "https://a", "https://b"]
    rows = [[c] + base for c in ("4189", "433", "24363", "20539")]
    rows.append(["9999"] + base[:4] + ["daily"] + base[5:])
    reg = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    problems = {(r.series_code, r.problem) for r in registry_violations(reg).collect()}
    assert ("21082", "code missing") in problems and ("9999", "code unexpected") in problems
    assert ("9999", "not monthly") in problems


def test_typed_csv_duplicates_and_manifest(spark, tmp_path):
    p = tmp_path / "rows.csv"
    p.write_text("source_period,source_url,source_checksum,v\n202501,u1,c1,\n202501,u1,c1,2\n")
    schema = "source_period string, source_url string, source_checksum string, v int"
    df = read_typed_csv(spark, str(p), schema)
    assert df.filter("v is null").count() == 1
    with pytest.raises(Exception, match="duplicate identity"):
        read_typed_csv(spark, str(p), schema, key="source_checksum").collect()
    rows = df.withColumns({"source_generated_at": F.lit(None).cast("date"), "retrieved_at_utc": F.lit(None)})
    assert derive_manifest(rows).first().row_count == 2


def test_fetches_and_probes(spark):
    obs = spark.createDataFrame([("433", dt.date(2025, 1, 31), None), ("433", dt.date(2025, 3, 31), None)],
                                "series_code string, source_observation_date date, retrieved_at_utc timestamp")
    f = derive_fetches(obs, fixture=True).first()
    assert (f.requested_start_date, f.requested_end_date, f.response_count) == (
        dt.date(2025, 1, 31), dt.date(2025, 3, 31), 2)
    log = spark.createDataFrame([(200, None, "10"), (206, "bytes 0-0/999", None), (404, None, None), (500, None, None)],
                                "status_code int, content_range string, content_length string")
    got = [(r.is_available, r.size_bytes, r.error) for r in classify_probes(log).orderBy("status_code").collect()]
    assert got == [(True, 10, None), (True, 999, None), (False, None, None), (None, None, "HTTP 500")]


def test_upsert_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upsert(spark, target, batch, "k")
    upsert(spark, target, batch, "k")
    assert spark.read.parquet(target).count() == 2
    upsert(spark, target, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), "k")
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_partition_landing_and_schema_freeze(spark, tmp_path):
    from pyspark.sql import types as T
    target = str(tmp_path / "p")
    b = spark.createDataFrame([("c1", 1), ("c1", 2), ("c2", 3)], "source_checksum string, n int")
    land_partitions(b, target, "source_checksum")
    land_partitions(b.filter("source_checksum = 'c1'"), target, "source_checksum")
    assert spark.read.parquet(target).count() == 3
    with pytest.raises(SchemaDrift):
        assert_schema(b, T.StructType([T.StructField("n", T.IntegerType()), T.StructField("source_checksum", T.StringType())]))


def test_contract_and_run_log(spark, tmp_path):
    c = tmp_path / "c.yml"
    c.write_text("objects:\n  - name: dim_x\n    primary_key: [k]\n    columns:\n"
                 "      - {name: k, type: text, nullable: false}\n      - {name: n, type: 'numeric(38,2)', nullable: true}\n")
    contract = load_contract(str(c))
    assert contract["dim_x"]["required"] == ["k"]
    assert contract["dim_x"]["schema"].fields[1].dataType.simpleString() == "decimal(38,2)"
    log = tmp_path / "run.json"
    log.write_text(json.dumps({"results": [{"unique_id": "model.p.a", "status": "success"},
                                           {"unique_id": "test.p.b", "status": "pass"},
                                           {"unique_id": "test.p.c", "status": "fail"}]}))
    got = {(r.resource_type, r.status): (r["count"], r.is_failure) for r in summarise_runs(spark, str(log)).collect()}
    assert got == {("model", "success"): (1, False), ("test", "pass"): (1, False), ("test", "fail"): (1, True)}


def test_streaming_landing_replay_is_idempotent(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    sha = make_zip(str(land / "202501BANCOS.zip"), "202501", ROWS)
    records = spark.createDataFrame([(sha, "202501", "u", "2025-03-20 10:00:00")],
                                    "source_checksum string, period string, source_url string, retrieved_at_utc string")
    target = str(tmp_path / "landed")
    q = start_landing_stream(spark, str(land), target, records, str(tmp_path / "ck1"))
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 3
    # a replay of the same file (fresh stream state) rewrites the same partition
    q = start_landing_stream(spark, str(land), target, records, str(tmp_path / "ck2"))
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 3


def test_write_table_swaps_snapshot_and_run_log_by_status(spark, tmp_path):
    from ledgermart.sources.landing import mart, write_table
    target = str(tmp_path / "mart")
    write_table(spark.createDataFrame([(1,)], "a int"), target)
    write_table(spark.createDataFrame([(2,), (3,)], "a int"), target)
    assert sorted(r.a for r in mart(spark, target).collect()) == [2, 3]
    assert not [p for p in os.listdir(tmp_path) if p.startswith("mart.__")]  # no leftovers
    log = tmp_path / "run.json"
    log.write_text(json.dumps({"results": [{"unique_id": "model.p.a", "status": "success"},
                                           {"unique_id": "test.p.b", "status": "success"}]}))
    got = [(r.status, r["count"]) for r in summarise_runs(spark, str(log), by_kind=False).collect()]
    assert got == [("success", 2)]


def test_landing_checks_profile_row_count(spark, tmp_path):
    d = tmp_path / "drift"
    d.mkdir()
    sha = make_zip(str(d / "202501BANCOS.zip"), "202501", ROWS)
    raw = read_archives(spark, str(d))
    records = spark.createDataFrame([(sha, "202501", "u", "2025-03-20 10:00:00")],
                                    "source_checksum string, period string, source_url string, retrieved_at_utc string")
    prof = profile_files(raw)
    assert landing_rows(raw, records, prof).count() == 3
    drifted = prof.withColumn("row_count", F.col("row_count") + 1)
    with pytest.raises(Exception, match="row count differs"):
        landing_rows(raw, records, drifted).collect()


# --- guards on empty or unlisted input ---------------------------------------


def _records(spark, rows):
    return spark.createDataFrame(rows, "source_checksum string, period string, source_url string, retrieved_at_utc string")


def test_unlisted_and_absent_archives_are_refused(spark, tmp_path):
    d = tmp_path / "guards"
    d.mkdir()
    make_zip(str(d / "202501BANCOS.zip"), "202501", ROWS)
    raw = read_archives(spark, str(d))
    checksum = raw.first().source_checksum
    with pytest.raises(Exception, match="archive without a record"):
        landing_rows(raw, _records(spark, [])).collect()
    both = [(checksum, "202501", "u", "2025-03-01"), ("absent", "202502", "u", "2025-03-01")]
    with pytest.raises(Exception, match="record without an archive"):
        landing_rows(raw, _records(spark, both)).collect()
    assert landing_rows(raw, _records(spark, both), all_records=False).count() == len(ROWS)


def test_header_only_archive_has_a_profile(spark, tmp_path):
    d = tmp_path / "bare"
    d.mkdir()
    make_zip(str(d / "202501BANCOS.zip"), "202501", [])
    profile = profile_files(read_archives(spark, str(d))).collect()
    assert [(p.row_count, p.account_count, p.declared_periods) for p in profile] == [(0, 0, "")]


def test_guards_fire_without_rows(spark, tmp_path):
    from ledgermart.sources.series import REGISTRY_COLUMNS, pair_series, read_registry

    lone = tmp_path / "433.json"
    lone.write_text("[]")
    with pytest.raises(Exception, match="without observations"):
        read_series(spark, str(lone)).collect()
    bare = tmp_path / "registry.csv"
    bare.write_text(",".join(REGISTRY_COLUMNS) + "\n")
    with pytest.raises(Exception, match="violates its rules"):
        read_registry(spark, str(bare)).collect()
    other = tmp_path / "catalog.json"
    other.write_text(json.dumps({"items": []}))
    with pytest.raises(Exception, match="without a list of items"):
        read_catalog(spark, str(other)).collect()
    inactive = spark.createDataFrame([("202501", False)], "period string, is_active boolean")
    with pytest.raises(Exception, match="exactly one active"):
        active_files(inactive).collect()
    with pytest.raises(Exception, match="exactly one active"):
        active_files(inactive.limit(0)).collect()
    registry = spark.createDataFrame([("433",)], "series_code string")
    profiles = spark.createDataFrame([("433", "complete", 1)], "series_code string, status string, row_count long")
    stamp = dt.datetime(2025, 4, 1)
    rows = [("433", dt.date(2025, 1, 31), stamp)]
    schema = "series_code string, source_observation_date date, retrieved_at_utc timestamp"
    for bad in ([], rows + rows, rows + [("999", dt.date(2025, 1, 31), stamp)]):
        with pytest.raises(Exception, match="does not pair"):
            pair_series(registry, spark.createDataFrame(bad, schema), profiles, "2025-01-01", "2025-01-31")[1].collect()
    moved = spark.createDataFrame([(*rows[0], "202502")], schema + ", report_month string")
    with pytest.raises(Exception, match="does not pair"):
        pair_series(registry, moved, profiles, "2025-01-01", "2025-01-31")[1].collect()


def test_publish_restores_the_old_table(tmp_path):
    from ledgermart.sources.landing import swap_in

    class Disk:
        """A file system whose rename onto ``blocked`` fails."""

        def __init__(self, names, blocked=()):
            self.names, self.blocked = set(names), set(blocked)

        def exists(self, p):
            return p in self.names

        def rename(self, a, b):
            if (a, b) in self.blocked:
                return False
            self.names = self.names - {a} | {b}
            return True

        def delete(self, p, _):
            self.names.discard(p)

    good = Disk({"t", "new"})
    swap_in(good, "new", "t", "old")
    assert good.names == {"t"}
    for blocked in ([("t", "old")], [("new", "t")]):
        disk = Disk({"t", "new"}, blocked)
        with pytest.raises(OSError, match="cannot"):
            swap_in(disk, "new", "t", "old")
        assert disk.names == {"t", "new"}


def test_batch_keys_land_once(spark):
    from ledgermart.sources.landing import upsert_frames

    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, v string")
    once = upsert_frames(target, batch, "k")
    assert sorted(map(tuple, once.collect())) == [(1, "y"), (2, "b"), (3, "z")]
    assert sorted(map(tuple, upsert_frames(once, batch, "k").collect())) == [(1, "y"), (2, "b"), (3, "z")]


def test_derivations_with_zero_and_impossible_values(spark):
    from ledgermart.operators.calendar import derive_series

    months = [dt.date(2024 + i // 12, i % 12 + 1, 1) for i in range(14)]
    rates = [0.0] + [1.0] * 11 + [2.0, -150.0]
    df = spark.createDataFrame([("s", m, v) for m, v in zip(months, rates)], "s string, m date, v double")
    yoy = {r.m: r.derived_value for r in derive_series(df, "s", "m", "v", "yoy_pct").collect()}
    assert yoy[months[12]] is None and yoy[months[13]] == pytest.approx(-15100.0)
    rolling = {r.m: r.derived_value for r in derive_series(df, "s", "m", "v", "rolling_12m").collect()}
    assert rolling[months[11]] == pytest.approx((1.01**11 - 1) * 100)
    assert rolling[months[10]] is None and rolling[months[13]] is None
    step = {r.m: r.derived_value for r in derive_series(df, "s", "m", "v", "pp_change").collect()}
    assert step[months[0]] is None and step[months[13]] == -152.0
