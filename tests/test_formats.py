"""The file formats: planning, pruning, refusals, round trips, commits."""

import hashlib
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, StringStartsWith

from ledgermart.sources import formats
from ledgermart.sources.archives import read_archives

COLUMNS = "#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;NOME_CONTA;SALDO"


def archive(folder, name, lines, encoding="cp1252", members=1):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w") as z:
        for i in range(members):
            z.writestr(f"m{i}.csv", "\r\n".join(lines).encode(encoding))
    with open(path, "rb") as f:
        return path, hashlib.sha256(f.read()).hexdigest()


def manifest(path, rows):
    with open(path, "w") as f:
        f.writelines(json.dumps(dict(zip(("archive_path", "sha256", "period"), r))) + "\n" for r in rows)
    return str(path)


def body(period, n):
    return ["#Balancetes", "#Gerado em 10/02/2025", COLUMNS, *[f"{period};4010;{i:08d};AÇÃO;1;n;{i},5" for i in range(n)], "", ";;;;;;"]


def test_archive_scan_equals_the_binary_file_reader(spark, tmp_path):
    folder = str(tmp_path / "z")
    archive(folder, "202501BANCOS.zip", body("202501", 5))
    archive(folder, "202502BANCOS.ZIP", body("202502", 3), "utf-8-sig")
    archive(folder + "/deeper", "202503.zip", ["nothing"])
    archive(folder, "202504.zip", body("202504", 1), members=2)
    archive(folder, "_hidden.zip", body("202505", 1))
    with open(folder + "/202506.zip", "wb") as f:
        f.write(b"no zip")
    got = formats.scan_archives(spark, folder)
    other = read_archives(spark, folder + "/*.*").unionByName(read_archives(spark, folder + "/deeper"))
    other = other.filter(~F.col("source_path").contains("_hidden")).withColumn("source_path", F.regexp_replace("source_path", "^file:", ""))
    assert got.drop("period").exceptAll(other).isEmpty() and other.exceptAll(got.drop("period")).isEmpty()
    errors = {r.period: r.error for r in got.filter("error is not null").collect()}
    assert set(errors) == {"202503", "202504", "202506"} and "2 CSV members" in errors["202504"]
    assert {r.encoding for r in got.filter("file_row_number = 1").collect()} == {"cp1252", "utf-8-sig"}


def test_a_period_filter_leaves_other_archives_unread(spark, tmp_path):
    folder = str(tmp_path / "z")
    for period in ("202501", "202502", "202503"):
        archive(folder, f"{period}BANCOS.zip", body(period, 2))
    path, _ = archive(folder, "202504BANCOS.zip", body("202504", 2))
    listed = manifest(tmp_path / "m.json", [(f"{folder}/{p}BANCOS.zip", hashlib.sha256(open(f"{folder}/{p}BANCOS.zip", "rb").read()).hexdigest(), p) for p in ("202501", "202502", "202503")] + [(path, "0" * 64, "202504")])
    got = formats.scan_archives(spark, folder, listed)
    # the archive whose checksum is wrong isn't opened
    assert got.filter("period < '202504' and file_row_number = 1").count() == 3
    assert got.filter("period = '202502'").filter("file_row_number is not null").count() == 2  # blank records give no row
    with pytest.raises(Exception, match="checksum mismatch"):
        got.count()
    reader = formats.ArchiveReader({"path": folder, "manifest": listed})
    kept = [EqualTo(("period",), "202501"), EqualTo(("member_name",), "x"), GreaterThanOrEqual(("period",), "202501"), StringStartsWith(("period",), "2025")]
    assert list(reader.pushFilters(kept)) == kept and len(reader.tests) == 3
    assert [len(p.files) for p in reader.partitions()] == [1]


def test_manifest_refusals(spark, tmp_path):
    folder = str(tmp_path / "z")
    path, sha = archive(folder, "202501BANCOS.zip", body("202501", 2))
    other, _ = archive(folder, "202502BANCOS.zip", body("202502", 2))
    with pytest.raises(Exception, match="unlisted archive"):
        formats.scan_archives(spark, folder, manifest(tmp_path / "a.json", [(path, sha, "202501")])).count()
    with pytest.raises(Exception, match="is absent"):
        formats.scan_archives(spark, folder, manifest(tmp_path / "b.json", [(path, sha, "202501"), (other, "0", "202502"), (folder + "/x.zip", "0", "202503")])).count()
    with pytest.raises(Exception, match="no such file"):
        formats.scan_archives(spark, str(tmp_path / "nowhere")).count()
    os.makedirs(tmp_path / "bare")
    assert formats.scan_archives(spark, str(tmp_path / "bare")).count() == 0


def test_plan_spreads_files_by_bytes():
    files = [(f"f{i}", 1 << 20, {}) for i in range(30)] + [("large", 200 << 20, {})]
    plan = formats.packed(files, 64 << 20, 4)
    assert len(plan) == 5  # 260 MiB and what opening costs, in 64 MiB each
    assert sorted(p for part in plan for p, _ in part.files) == sorted(f[0] for f in files)
    alone = next(part for part in plan if ("large", {}) in part.files)
    assert len(alone.files) == 1
    rest = [len(part.files) for part in plan if part is not alone]
    assert max(rest) - min(rest) <= 1
    assert len(formats.packed(files[:3], 64 << 20, 8)) == 3 and formats.packed([], 64 << 20, 8) == []


def test_archive_round_trip(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"2025{m:02d}", i, f"é;\"{i}\nx") for m in range(1, 13) for i in range(40)], "p string, i int, t string")
    fields = ["p", F.lit("4010"), F.lit("1"), "t", F.lit("2"), F.lit(None).cast("string"), F.col("i").cast("string")]
    write = lambda mode: formats.write_archives(rows, folder, F.concat("p", F.lit("BANCOS.zip")), fields, ["i"], COLUMNS, mode=mode)
    write("append")
    assert sorted(os.listdir(folder)) == [f"2025{m:02d}BANCOS.zip" for m in range(1, 13)]
    got = formats.scan_archives(spark, folder).filter("file_row_number is not null").collect()
    assert sorted((r.period, int(r.fields[6]), r.fields[3], r.file_row_number, r.fields[5]) for r in got) == [(f"2025{m:02d}", i, f"é;\"{i}\nx", i + 1, "") for m in range(1, 13) for i in range(40)]
    with pytest.raises(Exception, match="there already"):
        write("append")
    assert not [f for f in os.listdir(folder) if f.startswith("_staging")]  # the failed job's files are gone
    write("overwrite")
    assert formats.scan_archives(spark, folder).count() == 12 * 41


def test_json_formats(spark, tmp_path):
    folder = tmp_path / "c"
    folder.mkdir()
    good = {"Titulo": "T", "Url": "/x/202501BANCOS.ZIP", "DataDocumento": "2025-02-01"}
    (folder / "a.json").write_text(json.dumps({"conteudo": [good, "text", None, 7, {**good, "DataDocumento": "2025-03-01"}]}))
    got = {r.item_index: r for r in formats.scan_catalog(spark, str(folder)).collect()}
    assert [(got[i].period, got[i].is_active, got[i].error) for i in range(5)] == [
        ("202501", False, None), (None, None, "Catalog item is not an object"), (None, None, "Catalog item is not an object"),
        (None, None, "Catalog item is not an object"), ("202501", True, None)]
    (folder / "b.json").write_text("[]")
    with pytest.raises(Exception, match="without a list of items"):
        formats.scan_catalog(spark, str(folder)).count()

    series = tmp_path / "s"
    series.mkdir()
    (series / "433.json").write_text(json.dumps([{"data": "01/01/2025", "valor": "0,16"}, {"data": "31/02/2025", "valor": "1"}, {"data": "01/03/2025", "valor": "NaN"}, 5]))
    (series / "11.json").write_text(json.dumps([{"data": "01/01/2025", "valor": "2.5"}]))
    loose = formats.scan_series(spark, str(series), strict=False)
    assert sorted((r.series_code, r.report_month or "", str(r.value), r.error) for r in loose.collect() if r.series_code == "433") == [
        ("433", "", "1.0000000000", "invalid date"), ("433", "", "None", "invalid shape"), ("433", "202501", "0.1600000000", None), ("433", "202503", "None", "non-finite or invalid value")]
    # the filter's file alone is opened, so the other one's errors don't show
    assert formats.scan(spark, "ledger_series", str(series)).filter("series_code = '11'").count() == 1
    with pytest.raises(Exception, match="invalid"):
        formats.scan_series(spark, str(series)).collect()
    (series / "433.json").write_text("[]")
    with pytest.raises(Exception, match="without observations"):
        formats.scan_series(spark, str(series)).collect()
    (series / "433.json").write_text("{")
    with pytest.raises(Exception, match="not JSON"):
        formats.scan(spark, "ledger_series", str(series)).count()


def test_reads_of_one_frame_plan_for_themselves(spark, tmp_path):
    folder = str(tmp_path / "z")
    for period in ("202501", "202502"):
        archive(folder, f"{period}BANCOS.zip", body(period, 2))
    got = formats.scan_archives(spark, folder)
    records = got.filter("file_row_number is not null")
    assert [records.filter("period = '202501'").count(), records.count(), records.filter("period = '202502'").count(), got.count()] == [2, 4, 2, 6]


def test_writers_take_files_across_batches(spark, tmp_path):
    folder, before = str(tmp_path / "out"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = spark.range(50).selectExpr("concat(id % 3, '.zip') f", "id", "string(id) s", "if(id % 5 = 0, null, concat('a;', id)) t")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        formats.write_archives(rows, folder, F.col("f"), ["s", "t"], ["id"], COLUMNS)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for i in range(3):
        with zipfile.ZipFile(f"{folder}/{i}.zip") as z:
            lines = z.read(f"{i}.CSV").decode().splitlines()
        assert lines[1:] == [f"{k};" + ("" if k % 5 == 0 else f'"a;{k}"') for k in range(i, 50, 3)]
