"""Versioned tables, the incremental merge and the rebuild of touched periods."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgermart.sources.versions import Conflict, VersionedTable, history, merge
from ledgermart.streaming.rebuild import core_table, rebuild, start_core_stream
from tests import fixtures as fx
from tests.test_end_to_end import _write_archive


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_equals_a_dictionary(spark, tmp_path):
    rng, path, held = random.Random(4), str(tmp_path / "t"), {}
    for step in range(4):
        batch = [(rng.randrange(60), f"v{rng.randrange(5)}") for _ in range(25)]
        merge(spark, path, spark.createDataFrame(batch, "k int, v string"), "k", buckets=7, batch_id=f"b{step}")
        for k in {k for k, _ in batch}:
            held[k] = max(v for q, v in batch if q == k)
        assert rows_of(VersionedTable(spark, path).read()) == sorted(held.items())
    table = VersionedTable(spark, path)
    log = table.log()
    assert [e["version"] for e in log] == [1, 2, 3, 4]
    assert sum(e["facts"]["inserted"] for e in log) == len(held)
    assert len(rows_of(table.read(version=1))) == log[0]["facts"]["inserted"]  # old versions stay
    assert [r.touched for r in history(table).orderBy("version").collect()][0] == len(log[0]["units"])


def test_merge_touches_only_buckets_that_change(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, path, spark.range(2000).select("id", F.lit("old").alias("v")), "id", buckets=32)
    one = spark.createDataFrame([(5, "new"), (6, "old"), (5, "mid")], "id bigint, v string")
    table = merge(spark, path, one, "id")
    before, after = table.log()
    moved = [u for u in after["units"] if after["units"][u] != before["units"].get(u)]
    assert len(moved) == 1 and after["facts"] == {"inserted": 0, "updated": 1, "touched": 1}
    read = table.read(units=moved).inputFiles()
    assert read and all(f"/_unit={moved[0]}/" in f for f in read)
    # a replay, under its old name or another, writes nothing
    assert merge(spark, path, one, "id", batch_id="x").last()["version"] == 2
    assert len(os.listdir(tmp_path / "t" / "data")) == 2
    assert table.read().filter("v <> 'old'").collect() == [(5, "new")]


def test_merge_refusals(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    merge(spark, path, frame([(1, "a")]), "k")
    with pytest.raises(Exception, match="null key"):
        merge(spark, path, frame([(None, "a")]), "k")
    with pytest.raises(ValueError, match="keyed by"):
        merge(spark, path, frame([(1, "a")]), "v")
    with pytest.raises(Exception):
        merge(spark, path, spark.createDataFrame([(1, 2)], "k int, w int"), "k")
    assert merge(spark, path, frame([]), "k").last()["version"] == 1
    assert rows_of(merge(spark, str(tmp_path / "e"), frame([]), "k").read()) == []
    assert rows_of(merge(spark, str(tmp_path / "e"), frame([(2, None)]), "k").read()) == [(2, None)]
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, str(tmp_path / "none")).read()


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda v: spark.createDataFrame([("a", v)], "u string, v int")
    table = VersionedTable(spark, path)
    table.replace(frame(1), "u", ["a"])
    start = table.last()
    table.replace(frame(2), "u", ["a"], since=start)
    with pytest.raises(Conflict):
        VersionedTable(spark, path).replace(frame(3), "u", ["a"], since=start)
    assert rows_of(table.read()) == [("a", 2)]
    # an entry that a crash cut short is no version
    (tmp_path / "t" / "_log" / "000000000003.json").write_text('{"version": 3, "un')
    assert table.last()["version"] == 2
    with pytest.raises(Conflict):
        table.replace(frame(4), "u", ["a"])
    assert table.repair() == 1 and table.replace(frame(4), "u", ["a"]) == 3
    with pytest.raises(Exception, match="isn't replaced"):
        table.replace(spark.createDataFrame([("b", 1)], "u string, v int"), "u", ["a"])
    assert table.replace(frame(5).limit(0), "u", ["a"]) == 4 and rows_of(table.read()) == []  # a unit without rows goes
    table.vacuum(1)
    assert [e["version"] for e in table.log()] == [4] and rows_of(table.read()) == []


def manifest_of(spark, rows):
    """(period, checksum, status, active)"""
    return spark.createDataFrame([(p, "fixture://x", c, s, dt.date(2025, 4, 1), fx.RETRIEVED, a, True, 12) for p, c, s, a in rows], fx.MANIFEST_SCHEMA)


def test_rebuild_touches_the_period_of_a_late_file(spark, tmp_path):
    landed, core = str(tmp_path / "landed"), str(tmp_path / "core")
    rows = spark.createDataFrame(fx.balance_rows(), fx.BALANCE_SCHEMA)
    rows.write.partitionBy("source_checksum").parquet(landed)
    listed = [("202501", "fixture-202501", "complete", True), ("202502", "fixture-202502", "complete", True)]
    assert rebuild(spark, landed, manifest_of(spark, listed), core, ["202501", "202502"], "b1") == ["202501", "202502"]
    d2, d3 = core_table(spark, core, "account_balance"), core_table(spark, core, "bank_period")
    assert d2.read().count() == 24 and d3.read().count() == 6
    # a restated file of one month
    again = rows.filter("source_period = '202502'").withColumn("source_checksum", F.lit("late")).withColumn("saldo", (F.col("saldo") * 2).cast("decimal(38,2)"))
    again.write.mode("append").partitionBy("source_checksum").parquet(landed)
    listed[1] = ("202502", "fixture-202502", "complete", False)
    listed.append(("202502", "late", "complete", True))
    assert rebuild(spark, landed, manifest_of(spark, listed), core, ["202502"], "b2") == ["202502"]
    assert {(r.source_period, r.source_checksum, r.version) for r in d2.read(version_col="version").select("source_period", "source_checksum", "version").collect()} == {("202501", "fixture-202501", 1), ("202502", "late", 2)}
    assert {r.version for r in d3.read(version_col="version").filter("report_month = '2025-01-01'").collect()} == {1}
    # delivered again: nothing is written
    versions = [core_table(spark, core, n).last()["version"] for n in ("file_manifest", "account_balance", "bank_period")]
    assert rebuild(spark, landed, manifest_of(spark, listed), core, ["202502"], "b2") == []
    assert [core_table(spark, core, n).last()["version"] for n in ("file_manifest", "account_balance", "bank_period")] == versions
    # a file that doesn't win changes the manifest only
    listed.append(("202501", "failed", "incomplete", False))
    assert rebuild(spark, landed, manifest_of(spark, listed), core, ["202501"]) == []
    assert d2.last()["version"] == 2 and core_table(spark, core, "file_manifest").read(units=["202501"]).count() == 2
    # a period that loses its only file has no rows left
    listed[0] = ("202501", "fixture-202501", "incomplete", True)
    assert rebuild(spark, landed, manifest_of(spark, listed), core, ["202501"]) == ["202501"]
    assert {r.source_period for r in d2.read().collect()} == {"202502"} and d3.read().count() == 3


def test_the_stream_keeps_the_core_up_to_date(spark, tmp_path):
    folder, evidence = str(tmp_path / "in"), tmp_path / "manifest.json"
    os.makedirs(folder)
    listed = []

    def deliver(period):
        path, sha, _ = _write_archive(folder, period)
        listed.append({"source_period": period, "source_url": f"fixture://{period}", "source_checksum": sha, "status": "complete", "source_generated_at": "2025-04-01",
                       "retrieved_at_utc": "2025-04-02T00:00:00", "is_active": True, "fixture": True, "row_count": 12})
        evidence.write_text("\n".join(json.dumps(r) for r in listed))

    def run():
        manifest = lambda: spark.read.schema(fx.MANIFEST_SCHEMA).json(str(evidence))
        start_core_stream(spark, folder, str(tmp_path / "landed"), str(tmp_path / "core"), manifest, str(tmp_path / "ck")).awaitTermination(120)
        return {(r.source_period, r.version) for r in core_table(spark, str(tmp_path / "core"), "account_balance").read(version_col="version").collect()}

    deliver("202501")
    assert run() == {("202501", 1)}
    deliver("202502")
    assert run() == {("202501", 1), ("202502", 2)}
    assert run() == {("202501", 1), ("202502", 2)}
