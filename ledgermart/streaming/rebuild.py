"""Keep D1 and D2 up to date after each landed batch, for the touched periods only.

A late or restated file concerns one period.  After a micro-batch is landed,
D1 (which version of a file counts) is recomputed for the periods of its files;
D2, and what is derived from it period by period, is rewritten only for periods
whose selected file is another one than before.  The tables are versioned by
period (``sources.versions``): other periods' files are neither read nor
written, readers see a version whole, and the log tells which batch wrote a
period.  A batch that is delivered again finds its number in the log, or
selects the same files, and changes nothing.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermart.plans import models
from ledgermart.session import checkpoint_dir, cut_lineage
from ledgermart.sources.versions import VersionedTable
from ledgermart.streaming.landing import BINARY_FILE_SCHEMA, landing_batch

#: Models with rows of one period each, made from D2 rows of that period.
DERIVED: dict[str, Callable[[DataFrame], DataFrame]] = {"bank_period": models.build_bank_period}


def core_table(spark: SparkSession, core: str, name: str) -> VersionedTable:
    return VersionedTable(spark, os.path.join(core, name))


def rebuild(spark: SparkSession, landed: str, manifest: DataFrame, core: str, periods, batch: str | None = None,
            derived: dict[str, Callable[[DataFrame], DataFrame]] = DERIVED) -> list[str]:
    """Bring the core tables under ``core`` up to date for ``periods``; the periods whose balances were rewritten.

    ``landed``: raw balance rows partitioned by source_checksum; ``manifest``: the raw file
    manifest, of which only rows of these periods count.
    """
    periods = sorted(set(periods))
    d1, d2 = core_table(spark, core, "file_manifest"), core_table(spark, core, "account_balance")
    if not periods:
        return []
    known = models.stg_file_manifest(manifest.filter(F.col("source_period").isin(periods)))
    chosen = cut_lineage(models.build_cosif_file_manifest(known))
    after = {r["source_period"]: r["source_checksum"] for r in chosen.filter("is_selected").select("source_period", "source_checksum").collect()}  # one row a period
    # what D2 holds is told by its own log: it may be a step behind D1 after a crash
    held = ((d2.last() or {}).get("settings") or {}).get("selected", {})
    moved = [p for p in periods if held.get(p) != after.get(p)]
    if moved:
        # partition pruning: the folders of the selected files alone
        rows = spark.read.parquet(landed).filter(F.col("source_checksum").isin([after[p] for p in moved if p in after]))
        balance = models.build_account_balance(models.stg_balance_rows(rows), chosen)
        settings = {"selected": {**held, **{p: after.get(p) for p in moved}}}
        for name, build in derived.items():
            # before D2, whose log says that the periods are done
            table = core_table(spark, core, name)
            month = F.date_format("report_month", "yyyyMM")
            table.replace(build(balance), month, moved, batch)
        d2.replace(balance, "source_period", moved, batch, settings)
    if d1.last() is None or moved or _differs(d1, chosen, periods):
        d1.replace(chosen, "source_period", periods, batch)
    return moved


def _differs(table: VersionedTable, rows: DataFrame, periods) -> bool:
    held = table.read(units=periods)
    return not (rows.select(*held.columns).exceptAll(held).isEmpty() and held.exceptAll(rows.select(*held.columns)).isEmpty())


def start_core_stream(spark: SparkSession, landing_dir: str, landed: str, core: str, manifest: Callable[[], DataFrame],
                      checkpoint_location: str | None = None, available_now: bool = True,
                      derived: dict[str, Callable[[DataFrame], DataFrame]] = DERIVED) -> StreamingQuery:
    """Land new archives and keep the core tables up to date.

    ``manifest`` reads the current raw file manifest (source_period, source_url, source_checksum,
    status, source_generated_at, retrieved_at_utc, is_active, row_count, fixture).
    """
    ckpt = checkpoint_location or os.path.join(checkpoint_dir(spark), "ledgermart", "core-stream")

    def step(files: DataFrame, number: int) -> None:
        now = cut_lineage(manifest())
        records = now.select("source_checksum", F.col("source_period").alias("period"), "source_url", "retrieved_at_utc")
        landing_batch(files, records, landed)
        seen = files.select(F.sha2("content", 256).alias("source_checksum")).distinct()
        periods = [r["period"] for r in records.join(seen, "source_checksum", "left_semi").select("period").distinct().collect()]  # the batch's files at most
        rebuild(spark, landed, now, core, periods, f"stream-{number}", derived)

    stream = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.[zZ][iI][pP]").load(landing_dir)
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", ckpt)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
