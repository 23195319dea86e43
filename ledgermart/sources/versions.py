"""Tables whose units (hash buckets, periods) are replaced one by one, with a version log.

A table is a folder with ``_log/<version>.json`` and ``data/<write>/_unit=<unit>``.
A log entry names the folder of every unit and the version that wrote it; data
files are never changed.  So a reader sees one version whole, old versions
stay readable, and a write touches the folders of its units only.

The log entry is created if absent, after the data: of two writers that
started from the same version one fails and changes nothing.  An entry that a
crash cut short is not a version; readers pass it over, writers refuse until
``repair`` has removed it.

``merge`` is a keyed upsert on such a table.  Rows are dealt to buckets by a
hash of the key; only buckets with a row that really differs are read and
rewritten, so work follows the batch, not the table, and a replayed batch
writes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.functions._util import names
from ledgermart.session import cut_lineage
from ledgermart.sources.landing import one_per_key, upsert_frames
from ledgermart.sources.series import guard


class Conflict(RuntimeError):
    """Another writer was first, or its entry was cut short."""


class VersionedTable:
    """A Parquet table by units under ``path``; every call sees the log as it is then."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _files(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))] if self._fs.exists(self._at(folder)) else []

    def _entry(self, name: str) -> dict | None:
        stream = self._fs.open(self._at(f"_log/{name}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def log(self) -> list[dict]:
        """Entries by version: version, batch, units {unit: {folder, version}}, schema, settings, facts."""
        return [e for e in map(self._entry, sorted(f for f in self._files("_log") if f.endswith(".json"))) if e]

    def last(self) -> dict | None:
        for name in sorted((f for f in self._files("_log") if f.endswith(".json")), reverse=True):
            if entry := self._entry(name):
                return entry
        return None

    def repair(self) -> int:
        """Remove entries that a crash cut short; their number."""
        torn = [f for f in self._files("_log") if f.endswith(".json") and self._entry(f) is None]
        for f in torn:
            self._fs.delete(self._at(f"_log/{f}"), False)
        return len(torn)

    def read(self, version: int | None = None, units=None, version_col: str | None = None) -> DataFrame:
        """The rows of a version (the last by default), of all units or some; only their folders are read.

        ``version_col`` adds the version that wrote each row's unit.
        """
        entry = self.last() if version is None else next((e for e in self.log() if e["version"] == version), None)
        if entry is None:
            raise FileNotFoundError(f"no version {version if version is not None else ''} of {self.path}")
        wanted = entry["units"] if units is None else {u: entry["units"][u] for u in map(str, units) if u in entry["units"]}
        schema = T.StructType.fromJson(entry["schema"])
        by_version: dict[int, list[str]] = {}
        for unit in wanted.values():
            by_version.setdefault(unit["version"] if version_col else 0, []).append(f"{self.path}/{unit['folder']}")
        out = self.spark.createDataFrame([], schema)
        if version_col:
            out = out.withColumn(version_col, F.lit(None).cast("bigint"))
        for number, folders in sorted(by_version.items()):
            rows = self.spark.read.schema(schema).parquet(*sorted(folders))
            rows = rows.withColumn(version_col, F.lit(number).cast("bigint")) if version_col else rows
            out = rows if not version_col and len(by_version) == 1 else out.unionByName(rows)
        return out

    def replace(self, rows: DataFrame, unit, units, batch: str | None = None, settings: dict | None = None, facts: dict | None = None,
                since: dict | None = None) -> int:
        """Write a version in which the ``units`` hold exactly ``rows`` (a unit without rows goes); the new version.

        ``unit``: the column of a row's unit.  ``since``: the entry that the caller worked from (the
        last one by default); if there is a newer one, nothing is written.
        """
        before = since if since is not None else self.last()
        units = sorted({str(u) for u in units})
        if any(self._entry(f) is None for f in self._files("_log") if f.endswith(".json")):
            raise Conflict(f"an unfinished entry in the log of {self.path}: another writer, or repair() it")
        number = before["version"] + 1 if before else 1
        folder = f"data/{number:012d}-{uuid.uuid4().hex}"
        schema = rows.schema
        if before and [(f.name, f.dataType) for f in T.StructType.fromJson(before["schema"])] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"the rows don't have the columns of {self.path}")
        named = F.col(unit) if isinstance(unit, str) else unit
        dealt = rows.withColumn("_unit", named.cast("string"))
        foreign = ~F.coalesce(F.col("_unit").isin(units), F.lit(False))
        dealt = guard(dealt, foreign, F.concat(F.lit("a row of a unit that isn't replaced: "), F.coalesce("_unit", F.lit("null"))))
        # one shuffle by unit; AQE splits a unit that is much larger than the others
        dealt.hint("rebalance", F.col("_unit")).write.partitionBy("_unit").parquet(f"{self.path}/{folder}")
        written = {}
        for status in self._fs.listStatus(self._at(folder)):
            name = status.getPath().getName()
            if name.startswith("_unit="):
                written[self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name[len("_unit="):])] = f"{folder}/{name}"
        kept = {u: v for u, v in (before["units"] if before else {}).items() if u not in units}
        entry = {"version": number, "batch": batch, "schema": schema.jsonValue(), "settings": settings or (before or {}).get("settings") or {},
                 "facts": facts or {}, "units": {**kept, **{u: {"folder": f, "version": number} for u, f in written.items()}}}
        self._commit(number, entry)
        return number

    def _commit(self, number: int, entry: dict) -> None:
        target = self._at(f"_log/{number:012d}.json")
        try:
            stream = self._fs.create(target, False)
        except Exception as error:  # noqa: BLE001  the file system's own class of "exists already"
            if self._fs.exists(target):
                raise Conflict(f"version {number} of {self.path} was written meanwhile") from error
            raise
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()

    def vacuum(self, keep: int = 2) -> int:
        """Delete data folders that none of the last ``keep`` versions names; their number."""
        entries = self.log()
        used = {u["folder"].split("/")[1] for e in entries[-keep:] for u in e["units"].values()}
        stale = [f for f in self._files("data") if f not in used and int(f.split("-")[0]) <= (entries[-1]["version"] if entries else 0)]
        for f in stale:
            self._fs.delete(self._at(f"data/{f}"), True)
        for e in entries[:-keep]:
            self._fs.delete(self._at(f"_log/{e['version']:012d}.json"), False)
        return len(stale)


def bucket_of(keys, buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in names(keys)]), F.lit(buckets)).cast("int")


def merge(spark: SparkSession, path: str, batch: DataFrame, keys, buckets: int = 64, batch_id: str | None = None) -> VersionedTable:
    """Upsert ``batch`` into the table at ``path`` by ``keys``.

    ``buckets`` counts for a new table; later merges keep the table's.  A key that
    repeats in the batch lands once, with the largest of its rows.  Null keys fail
    the job.  A batch that changes nothing writes no version; a ``batch_id`` that the
    log has isn't applied again.
    """
    ks, table = names(keys), VersionedTable(spark, path)
    before = table.last()
    settings = before["settings"] if before else {"keys": ks, "buckets": buckets}
    if settings["keys"] != ks:
        raise ValueError(f"{path} is keyed by {settings['keys']}, not {ks}")
    if batch_id is not None and any(e["batch"] == batch_id for e in table.log()):
        return table
    columns = [f["name"] for f in before["schema"]["fields"]] if before else batch.columns
    empty = F.lit(False)
    for k in ks:
        empty = empty | F.col(k).isNull()
    # the batch is read several times below, and alike each time
    once = cut_lineage(one_per_key(guard(batch.select(*columns), empty, "null key in a merge"), ks).withColumn("_unit", bucket_of(ks, settings["buckets"])))
    met = [r["_unit"] for r in once.select("_unit").distinct().collect()]  # buckets at most
    target = table.read(units=met) if before else batch.select(*columns).limit(0)
    changed = cut_lineage(once.select(*columns).subtract(target).withColumn("_unit", bucket_of(ks, settings["buckets"])))
    touched = {r["_unit"]: r for r in changed.join(target.select(*ks, F.lit(1).alias("_there")), ks, "left").groupBy("_unit").agg(
        F.count_if(F.col("_there").isNull()).alias("inserted"), F.count_if(F.col("_there").isNotNull()).alias("updated")).collect()}  # buckets at most
    if not touched and before:
        return table
    held = table.read(units=touched) if before else target
    merged = upsert_frames(held, changed.drop("_unit"), ks)
    facts = {"inserted": sum(r["inserted"] for r in touched.values()), "updated": sum(r["updated"] for r in touched.values()), "touched": len(touched)}
    table.replace(merged, bucket_of(ks, settings["buckets"]), touched, batch_id, settings, facts, since=before)
    return table


def history(table: VersionedTable) -> DataFrame:
    """One row a version: version, batch, inserted, updated, touched (units rewritten) and units."""
    rows = [(e["version"], e["batch"], e["facts"].get("inserted"), e["facts"].get("updated"), e["facts"].get("touched"), len(e["units"])) for e in table.log()]
    return table.spark.createDataFrame(rows, "version bigint, batch string, inserted bigint, updated bigint, touched bigint, units bigint")
