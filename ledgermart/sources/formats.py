"""Balance archives, catalog JSON and series JSON as Spark data sources.

``register(spark)`` makes three formats known to ``spark.read.format`` and
``df.write.format``:

* ``ledger_archive``: zipped balance files → raw records (the columns of
  ``archives.RAW_SCHEMA`` and the archive's ``period``);
* ``ledger_catalog``: file catalogs → one row per item, as JSON text;
* ``ledger_series``: observation files → one row per observation.

A reader plans on the driver from the listing alone (names and sizes): it
drops the files that a pushed filter on ``period`` or ``series_code`` rules
out, and packs the rest into partitions of about ``split_bytes``.  A file is
one unit of work (a zip can't be split) and is streamed, never held whole:
its checksum is taken in one pass, its records come in bounded batches.  With
a ``manifest`` (a file or folder of JSON lines: archive_path, sha256 and, optionally, period) an
archive that isn't listed, a listed one that is absent and a checksum that
differs fail the job before a record of that archive is emitted.

A writer streams each task's rows into files of its own in a staging folder;
the commit moves them into place, so a failed or repeated task leaves nothing
half-written.  The rows of a file must be together (``write_archives`` and
``write_json`` see to it).  A file that is there already is an error unless
the mode is ``overwrite``, which replaces files of the same name only.

Files are reached through ``pyarrow.fs`` (local, HDFS, S3, GCS by URI).  On a
store that only Spark's own readers can open, ``archives.read_archives``,
``catalog.read_catalog`` and ``series.read_series`` read the same files.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import itertools
import json
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
                                    StringStartsWith, WriterCommitMessage)

from ledgermart.sources import archives
from ledgermart.sources.catalog import catalog_rows
from ledgermart.sources.series import guard_table, series_rows

#: Bytes of a task's files at most (a larger file is a task of its own), and what opening a file counts as.
SPLIT_BYTES, OPEN_BYTES = 64 << 20, 1 << 20
CHUNK = 1 << 20
ROWS = 20_000
#: The period in an archive's name: its first run of six digits.
PERIOD_IN_NAME = r"(?<!\d)(\d{6})(?!\d)"


def filesystem(path: str):
    """(file system, path on it) of a URI or plain path."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", path)
    if not re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", uri):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def listing(path: str, suffix: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files with a suffix, in the order of their names; hidden files are left out."""
    from pyarrow import fs

    system, root = filesystem(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no such file or folder: {path}")
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    inside = lambda p: not any(part[:1] in "._" for part in posixpath.relpath(p, root).split("/") if part != ".")
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.lower().endswith(suffix) and inside(f.path))


@dataclass
class Files(InputPartition):
    """Files that one task reads: (path, what the plan knows about it)."""

    files: list = field(default_factory=list)

    def __post_init__(self):
        InputPartition.__init__(self, None)


def packed(files: list[tuple[str, int, dict]], split_bytes: int, tasks: int) -> list[Files]:
    """Partitions of about even bytes: as many as ``split_bytes`` asks for, and ``tasks`` at least.

    Each file, largest first, goes to the emptiest partition.
    """
    total = sum(size + OPEN_BYTES for _, size, _ in files)
    out = [(0, i, Files()) for i in range(min(len(files), max(tasks, -(-total // split_bytes))))]
    for path, size, known in sorted(files, key=lambda f: (-f[1], f[0])):
        held, i, part = heapq.heappop(out)
        part.files.append((path, known))
        heapq.heappush(out, (held + size + OPEN_BYTES, i, part))
    return [part for _, _, part in out]


TESTS = {
    EqualTo: lambda v, f: v == f.value,
    EqualNullSafe: lambda v, f: v == f.value,
    GreaterThan: lambda v, f: v > f.value,
    GreaterThanOrEqual: lambda v, f: v >= f.value,
    LessThan: lambda v, f: v < f.value,
    LessThanOrEqual: lambda v, f: v <= f.value,
    In: lambda v, f: v in f.value,
    StringStartsWith: lambda v, f: v.startswith(f.value),
    IsNotNull: lambda v, f: True,
}


class FileReader(DataSourceReader):
    """Plans files by name and size.  ``column`` is the one whose value the file's name tells."""

    suffix, column = "", ""

    def __init__(self, options):
        self.path = options.get("path")
        self.split_bytes, self.tasks = int(options.get("split_bytes", SPLIT_BYTES)), int(options.get("tasks", 1))
        self.tests: list = []
        if not self.path:
            raise ValueError("a path is needed")

    def pushFilters(self, filters):
        for f in filters:
            if f.attribute == (self.column,) and type(f) in TESTS:
                self.tests.append(f)
            yield f  # Spark checks the rows again: a file may tell otherwise than its name

    def wanted(self, value: str | None) -> bool:
        """Files whose name doesn't tell the value are read."""
        return value is None or all(TESTS[type(f)](value, f) for f in self.tests)

    def known(self) -> list[tuple[str, int, dict]]:
        """(path, bytes, facts) of all files; ``facts[column]`` is the file's value, if known."""
        raise NotImplementedError

    def partitions(self):
        return packed([f for f in self.known() if self.wanted(f[2].get(self.column))], self.split_bytes, self.tasks) or [Files()]

    def batches(self, path: str, known: dict) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def read(self, partition):
        for path, known in partition.files:
            yield from self.batches(path, known)


# -- archives ------------------------------------------------------------------
ARCHIVE_SCHEMA = archives.RAW_SCHEMA + ", period string"
_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}


def arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (c.split(" ", 1) for c in schema.split(", "))])


def checksum(file) -> str:
    digest = hashlib.sha256()
    while chunk := file.read(CHUNK):
        digest.update(chunk)
    file.seek(0)
    return digest.hexdigest()


class ArchiveReader(FileReader):
    suffix, column = ".zip", "period"

    def __init__(self, options):
        super().__init__(options)
        self.delimiter = options.get("delimiter", archives.DELIMITER)
        self.manifest = options.get("manifest")

    def known(self):
        # an archive whose name doesn't have one period has none until it is read
        named = lambda path: p[0] if len(p := re.findall(PERIOD_IN_NAME, posixpath.basename(path))) == 1 else None
        files = listing(self.path, self.suffix)
        if not self.manifest:
            return [(p, n, {"period": named(p)}) for p, n in files]
        system, listed = filesystem(self.manifest)[0], {}
        for path, _ in listing(self.manifest, ".json"):
            with system.open_input_stream(path) as stream:
                listed |= {filesystem(r["archive_path"])[1]: r for r in map(json.loads, io.TextIOWrapper(stream, "utf-8"))}
        unlisted, absent = sorted({p for p, _ in files} - set(listed)), sorted(set(listed) - {p for p, _ in files})
        if unlisted or absent:
            raise ValueError(f"unlisted archive: {unlisted[0]}" if unlisted else f"listed archive is absent: {absent[0]}")
        return [(p, n, {"period": listed[p].get("period") or named(p), "sha256": listed[p]["sha256"]}) for p, n in files]

    def batches(self, path, known):
        schema = arrow_schema(ARCHIVE_SCHEMA)
        system, _ = filesystem(self.path)
        with system.open_input_file(path) as file:
            found = checksum(file)
            if known.get("sha256", found) != found:
                raise ValueError(f"checksum mismatch: {path}")
            for facts, error, records in archives.archive_records(file, archives.REQUIRED_COLUMNS, self.delimiter):
                facts = {**facts, "source_path": path, "source_checksum": found, "error": error, "period": known.get("period")}
                numbers, fields = zip(*records) if records else ((None,), (None,))
                own = {"file_row_number": numbers, "fields": fields}
                columns = [pa.array(own[c.name], c.type) if c.name in own else pa.repeat(pa.scalar(facts.get(c.name), c.type), len(numbers)) for c in schema]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)


# -- JSON ----------------------------------------------------------------------
def loaded(system, path: str):
    with system.open_input_stream(path) as stream:
        try:
            return json.load(io.TextIOWrapper(stream, "utf-8-sig"))
        except ValueError as error:
            raise ValueError(f"not JSON: {path}: {error}") from None


CATALOG_SCHEMA = "catalog_file string, item_index int, item string"


class CatalogReader(FileReader):
    suffix, column = ".json", "catalog_file"

    def known(self):
        return [(p, n, {"catalog_file": p}) for p, n in listing(self.path, self.suffix)]

    def batches(self, path, known):
        payload = loaded(filesystem(self.path)[0], path)
        items = payload.get("conteudo") if isinstance(payload, dict) else None
        if not isinstance(items, list):
            raise ValueError(f"catalog payload without a list of items: {path}")
        # an item that isn't an object stays, as text that isn't one either
        texts = [None if i is None else i if isinstance(i, str) else json.dumps(i, ensure_ascii=False) for i in items]
        for lo in range(0, len(texts), ROWS):
            part = texts[lo : lo + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.array(range(lo, lo + len(part)), pa.int32()), pa.array(part, pa.string())], schema=arrow_schema(CATALOG_SCHEMA))


SERIES_SCHEMA = "series_code string, source_url string, item_index int, data string, valor string, _corrupt_record string"


class SeriesReader(FileReader):
    suffix, column = ".json", "series_code"

    def known(self):
        return [(p, n, {"series_code": posixpath.basename(p)[: -len(".json")]}) for p, n in listing(self.path, self.suffix)]

    def batches(self, path, known):
        items = loaded(filesystem(self.path)[0], path)
        if not isinstance(items, list) or not items:
            raise ValueError(f"series file without observations: {path}")
        rows = []
        for i, item in enumerate(items):
            fields = [item.get(k) if isinstance(item, dict) else None for k in ("data", "valor")]
            sound = all(isinstance(v, (str, int, float)) and not isinstance(v, bool) for v in fields)
            date, value = (str(v) for v in fields) if sound else (None, None)
            rows.append((known["series_code"], path, i, date, value, None if sound else json.dumps(item, ensure_ascii=False)))
        for lo in range(0, len(rows), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows[lo : lo + ROWS]), arrow_schema(SERIES_SCHEMA))], schema=arrow_schema(SERIES_SCHEMA))


# -- writers -------------------------------------------------------------------
@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (staged path, name)."""

    files: list


class FileWriter(DataSourceArrowWriter):
    """One file for each run of rows with the same ``file_name`` (the first column)."""

    def __init__(self, options, schema, overwrite: bool):
        self.path, self.overwrite, self.job = options.get("path"), overwrite, uuid.uuid4().hex
        self.options = {k: options.get(k) for k in ("header", "encoding", "delimiter", "member")}
        self.names = schema.fieldNames()

    def staging(self) -> str:
        return posixpath.join(filesystem(self.path)[1], f"_staging-{self.job}")

    def write(self, iterator):
        system, root = filesystem(self.path)
        # a repeated attempt writes files of its own; only the committed one's are moved
        folder, files, out, name = posixpath.join(self.staging(), uuid.uuid4().hex), [], None, None
        system.create_dir(folder, recursive=True)
        for batch in iterator:
            names, values = (batch.column(i).to_pylist() for i in (0, 1))
            for found, run in itertools.groupby(zip(names, values), lambda row: row[0]):
                if found != name:
                    if out is not None:
                        self.finish(out)
                    name = found
                    if name in (n for _, n in files):
                        raise ValueError(f"the rows of {name} are not together")
                    staged = posixpath.join(folder, name)
                    files.append((staged, name))
                    out = self.begin(system.open_output_stream(staged), name)
                self.add(out, [value for _, value in run])
        if out is not None:
            self.finish(out)
        return Written(files)

    def commit(self, messages):
        system, root = filesystem(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        if len({n for _, n in files}) < len(files):
            raise ValueError("the rows of a file are in several tasks")
        there = {posixpath.basename(f.path) for f in system.get_file_info([posixpath.join(root, n) for _, n in files]) if f.type.name == "File"}
        if there and not self.overwrite:
            raise FileExistsError(f"files are there already: {sorted(there)[:3]}")
        for staged, name in files:
            system.move(staged, posixpath.join(root, name))
        system.delete_dir(self.staging())

    def abort(self, messages):
        from pyarrow import fs

        system, _ = filesystem(self.path)
        if system.get_file_info(self.staging()).type == fs.FileType.Directory:
            system.delete_dir(self.staging())

    def begin(self, stream, name):
        raise NotImplementedError

    def add(self, out, values):
        raise NotImplementedError

    def finish(self, out):
        raise NotImplementedError


class ArchiveWriter(FileWriter):
    """file_name and fields (array of strings) → a zip with one CSV member, header lines first."""

    def begin(self, stream, name):
        import csv

        archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
        inner = io.TextIOWrapper(archive.open(zipfile.ZipInfo(re.sub(r"(?i)\.zip$", ".CSV", name), (2000, 1, 1, 0, 0, 0)), "w", force_zip64=True),
                                 encoding=self.options["encoding"] or "cp1252", newline="")
        inner.write(self.options["header"] + "\r\n")
        return stream, archive, inner, csv.writer(inner, delimiter=self.options["delimiter"] or archives.DELIMITER)

    def add(self, out, values):
        out[3].writerows([["" if v is None else v for v in fields] for fields in values])

    def finish(self, out):
        out[2].close()
        out[1].close()
        out[0].close()


class JsonWriter(FileWriter):
    """file_name and item (JSON text) → a JSON list, or that list as the member ``member`` of an object."""

    def begin(self, stream, name):
        stream.write((f"{{{json.dumps(self.options['member'])}: [" if self.options["member"] else "[").encode())
        return {"stream": stream, "first": True}

    def add(self, out, values):
        text = ",\n".join("null" if v is None else v for v in values)
        out["stream"].write((b"" if out["first"] else b",\n") + text.encode())
        out["first"] = False

    def finish(self, out):
        out["stream"].write(b"]}" if self.options["member"] else b"]")
        out["stream"].close()


def source(format_name: str, columns: str, reading: type, writing: type) -> type:
    class Source(DataSource):
        @classmethod
        def name(cls):
            return format_name

        def schema(self):
            return columns

        def reader(self, schema):
            return reading(self.options)

        def writer(self, schema, overwrite):
            return writing(self.options, schema, overwrite)

    return Source


SOURCES = [source("ledger_archive", ARCHIVE_SCHEMA, ArchiveReader, ArchiveWriter), source("ledger_catalog", CATALOG_SCHEMA, CatalogReader, JsonWriter), source("ledger_series", SERIES_SCHEMA, SeriesReader, JsonWriter)]


def register(spark: SparkSession) -> None:
    """Make the formats known to the session, with filter pushdown for Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for s in SOURCES:
        spark.dataSource.register(s)


#: The column that is never null, as every row comes from a file.
PATH_COLUMNS = {"ledger_archive": "source_path", "ledger_catalog": "catalog_file", "ledger_series": "source_url"}


def scan(spark: SparkSession, format_name: str, path: str, **options) -> DataFrame:
    register(spark)
    options = {"tasks": spark.sparkContext.defaultParallelism, **options}
    found = spark.read.format(format_name).options(**{k: str(v) for k, v in options.items() if v is not None}).load(path)
    # Spark keeps the plan of the last read that pushed a filter, also for reads without one: so each pushes one (no row's is null)
    return found.where(F.col(PATH_COLUMNS[format_name]).isNotNull())


def scan_archives(spark: SparkSession, path: str, manifest: str | None = None, split_bytes: int | None = None) -> DataFrame:
    """Raw records (S1–S3) with the archive's ``period``; a filter on it leaves other archives unread."""
    return scan(spark, "ledger_archive", path, manifest=manifest, split_bytes=split_bytes)


def scan_catalog(spark: SparkSession, path: str, discovered_at_utc: str | None = None) -> DataFrame:
    """Catalog rows (S5) with versions per period."""
    return catalog_rows(scan(spark, "ledger_catalog", path), discovered_at_utc)


def scan_series(spark: SparkSession, path: str, retrieved_at_utc: str | None = None, strict: bool = True) -> DataFrame:
    """Observations (S6); a folder without files fails too."""
    raw = scan(spark, "ledger_series", path)
    out = series_rows(raw, retrieved_at_utc, strict)
    return guard_table(out, F.when(raw.select(F.count(F.lit(1))).scalar() == 0, 1).otherwise(0), "no series file") if strict else out


def write_archives(rows: DataFrame, path: str, file_name, fields, order, header: str, encoding: str = "cp1252", mode: str = "append") -> None:
    """Archives from rows: one per ``file_name``, its records in ``order``.  ``header`` is the text up to the column line."""
    register(rows.sparkSession)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [f"_order{i}" for i in range(len(order))]
    named = rows.select(file_name.alias("file_name"), F.array(*fields).alias("fields"), *[c.alias(k) for c, k in zip(order, keys)])
    dealt = named.repartition("file_name").sortWithinPartitions("file_name", *keys).select("file_name", "fields")
    dealt.write.format("ledger_archive").option("header", header).option("encoding", encoding).mode(mode).save(path)


def write_json(rows: DataFrame, path: str, format_name: str, file_name, item, order, member: str | None = None, mode: str = "append") -> None:
    """JSON files from rows: one per ``file_name``, a list of its items in ``order``."""
    register(rows.sparkSession)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [f"_order{i}" for i in range(len(order))]
    named = rows.select(file_name.alias("file_name"), F.to_json(item).alias("item"), *[c.alias(k) for c, k in zip(order, keys)])
    dealt = named.repartition("file_name").sortWithinPartitions("file_name", *keys).select("file_name", "item")
    writer = dealt.write.format(format_name).mode(mode)
    (writer.option("member", member) if member else writer).save(path)
