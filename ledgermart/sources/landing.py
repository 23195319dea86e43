"""Idempotent keyed landing, schema freeze and sinks.

Two landing shapes:

* file-keyed tables (one source file = one partition value, e.g. the
  checksum): ``land_partitions`` overwrites exactly the partitions present in
  the batch (dynamic partition overwrite).  Replaying a batch rewrites the
  same files; untouched partitions are never read or rewritten.
* small keyed tables: ``upsert`` = (target minus batch keys) ∪ batch, written
  as a new snapshot folder and then published, so a failed job never leaves a
  half-written table.  For large ones see ``versions.merge``, which rewrites
  only the buckets that a batch changes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.functions._util import names
from ledgermart.operators.quality import check_schema


class SchemaDrift(ValueError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType, check_nullability: bool = False) -> DataFrame:
    """Frozen schema (S16): exact ordered names and types, else raise."""
    issues = check_schema(df, expected)
    if not issues:
        for f in expected.fields:
            if f.dataType != df.schema[f.name].dataType:
                issues.append({"column": f.name, "expected": f.dataType.simpleString(),
                               "actual": df.schema[f.name].dataType.simpleString()})
    if check_nullability:
        for f in expected.fields:
            if not f.nullable and f.name in df.columns:
                df = df.withColumn(f.name, F.when(F.col(f.name).isNull(), F.raise_error(
                    F.lit(f"null in non-nullable column {f.name}"))).otherwise(F.col(f.name)))
    if issues:
        raise SchemaDrift(f"schema drift: {issues}")
    return df


def one_per_key(batch: DataFrame, keys) -> DataFrame:
    """A key that repeats lands once, with the largest of its rows (compared column by column in the frame's order)."""
    ks = names(keys)
    rest = [c for c in batch.columns if c not in ks]
    once = batch.distinct() if not rest else batch.groupBy(*ks).agg(
        F.max(F.struct(*rest)).alias("_row")).select(*ks, *[F.col(f"_row.{c}").alias(c) for c in rest])
    return once.select(*batch.columns)


def upsert_frames(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Keyed merge as a relation: batch rows replace target rows with the same key."""
    ks = names(keys)
    once = one_per_key(batch.select(*target.columns), ks)
    return target.join(once.select(*ks), ks, "left_anti").unionByName(once)


def _publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by=()) -> str:
    """Write to a fresh sibling folder, then swap it in by rename.

    A rename that fails raises; the table that was there is put back first and
    only deleted once the new one is in place.  Between the two renames of a
    replaced table no table has the name for a moment.  For file systems with
    an atomic rename; on object stores, where a rename is a copy, publish
    through a table format or a pointer file instead.
    """
    spark = df.sparkSession
    tmp = f"{path.rstrip('/')}.__{uuid.uuid4().hex}"
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*names(partition_by))
    w.save(tmp)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(conf)
    new = jvm.org.apache.hadoop.fs.Path(tmp)
    swap_in(fs, new, fs_path, jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old_{uuid.uuid4().hex}"))
    return path


def swap_in(fs, new, target, aside) -> None:
    """Rename ``new`` to ``target``; what was there goes ``aside`` and comes back if that fails."""
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, aside):
        raise OSError(f"cannot move {target} aside; the new data stays in {new}")
    if not fs.rename(new, target):
        if replaced and not fs.rename(aside, target):
            raise OSError(f"cannot publish {target}; the old data is in {aside}, the new in {new}")
        raise OSError(f"cannot publish {target}; the old data is unchanged, the new is in {new}")
    if replaced:
        fs.delete(aside, True)


def upsert(spark: SparkSession, path: str, batch: DataFrame, keys, schema: T.StructType | None = None) -> DataFrame:
    """Idempotent keyed landing of a small table.

    The merged relation is materialised in a new folder before the old one is
    replaced (a table is never read and overwritten in the same job).
    """
    if schema is not None:
        assert_schema(batch, schema)
    target = spark.read.parquet(path) if table_exists(spark, path) else batch.limit(0)
    merged = upsert_frames(target, batch, keys)
    _publish(merged, path)
    return spark.read.parquet(path)


def land_partitions(batch: DataFrame, path: str, partition_col: str, schema: T.StructType | None = None) -> None:
    """File-keyed landing: overwrite only the partitions present in ``batch``."""
    if schema is not None:
        assert_schema(batch, schema)
    (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def write_table(df: DataFrame, path: str, partition_by=()) -> str:
    """Full-refresh table sink."""
    return _publish(df, path, partition_by=partition_by)


def write_evidence(df: DataFrame, path: str) -> str:
    """Evidence CSV sink (S18): one header CSV; refuses an empty set.

    Evidence sets are small by construction (one row per file, series,
    control), hence the single output file.
    """
    if df.isEmpty():
        raise ValueError(f"refusing to write empty evidence to {path}")
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path


def mart(spark: SparkSession, path: str) -> DataFrame:
    """BI import scan of a mart."""
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
