"""Typed evidence CSVs, derived manifests, pairing, contracts and run logs
(S7, S10, S11, S13, S19, S20, S21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.functions._util import names
from ledgermart.functions.types import contract_type
from ledgermart.sources.series import guard


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str, key=None) -> DataFrame:
    """Header CSV with a declared schema (S7, S10, S21): no inference, FAILFAST,
    empty → null; duplicate ``key`` values fail the job."""
    df = (spark.read.option("header", "true").option("mode", "FAILFAST").option("emptyValue", None)
          .option("nullValue", "").schema(schema).csv(path))
    if key:
        ks = names(key)
        dups = df.groupBy(*ks).count().filter("count > 1")
        n = dups.select(F.count(F.lit(1))).scalar()
        df = guard(df, n > 0, "duplicate identity in " + path)
    return df


def derive_manifest(rows: DataFrame, period: str = "source_period", url: str = "source_url",
                    checksum: str = "source_checksum") -> DataFrame:
    """One manifest row per checksum (S11); a checksum spanning several periods
    or URLs fails the job."""
    m = rows.groupBy(checksum).agg(
        F.min(period).alias(period),
        F.min(url).alias(url),
        F.count_distinct(period).alias("_periods"),
        F.count_distinct(url).alias("_urls"),
        F.max("source_generated_at").alias("source_generated_at"),
        F.max("retrieved_at_utc").alias("retrieved_at_utc"),
        F.count(F.lit(1)).alias("row_count"),
    )
    m = guard(m, (F.col("_periods") > 1) | (F.col("_urls") > 1),
              F.concat(F.lit("checksum spans several periods or URLs: "), F.col(checksum)))
    return m.drop("_periods", "_urls").withColumns({"status": F.lit("complete"), "is_active": F.lit(True)})


def pair_manifest_profile(manifest: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pair download records with file profiles on the checksum.

    An incomplete download is an error.  Every download needs exactly one profile with the same period,
    URL and byte count, no malformed rows, a matching declared period and a
    generation date; a profile without a download, or two profiles for one
    checksum, is an error.  Returns the paired rows or fails the job.
    """
    # a checksum holds one profile (or a few duplicates): a bounded window
    p = profiles.withColumn("_profiles", F.count(F.lit(1)).over(Window.partitionBy("sha256")))
    j = manifest.alias("m").join(p.alias("p"), "sha256", "full_outer")
    err = (F.when(F.col("m.period").isNull(), F.lit("profile without a download"))
           .when(F.coalesce(F.col("m.status"), F.lit("")) != "complete", F.lit("incomplete download"))
           .when(F.col("p.period").isNull(), F.lit("download without a profile"))
           .when(F.coalesce(F.col("p.row_count"), F.lit(0)) < 1, F.lit("file without rows"))
           .when(F.col("_profiles") > 1, F.lit("duplicate profile checksum"))
           .when((F.col("m.period") != F.col("p.period")) | (F.col("m.source_url") != F.col("p.source_url")),
                 F.lit("identity differs"))
           .when(F.col("m.compressed_bytes") != F.col("p.compressed_bytes"), F.lit("byte count differs"))
           .when(F.col("p.malformed_row_count") > 0, F.lit("malformed rows"))
           .when(~F.coalesce(F.col("p.period_matches"), F.lit(False)), F.lit("declared period differs"))
           .when(F.col("p.source_generated_at").isNull(), F.lit("no generation date")))
    out = j.withColumn("pair_error", err)
    out = guard(out, F.col("pair_error").isNotNull(),
                F.concat(F.col("pair_error"), F.lit(": "), F.coalesce(F.col("sha256"), F.lit("?"))))
    return out.select("sha256", "m.period", "m.source_url", "m.retrieved_at_utc", "p.row_count",
                      "p.source_generated_at", "p.columns", "p.encoding")


def load_contract(path: str) -> dict:
    """Mart contract YAML → {object: {"schema": StructType, "required": [...]}}."""
    import yaml

    with open(path, encoding="utf-8") as fh:
        payload = yaml.safe_load(fh)
    if not isinstance(payload, dict) or not isinstance(payload.get("objects"), list):
        raise ValueError(f"contract has an invalid structure: {path}")
    out = {}
    for obj in payload["objects"]:
        fields = [T.StructField(str(c["name"]), contract_type(str(c["type"])), bool(c["nullable"]))
                  for c in obj["columns"]]
        out[str(obj["name"])] = {
            "schema": T.StructType(fields),
            "required": [str(c["name"]) for c in obj["columns"] if not bool(c["nullable"])],
            "primary_key": list(obj.get("primary_key", [])),
        }
    return out


def summarise_runs(spark: SparkSession, path: str, by_kind: bool = True) -> DataFrame:
    """Run-log JSON (``{"results": [{unique_id, status}, …]}``) → counts.

    ``by_kind``: split by resource type (prefix of ``unique_id``) and status;
    otherwise by status only.  ``is_failure`` marks statuses other than
    success / pass.
    """
    raw = spark.read.option("multiLine", "true").schema(
        "results array<struct<unique_id: string, status: string>>").json(path)
    r = raw.select(F.explode("results").alias("r")).select(
        F.split(F.col("r.unique_id"), r"\.").getItem(0).alias("resource_type"), F.col("r.status").alias("status"))
    keys = ["resource_type", "status"] if by_kind else ["status"]
    return r.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "is_failure", ~F.col("status").isin("success", "pass"))
