"""Monthly macro series: JSON observations, registry, fetch manifest, pairing
(S6, S8, S12, S14, C5, P21).

Fail-closed checks are evaluated inside the job: a guard column calls
``raise_error`` on the first bad row, so nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions._util import values_frame
from ledgermart.functions.dates import period_text
from ledgermart.functions.numbers import MACRO
from ledgermart.functions.text import blank_to_null, strip_all
from ledgermart.operators.joins import set_diff

# The registered series codes and the registry's columns.
SERIES_CODES = ("4189", "433", "24363", "20539", "21082")
REGISTRY_COLUMNS = (
    "series_code", "theme", "display_name", "official_title", "unit", "frequency", "source_start_date",
    "observation_semantics", "monthly_alignment", "derived_metric", "max_expected_lag_months",
    "revision_policy", "source_url", "metadata_url",
)


def guard(df: DataFrame, failure: Column, message: Column | str) -> DataFrame:
    """Fail the job on the first row where ``failure`` holds."""
    msg = F.lit(message) if isinstance(message, str) else message
    return df.withColumn("_guard", F.when(failure, F.raise_error(msg))).filter(F.col("_guard").isNull()).drop("_guard")


def guard_table(df: DataFrame, failures: Column, message: str) -> DataFrame:
    """Fail the job when the one-row value ``failures`` is above zero, rows or none.

    The check sits on a row of its own that never reaches the output, so it
    fires for an empty frame too; the rows carry it as well, for filters that
    would skip that row.
    """
    check = F.when(failures > 0, F.raise_error(F.lit(message))).otherwise(F.lit(None)).isNotNull()
    alone = df.sparkSession.range(1).filter(check).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return guard(df, failures > 0, message).unionByName(alone)


def series_rows(raw: DataFrame, retrieved_at_utc: str | None = None, strict: bool = True) -> DataFrame:
    """Raw items (series_code, source_url, data, valor, _corrupt_record) → observations."""
    text = strip_all(F.col("valor"))
    norm = F.replace(text, F.lit(","), F.lit("."))
    finite = norm.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    obs_date = F.try_to_date(strip_all(F.col("data")), "dd/MM/yyyy")
    err = (F.when(F.col("_corrupt_record").isNotNull() | F.col("data").isNull() | F.col("valor").isNull(),
                  F.lit("invalid shape"))
           .when(obs_date.isNull(), F.lit("invalid date"))
           .when(~finite, F.lit("non-finite or invalid value")))
    out = raw.select(
        "series_code",
        obs_date.alias("source_observation_date"),
        period_text(obs_date).alias("report_month"),
        F.when(finite, norm.try_cast(MACRO)).alias("value"),
        text.alias("value_raw"),
        F.lit(retrieved_at_utc).cast("timestamp").alias("retrieved_at_utc"),
        "source_url",
        err.alias("error"),
    )
    if strict:
        out = guard(out, F.col("error").isNotNull(),
                    F.concat(F.lit("series "), F.col("series_code"), F.lit(": "), F.col("error")))
    return out


def read_series(spark: SparkSession, path: str, series_code: str | None = None,
                retrieved_at_utc: str | None = None, strict: bool = True) -> DataFrame:
    """Series JSON ``[{"data": "dd/MM/yyyy", "valor": "0,16"}, …]`` → observations.

    The code comes from ``series_code`` or the file name (``<code>.json``).
    Comma or dot decimals; non-finite values, empty files, missing keys and
    bad dates are errors (``strict`` raises, else rows keep an ``error``).
    """
    raw = spark.read.option("multiLine", "true").schema(
        "data string, valor string, _corrupt_record string").option(
        "columnNameOfCorruptRecord", "_corrupt_record").json(path)
    code = F.lit(series_code) if series_code else F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    out = series_rows(raw.withColumns({"series_code": code, "source_url": F.input_file_name()}), retrieved_at_utc, strict)
    if strict:
        # a file without any observation (``[]``) is an error too: list the
        # files (paths only, contents unread) and anti-join the ones seen
        def norm(c):
            return F.regexp_replace(c, r"^file:/+", "/")
        listed = spark.read.format("binaryFile").load(path).select(norm(F.col("path")).alias("_file"))
        seen = out.select(norm(F.col("source_url")).alias("_file")).distinct()
        empty = listed.join(seen, "_file", "left_anti").select(F.count(F.lit(1))).scalar()
        out = guard_table(out, empty, "series file without observations")
    return out


def registry_violations(registry: DataFrame, codes=SERIES_CODES) -> DataFrame:
    """Rule violations of a series registry (S8), one row per problem."""
    spark = registry.sparkSession
    expected = values_frame(spark, [(c,) for c in codes], "series_code string")
    code_set = set_diff(expected, registry.select(strip_all("series_code").alias("series_code"))).select(
        "series_code", F.concat(F.lit("code "), F.col("issue")).alias("problem"))
    dup = registry.groupBy("series_code").count().filter("count > 1").select(
        "series_code", F.lit("duplicate code").alias("problem"))
    blanks = [F.when(blank_to_null(F.col(c).cast("string")).isNull(), F.lit(f"blank {c}")) for c in REGISTRY_COLUMNS]
    rules = registry.select(
        "series_code",
        F.array_compact(F.array(
            *blanks,
            F.when(F.lower(strip_all("frequency")) != "monthly", F.lit("not monthly")),
            F.when(F.col("max_expected_lag_months").cast("string").try_cast("bigint").isNull()
                   | (F.col("max_expected_lag_months").cast("string").try_cast("bigint") < 0), F.lit("bad expected lag")),
            F.when(~F.col("source_url").startswith("https://"), F.lit("non-https source_url")),
            F.when(~F.col("metadata_url").startswith("https://"), F.lit("non-https metadata_url")),
        )).alias("_p"),
    ).select("series_code", F.explode("_p").alias("problem"))
    return code_set.unionByName(dup).unionByName(rules)


def read_registry(spark: SparkSession, path: str, codes=SERIES_CODES) -> DataFrame:
    """Governed registry read (S8): typed rows, failing on any rule violation."""
    schema = ", ".join(f"{c} string" for c in REGISTRY_COLUMNS)
    reg = spark.read.option("header", "true").option("mode", "FAILFAST").schema(schema).csv(path)
    bad = registry_violations(reg, codes)
    n_bad = bad.select(F.count(F.lit(1))).scalar()
    typed = reg.select(
        *[strip_all(c).alias(c) for c in REGISTRY_COLUMNS if c not in ("source_start_date", "max_expected_lag_months")],
        F.to_date(strip_all("source_start_date")).alias("source_start_date"),
        strip_all("max_expected_lag_months").cast("bigint").alias("max_expected_lag_months"),
    ).select(*REGISTRY_COLUMNS)
    return guard_table(typed, n_bad, "series registry violates its rules")


def derive_fetches(obs: DataFrame, fixture: bool | None = None) -> DataFrame:
    """Fetch manifest from observations (S12): bounds and count per series."""
    g = obs.groupBy("series_code").agg(
        F.min("source_observation_date").alias("requested_start_date"),
        F.max("source_observation_date").alias("requested_end_date"),
        F.max("retrieved_at_utc").alias("retrieved_at_utc"),
        F.count(F.lit(1)).alias("response_count"),
    ).withColumn("status", F.lit("complete"))
    if fixture is not None:
        g = g.withColumn("fixture", F.lit(fixture))
    return g


def _month_mismatches(obs: DataFrame) -> Column:
    """Observations whose declared month isn't that of their date (0 without the column)."""
    if "report_month" not in obs.columns:
        return F.max(F.lit(0))
    declared, dated = F.col("report_month").cast("string"), F.col("source_observation_date")
    # a month is declared as yyyy-MM, yyyyMM or a date of it
    key = F.substring(F.regexp_replace(declared, "-", ""), 1, 6)
    return F.count_if(key != F.date_format(dated, "yyyyMM"))


def pair_series(registry: DataFrame, obs: DataFrame, profiles: DataFrame, start, end):
    """Validate observations against their profiles and emit landing frames.

    Checks before any row is emitted: every registered series has a
    ``complete`` profile and no other series occurs; observation counts and
    date bounds equal the profile's; every observation lies in [start, end], in
    the month it declares, and once per date; one retrieval stamp per series;
    a profile that carries the expected lag carries the registry's.
    Returns ``(metadata, observations, fetches)``.
    """
    start_d, end_d = F.lit(start).cast("date"), F.lit(end).cast("date")
    per_series = obs.groupBy("series_code").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if((F.col("source_observation_date") < start_d) | (F.col("source_observation_date") > end_d)).alias("_out"),
        F.min("retrieved_at_utc").alias("_stamp"),
        F.max("retrieved_at_utc").alias("_last_stamp"),
        F.min("source_observation_date").alias("_first"),
        F.max("source_observation_date").alias("_last"),
        _month_mismatches(obs).alias("_other_month"),
    )
    repeats = obs.groupBy("series_code", "source_observation_date").agg(F.count(F.lit(1)).alias("_times")).groupBy(
        "series_code").agg(F.count_if(F.col("_times") > 1).alias("_repeats"))
    optional = {c: t for c, t in (("first_observation_date", "date"), ("last_observation_date", "date"),
                                  ("max_expected_lag_months", "bigint")) if c in profiles.columns}
    profiled = profiles.select("series_code", "status", "row_count", F.lit(True).alias("_profiled"),
                               *[F.col(c).cast(t).alias(f"_p_{c}") for c, t in optional.items()])
    known = registry.select("series_code", F.lit(True).alias("_registered"), *(
        [F.col("max_expected_lag_months").cast("bigint").alias("_lag")] if "max_expected_lag_months" in registry.columns else []))
    checks = known.join(profiled, "series_code", "full_outer").join(per_series, "series_code", "full_outer").join(
        repeats, "series_code", "left")
    differs = F.lit(False)
    for ours, theirs in (("_first", "_p_first_observation_date"), ("_last", "_p_last_observation_date"),
                         ("_lag", "_p_max_expected_lag_months")):
        if ours in checks.columns and theirs in checks.columns:
            differs = differs | ~F.col(ours).eqNullSafe(F.col(theirs))
    bad = checks.filter(
        F.col("_registered").isNull()
        | differs
        | (F.coalesce(F.col("_repeats"), F.lit(0)) > 0)
        | (F.coalesce(F.col("_other_month"), F.lit(0)) > 0)
        | (F.coalesce(F.col("status"), F.lit("missing")) != "complete")
        | (F.coalesce(F.col("_n"), F.lit(0)) != F.col("row_count"))
        | (F.coalesce(F.col("_out"), F.lit(0)) > 0)
        | F.col("_stamp").isNull() | (F.col("_stamp") != F.col("_last_stamp")))
    n_bad = bad.select(F.count(F.lit(1))).scalar()
    ok_obs = guard_table(obs, n_bad, "series evidence does not pair with its profiles")
    fetches = derive_fetches(ok_obs).withColumns({"requested_start_date": start_d, "requested_end_date": end_d})
    return registry, ok_obs, fetches
