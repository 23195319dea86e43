"""Bank-file catalog JSON and availability probes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions.dates import BANK_URL_PERIOD, period_from_url
from ledgermart.functions.text import blank_to_null, first_text
from ledgermart.operators.versioning import version_ordinal
from ledgermart.sources.series import guard_table

# The site that relative catalog URLs resolve against and the
# title / date field variants of the catalog API.
BASE_URL = "https://www.bcb.gov.br"
TITLE_FIELDS = ("Titulo", "Nome", "Title", "Name")
DATE_FIELDS = ("DataDocumento", "DataPublicacao")


def _resolve(url):
    """Absolute URLs stay; ``/path`` is joined to the base site."""
    return (F.when(url.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), url)
            .when(url.startswith("/"), F.concat(F.lit(BASE_URL), url))
            .when(url.isNotNull(), F.concat(F.lit(BASE_URL + "/"), url)))


def read_catalog(spark: SparkSession, path: str, discovered_at_utc: str | None = None,
                 pattern: str = BANK_URL_PERIOD) -> DataFrame:
    """One row per ``conteudo`` item; items that are not bank files keep an ``error``.

    Each file is read whole (``wholetext``) and parsed with ``from_json``;
    mixed items (objects and strings) survive as JSON text.
    """
    raw = spark.read.option("wholetext", "true").text(path).select(
        F.input_file_name().alias("catalog_file"),
        F.from_json("value", "struct<conteudo: array<string>>").getField("conteudo").alias("items"))
    # a payload without the list is an error, not a catalog without files
    raw = raw.withColumn("items", F.when(F.col("items").isNotNull(), F.col("items")).otherwise(
        F.raise_error(F.concat(F.lit("catalog payload without a list of items: "), F.col("catalog_file"))).cast("array<string>")))
    return catalog_rows(raw.select("catalog_file", F.posexplode("items").alias("item_index", "item")), discovered_at_utc, pattern)


def catalog_rows(items: DataFrame, discovered_at_utc: str | None = None, pattern: str = BANK_URL_PERIOD) -> DataFrame:
    """Items as JSON text (catalog_file, item_index, item) → catalog rows with versions per period."""
    obj = F.col("item").startswith("{")

    def field(name):
        return F.when(obj, F.get_json_object("item", f"$.{name}"))

    url = _resolve(blank_to_null(field("Url"), python_strip=True))
    period = period_from_url(url, pattern)
    out = items.select(
        "catalog_file", "item_index",
        period.alias("period"),
        first_text(*[field(n) for n in TITLE_FIELDS]).alias("title"),
        url.alias("source_url"),
        first_text(*[field(n) for n in DATE_FIELDS]).alias("document_date"),
        F.lit(discovered_at_utc).cast("string").alias("discovered_at_utc"),
        F.when(~obj | F.col("item").isNull(), F.lit("Catalog item is not an object"))
        .when(period.isNull(), F.lit("Unrecognized or missing bank file URL")).alias("error"),
    )
    versioned = version_ordinal(
        out.filter(F.col("period").isNotNull()), "period",
        [F.coalesce("document_date", F.lit("")), F.coalesce("source_url", F.lit("")),
         F.col("catalog_file"), F.col("item_index")],
        version_col="period_version", active_col="is_active")
    rest = out.filter(F.col("period").isNull()).withColumns(
        {"period_version": F.lit(None).cast("bigint"), "is_active": F.lit(None).cast("boolean")})
    return versioned.unionByName(rest)


def active_files(catalog: DataFrame, period: str = "period", active: str = "is_active") -> DataFrame:
    """Active URL per period; a period without exactly one active row raises.

    The check is one aggregate over the catalog (a scalar subquery) evaluated
    inside the job by ``raise_error``.
    """
    bad = catalog.filter(F.col(period).isNotNull()).groupBy(period).agg(
        F.count_if(F.col(active)).alias("_n")).filter(F.col("_n") != 1)
    bad_count = bad.select(F.count(F.lit(1))).scalar()
    # filter-based guard: a dropped guard column would be pruned away unevaluated
    active_count = catalog.select(F.count_if(F.col(active))).scalar()
    bad_count = bad_count + F.when(active_count > 0, 0).otherwise(1)
    return guard_table(catalog.filter(F.col(active)), bad_count, "catalog period without exactly one active URL")


def classify_probes(log: DataFrame, status: str = "status_code", content_range: str = "content_range",
                    content_length: str = "content_length", request_error: str | None = None) -> DataFrame:
    """HTTP probe outcome → availability.

    200/206 → available, 404 → absent, anything else → unknown with an error;
    size from ``Content-Range`` (``…/total``) else ``Content-Length``.
    """
    s = F.col(status)
    available = F.when(s.isin(200, 206), F.lit(True)).when(s == 404, F.lit(False))
    http_error = F.when(s.isNotNull() & ~s.isin(200, 206, 404), F.concat(F.lit("HTTP "), s.cast("string")))
    err = F.coalesce(F.col(request_error), http_error) if request_error else http_error
    rng = F.nullif(F.regexp_extract(F.coalesce(F.col(content_range), F.lit("")), r"/(\d+)$", 1), F.lit(""))
    size = F.coalesce(rng, blank_to_null(content_length)).cast("bigint")
    return log.withColumns({"is_available": available, "size_bytes": size, "error": err})
