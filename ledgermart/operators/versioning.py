"""Version choice and recency.

Skew: any partition key may hold a large share of all rows, so nothing here
runs a window over a whole raw group in one task.

* top-1 per key (``latest_by``, ``select_version``) uses ``row_number() = 1``,
  which Catalyst plans as a *partial* ``WindowGroupLimit`` before the shuffle:
  a hot key arrives at the reducer as at most one row per map partition.
  Flags are joined back on the row identity, which is evenly spread.
* ordinals (``version_ordinal``) are numbered in a range-partitioned layout
  that splits a hot group into slices, each slice adding the count of the
  earlier slices of the same group (a small per-(group, slice) table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermart.functions._util import names
from ledgermart.session import cut_lineage


def _sort_cols(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def latest_by(df: DataFrame, key, order, rank_col: str = "_rank") -> DataFrame:
    """One row per ``key``: the first row under ``order``."""
    w = Window.partitionBy(*names(key)).orderBy(*_sort_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def select_version(
    df: DataFrame,
    partition,
    order,
    identity,
    complete: Column | None = None,
    flag_col: str = "is_selected",
) -> DataFrame:
    """Flag, on every row, the first version per ``partition``.

    ``is_selected = (rank 1) and complete``: a partition whose best version is
    not complete selects nothing.  ``identity`` must be unique per row.
    """
    ident = names(identity)
    winners = latest_by(df, partition, order).select(*ident).withColumn("_winner", F.lit(True))
    out = df.join(winners, ident, "left")
    selected = F.coalesce(F.col("_winner"), F.lit(False))
    if complete is not None:
        selected = selected & F.coalesce(complete, F.lit(False))
    return out.withColumn(flag_col, selected).drop("_winner")


def distributed_row_number(
    df: DataFrame,
    partition,
    order,
    out_col: str = "row_number",
    count_col: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``row_number() over (partition by … order by …)`` that splits hot groups.

    ``order`` must be a total order within a group (end it with a unique key).
    Range partitioning on (partition, order) cuts every large group into
    contiguous slices on several tasks; the per-(group, slice) row counts
    (at most groups + slices rows) give each slice its offset.  Null keys are
    a group like any other.  Numbers are ``bigint``.  With ``count_col`` the
    group size is attached as well.

    The sliced frame is read twice (numbering, counts) and its range bounds
    come from sampling, so it is written once to the shared checkpoint folder
    while the query is built: both reads then see the same slices, and a lost
    executor is recovered from there, not by re-sampling.
    """
    part = names(partition)
    order_cols = _sort_cols(order)
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, *[F.col(p) for p in part], *order_cols).withColumn(
        "_slice", F.spark_partition_id()
    ))
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*part, "_slice").orderBy(*order_cols)).cast("bigint")
    )
    counts = ranged.groupBy(*part, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint"))
    keep = ["_offset"]
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_n").over(Window.partitionBy(*part)))
        keep.append(count_col)
    offsets = offsets.select(*[F.col(p).alias(f"_key{i}") for i, p in enumerate(part)], F.col("_slice").alias("_of"), *keep)
    same = F.col("_slice") == F.col("_of")
    for i, p in enumerate(part):
        same = same & F.col(p).eqNullSafe(F.col(f"_key{i}"))
    out = local.join(offsets, same, "inner")
    return out.withColumn(out_col, F.col("_local") + F.col("_offset")).drop(
        "_slice", "_local", "_offset", "_of", *[f"_key{i}" for i in range(len(part))]
    )


def version_ordinal(
    df: DataFrame,
    partition,
    order,
    version_col: str = "period_version",
    active_col: str = "is_active",
    slices: int | None = None,
) -> DataFrame:
    """Version number per partition and ``is_active`` = last version."""
    out = distributed_row_number(df, partition, order, version_col, "_versions", slices)
    return out.withColumn(active_col, F.col(version_col) == F.col("_versions")).drop("_versions")
