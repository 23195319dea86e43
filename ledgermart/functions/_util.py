from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col(c) for c in cs]


def names(cs) -> list[str]:
    if isinstance(cs, str):
        return [cs]
    return list(cs)


def values_frame(spark, rows, schema):
    """A small constant relation built JVM-side (``inline`` over literal structs).

    For inline mappings, code sets and dimension rows: unlike a DataFrame
    created from a Python list, nothing runs in a Python worker.
    """
    from pyspark.sql import types as T

    st = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, st.fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
