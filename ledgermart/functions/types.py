"""Type-name normalisation for schema contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# Contract type names and their Spark equivalents.
CONTRACT_TYPES = {
    "text": T.StringType(),
    "varchar": T.StringType(),
    "character varying": T.StringType(),
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp with time zone": T.TimestampType(),
    "timestamptz": T.TimestampType(),
    "timestamp": T.TimestampType(),
    "double precision": T.DoubleType(),
    "double": T.DoubleType(),
    "numeric": T.DecimalType(38, 2),
}


def type_name(dt: T.DataType) -> str:
    """Normalised name used when comparing a live schema with a contract."""
    if isinstance(dt, T.StringType):
        return "text"
    if isinstance(dt, T.IntegerType):
        return "integer"
    if isinstance(dt, T.LongType):
        return "bigint"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp with time zone"
    if isinstance(dt, T.DecimalType):
        return "numeric"
    if isinstance(dt, T.DoubleType):
        return "double precision"
    return dt.simpleString()


def sized_type_name(dt: T.DataType) -> str:
    """``type_name`` with the precision and scale of a decimal."""
    return f"numeric({dt.precision},{dt.scale})" if isinstance(dt, T.DecimalType) else type_name(dt)


def contract_type(name: str) -> T.DataType:
    """Parse a contract type name (``numeric(38,2)``, ``varchar(6)``, ...)."""
    key = name.strip().lower()
    if key.startswith("numeric(") or key.startswith("decimal("):
        p, s = key[key.index("(") + 1 : -1].split(",")
        return T.DecimalType(int(p), int(s))
    if key.startswith("varchar(") or key.startswith("character varying("):
        return T.StringType()
    return CONTRACT_TYPES[key]
