"""Data-quality checks and control sets (Q1–Q21).

Every ``check_*`` returns the *failing* rows (empty = pass), the way a
singular SQL test does.  ``build_controls`` turns several checks into one
control table ``(control_name, passed, expected, actual, detail)`` with a
final fail-closed roll-up row.  Each control is one aggregate over its check,
never a collect to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.functions._util import names
from ledgermart.functions.numbers import differs
from ledgermart.functions.types import sized_type_name, type_name
from ledgermart.operators.aggregates import metrics_row
from ledgermart.operators.calendar import continuity_breaks
from ledgermart.operators.joins import set_diff


def check_not_null(df: DataFrame, cols) -> DataFrame:
    """Q1: rows where any listed column is null."""
    cond = None
    for c in names(cols):
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def check_unique(df: DataFrame, cols) -> DataFrame:
    """Q2 / Q4: key values occurring more than once (with their count)."""
    return df.groupBy(*names(cols)).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def check_accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """Q3: values outside the accepted set (nulls are ``not_null``'s business)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
            .groupBy(col).agg(F.count(F.lit(1)).alias("row_count")))


def check_row_count(df: DataFrame, key, declared: str) -> DataFrame:
    """Q5: declared vs actual row count per key."""
    return df.groupBy(*names(key)).agg(
        F.max(declared).alias("declared_row_count"), F.count(F.lit(1)).alias("actual_row_count")
    ).filter(F.col("declared_row_count") != F.col("actual_row_count"))


def check_one_selected(df: DataFrame, period: str, flag: str = "is_selected") -> DataFrame:
    """Q6: periods without exactly one selected version."""
    return df.groupBy(period).agg(F.count_if(F.col(flag)).alias("selected")).filter(F.col("selected") != 1)


def check_identity(df: DataFrame, keys, code: str, amount: str, left: list[str], right: tuple[str, str],
                   codes: dict[str, str], tolerance: float = 0.01, lenient: bool = False) -> DataFrame:
    """Q7: ``sum(left) = right[0] − right[1]`` per key; a missing component fails, unless ``lenient``.

    ``codes`` maps alias → account code; ``left`` and ``right`` name aliases.
    """
    pivot = df.groupBy(*names(keys)).agg(
        *[F.sum(F.when(F.col(code) == F.lit(v), F.col(amount))).alias(k) for k, v in codes.items()]
    )
    any_null = None
    for k in codes:
        any_null = F.col(k).isNull() if any_null is None else any_null | F.col(k).isNull()
    lhs = sum((F.col(c) for c in left[1:]), F.col(left[0]))
    rhs = F.col(right[0]) - F.col(right[1])
    unequal = differs(lhs, rhs, tolerance)
    return pivot.filter(~any_null & unequal if lenient else any_null | unequal)


def check_continuity(df: DataFrame, key, month: str) -> DataFrame:
    """Q8: months that do not follow the previous month of the key."""
    return continuity_breaks(df, key, month)


def check_exact_set(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Q9: missing / unexpected codes."""
    return set_diff(expected, actual)


def check_reconciles(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Q10: symmetric difference of two relations with the same columns."""
    return set_diff(expected, actual, missing="expected_only", unexpected="actual_only")


def check_coverage_gate(metrics: DataFrame, active: Column, ok: Column) -> DataFrame:
    """Q11: the metrics row fails only when the gate is active and not ok."""
    return metrics.filter(active & ~ok)


def check_stable_membership(df: DataFrame, member: str, month: str, expected: int) -> DataFrame:
    """Q12: members not present in exactly ``expected`` months."""
    return df.groupBy(member).agg(F.count_distinct(month).alias("months")).filter(F.col("months") != expected)


def check_schema(df: DataFrame, expected: T.StructType | list[tuple[str, str]]) -> list[dict]:
    """Q13: ordered (name, type) comparison of a schema with a contract.

    Pure metadata: no job runs.  Returns one dict per position that differs.
    """
    if isinstance(expected, T.StructType):
        exp = [(f.name, sized_type_name(f.dataType)) for f in expected.fields]
    else:
        exp = [(n, t) for n, t in expected]
    # a contract that says just ``numeric`` leaves precision and scale open
    act = [(f.name, type_name(f.dataType) if i < len(exp) and exp[i][1] == "numeric" else sized_type_name(f.dataType))
           for i, f in enumerate(df.schema.fields)]
    issues = []
    for i in range(max(len(exp), len(act))):
        e = exp[i] if i < len(exp) else None
        a = act[i] if i < len(act) else None
        if e != a:
            issues.append({"position": i + 1, "expected": e, "actual": a})
    return issues


def live_contract(spark: SparkSession, relations: dict[str, DataFrame], contract: dict[str, list[tuple]]) -> DataFrame:
    """Evidence of a live contract (Q13, Q19): one row per contracted or actual column.

    ``contract`` lists (column, type, required) in order for each relation.  Names,
    order and types come from the schema of the relation as it is (no job); nulls
    of all required columns of a relation from one aggregate over it.  Columns:
    relation, position, column_name, expected, actual, null_rows (null where it
    isn't required or isn't there), passed.  A relation or column on one side only
    fails; ``actual`` or ``expected`` says ``missing`` there.
    """
    tables = []
    for name in sorted(set(relations) | set(contract)):
        exp, df = contract.get(name, []), relations.get(name)
        act = [] if df is None else df.schema.fields
        structs = []
        for i in range(max(len(exp), len(act))):
            want = exp[i] if i < len(exp) else None
            have = act[i] if i < len(act) else None
            open_size = want is not None and want[1] == "numeric"
            found = None if have is None else f"{have.name} {type_name(have.dataType) if open_size else sized_type_name(have.dataType)}"
            asked = None if want is None else f"{want[0]} {want[1]}"
            required = want is not None and want[2] and df is not None and want[0] in df.columns
            nulls = F.count_if(F.col(f"`{want[0]}`").isNull()) if required else F.lit(None).cast("bigint")
            structs.append(F.struct(
                F.lit(name).alias("relation"), F.lit(i + 1).alias("position"), F.lit(want[0] if want else have.name).alias("column_name"),
                F.lit(asked or "missing").alias("expected"), F.lit(found or "missing").alias("actual"), nulls.alias("null_rows"),
                (F.lit(asked == found) & (F.coalesce(nulls, F.lit(0)) == 0)).alias("passed")))
        if structs:
            frame = spark.range(1) if df is None else df
            tables.append(frame.agg(F.array(*structs).alias("_rows")).select(F.inline("_rows")))
    if not tables:
        raise ValueError("a live contract needs a relation")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def duplicate_detail(df: DataFrame, key: str) -> DataFrame:
    """Q21: one row per duplicated key value with ``value×count`` detail text.

    Kept one row per value (not one string of all values) so a badly broken
    table never funnels its duplicates through a single task.
    """
    dups = check_unique(df, key)
    return dups.select(
        F.col(key), "row_count",
        F.concat(F.col(key).cast("string"), F.lit("×"), F.col("row_count").cast("string")).alias("detail"))


def duplicate_text(df: DataFrame, key: str, most: int = 10) -> DataFrame:
    """Q21: one row ``(duplicates, detail)``: how many key values repeat, and the ``most`` worst as text.

    ``detail`` lists ``value×count``, the most frequent first and equal counts by
    value; what it leaves out stands as ``+n more``.  The shown values are a
    distributed top-k (each task sends on at most ``most`` rows), so a badly broken
    table stays one small row.  Null keys count as one value, ``<null>``; without
    duplicates the detail is empty.
    """
    dups = check_unique(df, key).select(F.coalesce(F.col(key).cast("string"), F.lit("<null>")).alias("value"), "row_count")
    top = dups.orderBy(F.desc("row_count"), "value").limit(most)
    shown = F.array_sort(F.collect_list(F.struct((-F.col("row_count")).alias("order"), "value")))
    listed = top.agg(F.concat_ws(", ", F.transform(shown, lambda d: F.concat(d["value"], F.lit("×"), (-d["order"]).cast("string")))).alias("listed"))
    counted = metrics_row(df.sparkSession, {"duplicates": (dups, F.count(F.lit(1))), "listed": (listed, F.max("listed"))})
    more = F.when(F.col("duplicates") > most, F.concat(F.lit(", +"), (F.col("duplicates") - most).cast("string"), F.lit(" more"))).otherwise("")
    return counted.select("duplicates", F.concat(F.col("listed"), more).alias("detail"))


def _row_hash(columns: list[str], seed: int) -> Column:
    """A 64-bit hash of a row's values, of where it is null, and of the columns' names."""
    parts = [x for c in columns for x in (F.lit(c), F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")


def replay_compare(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Q18: per relation ``(relation, rows_before, rows_after, identical)``; are both sides the same multiset of rows?

    Every row counts +1 before and -1 after, together with two independent 64-bit
    hashes of its values, so equal multisets cancel to zero in any order and any
    number of partitions.  Swapped or changed values, another type or name of a
    column, and lost or repeated rows leave a rest (but for hash collisions, about
    one in 2^128).  One partial aggregate over each relation, a few rows shuffle.
    A relation on one side only isn't identical, nor are two empty ones whose
    schemas differ; columns of map type can't be hashed.
    """
    parts = []
    for relation in sorted(set(before) | set(after)):
        sides = [(side[relation], sign) for side, sign in ((before, 1), (after, -1)) if relation in side]
        alike = len(sides) == 2 and sorted(sides[0][0].dtypes) == sorted(sides[1][0].dtypes)
        rows = None
        for df, sign in sides:
            columns = sorted(df.columns)
            one = df.select(F.lit(sign).alias("sign"), *[(_row_hash(columns, seed) * sign).alias(f"h{seed}") for seed in (1, 2)])
            rows = one if rows is None else rows.unionByName(one)
        same = (F.coalesce(F.sum("h1"), F.lit(0)) == 0) & (F.coalesce(F.sum("h2"), F.lit(0)) == 0)
        parts.append(rows.agg(
            F.lit(relation).alias("relation"), F.count_if(F.col("sign") > 0).alias("rows_before"), F.count_if(F.col("sign") < 0).alias("rows_after"),
            (F.lit(alike) & same & (F.coalesce(F.sum("sign"), F.lit(0)) == 0)).alias("identical")))
    if not parts:
        raise ValueError("no relations to compare")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@dataclass
class Control:
    """One control: ``actual`` is an aggregate Column over ``frame``."""

    name: str
    frame: DataFrame
    actual: Column
    expected: object
    op: str = "=="  # one of ==, <=, >=, <, >, !=
    detail: str = ""


_OPS = {
    "==": lambda a, e: a == e,
    "<=": lambda a, e: a <= e,
    ">=": lambda a, e: a >= e,
    "<": lambda a, e: a < e,
    ">": lambda a, e: a > e,
    "!=": lambda a, e: a != e,
}


def failing_rows(name: str, check: DataFrame, detail: str = "") -> Control:
    """A control that passes when ``check`` returns no rows."""
    return Control(name, check, F.count(F.lit(1)), 0, "==", detail)


def build_controls(spark: SparkSession, controls: list[Control], rollup_name: str = "all_controls_pass") -> DataFrame:
    """Control table (Q14–Q20), the last row = AND of all earlier ones.

    Each control is one value, evaluated once; all of them stand in one row,
    which is turned into the table's rows together with the roll-up.
    """
    values = metrics_row(spark, {f"_a{i}": (c.frame, c.actual) for i, c in enumerate(controls)})
    passed = [F.coalesce(_OPS[c.op](F.col(f"_a{i}"), F.lit(c.expected)), F.lit(False)) for i, c in enumerate(controls)]

    def row(order, name, ok, expected, actual, detail):
        return F.struct(F.lit(order).alias("control_order"), F.lit(name).alias("control_name"), ok.alias("passed"),
                        F.lit(expected).alias("expected"), actual.alias("actual"), F.lit(detail).alias("detail"))

    rows = [row(i + 1, c.name, passed[i], f"{c.op} {c.expected}", F.col(f"_a{i}").cast("string"), c.detail)
            for i, c in enumerate(controls)]
    table = values.select(F.array(*rows).alias("_rows"))
    good = F.size(F.filter("_rows", lambda r: r["passed"]))
    rollup = row(len(controls) + 1, rollup_name, good == len(controls), "all prior controls pass",
                 F.concat(good.cast("string"), F.lit(f"/{len(controls)}")), "fail-closed roll-up")
    return table.select(F.inline(F.concat("_rows", F.array(rollup))))
