"""A relationship graph over marts: paths, filters and grouped measures.

Relationships lead from the many side to the one side, and filters only the
other way: a filter on a dimension reaches the facts that lead to it, never a
dimension from a fact, nor another dimension through one.  A filter on a table
that a fact doesn't lead to leaves that fact's measures as they are.  Columns
to group by must be reachable from every measure's table by exactly one path of
active relationships: none is an error, two are an ambiguity and an error too.

``query`` derives the joins.  Each fact is first aggregated to the foreign keys
that the query needs (partial aggregation on the map side), then joined with
the needed columns of the dimensions, then aggregated to the group; so the
joins see one row a key combination, not the fact.  Rows without a partner in a
dimension are kept under null, unless a filter asks for that dimension.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Unreachable(ValueError):
    """No path of active relationships."""


class Ambiguous(ValueError):
    """Several paths of active relationships."""


@dataclass(frozen=True)
class Relationship:
    """``many.many_col`` → ``one.one_col``."""

    many: str
    many_col: str
    one: str
    one_col: str
    active: bool = True

    @property
    def name(self) -> str:
        return f"{self.many}.{self.many_col} -> {self.one}.{self.one_col}"


@dataclass(frozen=True)
class Measure:
    """``kind`` (sum, count, min, max, count_distinct) of a table's column."""

    table: str
    kind: str
    column: str


#: How a measure is begun at the grain of the keys, and how those values go on.
_BEGIN = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_GO_ON = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


class Relationships:
    """Tables by name and the relationships between them."""

    def __init__(self, tables: Mapping[str, DataFrame], relationships):
        self.tables, self.edges = tables, list(relationships)
        for r in self.edges:
            for table in (r.many, r.one):
                if table not in tables:
                    raise ValueError(f"{r.name}: there is no table {table}")
            if r.many == r.one:
                raise ValueError(f"{r.name}: a table doesn't lead to itself")

    def paths(self, start: str, target: str, use=()) -> list[list[Relationship]]:
        """All paths of active relationships, and of those in ``use``, from many to one."""
        found: list[list[Relationship]] = []

        def walk(at: str, path: list[Relationship]) -> None:
            if at == target:
                found.append(path)
                return
            for r in self.edges:
                if r.many == at and (r.active or r.name in use) and r.one not in {start, *(p.one for p in path)}:
                    walk(r.one, [*path, r])

        walk(start, [])
        return found

    def path(self, start: str, target: str, use=()) -> list[Relationship]:
        found = self.paths(start, target, use)
        if not found:
            raise Unreachable(f"{start} doesn't lead to {target}")
        if len(found) > 1:
            ways = "; ".join(" | ".join(r.name for r in p) for p in found)
            raise Ambiguous(f"{start} leads to {target} in several ways: {ways}")
        return found[0]

    def _joined(self, keys: DataFrame, prefix: str, path: list[Relationship], wanted: dict[str, str], condition: Column | None) -> DataFrame:
        """``keys`` with the columns ``wanted`` (name → alias) of the path's last table; inner if there is a condition."""
        out, at = keys, f"{prefix}{path[0].many_col}"
        for i, r in enumerate(path):
            last = i == len(path) - 1
            table = self.tables[r.one]
            if last and condition is not None:
                table = table.filter(condition)
            carried = {c: a for c, a in wanted.items()} if last else {path[i + 1].many_col: f"_hop{i}_{path[i + 1].many_col}"}
            right = table.select(F.col(r.one_col).alias("_one"), *[F.col(c).alias(a) for c, a in carried.items()])
            out = out.join(right, F.col(at) == F.col("_one"), "inner" if condition is not None else "left").drop("_one")
            if not last:
                at = f"_hop{i}_{path[i + 1].many_col}"
        return out

    def query(self, measures: Mapping[str, Measure], by=(), where: Mapping[str, Column] | None = None, use=()) -> DataFrame:
        """One row a group: the ``by`` columns ("table.column", named by their column) and the measures.

        ``where``: a condition over a table's own columns, by table.  Measures of several
        facts meet on the group; a group that a fact doesn't have is null in its measures.
        """
        where = dict(where or {})
        groups = [(t, c) for t, _, c in (b.rpartition(".") for b in by)]
        names = [c for _, c in groups]
        if len(set(names)) < len(names) or set(names) & set(measures):
            raise ValueError("columns to group by and measures need names of their own")
        parts = []
        for fact in dict.fromkeys(m.table for m in measures.values()):
            own = {n: m for n, m in measures.items() if m.table == fact}
            parts.append(self._grouped(fact, own, groups, where, use))
        if len(parts) == 1:
            return parts[0].select(*names, *measures)
        # one tagged union instead of a chain of full joins; null groups meet as well
        wide = [p.select(*names, *[F.col(n) if n in p.columns else F.lit(None).alias(n) for n in measures]) for p in parts]
        types = {n: next(p.schema[n].dataType for p in parts if n in p.columns) for n in measures}
        out = None
        for w in wide:
            w = w.select(*names, *[F.col(n).cast(types[n]).alias(n) for n in measures])
            out = w if out is None else out.unionByName(w)
        return out.groupBy(*names).agg(*[F.max(n).alias(n) for n in measures])

    def _grouped(self, fact: str, measures: dict[str, Measure], groups, where, use) -> DataFrame:
        rows = self.tables[fact]
        if fact in where:
            rows = rows.filter(where[fact])
        dims: dict[str, dict[str, str]] = {}
        for table, column in groups:
            if table != fact:
                dims.setdefault(table, {})[column] = f"_by_{column}"
        # single direction: a filter counts where the fact leads to its table
        filters = {t: c for t, c in where.items() if t != fact and self.paths(fact, t, use)}
        needed = {t: self.path(fact, t, use) for t in {**dims, **filters}}
        keys = sorted({p[0].many_col for p in needed.values()})
        own = sorted({c for t, c in groups if t == fact})
        distinct = sorted({m.column for m in measures.values() if m.kind == "count_distinct"})
        held = rows.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_by_{c}") for c in own],
                           *[F.col(c).alias(f"_set_{c}") for c in distinct],
                           *[F.col(m.column).alias(f"_value_{n}") for n, m in measures.items() if m.kind != "count_distinct"])
        grain = [c for c in held.columns if not c.startswith("_value_")]
        begun = [_BEGIN[m.kind](f"_value_{n}").alias(f"_value_{n}") for n, m in measures.items() if m.kind != "count_distinct"]
        # the grain of the keys; without keys and groups one row, also of an empty table
        part = held.groupBy(*grain).agg(*begun) if begun else held.distinct()
        for table, path in needed.items():
            part = self._joined(part, "_key_", path, dims.get(table, {}), filters.get(table))
        final = []
        for n, m in measures.items():
            if m.kind == "count_distinct":
                final.append(F.count_distinct(f"_set_{m.column}").alias(n))
            else:
                value = _GO_ON[m.kind](f"_value_{n}")
                if m.kind == "sum":
                    value = value.cast(part.schema[f"_value_{n}"].dataType)
                final.append((F.coalesce(value, F.lit(0)) if m.kind == "count" else value).alias(n))
        return part.groupBy(*[F.col(f"_by_{c}").alias(c) for _, c in groups]).agg(*final)

    def controls(self) -> DataFrame:
        """One row a relationship: rows of the many side, those without a partner, keys repeated on the one side.

        Null keys have no partner and aren't counted as orphans: they mean that there is none.
        """
        out = None
        for r in self.edges:
            many = self.tables[r.many].groupBy(F.col(r.many_col).alias("_key")).agg(F.count(F.lit(1)).alias("_many"))
            one = self.tables[r.one].groupBy(F.col(r.one_col).alias("_key")).agg(F.count(F.lit(1)).alias("_one"))
            both = many.join(one, "_key", "full_outer")
            row = both.agg(
                F.coalesce(F.sum("_many"), F.lit(0)).alias("many_rows"),
                F.coalesce(F.sum(F.when(F.col("_one").isNull() & F.col("_key").isNotNull(), F.col("_many"))), F.lit(0)).alias("orphan_rows"),
                F.count_if(F.col("_one") > 1).alias("repeated_keys"),
            ).select(F.lit(r.name).alias("relationship"), F.lit(r.active).alias("active"), "many_rows", "orphan_rows", "repeated_keys")
            out = row if out is None else out.unionByName(row)
        return out.withColumn("passed", (F.col("orphan_rows") == 0) & (F.col("repeated_keys") == 0))


# The thirteen relationships of the reporting model, all many-to-one.
MART_RELATIONSHIPS = [
    Relationship("fact_reporting_line_balance", "month_key", "dim_date", "month_key"),
    Relationship("fact_reporting_line_balance", "bank_key", "dim_bank", "bank_key"),
    Relationship("fact_reporting_line_balance", "reporting_line_key", "dim_reporting_line", "reporting_line_key"),
    Relationship("fact_reporting_line_balance", "source_file_key", "dim_source_file", "source_file_key"),
    Relationship("fact_account_balance", "month_key", "dim_date", "month_key"),
    Relationship("fact_account_balance", "bank_key", "dim_bank", "bank_key"),
    Relationship("fact_account_balance", "account_key", "dim_cosif_account", "account_key"),
    Relationship("fact_account_balance", "source_file_key", "dim_source_file", "source_file_key"),
    Relationship("fact_account_balance", "document_code", "dim_document", "document_code"),
    Relationship("bridge_account_reporting_line", "account_key", "dim_cosif_account", "account_key"),
    Relationship("bridge_account_reporting_line", "reporting_line_key", "dim_reporting_line", "reporting_line_key"),
    Relationship("fact_monthly_economic_context", "month_key", "dim_date", "month_key"),
    Relationship("fact_monthly_economic_context", "macro_series_key", "dim_macro_series", "macro_series_key"),
]
