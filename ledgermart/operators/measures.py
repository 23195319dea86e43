"""Governed measures over a line-balance fact.

A filter context becomes ``(by, where, months)``:

* ``by``     – group keys (the visual's axes / rows);
* ``where``  – a Column filter on fact attributes (slicers: member, line, ...);
* ``months`` – an optional inclusive (start, end) filter on the date axis,
  kept apart because growth measures replace it (DAX ``ALL('Date')``).

Rules reproduced (see SURVEY §2.8):

1. Balances are semi-additive: a line's value is its sum **at the last month
   present in the group's context**, the last month being chosen over *all*
   lines (the line filter is applied afterwards).  A line missing in that
   month is null – no fall-back to an older month.
2. Hence totals are not sums of members when a member ends early; the share
   denominator follows the total's own rule.
3. A ``where`` on another line intersects: Total Assets is then null.
4. Growth: the current month is the group's month, else the last fact month
   (``anchor="fact"``) or the last calendar month in context
   (``anchor="date_dim"``, parity with the report).  The prior value is the
   exact month ``n`` back (not a row offset).  Prior null → null; current null
   with prior present → −100 %.
5. Peer median: over members with a value; blanks drop out.

All inputs are aggregated facts (month × member × line); every step is a
groupBy / equi-join on the group keys or an uncorrelated scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.functions._util import names
from ledgermart.functions.numbers import growth, safe_divide

# The four governed reporting lines and the ratio definitions.
LINES = {
    "total_assets": "total_assets",
    "credit_portfolio": "credit_portfolio",
    "deposits": "deposits",
    "equity": "equity",
}
RATIOS = {
    "credit_share": ("credit_portfolio", "total_assets"),
    "deposit_funding_share": ("deposits", "total_assets"),
    "equity_to_assets": ("equity", "total_assets"),
}
GROWTH = {"mom_growth": 1, "yoy_growth": 12}


def at_last_month(df: DataFrame, month: str, by=()) -> DataFrame:
    """Rows of ``df`` at the last month present per ``by`` group."""
    b = [c for c in names(by) if c != month]
    if month in names(by):
        return df
    if not b:
        return df.filter(F.col(month) == df.select(F.max(month)).scalar())
    last = df.groupBy(*b).agg(F.max(month).alias("_last"))
    return df.join(last, b, "inner").filter(F.col(month) == F.col("_last")).drop("_last")


def prior_period(df: DataFrame, month: str, n: int, keys, value: str, out_col: str = "prior_value") -> DataFrame:
    """Value of the exact month ``n`` months earlier for the same keys."""
    ks = [k for k in names(keys) if k != month]
    shifted = df.select(*ks, F.add_months(month, n).alias(month), F.col(value).alias(out_col))
    return df.join(shifted, [*ks, month], "left")


def share_of_selection(df: DataFrame, measure: str, by=(), out_col: str = "share") -> DataFrame:
    """Member value ÷ the total over the selection per ``by``.

    ``df`` holds one row per member (and ``by`` keys); the total is a groupBy
    on ``by`` (or a scalar subquery without ``by``).
    """
    b = names(by)
    if not b:
        total = df.select(F.sum(measure)).scalar()
        return df.withColumn(out_col, safe_divide(measure, total))
    totals = df.groupBy(*b).agg(F.sum(measure).alias("_total"))
    return df.join(totals, b, "left").withColumn(out_col, safe_divide(measure, "_total")).drop("_total")


class MeasureModel:
    """The measure layer over a line fact (one row per month × member × line)."""

    def __init__(
        self,
        fact: DataFrame,
        month: str = "report_month",
        member: str = "bank_key",
        line: str = "reporting_line_code",
        amount: str = "presentation_balance_amount",
        date_dim: DataFrame | None = None,
        date_month: str = "month_start",
        lines: dict[str, str] | None = None,
        member_attributes: Sequence[str] = (),
    ):
        """``member_attributes``: further columns that name the member (its
        label, say); the share's denominator clears them with the member."""
        self.fact = fact
        self.month = month
        self.member = member
        self.line = line
        self.amount = amount
        self.date_dim = date_dim
        self.date_month = date_month
        self.lines = dict(lines or LINES)
        self.member_attributes = tuple(member_attributes)

    # -- context -----------------------------------------------------------
    def _months(self, df: DataFrame, months, col: str | None = None) -> DataFrame:
        if not months:
            return df
        c = F.col(col or self.month)
        start, end = months
        return df.filter((c >= F.lit(start).cast("date")) & (c <= F.lit(end).cast("date")))

    def context(self, where: Column | None = None, months=None) -> DataFrame:
        df = self.fact if where is None else self.fact.filter(where)
        return self._months(df, months)

    # -- building blocks ---------------------------------------------------
    def line_values(self, ctx: DataFrame, by: Sequence[str]) -> DataFrame:
        """M1–M4 for every group of ``by``."""
        at = at_last_month(ctx, self.month, by)
        g = at.groupBy(*by)
        return g.agg(
            *[F.sum(F.when(F.col(self.line) == F.lit(code), F.col(self.amount))).alias(name)
              for name, code in self.lines.items()]
        )

    def _current_month(self, ctx: DataFrame, by: Sequence[str], anchor: str, months) -> DataFrame | Column:
        if self.month in by:
            return F.col(self.month)
        if anchor == "date_dim":
            if self.date_dim is None:
                raise ValueError("anchor='date_dim' needs a date dimension")
            dd = self._months(self.date_dim, months, self.date_month)
            return dd.select(F.max(self.date_month)).scalar()
        if not by:
            return ctx.select(F.max(self.month)).scalar()
        return ctx.groupBy(*by).agg(F.max(self.month).alias("_cur_month"))

    def growth_frame(self, ctx: DataFrame, base: DataFrame, by: Sequence[str], n: int,
                     anchor: str, months, out_col: str) -> DataFrame:
        """Total-assets growth over ``n`` months for every group of ``by``."""
        ta = self.lines["total_assets"]
        prior_rows = base.filter(F.col(self.line) == F.lit(ta))
        others = [c for c in by if c != self.month]
        cur_month = self._current_month(ctx, by, anchor, months)
        if self.month in by:
            # months of the context only: a prior value doesn't open a month beyond it
            shown = ctx.select(self.month).distinct()
            prior = prior_rows.groupBy(*others, F.add_months(self.month, n).alias(self.month)).agg(
                F.sum(self.amount).alias("_prior")).join(shown, self.month, "left_semi")
        elif isinstance(cur_month, DataFrame):
            prior = prior_rows.join(cur_month, others, "inner").filter(
                F.col(self.month) == F.add_months("_cur_month", -n)
            ).groupBy(*by).agg(F.sum(self.amount).alias("_prior"))
        else:
            prior = prior_rows.filter(F.col(self.month) == F.add_months(cur_month, -n)).groupBy(*by).agg(
                F.sum(self.amount).alias("_prior"))
        cur = self.line_values(ctx, by).select(*by, F.col("total_assets").alias("_cur"))
        if not by:
            return cur.select(growth(F.col("_cur"), prior.select("_prior").scalar()).alias(out_col))
        # a group that has only a prior value is one that ended: -100 %
        j = cur.join(prior, list(by), "full_outer")
        return j.select(*by, growth("_cur", "_prior").alias(out_col))

    def peer_median(self, ctx: DataFrame, by: Sequence[str], out_col: str = "peer_median") -> DataFrame:
        """Median of members' total assets (each at its own last month)."""
        per_member = list(dict.fromkeys([*by, self.member]))
        vals = self.line_values(ctx, per_member)
        # median over integer cents: exact midpoint, engine-independent
        cents = (F.col("total_assets") * 100).cast("double")
        return vals.groupBy(*by).agg((F.median(cents) / 100).alias(out_col))

    # -- cards ---------------------------------------------------------------
    def card(self, measures: Sequence[str], base: DataFrame, months=None, anchor: str = "fact") -> DataFrame:
        """Measures without group keys from one read of the fact.

        The fact is summed per month and line; the months (a bounded list)
        come together in one row, and every measure picks its months there.
        """
        ta = next(k for k, code in self.lines.items() if code == self.lines["total_assets"])
        per_month = base.groupBy(F.col(self.month).alias("_m")).agg(*[
            F.sum(F.when(F.col(self.line) == F.lit(code), F.col(self.amount))).alias(name) for name, code in self.lines.items()])
        inside = F.lit(True)
        if months:
            inside = F.col("_m").between(F.lit(months[0]).cast("date"), F.lit(months[1]).cast("date"))
        row = per_month.agg(F.max(F.when(inside, F.col("_m"))).alias("_last"),
                            F.collect_list(F.struct("_m", *self.lines)).alias("_all"))
        if anchor == "date_dim":
            if self.date_dim is None:
                raise ValueError("anchor='date_dim' needs a date dimension")
            row = row.withColumn("_anchor", self._months(self.date_dim, months, self.date_month).select(F.max(self.date_month)).scalar())
        else:
            row = row.withColumn("_anchor", F.col("_last"))

        def at(name: str, month: Column) -> Column:
            return F.get(F.filter("_all", lambda s: s["_m"] == month), 0)[name]

        def value(m: str) -> Column:
            if m in self.lines:
                return at(m, F.col("_last"))
            if m in RATIOS:
                return safe_divide(*[at(part, F.col("_last")) for part in RATIOS[m]])
            if m == "population_share":
                return safe_divide(at(ta, F.col("_last")), at(ta, F.col("_last")))
            if m in GROWTH:
                return growth(at(ta, F.col("_last")), at(ta, F.add_months("_anchor", -GROWTH[m])))
            raise ValueError(f"unknown measure {m!r}")

        return row.select(*[value(m).alias(m) for m in measures])

    # -- query -------------------------------------------------------------
    def query(self, measures: Sequence[str], by=(), where: Column | None = None, months=None,
              anchor: str = "fact") -> DataFrame:
        by = names(by)
        base = self.fact if where is None else self.fact.filter(where)
        if not by and "peer_median" not in measures:
            return self.card(measures, base, months, anchor)
        ctx = self.context(where, months)
        vals = self.line_values(ctx, by)
        frames: list[DataFrame] = [vals]
        selected: list[Column] = []
        for m in measures:
            if m in self.lines:
                selected.append(F.col(m))
            elif m in RATIOS:
                num, den = RATIOS[m]
                selected.append(safe_divide(num, den).alias(m))
            elif m == "population_share":
                rest = [c for c in by if c != self.member and c not in self.member_attributes]
                den = self.line_values(ctx, rest).select(*rest, F.col("total_assets").alias("_selection_total"))
                frames.append(den)
                selected.append(safe_divide("total_assets", "_selection_total").alias(m))
            elif m in GROWTH:
                frames.append(self.growth_frame(ctx, base, by, GROWTH[m], anchor, months, m))
                selected.append(F.col(m))
            elif m == "peer_median":
                frames.append(self.peer_median(ctx, by))
                selected.append(F.col(m))
            else:
                raise ValueError(f"unknown measure {m!r}")
        return _combine(frames, by).select(*by, *selected)


def _combine(frames: list[DataFrame], by: list[str]) -> DataFrame:
    """Join per-group measure frames on ``by``; without keys, one row of scalars."""
    if by:
        out = frames[0]
        for f in frames[1:]:
            rest = [c for c in by if c in f.columns]
            # growth frames may hold groups that have only a prior value
            out = out.join(f, rest, "full_outer" if len(rest) == len(by) else "left") if rest else out.withColumns({c: f.select(c).scalar() for c in f.columns})
        return out
    out = frames[0]
    for f in frames[1:]:
        out = out.withColumns({c: f.select(c).scalar() for c in f.columns})
    return out


def measure_query(fact: DataFrame, measures: Sequence[str], by=(), where: Column | None = None, months=None,
                  anchor: str = "fact", **columns) -> DataFrame:
    """Functional form of :meth:`MeasureModel.query`; ``columns`` name the
    fact's month / member / line / amount columns and the date dimension."""
    return MeasureModel(fact, **columns).query(measures, by=by, where=where, months=months, anchor=anchor)


# -- simple measures (M12–M16) ---------------------------------------------
def account_amount(fact: DataFrame, amount: str = "balance_amount", by=(), where: Column | None = None) -> DataFrame:
    """Sum of account balances."""
    df = fact if where is None else fact.filter(where)
    return df.groupBy(*names(by)).agg(F.sum(amount).alias("account_balance_amount"))


def macro_value(fact: DataFrame, value: str = "value", by=("series_code", "month_key")) -> DataFrame:
    """Macro value, meaningful only split by series."""
    return fact.groupBy(*names(by)).agg(F.sum(value).alias("macro_value"))


def trust_card(source_files: DataFrame, date_dim: DataFrame, period: str = "source_period",
               month_key: str = "month_key") -> DataFrame:
    """Latest source period, selected source files, months covered."""
    return source_files.agg(
        F.max(period).alias("latest_source_period"),
        F.count(F.lit(1)).alias("selected_source_files"),
    ).withColumn("months_covered", date_dim.select(F.count_distinct(month_key)).scalar())
