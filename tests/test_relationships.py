"""The relationship graph: paths, single direction, derived joins."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgermart.operators.relationships import MART_RELATIONSHIPS, Ambiguous, Measure, Relationship, Relationships, Unreachable


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    sales = [(rng.choice([1, 1, 1, 2, 3, 9, None]), rng.randint(1, 4), rng.randint(1, 50)) for _ in range(400)]
    returns = [(rng.randint(1, 4), rng.randint(1, 9)) for _ in range(60)]
    return sales, returns


@pytest.fixture(scope="module")
def graph(spark, rows):
    sales, returns = rows
    tables = {
        "sales": spark.createDataFrame(sales, "shop int, day int, amount int"),
        "returns": spark.createDataFrame(returns, "day int, amount int"),
        "shops": spark.createDataFrame([(1, "A", 10), (2, "B", 20), (3, "C", None)], "shop int, name string, region int"),
        "regions": spark.createDataFrame([(10, "north"), (20, "south")], "region int, label string"),
        "days": spark.createDataFrame([(d, d % 2) for d in range(1, 5)], "day int, odd int"),
    }
    return Relationships(tables, [Relationship("sales", "shop", "shops", "shop"), Relationship("sales", "day", "days", "day"), Relationship("returns", "day", "days", "day"),
                                  Relationship("shops", "region", "regions", "region"), Relationship("sales", "day", "regions", "region", active=False)])


SHOPS = {1: ("A", "north"), 2: ("B", "south"), 3: ("C", None)}


def test_measures_follow_a_path_of_two_hops(graph, rows):
    got = graph.query({"total": Measure("sales", "sum", "amount"), "n": Measure("sales", "count", "amount"), "shops": Measure("sales", "count_distinct", "shop"),
                       "most": Measure("sales", "max", "amount")}, by=["regions.label", "days.odd"])
    want = defaultdict(list)
    for shop, day, amount in rows[0]:
        want[SHOPS.get(shop, (None, None))[1], day % 2].append((shop, amount))
    assert {(r.label, r.odd): (r.total, r.n, r.shops, r.most) for r in got.collect()} == {
        k: (sum(a for _, a in v), len(v), len({s for s, _ in v if s is not None}), max(a for _, a in v)) for k, v in want.items()}


def test_filters_go_from_one_to_many_only(graph, rows):
    measures = {"sold": Measure("sales", "sum", "amount"), "returned": Measure("returns", "sum", "amount")}
    got = graph.query(measures, by=["days.day"], where={"shops": F.col("name") == "A", "days": F.col("odd") == 1})
    sold, back = defaultdict(int), defaultdict(int)
    for shop, day, amount in rows[0]:
        if shop == 1 and day % 2:
            sold[day] += amount
    for day, amount in rows[1]:
        if day % 2:
            back[day] += amount  # returns don't lead to shops
    assert {r.day: (r.sold, r.returned) for r in got.collect()} == {d: (sold[d], back[d]) for d in sold}
    # a filter on a fact stays there
    got = graph.query(measures, where={"returns": F.col("amount") > 100}).first()
    assert (got.sold, got.returned) == (sum(a for *_, a in rows[0]), None)


def test_the_fact_is_aggregated_before_the_joins(graph):
    plan = graph.query({"total": Measure("sales", "sum", "amount")}, by=["shops.name"])._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    assert "Aggregate" in plan[join:]  # below the join
    assert "odd" not in plan and "label" not in plan  # no other dimension is read


def test_missing_and_double_paths_are_errors(graph, spark):
    with pytest.raises(Unreachable):
        graph.query({"x": Measure("returns", "sum", "amount")}, by=["shops.name"])
    with pytest.raises(Unreachable):
        graph.path("shops", "sales")  # not against the direction
    with pytest.raises(Ambiguous, match="several ways"):
        graph.query({"x": Measure("sales", "sum", "amount")}, by=["regions.label"], use=["sales.day -> regions.region"])
    with pytest.raises(ValueError, match="there is no table"):
        Relationships({"a": spark.range(1)}, [Relationship("a", "id", "b", "id")])
    with pytest.raises(ValueError, match="names of their own"):
        graph.query({"day": Measure("sales", "sum", "amount")}, by=["days.day"])


def test_controls_count_orphans_and_repeated_keys(graph, rows, spark):
    got = {r.relationship: r for r in graph.controls().collect()}
    shop = got["sales.shop -> shops.shop"]
    assert (shop.many_rows, shop.orphan_rows, shop.repeated_keys, shop.passed) == (400, sum(s == 9 for s, *_ in rows[0]), 0, False)
    assert got["shops.region -> regions.region"].passed and not got["sales.day -> regions.region"].active
    double = Relationships({"a": spark.createDataFrame([(1,)], "k int"), "b": spark.createDataFrame([(1,), (1,), (2,)], "k int")}, [Relationship("a", "k", "b", "k")])
    assert [(r.orphan_rows, r.repeated_keys, r.passed) for r in double.controls().collect()] == [(0, 1, False)]


def test_the_model_has_thirteen_relationships():
    assert len({r.name for r in MART_RELATIONSHIPS}) == 13
