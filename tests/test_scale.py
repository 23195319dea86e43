"""What a task holds doesn't grow with the tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgermart.plans import driver_tables as D


@pytest.fixture()
def tables(spark, tmp_path):
    """Orders of many customers in few nations and months; a customer and an order come twice, keys may be null."""
    d = str(tmp_path / "t")
    n = 400
    customers = [(i, i % 3) for i in range(n)] + [(1, 2), (None, 1)]
    orders = [(i, i % n, "F" if i % 7 else "O", dt.datetime(1996, 1 + i % 2, 5)) for i in range(3 * n)] + [(5, 5, "O", dt.datetime(1996, 1, 5)), (None, 1, "F", None), (3 * n, None, "F", dt.datetime(1996, 1, 1))]
    items = [(i % (3 * n + 5), i % 11, float(i) / 4) for i in range(6 * n)] + [(None, 1, 1.0), (1, None, 1.0), (2, 2, None)]
    parts = [(i, "SMALL" if i % 2 else "LARGE") for i in range(10)] + [(None, "PROMO"), (3, None)]
    for name, rows, schema in (("customer", customers, "c_custkey long, c_nationkey int"), ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz"),
                               ("lineitem", items, "l_orderkey long, l_partkey long, l_extendedprice double"), ("part", parts, "p_partkey long, p_type string")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def test_member_mart_groups_by_member_only(spark, tables):
    mart = D.build_member_account_month(spark, tables)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "HashAggregate" in line]
    assert grouped and not [line for line in grouped if "o_custkey" in line]
    # against the whole join, grouped once
    c, o, li, p = (D.table(spark, tables, n) for n in ("customer", "orders", "lineitem", "part"))
    rows = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).join(c, o.o_custkey == c.c_custkey)
    plain = rows.groupBy(D._month("o_orderdate").alias("report_month"), "c_nationkey", "p_type").agg(
        F.sum(D.money("l_extendedprice")).alias("amount"), F.count(F.lit(1)).alias("line_count"), F.bool_and(F.col("o_orderstatus") == "F").alias("is_final"))
    assert mart.schema.simpleString() == plain.schema.simpleString()
    assert mart.count() > 10 and mart.exceptAll(plain).isEmpty() and plain.exceptAll(mart).isEmpty()


def test_mart_partitions_follow_the_input(spark, tables, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size = D.input_bytes(spark, tables)
    monkeypatch.setattr(D, "PARTITION_BYTES", -(-size // 40))
    seen = []

    def build():
        seen.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return spark.range(3)

    assert D.session_mart(spark, tables, "probe", build).count() == 3
    assert 30 < seen[0] <= 40 and spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(ValueError), D.shuffles_for(spark, tables):
        raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_landing_takes_each_cell_once(spark):
    from ledgermart.sources import archives

    header = ["DATA_BASE", "DOCUMENTO", "CNPJ", "NOME_INSTITUICAO", "CONTA", "NOME_CONTA", "SALDO"]
    known = ("p", "sha", "m.csv", 1, 9, "utf-8-sig", 1, "#Gerado em 10/02/2025", 1, header)
    rows = [(*known, None, None, None), (*known, 1, ["202501", " 4010\t", "1", "A", "9", "n", " 1.234,5 "], None)]
    records = spark.createDataFrame([("sha", "202501", "u", "2025-03-01 00:00:00")], "source_checksum string, period string, source_url string, retrieved_at_utc string")
    landed = archives.landing_rows(spark.createDataFrame(rows, archives.RAW_SCHEMA), records)
    plan = landed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_position(") == 1
    (row,) = landed.collect()
    assert (row.documento, row.saldo_raw, str(row.saldo), row.agencia) == ("4010", "1.234,5", "1234.50", None)
    for short, message in ((["202501"], "row changed shape"), (["202502", *"123456"], "row of another period"), (["202501", *"12345", "x"], "invalid balance")):
        bad = spark.createDataFrame([rows[0], (*known, 1, short, None)], archives.RAW_SCHEMA)
        with pytest.raises(Exception, match=message):
            archives.landing_rows(bad, records).collect()
