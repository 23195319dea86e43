"""Operator 10: shards from a Feistel permutation of global row numbers. DataFrame functions only.

Rows are numbered 0 .. n - 1: a hash of the row chooses one of ``BUCKETS`` buckets, the counts of
the buckets give each its first number, and a window inside the bucket numbers its rows by id.
The numbering depends on the rows alone, not on files or tasks. A Feistel network over two
digits (of radix about the root of n) permutes a range slightly larger than n; a result outside
0 .. n - 1 is permuted again until it falls inside (cycle walking), which is a permutation of
the rows. Position p goes to shard p mod ``shards``, slot p div ``shards``: counts differ by at
most one, slots have no gaps, and the place of any row number can be computed without data.

Rows that agree in id and text are counted before any shuffle and given consecutive numbers, so a
row repeated without limit reaches the window as one row per task. Its numbers are written out in runs
of at most ``CHUNK``.

Edge cases: null text counts as no bytes (size 8); null ids are a value like others, spread by
their texts; an empty table gives an empty table; one row gets shard and slot from position 0;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermart.llm.common import text_of

#: Buckets of the numbering: fixed, so a bucket's share of n rows is n / BUCKETS.
BUCKETS = 8192
ROUNDS = 4
#: Copies of one row that are numbered in one array.
CHUNK = 1 << 16
#: Applications of the network at most. A walk visits distinct numbers outside the range, of which
#: there are at most root(n) + 1 among n, so up to 3,800 rows this many always suffice; above, a
#: longer walk has a chance below n ** -30 and would fail loudly.
WALK = 64


def whole(x: Column, y: Column) -> Column:
    """x div y for integers, without a detour through rounded fractions."""
    return F.call_function("div", x, y)


def permuted(x: Column, n: Column, seed: int = 0) -> Column:
    """The place of row number ``x`` among ``n``, a bijection of 0 .. n - 1 for each seed."""

    def network(v: Column) -> Column:
        root = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
        a = F.when(root * root < n, root + 1).otherwise(root)
        b = whole(n + a - 1, a)
        left, right = whole(v, b), F.pmod(v, b)
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), F.lit(i), right), a), a)
            else:
                right = F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), F.lit(i), left), b), b)
        return left * b + right

    steps = F.sequence(F.lit(2), F.lit(WALK))
    walked = F.aggregate(steps, network(x), lambda at, _: F.when(at >= n, network(at)).otherwise(at))
    return walked


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct rows: doc_id, size, text_crc32, times (rows that agree), first (their first number), total."""
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    distinct = rows.groupBy("doc_id", "size", "text_crc32", "text_hash").agg(F.count("*").alias("times"))
    dealt = distinct.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(BUCKETS)))
    per_bucket = dealt.groupBy("bucket").agg(F.sum("times").alias("held"))
    # at most BUCKETS rows, whatever the input
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select("bucket", F.coalesce(F.sum("held").over(upto), F.lit(0)).alias("start"), F.sum("held").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("bucket").orderBy("doc_id", "text_hash", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("times").over(inside), F.lit(0)))
    return placed.join(F.broadcast(starts), "bucket").select("doc_id", "size", "text_crc32", "times", (F.col("start") + F.col("inside")).alias("first"), "total")


def each_number(placed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each of a distinct row's numbers; no array holds more than ``chunk`` of them."""
    runs = F.sequence(F.lit(0).cast("bigint"), whole(F.col("times") - 1, F.lit(chunk)))
    started = placed.select("doc_id", "size", "text_crc32", "total", "first", (F.col("first") + F.col("times")).alias("upto"), F.explode(runs).alias("run"))
    begin = F.col("first") + F.col("run") * chunk
    return started.select("doc_id", "size", "text_crc32", "total", F.explode(F.sequence(begin, F.least(F.col("upto"), begin + chunk) - 1)).alias("number"))


def shard(docs: DataFrame, shards: int = 24, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard and position (the shuffled number)."""
    one_each = each_number(numbered(docs, id_col, text_col))
    at = one_each.withColumn("position", permuted(F.col("number"), F.col("total"), seed))
    checked = F.when(F.col("position") < F.col("total"), F.col("position")).otherwise(F.raise_error(F.lit("a cycle walk did not end")).cast("bigint"))
    return at.withColumn("position", checked).select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        whole(F.col("position"), F.lit(shards)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "position",
    )
