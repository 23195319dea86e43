"""A one-bit-per-hash filter from Spark's bitmap functions: which rows may have a partner.

Rows that certainly have none pass straight through instead of joining a shuffle. The filter has
at most ``MOST_BITS`` bits (16 MiB), which bounds its broadcast; when fuller it lets more rows
through, never fewer, and an exact join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 27
#: Bits of one row of Spark's bitmap functions.
ROW_BITS = 32768


def bits_for(rows: int) -> int:
    wanted = max(ROW_BITS, 16 * rows)
    return min(MOST_BITS, 1 << (wanted - 1).bit_length())


def bitmap_of(hashes: DataFrame, bits: int) -> DataFrame:
    """(bitmap_row, bitmap) with the bit of every value of the column ``hash``."""
    at = hashes.select(F.pmod("hash", F.lit(bits)).alias("at"))
    return at.groupBy(F.expr("bitmap_bucket_number(at)").alias("bitmap_row")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bitmap"))


def marked(df: DataFrame, hashed: Column, bitmap: DataFrame, bits: int, name: str) -> DataFrame:
    """``df`` with the boolean column ``name``: the bit of ``hashed`` is set (null hashes: false)."""
    inner = df.withColumn("bitmap_at", F.pmod(hashed, F.lit(bits))).withColumn("bitmap_row", F.expr("bitmap_bucket_number(bitmap_at)"))
    byte = "conv(hex(substring(bitmap, cast(bitmap_bit_position(bitmap_at) div 8 as int) + 1, 1)), 16, 10)"
    bit = F.expr(f"(shiftright(cast({byte} as int), cast(bitmap_bit_position(bitmap_at) % 8 as int)) & 1) = 1")
    return inner.join(F.broadcast(bitmap), "bitmap_row", "left").withColumn(name, F.coalesce(bit, F.lit(False))).drop("bitmap_row", "bitmap", "bitmap_at")
