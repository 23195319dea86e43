"""Small tables for the operators: plain ones, and one with every awkward case."""

from __future__ import annotations

import random

from pyspark.sql import types as T

PLAIN = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
#: Names that the operators use inside.
CLASHES = ["name", "row", "node", "maybe", "hash", "score", "predicted", "text_hash", "base", "terms", "n_lines", "n_dropped", "n_near", "bitmap", "root", "stay", "now", "label", "block", "segment"]


def frame(spark, rows):
    return spark.createDataFrame(rows, PLAIN)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def awkward_rows():
    rng = random.Random(3)
    long = "\n".join(words(rng, 60) for _ in range(300))
    text = words(rng, 50)
    return [
        (1, text), (2, None), (3, ""), (4, long), (5, text), (5, text), (None, words(rng, 40)), (None, None),
        (6, "é中😀 x"), (7, " \n\t "), (8, text.upper()), (2**60 + 1, "one"), (9, "\u0000 a\u001cb   z"),
    ]


def awkward(spark):
    """Nulls, empty and long texts, repeated rows and further columns with the operators' own names."""
    schema = T.StructType([*PLAIN, *[T.StructField(c, T.StringType()) for c in CLASHES]])
    return spark.createDataFrame([(*r, *[None if i % 2 else f"x{i}" for i in range(len(CLASHES))]) for r in awkward_rows()], schema)


def empty(spark):
    return spark.createDataFrame([], PLAIN)
