"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.session import checkpoint_dir

#: Bytes of a batch that goes to a Python worker. Whole texts travel in these batches, so a bound on
#: rows alone would hold gigabytes where documents are long, or send a handful of numbers at a time.
BATCH_BYTES = "2m"


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of each Arrow batch of this session (texts are large rows)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text"):
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text): no other column of the input can clash with an operator's own."""
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until it isn't among ``columns`` (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the session's shared checkpoint folder and read it back.

    Cuts the lineage with files that survive lost executors, compressed as Parquet. The step's
    shuffle files are of no use then; Spark deletes them once the driver's objects are collected.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


_HELD: dict = {}


def held(name, make: Callable):
    """What ``make`` builds, kept by the worker for its next tasks: one operator's at a time."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def let_go() -> None:
    """Free what an operator before kept in this worker."""
    _HELD.clear()


class GenerationCache(dict):
    """A bounded memo: ``cache[key]`` computes a missing value with ``make(key)``.

    Two generations of at most ``limit`` entries: when the young one is full it becomes the
    old one, and keys found there move back, so frequent keys stay and memory is bounded.
    """

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def map_texts(source: DataFrame, columns: str, make: Callable) -> DataFrame:
    """(doc_id, text) to (doc_id, ``columns``), one row each, in one map without a shuffle.

    ``make()`` runs in the worker and returns the function from a text to a tuple of values.
    Ids travel as strings, so that no id is rounded where others are null.
    """
    import pandas as pd

    small_batches(source.sparkSession)
    names = [c.split()[0] for c in columns.split(", ")]

    def run(frames: Iterable) -> Iterator:
        each = make()
        for f in frames:
            out = pd.DataFrame([each(t) for t in f["text"]], columns=names)
            out.insert(0, "doc_id", f["doc_id"].to_numpy())
            yield out

    kind = source.schema["doc_id"].dataType
    keyed = source.select(F.col("doc_id").cast("string"), "text")
    return keyed.mapInPandas(run, f"doc_id string, {columns}").withColumn("doc_id", F.col("doc_id").cast(kind))
