"""Shared helpers of the training-data operators: scratch tables, word patterns, numpy hashing."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one is made only for a session without a cluster that names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="littoral-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Rows and bytes of an Arrow batch, at most, so that the memory of Python workers does not depend on long texts.
ARROW_ROWS, ARROW_BYTES = 1024, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to these sizes unless they are lower. The setting stays, as results are computed later."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = spark.conf.get(name, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


class Scratch:
    """Tables written to the shared folder, which cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Columns that an operator does not use bear names with this prefix inside it.
_KEPT = "littoral_kept_"


class Kept:
    """The columns that an operator carries through without using them.

    ``Kept(docs, "text").frame`` has the named columns as they are and all others under reserved
    names, by position, so no name of the input can clash with one that the operator gives.
    ``back`` restores the names; input columns that bear the name of an output column (in either
    case) are replaced.
    """

    def __init__(self, docs: DataFrame, *used: str, **more: Column):
        """more: columns over ``docs`` that the frame has besides."""
        self.names, lower = docs.columns, {u.lower(): u for u in used}
        self.inside = [lower.get(c.lower(), f"{_KEPT}{i}") for i, c in enumerate(self.names)]
        self.frame = docs.select("*", *more.values()).toDF(*self.inside, *more)

    def back(self, out: DataFrame, *made: str, without: tuple[str, ...] = ()) -> DataFrame:
        """The input's columns of ``out``, in order, but for some, and those that were made."""
        new = {m.lower() for m in made + without}
        own = [F.col(i).alias(n) for n, i in zip(self.names, self.inside, strict=True) if n.lower() not in new]
        return out.select(*own, *made)


#: Keys of more rows are hot: there are at most one in HOT_ROWS of them, so what belongs to them can be sent to every task.
HOT_ROWS = 100_000


def join_spread(rows: DataFrame, table: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """Inner join with a table of one row per key. Rows of hot keys stay where they are, so no task gets a hot key's rows."""
    hot = scratch.save(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select(key), f"hot-{uuid.uuid4().hex}")
    if hot.isEmpty():
        return rows.join(table, key)
    of_hot = table.join(F.broadcast(hot), key, "left_semi")
    return rows.join(F.broadcast(of_hot), key).unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key))


def join_counts(rows: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Inner join with (key, n), which counts the rows of a key: hot keys by broadcast, so their rows stay where they are."""
    hot = counts.where(F.col("n") > HOT_ROWS)
    if hot.isEmpty():
        return rows.join(counts, key)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(counts.where(F.col("n") <= HOT_ROWS), key))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, inside interpreted expressions too."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """All words of a text; null gives an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def give_back() -> None:
    """Return what this process has freed to the system, as a worker waits for its next task with all it ever held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(batches: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function over batches that gives memory back when it is done."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from batches(given)
        finally:
            give_back()

    return run


#: Words that a task has in hand at once, about.
WORDS_AT_ONCE = 1 << 19


def some_texts(texts: pa.ListArray) -> Iterator[pa.ListArray]:
    """Slices of lists that hold a bounded number of items; a longer list is a slice of its own."""
    bounds, at = texts.offsets.to_numpy(), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + WORDS_AT_ONCE, "right")) - 1)
        yield texts.slice(at, to - at)
        at = to


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64) over an array of uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def literal(one_row: DataFrame) -> Column:
    """The only value of a frame as a compact literal; its size must be bounded."""
    jvm, jdf = one_row.sparkSession._jvm, one_row._jdf
    value = jdf.queryExecution().executedPlan().executeCollect()[0].getArray(0)
    expression = jvm.org.apache.spark.sql.catalyst.expressions.Literal(value, jdf.schema().apply(0).dataType())
    return Column(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(expression))


def bucket(key: Column, buckets: int) -> Column:
    """The hash bucket of a key, from 0; ``buckets`` is a power of two. xxhash with seed 42 gives the same outside Spark."""
    return F.xxhash64(key).bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")
