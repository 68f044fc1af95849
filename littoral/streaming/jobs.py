"""Structured Streaming forms of the batch operators; batch results are the source of truth."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType


def parquet_stream(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def dedupe(stream: DataFrame, keys: list[str], time: str, delay: str = "7 days") -> DataFrame:
    """One row per key within the delay; rows later than that are dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def daily(stream: DataFrame, key: str, time: str, value: str, delay: str = "1 day", start: str = "13 hours") -> DataFrame:
    """Tumbling days that begin at a fixed hour of UTC."""
    w = F.window(time, "1 day", "1 day", start)
    return stream.withWatermark(time, delay).groupBy(key, w).agg(F.count(F.lit(1)).alias("readings"), F.sum(value).alias("total"), F.max(value).alias("most")).select(key, F.col("window.end").alias("until"), "readings", "total", "most")


def sliding(stream: DataFrame, key: str, time: str, value: str, length: str = "72 hours", step: str = "24 hours", delay: str = "1 day") -> DataFrame:
    """T4: long windows that advance by a day."""
    return stream.withWatermark(time, delay).groupBy(key, F.window(time, length, step)).agg(F.sum(value).alias("total")).select(key, F.col("window.end").alias("until"), "total")


def sessions(stream: DataFrame, key: str, time: str, value: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """T5: clusters by gaps; a gap of exactly the limit splits here and joins in the batch form."""
    return stream.withWatermark(time, delay).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("samples"), F.max(value).alias("most")).select(key, F.col("w.start").alias("since"), "samples", "most")


def last_value(stream: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """The newest value per key, kept as state; emits a row whenever it changes."""

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else (None, None)
        when, what = pd.Timestamp(held[0], unit="us") if held[0] is not None else None, held[1]
        changed = False
        for rows in batches:
            rows = rows.dropna(subset=[value]).sort_values([time, value], kind="stable")
            if len(rows) and (when is None or rows[time].iloc[-1] >= when):
                when, what, changed = rows[time].iloc[-1], float(rows[value].iloc[-1]), True
        if changed:
            state.update((int(when.value // 1000), what))
            yield pd.DataFrame({key: [k[0]], "at": [when], "last": [what]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.select(key, F.col(time).cast("timestamp_ntz").alias(time), value).groupBy(key).applyInPandasWithState(update, f"{key} {kind}, at timestamp_ntz, last double", "t long, v double", "update", GroupStateTimeout.NoTimeout)


def append_once(stream: DataFrame, path: str, keys: list[str], checkpoint: str, order: str | None = None):
    """Each batch is written under its number, so a batch that is run again replaces itself.

    Of a batch the last row of each key is written, unless the log has that very row already; a later row of
    a key is appended, and ``read_once`` takes the last.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = Window.partitionBy(*keys).orderBy(F.desc(order) if order else F.lit(0))
        rows = batch.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if number and hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            log = spark.read.schema(StructType([*batch.schema.fields, StructField("batch", LongType())])).parquet(path).where(F.col("batch") < number)
            log = log.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("batch")))).where("_r = 1").drop("_r")
            same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in batch.columns]
            rows = rows.alias("a").join(log.alias("b"), reduce(lambda x, y: x & y, same), "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_once(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last row of each key."""
    last = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return spark.read.parquet(path).withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r", "batch")


def run_to_table(stream: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Process all that is there, batch by batch, into files: each batch under its number, or the whole result anew in
    ``complete`` mode. For checks against the batch form."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).outputMode(mode).trigger(availableNow=True)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    writer.start().awaitTermination()
    out = stream.sparkSession.read.parquet(path)
    return out if mode == "complete" else out.drop("batch")
