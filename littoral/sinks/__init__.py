"""Sinks: tables, append logs, JSON documents, reports."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_bundle(tables: dict[str, DataFrame], root: str, partitions: dict[str, list[str]] | None = None) -> None:
    """K1: each table overwritten; the commit protocol makes each write atomic."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*(partitions or {}).get(name, [])).parquet(f"{root}/{name}")


def replace_atomically(df: DataFrame, path: str) -> None:
    """K2: written beside the old table, then renamed; readers see one or the other."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fresh, old = hadoop(path + ".new"), hadoop(path)
    df.write.mode("overwrite").parquet(path + ".new")
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    fs.rename(fresh, old)


def write_snapshot(parts: dict[str, tuple[DataFrame, str]], root: str, health: dict) -> None:
    """K4: the tables of a serving snapshot, each sorted by its key inside its files, and a health table of strict JSON.

    All are written beside the place of the snapshot, which one rename then fills, so readers see all tables or none.
    """
    spark = next(iter(parts.values()))[0].sparkSession
    for name, (df, key) in parts.items():
        finite_columns(df).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{root}.new/{name}")
    rows = [(k, json.dumps(None if isinstance(v, float) and not math.isfinite(v) else v, allow_nan=False)) for k, v in health.items()]
    spark.createDataFrame(rows, "key string, payload string").write.mode("overwrite").parquet(f"{root}.new/system_health")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fresh, old = hadoop(f"{root}.new"), hadoop(root)
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    fs.rename(fresh, old)


def append_log(df: DataFrame, path: str) -> None:
    """K3: appended as it is; readers keep the last of each key."""
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    """K3: the last row per key, so an append that is repeated changes nothing."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return spark.read.parquet(path).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def create_table(df: DataFrame, name: str) -> None:
    """K5."""
    df.write.mode("overwrite").saveAsTable(name)


def strict_json(*columns: str | Column) -> Column:
    """K6: no NaN or infinity reaches the text; nulls are written."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def finite_columns(df: DataFrame) -> DataFrame:
    """K6: NaN and infinities of all floating columns become null."""
    bad = {c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(bad)


def write_documents(documents: DataFrame, path: str, bucket: str) -> None:
    """K7: JSON documents by bucket folder."""
    documents.write.mode("overwrite").partitionBy(bucket).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K9: a folder of parts, each with its header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def markdown_table(df: DataFrame, limit: int = 200) -> str:
    """K9: a small report."""
    rows = df.limit(limit).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v) for v in r) + " |" for r in rows])


def publish_unless(blockers: list[str], df: DataFrame, path: str) -> bool:
    """Written only if nothing blocks the release."""
    if not blockers:
        df.write.mode("overwrite").parquet(path)
    return not blockers
