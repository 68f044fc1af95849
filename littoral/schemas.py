"""Declared schemas, conforming of frames to them, and schema guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SITE_DAY = T.StructType([T.StructField("site", T.LongType()), T.StructField("day", T.DateType()), T.StructField("exceeds", T.BooleanType()), T.StructField("value", T.DoubleType()), T.StructField("ratio", T.DoubleType())])
ADVISORY = T.StructType([T.StructField("site", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("started", T.TimestampNTZType()), T.StructField("ended", T.TimestampNTZType()), T.StructField("status", T.StringType()), T.StructField("url", T.StringType())])


def column_or(df: DataFrame, name: str, default=None, kind: str | None = None) -> Column:
    """The column, or a literal where the frame lacks it."""
    found = F.col(name) if name in df.columns else F.lit(default)
    return found.cast(kind) if kind else found


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order; absent ones are null, others are cast, bad values become null."""
    cols = [F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType) for f in schema.fields]
    return df.select(*[c.alias(f.name) for c, f in zip(cols, schema.fields, strict=True)])


def missing_columns(df: DataFrame, required: list[str], expected: list[str] = ()) -> tuple[list[str], list[str]]:
    """Q1, at plan time: absent required columns (an error) and absent expected ones (a warning)."""
    return [c for c in required if c not in df.columns], [c for c in expected if c not in df.columns]


def guard(df: DataFrame, keys: list[str], labels: list[str], features: list[str]) -> list[tuple[str, str]]:
    """Q1: (name, level) of each finding: an empty frame and absent keys and labels are errors, and end the check;
    absent features and such as are null throughout are warnings. One pass over the rows."""
    present = [c for c in features if c in df.columns]
    errors, warnings = missing_columns(df, [*keys, *labels], features)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in present]).first()
    if not counts["_rows"]:
        return [("no table", "error")]
    if errors:
        return [(c, "error") for c in errors]
    return [(c, "warning") for c in [*warnings, *(c for c in present if not counts[c])]]


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q2 and Q3: one row per column: rows, non-null values, share, whether it is null throughout."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in columns])).alias("x")
    out = counts.select("rows", pairs).select(F.col("x.name").alias("column_name"), "rows", F.col("x.n").alias("filled"))
    share = F.when(F.col("rows") > 0, F.col("filled") / F.col("rows"))
    return out.withColumn("share", share).withColumn("all_null", (F.col("filled") == 0) & (F.col("rows") > 0))


def suspicious_columns(profile: DataFrame, populated: float = 0.5) -> DataFrame:
    """Q3: columns that are null throughout while a sibling is filled to ``populated`` at least."""
    best = profile.agg(F.max("share").alias("_best"))  # one row
    return profile.join(F.broadcast(best), F.col("_best") >= populated).where("all_null").drop("_best")
