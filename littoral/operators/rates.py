"""Shrunk, pooled and hierarchical rates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from littoral.functions.core import logit


def shrunk_rate(sites: DataFrame, obs: DataFrame, key: str, day: str, hit: str, as_of: str, days: int = 365, k: float = 5.0) -> DataFrame:
    """(hits + k g) / (n + k) over [as_of - days, as_of), g being the pooled rate; each site has a row."""
    end = F.lit(as_of).cast("date")
    inside = obs.where((F.col(day) < end) & (F.col(day) >= F.date_sub(end, days)))
    daily = inside.groupBy(key, day).agg(F.max(F.col(hit).cast("int")).alias("_y"))
    per = daily.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("_y").cast("long").alias("pos"))
    pool = per.agg((F.sum("pos") / F.sum("n")).alias("g"))  # one row
    out = sites.select(key).distinct().join(per, key, "left").join(F.broadcast(pool))
    out = out.withColumns({"n": F.coalesce("n", F.lit(0)), "pos": F.coalesce("pos", F.lit(0))})
    return out.withColumn("p", (F.col("pos") + k * F.col("g")) / (F.col("n") + k))


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    from math import lgamma

    f = np.frompyfunc(lgamma, 1, 1)
    return (f(a) + f(b) - f(a + b)).astype(float)


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction, evaluated by Lentz's method."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, float) for v in (x, a, b)))
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.clip(np.where(swap, 1 - x, x), 1e-300, 1)
    tiny = 1e-300
    c = np.ones_like(z)
    d = 1 - (p + q) * z / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 200):
        for num in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h *= d * c
    out = np.exp(p * np.log(z) + q * np.log1p(-np.minimum(z, 1 - 1e-16)) - _log_beta(p, q)) * h / p
    return np.clip(np.where(swap, 1 - out, out), 0, 1)


def beta_quantile(prob: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low, high = np.zeros(len(a)), np.ones(len(a))
    for _ in range(60):
        mid = (low + high) / 2
        below = beta_cdf(mid, a, b) < prob
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


@F.pandas_udf(T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())]))
def beta_interval(pos: pd.Series, n: pd.Series, g: pd.Series, k: pd.Series) -> pd.DataFrame:
    """5 and 95 per cent points of the posterior of a shrunk rate."""
    a, b = (pos + k * g).to_numpy(float), (n - pos + k * (1 - g)).to_numpy(float)
    a, b = np.maximum(a, 1e-9), np.maximum(b, 1e-9)
    return pd.DataFrame({"low": beta_quantile(0.05, a, b), "high": beta_quantile(0.95, a, b)})


def hierarchical_rate(rows: DataFrame, outer: str, inner: str, hit: str, k_outer: float = 20.0, k_inner: float = 5.0) -> DataFrame:
    """Inner groups shrink to their outer group, which shrinks to the whole."""
    per = rows.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(hit).cast("long")).alias("pos"))
    top = per.groupBy(outer).agg(F.sum("n").alias("_all"), F.sum("pos").alias("_hits"))
    whole = top.agg((F.sum("_hits") / F.sum("_all")).alias("g"))  # one row
    top = top.join(F.broadcast(whole)).withColumn("outer_rate", (F.col("_hits") + k_outer * F.col("g")) / (F.col("_all") + k_outer))
    return per.join(top.select(outer, "outer_rate", "g"), outer).withColumn("rate", (F.col("pos") + k_inner * F.col("outer_rate")) / (F.col("n") + k_inner))


def margins(rows: DataFrame, key: str, hit: str, k: float = 10.0) -> DataFrame:
    """Log-odds of the shrunk rate per key, and of the whole for keys not seen."""
    per = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(hit).cast("long")).alias("pos"))
    whole = per.agg((F.sum("pos") / F.sum("n")).alias("g"))
    return per.join(F.broadcast(whole)).select(key, logit((F.col("pos") + k * F.col("g")) / (F.col("n") + k)).alias("margin"), logit(F.col("g")).alias("global_margin"))


def routed_prior(rates: DataFrame, least_inner: int = 10, least_outer: int = 50, outer: str = "outer") -> tuple[Column, Column]:
    """Inner rate with enough samples, else the outer one, else the whole; and which it was."""
    scope = F.when(F.col("n") >= least_inner, "inner").when(F.col("outer_n") >= least_outer, outer).otherwise("global")
    return F.when(F.col("n") >= least_inner, F.col("rate")).when(F.col("outer_n") >= least_outer, F.col("outer_rate")).otherwise(F.col("g")), scope
