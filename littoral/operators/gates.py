"""Quality and release gates: one aggregate row per check, decisions on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def forecast_validity(forecasts: DataFrame, p: str, issued: str, now: Column, prior_rows: int = 0, least: int = 50, share: float = 0.8, hours: int = 48) -> DataFrame:
    """Q4: one row of measurements and a verdict."""
    c = F.col(p)
    finite = c.isNotNull() & ~F.isnan(c)
    facts = forecasts.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~finite).alias("not_finite"), F.count_if(finite & ((c < 0) | (c > 1))).alias("out_of_range"),
        F.count_distinct(F.when(finite, c)).alias("levels"), F.max(issued).alias("newest"),
    )
    fresh = F.coalesce(F.col("newest") >= now - F.expr(f"INTERVAL {hours} HOURS"), F.lit(False))
    ok = (F.col("rows") >= least) & (F.col("rows") >= share * prior_rows) & (F.col("not_finite") == 0) & (F.col("out_of_range") == 0) & (F.col("levels") > 1) & fresh
    return facts.withColumn("fresh", fresh).withColumn("valid", ok)


def anomaly(now: DataFrame, before: DataFrame, p: str, band: str) -> DataFrame:
    """Q5: ratio of means, share of low bands, loss of bands."""

    def facts(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.avg(p).alias(f"mean_{name}"), F.avg((F.col(band) == "low").cast("double")).alias(f"low_{name}"), F.count_distinct(band).alias(f"bands_{name}"))

    both = facts(now, "now").join(F.broadcast(facts(before, "before")))  # one row each
    ratio = F.when(F.col("mean_before") > 0, F.col("mean_now") / F.col("mean_before"))
    odd = ~F.coalesce(ratio.between(0.25, 4.0), F.lit(True)) | ((F.col("low_now") == 1) & (F.col("low_before") < 1)) | ((F.col("bands_now") == 1) & (F.col("bands_before") > 1))
    return both.withColumn("ratio", ratio).withColumn("anomalous", odd)


def agreement(acute: int, agreeing: int, least: int = 5, share: float = 0.30) -> bool:
    """Q6: too few acute cases, or enough of them warned."""
    return acute < least or agreeing / acute >= share


def resolution_regression(now: DataFrame, before: DataFrame, key: str, resolved: str) -> DataFrame:
    """Q7: keys that resolved before and no longer do."""
    old = before.where(F.col(resolved)).select(key)
    return old.join(now.where(F.col(resolved)).select(key), key, "left_anti")


def retrain_due(marker: dict, now: dict, least_new: int = 500) -> bool:
    """Q8: labels changed and enough of them are new."""
    return marker.get("xor") != now.get("xor") and abs(now.get("rows", 0) - marker.get("rows", 0)) >= least_new


def scraper_health(runs: DataFrame, key: str, day: str, ok: str, today: str) -> DataFrame:
    """Q10: per source days run, days missed, failures, and the clean streak that ends today."""
    now = F.lit(today).cast("date")
    daily = runs.groupBy(key, day).agg(F.bool_and(ok).alias("_ok"))
    bad = F.max(F.when(~F.col("_ok"), F.col(day)))
    out = daily.groupBy(key).agg(F.count(F.lit(1)).alias("days_run"), (F.datediff(F.max(day), F.min(day)) + 1 - F.count(F.lit(1))).cast("long").alias("days_missed"), F.count_if(~F.col("_ok")).alias("days_failed"), bad.alias("last_failure"), F.min(day).alias("first_day"))
    return out.withColumn("clean_streak", F.datediff(now, F.coalesce("last_failure", F.date_sub("first_day", 1))).cast("long")).drop("first_day")


def served_freshness(served: DataFrame, committed: DataFrame, time: str) -> DataFrame:
    """Q11: newest instants of what is served and what was written, and the lag in hours."""
    both = served.agg(F.max(time).alias("served")).join(F.broadcast(committed.agg(F.max(time).alias("committed"))))
    lag = (F.unix_micros(F.col("committed").cast("timestamp")) - F.unix_micros(F.col("served").cast("timestamp"))) / 3.6e9
    return both.withColumn("lag_hours", lag)


def carry_health(previous: dict, current: dict, keys: tuple[str, ...] = ("training", "calibration")) -> dict:
    """Q12: parts that a run without training does not produce are kept from the run before."""
    return {**{k: previous[k] for k in keys if k in previous and k not in current}, **current}


def release_problems(tables: dict[str, DataFrame], wanted: list[str], private: list[str], forecasts: str, day: str, today, hours: int = 48) -> list[str]:
    """Q9: what speaks against a release: absent or empty tables, private columns, forecasts that are too old."""
    found = [f"{n} is absent" for n in wanted if n not in tables]
    for name, df in tables.items():
        found += [f"{name} has {c}" for c in df.columns if c.lower() in private] + [f"{name} is empty"] * df.isEmpty()
    newest = tables[forecasts].agg(F.max(day).alias("day")).first().day if forecasts in tables else None
    if newest is None or (today - newest).days * 24 > hours:
        found.append(f"{forecasts} is old")
    return found


def frame_difference(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys on one side only, and keys whose columns differ; nulls equal nulls."""
    x = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("_a"))
    y = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("_b"))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    state = F.when(F.col("_b").isNull(), "left only").when(F.col("_a").isNull(), "right only").when(~same, "differs")
    return x.join(y, keys, "full").withColumn("state", state).where("state is not null").drop("_a", "_b")
