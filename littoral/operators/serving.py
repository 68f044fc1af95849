"""Serving tables: advisories, parents, forecasts, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from littoral.functions.core import ACTIVE_DAYS, OPEN_DAYS, persistence_estimate, risk_band, serve_probability, short_id


def active_now(now: Column, kind: str = "kind") -> Column:
    """Active, not lifted, and a closure or begun within a week; an unknown start counts as recent."""
    recent = F.col("started").isNull() | (F.col("started") >= now - F.expr(f"INTERVAL {ACTIVE_DAYS} DAYS"))
    lifted = F.coalesce(F.col("ended") <= now, F.lit(False))
    return (F.col("status") == "active") & ~lifted & ((F.col(kind) == "closure") | recent)


def expire_zombies(advisories: DataFrame, now: Column, seen: str = "last_seen") -> DataFrame:
    """An active advisory not seen for two weeks, unless chronic, becomes historical."""
    old = F.coalesce(F.col(seen), F.col("started")) < now - F.expr(f"INTERVAL {OPEN_DAYS} DAYS")
    zombie = (F.col("status") == "active") & F.coalesce(old, F.lit(False)) & ~F.lower(F.coalesce("kind", F.lit(""))).contains("chronic")
    return advisories.withColumn("status", F.when(zombie, "historical").otherwise(F.col("status")))


def active_on(advisories: DataFrame, day: Column, effective_end: Column) -> DataFrame:
    """Intervals that cover a day."""
    return advisories.where((F.to_date("started") <= day) & (F.to_date(effective_end) >= day))


def posted_sites(advisories: DataFrame, key: str, day: Column) -> DataFrame:
    """P15."""
    return advisories.where((F.col("status") == "active") & (F.to_date("started") <= day)).select(key).distinct()


def newest_per(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """O2: the first n rows of each key; Spark limits each task's groups before the exchange."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def recent_and_active(advisories: DataFrame, key: str, active: Column, tie: str, n: int = 10) -> DataFrame:
    """O3: the newest n of each site and all active ones, each once."""
    top = newest_per(advisories, [key], [F.desc_nulls_last("started"), F.asc(tie)], n).drop("position")
    return top.unionByName(advisories.where(active)).distinct()


def latest_urls(advisories: DataFrame, key: str, active: Column, tie: str) -> DataFrame:
    """V8: the address of the newest active advisory that has one."""
    order = F.when(F.col("url").isNotNull(), F.struct("started", tie))
    return advisories.where(active).groupBy(key).agg(F.count(F.lit(1)).alias("active"), F.max_by("url", order).alias("url"))


def forecast_for(forecasts: DataFrame, key: str, day: str, wanted: Column, now: Column) -> DataFrame:
    """V3: the forecast of the wanted day, else the newest one; late if issued over 48 hours ago."""
    w = Window.partitionBy(key).orderBy(F.desc(F.col(day) == wanted), F.desc(day), F.desc("issued"))
    best = forecasts.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return best.withColumns({"fallback": F.col(day) != wanted, "late": F.col("issued") < now - F.expr("INTERVAL 48 HOURS")})


def last_issue(forecasts: DataFrame, keys: list[str], issued: str, tie: str) -> DataFrame:
    """The last issue of a forecast is the one that was served."""
    w = Window.partitionBy(*keys).orderBy(F.desc(issued), F.desc(tie))
    return forecasts.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def served(rows: DataFrame, probability: Column, posted: Column, last_exceeded: Column, ratio: Column) -> DataFrame:
    """V4 and V7: derived where there is no estimate, floored, and banded from the served value only."""
    p = serve_probability(F.coalesce(probability, persistence_estimate(ratio)), posted, last_exceeded)
    return rows.withColumns({"p_served": p, "band": risk_band(p)})


def parent_cards(members: DataFrame, parent: str, key: str, p: str, flagged: Column, url: str) -> DataFrame:
    """The worst member of each parent, the flagged ones, the first address."""
    order = F.struct(F.coalesce(F.col(p), F.lit(-1.0)), -F.col(key))  # the first member of equals
    out = members.groupBy(parent).agg(
        F.count(F.lit(1)).alias("members"), F.max_by(key, order).alias("worst"), F.max(p).alias("p_worst"),
        F.sort_array(F.collect_list(F.when(flagged, F.col(key)))).alias("flagged"), F.min_by(url, F.when(F.col(url).isNotNull(), F.col(key))).alias("url"),
    )
    return out.withColumn("band", risk_band(F.col("p_worst")))


def sibling_rollup(parents: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """Each member of a parent gets the first value, by position, of its parent's members."""
    members = parents.select("parent", F.posexplode("members").alias("at", key))
    first = members.join(values, key).groupBy("parent").agg(F.min_by(value, "at").alias(value))
    return members.join(first, "parent", "left").select(key, "parent", value)


def closures_feed(advisories: DataFrame, places: DataFrame, key: str, active: Column) -> DataFrame:
    """Active closures with their place and a short stable id."""
    rows = advisories.where(active).join(places, key)
    return rows.withColumn("closure_id", short_id(F.col(key).cast("string"), F.col("kind"), F.date_format("started", "yyyy-MM-dd")))


def explanation(p: Column, band: Column, n: Column) -> Column:
    """V9."""
    return F.format_string("%s risk: about %.0f in 100 (%d samples in the past year)", F.initcap(band), p * 100, n)


def snapshot_entities(sites: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """V5 and K7: one JSON document per site, with arrays of bounded length from each part."""
    out = sites
    for name, rows in parts.items():
        cols = [c for c in rows.columns if c not in (key, "position")]
        packed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("position", *cols))).alias(name))
        out = out.join(packed, key, "left")
    return out.select(key, F.to_json(F.struct(*out.columns)).alias("document"))
