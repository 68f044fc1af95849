"""Registered queries with their SQL, and the roles that the driver's tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.functions.core import exceeds
from littoral.session import shared_path  # noqa: F401  the queries' folders

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def observations(spark: SparkSession, d: str) -> DataFrame:
    """events as lab samples; errors play the molecular assay with its own threshold."""
    threshold = F.when(F.col("event_type") == "error", 120.0).otherwise(60.0)
    rows = table(spark, d, "events").select("event_id", F.col("user_id").alias("site"), "ts", F.to_date("ts").alias("day"), F.col("event_type").alias("method"), "value", threshold.alias("threshold"))
    return rows.withColumns({"ratio": F.col("value") / F.col("threshold"), "exceeds": exceeds(F.col("value"), F.col("threshold"))})


OBS = """obs AS (SELECT event_id, user_id AS site, ts, CAST(ts AS DATE) AS day, event_type AS method, value, CASE WHEN event_type='error' THEN 120.0::DOUBLE ELSE 60.0::DOUBLE END AS threshold,
 value / CASE WHEN event_type='error' THEN 120.0::DOUBLE ELSE 60.0::DOUBLE END AS ratio, value > CASE WHEN event_type='error' THEN 120.0::DOUBLE ELSE 60.0::DOUBLE END AS exceeds FROM events)"""


def site_day(spark: SparkSession, d: str) -> DataFrame:
    """The worst sample of each site and day."""
    from littoral.operators.dedupe import worst_of_day

    return worst_of_day(observations(spark, d), ["site", "day"], "exceeds", "value", "ts", "event_id")


SD = OBS + """, sd AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY site, day ORDER BY exceeds DESC, value DESC, ts DESC, event_id DESC) = 1)"""


def advisories(spark: SparkSession, d: str) -> DataFrame:
    """orders as advisory intervals: open ones have no end."""
    o = table(spark, d, "orders")
    end = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("make_dt_interval(cast(o_orderkey % 40 as int))"))
    kind = F.when(F.col("o_orderpriority").startswith("1"), "closure").when(F.col("o_orderpriority").startswith("2"), "chronic posting").otherwise("posting")
    status = F.when(F.col("o_orderstatus") == "F", "historical").otherwise("active")
    return o.select(F.col("o_orderkey").alias("advisory"), F.col("o_custkey").alias("site"), kind.alias("kind"), F.col("o_orderdate").alias("started"), end.alias("ended"), status.alias("status"), F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("https://n.example/"), F.col("o_orderkey").cast("string"))).alias("url"))


ADV = """adv AS (SELECT o_orderkey AS advisory, o_custkey AS site, CASE WHEN o_orderpriority LIKE '1%' THEN 'closure' WHEN o_orderpriority LIKE '2%' THEN 'chronic posting' ELSE 'posting' END AS kind,
 o_orderdate AS started, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) END AS ended, CASE WHEN o_orderstatus = 'F' THEN 'historical' ELSE 'active' END AS status,
 CASE WHEN o_orderkey % 3 > 0 THEN 'https://n.example/' || o_orderkey END AS url FROM orders)"""


def places(spark: SparkSession, d: str, name: str = "supplier") -> DataFrame:
    """suppliers (or customers) as stations, with coordinates made from their keys."""
    key = {"supplier": "s_suppkey", "customer": "c_custkey"}[name]
    nation = {"supplier": "s_nationkey", "customer": "c_nationkey"}[name]
    label = {"supplier": "s_name", "customer": "c_name"}[name]
    k = F.col(key)
    return table(spark, d, name).select(k.alias("site"), F.col(nation).cast("long").alias("county"), F.col(label).alias("name"), (32 + (k * 37 % 1000) / 400.0).alias("lat"), (-120 + (k * 91 % 1000) / 400.0).alias("lon"))


def place_sql(name: str = "supplier", alias: str = "pl") -> str:
    p = {"supplier": "s", "customer": "c"}[name]
    key = {"supplier": "s_suppkey", "customer": "c_custkey"}[name]
    return f"{alias} AS (SELECT {key} AS site, CAST({p}_nationkey AS BIGINT) AS county, {p}_name AS name, 32 + ({key} * 37 % 1000) / 400.0::DOUBLE AS lat, -120 + ({key} * 91 % 1000) / 400.0::DOUBLE AS lon FROM {name})"


HAVERSINE = "2 * 6371.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h))"


def shipments(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as a daily series of rain per station."""
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("site"), F.to_date("l_shipdate").alias("day"))
    return rows.agg(F.sum("l_quantity").alias("rain"), F.max("l_discount").alias("cloud"), F.count(F.lit(1)).alias("n"))


SHIP = "ship AS (SELECT l_suppkey AS site, CAST(l_shipdate AS DATE) AS day, SUM(l_quantity) AS rain, MAX(l_discount) AS cloud, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)"


def scored(spark: SparkSession, d: str) -> DataFrame:
    """labels as outcomes, with a forecast made from the length of the document."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    rows = table(spark, d, "labels").join(docs, "doc_id")
    p = F.round((F.col("n_chars") % 97) / 100.0 + F.col("quality") * 0.02, 2)
    return rows.select("doc_id", "source", "lang", (F.col("quality") == 1).alias("y"), p.alias("p"), F.round((F.col("n_chars") % 31) / 31.0, 2).alias("p0"), F.col("toxic"))


SCORED = "sc AS (SELECT doc_id, source, lang, quality = 1 AS y, ROUND((n_chars % 97) / 100.0::DOUBLE + quality * 0.02::DOUBLE, 2) AS p, ROUND((n_chars % 31) / 31.0::DOUBLE, 2) AS p0, toxic FROM labels JOIN documents USING (doc_id))"
