"""Streaming forms over the event table, run to the end of what is there, a file a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from littoral.plans.registry import query, shared_path, table
from littoral.streaming import jobs


#: Files that the table is dealt into by time; each is a batch, so state and watermark carry over.
FILES = 4


def _events(spark, d):
    events = table(spark, d, "events")
    source = shared_path(spark, "stream")
    events.repartitionByRange(FILES, "ts").write.parquet(source)
    return jobs.parquet_stream(spark, source, events.schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _table(stream, spark, mode="append"):
    return jobs.run_to_table(stream, shared_path(spark, "streamed"), mode, shared_path(spark, "offsets"))


@query("t01_dedupe", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def t01(spark, d):
    s = _events(spark, d).withColumn("day", F.to_date("ts"))
    return _table(jobs.dedupe(s, ["user_id", "event_type", "day"], "ts", "60 days").select("user_id", "event_type", "day"), spark)


@query("t02_late_data", """WITH e AS (SELECT *, event_id % 4 <> 3 AS early, CAST(ts AS DATE) + 1 AS until FROM events), w AS (SELECT MAX(ts) FILTER (event_id % 2 = 0) - INTERVAL 2 DAYS AS mark FROM e)
 SELECT until, COUNT(*) FILTER (early OR until > mark) AS readings FROM e, w GROUP BY 1 HAVING COUNT(*) FILTER (early OR until > mark) > 0""")
def t02(spark, d):
    """A quarter of the rows comes after all others: those of days behind the watermark are too late and dropped."""
    events, source, k = table(spark, d, "events"), shared_path(spark, "stream"), F.col("event_id") % 4
    for part in (k % 2 == 0, k == 1, k == 3):
        events.where(part).repartitionByRange(FILES, "ts").write.mode("append").parquet(source)
    stream = jobs.parquet_stream(spark, source, events.schema, FILES).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = jobs.daily(stream.withColumn("all", F.lit(0)), "all", "ts", "value", "2 days", "0 hours")
    return _table(counts, spark, "update").groupBy(F.to_date("until").alias("until")).agg(F.max("readings").alias("readings"))


@query("t03_daily", "SELECT user_id, COUNT(*) AS readings, ROUND(SUM(value), 4) AS total FROM events GROUP BY 1, CAST(ts - INTERVAL 13 HOURS AS DATE)")
def t03(spark, d):
    out = _table(jobs.daily(_events(spark, d), "user_id", "ts", "value", "60 days"), spark, "complete")
    return out.select("user_id", "readings", F.round("total", 4).alias("total"))


@query("t04_sliding", "SELECT user_id, CAST(ts AS DATE) + CAST(k AS INT) + 1 AS until, ROUND(SUM(value), 4) AS total FROM events, range(3) t(k) GROUP BY 1, 2")
def t04(spark, d):
    out = _table(jobs.sliding(_events(spark, d), "user_id", "ts", "value", delay="60 days"), spark, "complete")
    return out.select("user_id", F.to_date("until").alias("until"), F.round("total", 4).alias("total"))


@query("t05_sessions", """WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 4 HOURS THEN 1 ELSE 0 END AS s FROM events), c AS (SELECT *, SUM(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, MIN(ts) AS since, COUNT(*) AS samples, MAX(value) AS most FROM c GROUP BY user_id, k""")
def t05(spark, d):
    out = _table(jobs.sessions(_events(spark, d), "user_id", "ts", "value", "4 hours", "60 days"), spark, "complete")
    return out.select("user_id", F.col("since").cast("timestamp_ntz").alias("since"), "samples", "most")


@query("t06_last_value", "SELECT user_id, arg_max(value, ts) AS last FROM events GROUP BY 1")
def t06(spark, d):
    out = _table(jobs.last_value(_events(spark, d), "user_id", "ts", "value"), spark, "update")
    return out.groupBy("user_id").agg(F.max_by("last", "at").alias("last"))


@query("t07_append_once", "SELECT user_id, event_type, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1, 2")
def t07(spark, d):
    """The newest event of each user and type; keys come again in later batches."""
    path = shared_path(spark, "sink")
    slim = _events(spark, d).select("user_id", "event_type", "event_id", "ts")
    jobs.append_once(slim, path, ["user_id", "event_type"], shared_path(spark, "offsets"), "ts").trigger(availableNow=True).start().awaitTermination()
    log = spark.read.parquet(path)
    return log.groupBy("user_id", "event_type").agg(F.max_by("event_id", "ts").alias("event_id"))
