"""Rates, features and joins over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from littoral.functions.core import effective_end
from littoral.operators import dedupe, rates, temporal
from littoral.plans.registry import ADV, OBS, SD, SHIP, advisories, observations, query, shipments, site_day


@query("a17_shrunk_rate", f"""WITH {OBS}, daily AS (SELECT site, day, MAX(CAST(exceeds AS INT)) y FROM obs WHERE day >= DATE '2024-01-11' AND day < DATE '2024-01-25' GROUP BY 1, 2),
 g AS (SELECT SUM(y) / COUNT(*)::DOUBLE AS g FROM daily), u AS (SELECT DISTINCT user_id AS site FROM events)
 SELECT u.site, CAST(COUNT(d.y) AS BIGINT) AS n, CAST(COALESCE(SUM(d.y), 0) AS BIGINT) AS pos, ROUND((COALESCE(SUM(d.y), 0) + 5 * ANY_VALUE(g.g)) / (COUNT(d.y) + 5), 6) AS p FROM u CROSS JOIN g LEFT JOIN daily d USING (site) GROUP BY u.site""")
def a17(spark, d):
    o = observations(spark, d)
    return rates.shrunk_rate(o, o, "site", "day", "exceeds", "2024-01-25", 14).select("site", "n", "pos", F.round("p", 6).alias("p"))


@query("a17_interval")
def a17_interval(spark, d):
    o = observations(spark, d)
    r = rates.shrunk_rate(o, o, "site", "day", "exceeds", "2024-01-25", 14)
    return r.withColumn("i", rates.beta_interval(F.col("pos").cast("double"), F.col("n").cast("double"), "g", F.lit(5.0))).select("site", "n", "pos", F.round("i.low", 5).alias("low"), F.round("i.high", 5).alias("high"))


@query("a18_hierarchical_rate", f"""WITH {OBS}, per AS (SELECT method, site, COUNT(*) n, SUM(CAST(exceeds AS INT)) pos FROM obs GROUP BY 1, 2), top AS (SELECT method, SUM(n) N_, SUM(pos) P_ FROM per GROUP BY 1),
 w AS (SELECT SUM(P_) / SUM(N_)::DOUBLE g FROM top), t2 AS (SELECT method, (P_ + 20 * g) / (N_ + 20) outer_rate, g FROM top, w)
 SELECT method, site, CAST(n AS BIGINT) n, CAST(pos AS BIGINT) pos, ROUND(outer_rate, 6) outer_rate, ROUND((pos + 5 * outer_rate) / (n + 5), 6) rate FROM per JOIN t2 USING (method)""")
def a18(spark, d):
    r = rates.hierarchical_rate(observations(spark, d), "method", "site", "exceeds")
    return r.select("method", "site", "n", "pos", F.round("outer_rate", 6).alias("outer_rate"), F.round("rate", 6).alias("rate"))


@query("a19_margins", f"""WITH {OBS}, per AS (SELECT site, COUNT(*) n, SUM(CAST(exceeds AS INT)) pos FROM obs GROUP BY 1), w AS (SELECT SUM(pos) / SUM(n)::DOUBLE g FROM per), q AS (SELECT site, (pos + 10 * g) / (n + 10) p, g FROM per, w)
 SELECT site, ROUND(ln(p / (1 - p)), 6) margin, ROUND(ln(g / (1 - g)), 6) global_margin FROM q""")
def a19(spark, d):
    return rates.margins(observations(spark, d), "site", "exceeds").select("site", F.round("margin", 6).alias("margin"), F.round("global_margin", 6).alias("global_margin"))


@query("a20_routed_prior", f"""WITH {OBS}, per AS (SELECT method, site, COUNT(*) n, SUM(CAST(exceeds AS INT)) pos FROM obs GROUP BY 1, 2), top AS (SELECT method, SUM(n) outer_n, SUM(pos) P_ FROM per GROUP BY 1),
 w AS (SELECT SUM(P_) / SUM(outer_n)::DOUBLE g FROM top), t2 AS (SELECT method, outer_n, (P_ + 20 * g) / (outer_n + 20) outer_rate, g FROM top, w)
 SELECT method, site, CASE WHEN n >= 15 THEN 'inner' WHEN outer_n >= 50 THEN 'outer' ELSE 'global' END AS scope, ROUND(CASE WHEN n >= 15 THEN (pos + 5 * outer_rate) / (n + 5) WHEN outer_n >= 50 THEN outer_rate ELSE g END, 6) AS prior FROM per JOIN t2 USING (method)""")
def a20(spark, d):
    r = rates.hierarchical_rate(observations(spark, d), "method", "site", "exceeds")
    sizes = r.groupBy("method").agg(F.sum("n").alias("outer_n"))
    prior, scope = rates.routed_prior(r, 15)
    return r.join(sizes, "method").select("method", "site", scope.alias("scope"), F.round(prior, 6).alias("prior"))


@query("w15_worst_of_day", f"WITH {SD} SELECT site, day, event_id, value, exceeds FROM sd")
def w15(spark, d):
    return site_day(spark, d).select("site", "day", "event_id", "value", "exceeds")


@query("a03_daily_outcomes", f"WITH {OBS} SELECT site, day, bool_or(exceeds) AS exceeds, COUNT(*) AS samples FROM obs GROUP BY 1, 2")
def a03(spark, d):
    return observations(spark, d).groupBy("site", "day").agg(F.bool_or("exceeds").alias("exceeds"), F.count(F.lit(1)).alias("samples"))


_WIN = "OVER (PARTITION BY site ORDER BY day RANGE BETWEEN INTERVAL {} DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)"


@query("w01_rolling", f"""WITH {SD} SELECT site, day, ROUND(AVG(ratio) {_WIN.format(7)}, 6) AS mean_7d, ROUND(AVG(ratio) {_WIN.format(30)}, 6) AS mean_30d, ROUND(STDDEV_SAMP(ratio) {_WIN.format(7)}, 6) AS std_7d,
 ROUND(AVG(ratio) {_WIN.format(7)} - AVG(ratio) {_WIN.format(30)}, 6) AS trend, CAST(day - LAG(day) OVER (PARTITION BY site ORDER BY day) AS BIGINT) AS days_since_sample FROM sd""")
def w01(spark, d):
    r = temporal.rolling(site_day(spark, d), ["site"], "day", "ratio")
    return r.select("site", "day", *[F.round(f"ratio_{c}", 6).alias(c) for c in ("mean_7d", "mean_30d", "std_7d", "trend")], F.col("days_since_sample").cast("long").alias("days_since_sample"))


@query("w05_last_observed", f"""WITH {SD}, x AS (SELECT site, day, CASE WHEN exceeds THEN value END AS v FROM sd) SELECT site, day, LAST_VALUE(v IGNORE NULLS) OVER w AS v_last,
 CAST(day - LAST_VALUE(CASE WHEN v IS NOT NULL THEN day END IGNORE NULLS) OVER w AS BIGINT) AS v_age FROM x WINDOW w AS (PARTITION BY site ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def w05(spark, d):
    x = site_day(spark, d).select("site", "day", F.when(F.col("exceeds"), F.col("value")).alias("v"))
    return temporal.last_observed(x, ["site"], "day", "v").select("site", "day", "v_last", F.col("v_age").cast("long").alias("v_age"))


@query("w07_geomean", f"""WITH {SD}, x AS (SELECT site, day, value, log10(GREATEST(value, 1.0)) AS l FROM sd), y AS (SELECT site, day, CASE WHEN COUNT(l) {_WIN.format(30)} >= 2 THEN pow(10.0, AVG(l) {_WIN.format(30)}) END AS a,
 CASE WHEN COUNT(l) {_WIN.format(42)} >= 2 THEN pow(10.0, AVG(l) {_WIN.format(42)}) END AS b, COUNT(*) {_WIN.format(30)} AS c FROM x)
 SELECT site, day, ROUND(a, 6) AS geomean_30d, COALESCE(a >= 30, FALSE) AS geomean_30d_above, ROUND(b, 6) AS geomean_42d, COALESCE(b >= 30, FALSE) AS geomean_42d_above, CASE WHEN c >= 1 THEN c END AS samples_30d FROM y""")
def w07(spark, d):
    r = temporal.regulatory_geomean(site_day(spark, d), ["site"], "day", "value")
    return r.select("site", "day", F.round("geomean_30d", 6).alias("geomean_30d"), "geomean_30d_above", F.round("geomean_42d", 6).alias("geomean_42d"), "geomean_42d_above", "samples_30d")


@query("w08_wetness", f"""WITH {OBS}, dr AS (SELECT site, day, SUM(value) AS rain FROM obs GROUP BY 1, 2), n AS (SELECT site, day, rain, row_number() OVER (PARTITION BY site ORDER BY day) AS i FROM dr)
 SELECT a.site, a.day, ROUND(COALESCE(SUM(b.rain * 0.2 * pow(0.8, a.i - 1 - b.i)), 0), 6) AS wetness FROM n a LEFT JOIN n b ON a.site = b.site AND b.i < a.i GROUP BY 1, 2""")
def w08(spark, d):
    dr = observations(spark, d).groupBy("site", "day").agg(F.sum("value").alias("rain"))
    return temporal.wetness_index(dr, ["site"], "day", "rain").select("site", "day", F.round("wetness", 6).alias("wetness"))


@query("w09_first_flush", f"""WITH {SHIP}, x AS (SELECT site, day, CASE WHEN n >= 2 THEN rain ELSE 0 END AS rain FROM ship) SELECT site, day, CAST(COALESCE(SUM(rain) OVER (PARTITION BY site ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) = 0 AND rain > 12.7 AS INTEGER) AS first_flush FROM x""")
def w09(spark, d):
    x = shipments(spark, d).withColumn("rain", F.when(F.col("n") >= 2, F.col("rain")).otherwise(0.0))
    return temporal.first_flush(x, ["site"], "day", "rain").select("site", "day", "first_flush")


@query("w10_days_since_sunny", f"""WITH {SHIP}, x AS (SELECT site, day, LAST_VALUE(CASE WHEN cloud <= 0.03 THEN day END IGNORE NULLS) OVER (PARTITION BY site ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM ship)
 SELECT site, day, CAST(LEAST(GREATEST(day - s, 0), 30) AS BIGINT) AS days_since_sunny FROM x WHERE s IS NOT NULL UNION ALL SELECT site, day, NULL FROM x WHERE s IS NULL""")
def w10(spark, d):
    return temporal.days_since(shipments(spark, d), ["site"], "day", F.col("cloud") <= 0.03, "days_since_sunny").select("site", "day", F.col("days_since_sunny").cast("long").alias("days_since_sunny"))


@query("w11_persistence", f"WITH {SD} SELECT site, day, COALESCE(LAG(CAST(exceeds AS INTEGER)) OVER (PARTITION BY site ORDER BY day), 0) AS persistence FROM sd")
def w11(spark, d):
    from pyspark.sql import Window

    return site_day(spark, d).select("site", "day", F.coalesce(F.lag(F.col("exceeds").cast("int")).over(Window.partitionBy("site").orderBy("day")), F.lit(0)).alias("persistence"))


@query("w12_trailing_counts", f"""WITH {OBS}, q AS (SELECT DISTINCT site, DATE '2024-01-21' AS day FROM obs UNION SELECT DISTINCT site, DATE '2024-01-28' FROM obs), p AS (SELECT q.day, COUNT(o.site) pool_n, CAST(COALESCE(SUM(CAST(o.exceeds AS INT)), 0) AS BIGINT) pool_hits FROM (SELECT DISTINCT day FROM q) q LEFT JOIN obs o ON o.day < q.day AND o.day >= q.day - 10 GROUP BY 1)
 SELECT q.site, q.day, COUNT(o.site) AS n, CAST(COALESCE(SUM(CAST(o.exceeds AS INT)), 0) AS BIGINT) AS hits, ANY_VALUE(pool_n) AS pool_n, ANY_VALUE(pool_hits) AS pool_hits FROM q JOIN p ON p.day = q.day LEFT JOIN obs o ON o.site = q.site AND o.day < q.day AND o.day >= q.day - 10 GROUP BY 1, 2""")
def w12(spark, d):
    o = observations(spark, d)
    q = o.select("site").distinct().withColumn("day", F.explode(F.array(F.lit("2024-01-21").cast("date"), F.lit("2024-01-28").cast("date"))))
    return temporal.trailing_counts(q, o, "site", "day", "exceeds", 10).select("site", "day", "n", "hits", "pool_n", "pool_hits")


@query("w13_freshness", f"""WITH {SD}, x AS (SELECT site, day, day - LAG(day) OVER (PARTITION BY site ORDER BY day) AS age FROM sd) SELECT site, day, ROUND(CASE WHEN age IS NULL THEN 0 ELSE exp(-(age - 1) / 3.0::DOUBLE) END, 6) AS freshness FROM x""")
def w13(spark, d):
    from pyspark.sql import Window

    from littoral.functions.core import freshness

    age = F.datediff("day", F.lag("day").over(Window.partitionBy("site").orderBy("day")))
    return site_day(spark, d).withColumn("age", age).select("site", "day", F.round(freshness(F.col("age")), 6).alias("freshness"))


@query("w14_history_tensor", f"""WITH {SD}, a AS (SELECT site, day FROM sd), h AS (SELECT a.site, a.day, CAST(a.day - b.day AS INT) AS k, b.value FROM a JOIN sd b ON a.site = b.site AND b.day < a.day AND b.day >= a.day - 30)
 SELECT site, day, COUNT(*) AS rows, ROUND(SUM(CAST(value AS FLOAT)::DOUBLE * k), 2) AS checksum FROM h GROUP BY 1, 2 HAVING COUNT(*) >= 3""")
def w14(spark, d):
    t = temporal.history_tensor(site_day(spark, d), ["site"], "day", ["value"])
    total = F.aggregate(F.transform("history", lambda x, i: x[0].cast("double") * (30 - i)), F.lit(0.0), lambda a, x: a + x)
    return t.select("site", "day", F.col("history_days").alias("rows"), F.round(total, 2).alias("checksum"))


@query("w16_keep_last", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def w16(spark, d):
    from littoral.plans.registry import table

    return dedupe.keep_one(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("w17_gap_clusters", f"""WITH {OBS}, g AS (SELECT event_id, site, ts, CASE WHEN ts - LAG(ts) OVER (PARTITION BY site ORDER BY ts, event_id) > INTERVAL 240 MINUTES THEN 1 ELSE 0 END AS s FROM obs)
 SELECT event_id, site, CAST(SUM(s) OVER (PARTITION BY site ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cluster FROM g""")
def w17(spark, d):
    return dedupe.gap_clusters(observations(spark, d), ["site"], "ts", 240, "event_id").select("event_id", "site", "cluster")


@query("w18_extrema", f"""WITH {OBS}, x AS (SELECT event_id, site, value, LAG(value) OVER w AS b, LEAD(value) OVER w AS a FROM obs WINDOW w AS (PARTITION BY site ORDER BY ts)), k AS (SELECT event_id, site, value, CASE WHEN value > b AND value >= a THEN 'H' WHEN value < b AND value <= a THEN 'L' END AS kind FROM x) SELECT * FROM k WHERE kind IS NOT NULL""")
def w18(spark, d):
    return temporal.extrema(observations(spark, d), ["site"], "ts", "value").select("event_id", "site", "value", "kind")


@query("w19_last_values", f"""WITH {OBS}, x AS (SELECT site, ts, CASE WHEN exceeds THEN value END AS bad, CASE WHEN method = 'view' THEN value END AS seen FROM obs) SELECT site, arg_max(bad, ts) FILTER (bad IS NOT NULL) AS bad, arg_max(seen, ts) FILTER (seen IS NOT NULL) AS seen FROM x GROUP BY 1""")
def w19(spark, d):
    x = observations(spark, d).select("site", "ts", F.when(F.col("exceeds"), F.col("value")).alias("bad"), F.when(F.col("method") == "view", F.col("value")).alias("seen"))
    return dedupe.last_values(x, ["site"], ["bad", "seen"], "ts")


@query("w20_recent_or_full", f"""WITH {OBS} SELECT site, COALESCE(arg_max(value, ts) FILTER (exceeds AND day >= DATE '2024-01-28'), arg_max(value, ts) FILTER (exceeds)) AS latest FROM obs GROUP BY 1""")
def w20(spark, d):
    recent, full = F.col("exceeds") & (F.col("day") >= F.lit("2024-01-28").cast("date")), F.col("exceeds")
    return observations(spark, d).groupBy("site").agg(F.coalesce(F.max_by("value", F.when(recent, F.col("ts"))), F.max_by("value", F.when(full, F.col("ts")))).alias("latest"))


_LAGS = ", ".join(f"l{n}.value AS value_lag_{n}" for n in (1, 2, 3, 7))


@query("j22_exact_lags", f"WITH {SD} SELECT a.site, a.day, {_LAGS} FROM sd a " + " ".join(f"LEFT JOIN sd l{n} ON l{n}.site = a.site AND l{n}.day = a.day - {n}" for n in (1, 2, 3, 7)))
def j22(spark, d):
    return temporal.exact_lags(site_day(spark, d), ["site"], "day", ["value"], [1, 2, 3, 7]).select("site", "day", *[f"value_lag_{n}" for n in (1, 2, 3, 7)])


@query("j09_asof_strict", f"""WITH {OBS}, l AS (SELECT * FROM obs WHERE method = 'purchase'), r AS (SELECT site, ts, value, event_id FROM obs WHERE method = 'view')
 SELECT l.event_id, l.site, r.ts AS asof_ts, r.value AS asof_value FROM l ASOF LEFT JOIN r ON l.site = r.site AND l.ts > r.ts""")
def j09(spark, d):
    o = observations(spark, d)
    r = temporal.asof_backward(o.where("method = 'purchase'"), o.where("method = 'view'"), "site", "ts", "ts", ["value"])
    return r.select("event_id", "site", "asof_ts", "asof_value")


@query("j10_asof_day", f"""WITH {SD}, l AS (SELECT DISTINCT site, DATE '2024-01-20' AS day FROM obs), r AS (SELECT site, day AS rday, value FROM sd WHERE method = 'error')
 SELECT l.site, l.day, r.rday AS asof_rday, r.value AS asof_value FROM l ASOF LEFT JOIN r ON l.site = r.site AND l.day >= r.rday""")
def j10(spark, d):
    sd = site_day(spark, d)
    left = observations(spark, d).select("site").distinct().withColumn("day", F.lit("2024-01-20").cast("date"))
    right = sd.where("method = 'error'").select("site", F.col("day").alias("rday"), "value")
    return temporal.asof_backward(left, right, "site", "day", "rday", ["value"], strict=False)


@query("j11_first_after", f"""WITH {SD} SELECT a.site, a.day, CAST(MIN(b.day - a.day) AS INTEGER) AS lead_days, arg_min(b.exceeds, b.day) AS exceeds FROM sd a LEFT JOIN sd b ON a.site = b.site AND b.day > a.day AND b.day <= a.day + 3 GROUP BY 1, 2""")
def j11(spark, d):
    sd = site_day(spark, d)
    return temporal.first_after(sd.select("site", "day"), sd.select("site", F.col("day").alias("rday"), "exceeds"), "site", "day", "rday", "exceeds").select("site", "day", "lead_days", "exceeds")


@query("j08_interval_features", f"""WITH {SHIP}, {ADV}, e AS (SELECT DISTINCT site, CAST(started AS DATE) s, CAST(COALESCE(ended, started + INTERVAL 14 DAYS) AS DATE) e FROM adv)
 SELECT ship.site, ship.day, COUNT(DISTINCT CASE WHEN e.s < ship.day AND e.e > ship.day - 14 THEN e.s::VARCHAR || e.e::VARCHAR END) AS overlaps, COUNT(DISTINCT CASE WHEN e.s < ship.day AND e.e > ship.day - 14 THEN e.s::VARCHAR || e.e::VARCHAR END) > 0 AS active,
 CAST(MIN(CASE WHEN e.e < ship.day THEN ship.day - e.e END) AS INTEGER) AS days_since_end FROM ship LEFT JOIN e ON e.site = ship.site GROUP BY 1, 2""")
def j08(spark, d):
    spans = advisories(spark, d).withColumn("ended", effective_end(F.col("started"), F.col("ended")))
    r = temporal.interval_features(shipments(spark, d).select("site", "day"), spans, "site", "day", "started", "ended")
    return r.select("site", "day", "overlaps", "active", "days_since_end")


@query("a08_window_sums", """WITH c AS (SELECT DISTINCT CAST(ts AS DATE) AS day, CAST(ts AS DATE) + INTERVAL 13 HOURS AS cut FROM events)
 SELECT user_id AS site, c.day, arg_max(value, ts) AS latest, COUNT(value) AS readings, ROUND(COALESCE(SUM(value) FILTER (ts >= cut - INTERVAL 24 HOURS), 0), 6) AS sum_24h, ROUND(AVG(value) FILTER (ts >= cut - INTERVAL 24 HOURS), 6) AS mean_24h, MAX(value) FILTER (ts >= cut - INTERVAL 24 HOURS) AS max_24h,
 ROUND(SUM(value), 6) AS sum_72h, ROUND(AVG(value), 6) AS mean_72h, MAX(value) AS max_72h, ROUND(GREATEST(SUM(value) - COALESCE(SUM(value) FILTER (ts >= cut - INTERVAL 24 HOURS), 0), 0), 6) AS before_24h FROM events JOIN c ON ts < cut AND ts >= cut - INTERVAL 72 HOURS GROUP BY 1, 2""")
def a08(spark, d):
    o = observations(spark, d)
    cuts = o.select("day").distinct().withColumn("cut", F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 13 HOURS"))
    r = temporal.window_to_cutoff(o, "site", "ts", "value", cuts, "cut", [24, 72])
    r = temporal.prior_by_difference(r, 72, 24, "before_24h")
    keep = ["sum_24h", "mean_24h", "sum_72h", "mean_72h", "before_24h"]
    return r.select("site", "day", "latest", "readings", "max_24h", "max_72h", *[F.round(c, 6).alias(c) for c in keep])


@query("a09_vector_wind", """SELECT user_id AS site, CAST(ts AS DATE) AS day, COUNT(*) AS readings, ROUND(AVG(value), 6) AS mean, ROUND(SUM(value) * 3600 / 1e6, 6) AS total FROM events GROUP BY 1, 2 HAVING COUNT(*) >= 2""")
def a09(spark, d):
    rows = observations(spark, d).groupBy("site", "day").agg(F.count(F.lit(1)).alias("readings"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.sum("value") * 3600 / 1e6, 6).alias("total"))
    return temporal.full_window(rows, 2)


@query("a05_circular_mean", """SELECT user_id AS site, CAST(ts AS DATE) AS day, ROUND(fmod(degrees(atan2(AVG(sin(radians(value))), AVG(cos(radians(value))))) + 360, 360), 4) AS bearing FROM events GROUP BY 1, 2""")
def a05(spark, d):
    return temporal.circular_daily(observations(spark, d), "site", "ts", "value").select("site", "day", F.round("bearing", 4).alias("bearing"))


@query("a10_uv_proxy", """WITH x AS (SELECT user_id AS site, CAST(ts AS DATE) AS day, CASE WHEN event_type = 'view' THEN value / 30 END AS uv, value AS sw FROM events) SELECT site, day, ROUND(COALESCE(MAX(uv), LEAST(15.0::DOUBLE, MAX(sw) / 80)), 6) AS uv_max, MAX(uv) IS NULL AS from_proxy FROM x GROUP BY 1, 2""")
def a10(spark, d):
    best, proxy = temporal.uv_or_proxy(F.when(F.col("method") == "view", F.col("value") / 30), F.col("value"))
    return observations(spark, d).groupBy("site", "day").agg(F.round(best, 6).alias("uv_max"), proxy.alias("from_proxy"))


@query("a11_nearest_in_time", """SELECT user_id AS site, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')), ts) = 1""")
def a11(spark, d):
    from datetime import datetime

    return temporal.nearest_in_time(observations(spark, d), ["site"], "ts", datetime(2024, 1, 15, 12), ["value"])


@query("a12_daily_peak", """WITH x AS (SELECT user_id AS site, CAST(timezone('America/Los_Angeles', timezone('UTC', ts)) AS DATE) AS day, ts, value FROM events) SELECT site, day, ROUND(AVG(value), 6) AS mean, MAX(value) AS max, arg_max(ts, ROW(value, -epoch_us(ts))) AS peak_ts FROM x GROUP BY 1, 2""")
def a12(spark, d):
    r = temporal.daily_with_peak(observations(spark, d), ["site"], "ts", "value", "value", ["ts"], "America/Los_Angeles")
    return r.select("site", "day", F.round("mean", 6).alias("mean"), "max", "peak_ts")


@query("a36_shallowest_daily", """WITH p AS (SELECT l_shipdate AS t, arg_max(l_quantity, l_tax) AS q FROM (SELECT l_shipdate, l_tax, MAX(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2) GROUP BY 1) SELECT CAST(t AS DATE) AS day, AVG(q) AS l_quantity FROM p GROUP BY 1""")
def a36(spark, d):
    from littoral.plans.registry import table

    rows = table(spark, d, "lineitem").groupBy("l_shipdate", "l_tax").agg(F.max("l_quantity").alias("l_quantity"))
    return temporal.shallowest_daily(rows, "l_shipdate", "l_tax", ["l_quantity"])
