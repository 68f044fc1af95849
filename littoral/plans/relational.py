"""Projections, joins, aggregations, sorts and set operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from littoral.functions import core
from littoral.operators import dedupe, entity, gates, metrics, serving, spatial
from littoral.plans.registry import ADV, HAVERSINE, OBS, SD, SHIP, advisories, observations, place_sql, places, query, shipments, site_day, table

NOW = datetime(2000, 6, 1)


# --- joins


@query("j01_left_dim", "SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def j01(spark, d):
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left").select("o_orderkey", "c_name", "n_name")


@query("j02_preaggregated", "SELECT c_custkey, COALESCE(n, 0) AS advisories FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def j02(spark, d):
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("advisories"))


@query("j03_composite", f"WITH {OBS}, a AS (SELECT site, day, MAX(value) m FROM obs GROUP BY 1, 2), b AS (SELECT site, day, COUNT(*) n FROM obs WHERE method = 'view' GROUP BY 1, 2) SELECT site, day, m, n FROM a LEFT JOIN b USING (site, day)")
def j03(spark, d):
    o = observations(spark, d)
    a = o.groupBy("site", "day").agg(F.max("value").alias("m"))
    return a.join(o.where("method = 'view'").groupBy("site", "day").agg(F.count(F.lit(1)).alias("n")), ["site", "day"], "left")


@query("j05_inner", "SELECT l_orderkey, l_linenumber, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def j05(spark, d):
    return table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_orderdate")


@query("j06_all_days", "SELECT s_suppkey, day FROM supplier CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)")
def j06(spark, d):
    days = table(spark, d, "events").select(F.to_date("ts").alias("day")).distinct().agg(F.collect_list("day").alias("days"))  # a calendar: bounded
    return table(spark, d, "supplier").select("s_suppkey").join(F.broadcast(days)).select("s_suppkey", F.explode("days").alias("day"))


@query("j16_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def j16(spark, d):
    """One side is filtered so that the join has keys to miss."""
    big = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(big, "c_custkey", "left_semi").select("c_custkey")


@query("j17_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def j17(spark, d):
    """One side is filtered so that the join has keys to miss."""
    big = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(big, "c_custkey", "left_anti").select("c_custkey")


@query("j18_rebind", """WITH p AS (SELECT c_nationkey, c_mktsegment, MIN(c_custkey) t FROM customer WHERE c_acctbal > 9000 GROUP BY 1, 2 HAVING COUNT(DISTINCT c_custkey) = 1) SELECT c_custkey, COALESCE(t, -1) AS target FROM customer LEFT JOIN p USING (c_nationkey, c_mktsegment)""")
def j18(spark, d):
    """The lookup side is filtered so that some rows find no target."""
    c = table(spark, d, "customer")
    pairs = c.where("c_acctbal > 9000").select("c_nationkey", "c_mktsegment", F.col("c_custkey").alias("target"))
    rows = c.withColumn("target", F.lit(-1).cast("long"))
    return dedupe.rebind(rows, pairs, ["c_nationkey", "c_mktsegment"], "target").select("c_custkey", "target")


@query("j19_crosswalk", """WITH st AS (SELECT s_suppkey AS station, s_suppkey % 40 AS code, CAST(s_nationkey AS BIGINT) AS county, s_name AS name FROM supplier), rw AS (SELECT c_custkey AS row_id, c_custkey % 50 AS code, CAST(c_nationkey AS BIGINT) AS county, 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS name FROM customer),
 a AS (SELECT code, county, MIN(station) s FROM st GROUP BY 1, 2 HAVING COUNT(DISTINCT station) = 1), b AS (SELECT code, MIN(station) s FROM st GROUP BY 1 HAVING COUNT(DISTINCT station) = 1), c AS (SELECT lower(name) n, county, MIN(station) s FROM st GROUP BY 1, 2 HAVING COUNT(DISTINCT station) = 1)
 SELECT row_id, COALESCE(a.s, b.s, c.s) AS station, CASE WHEN a.s IS NOT NULL THEN 0 WHEN b.s IS NOT NULL THEN 1 WHEN c.s IS NOT NULL THEN 2 END AS layer FROM rw LEFT JOIN a USING (code, county) LEFT JOIN b ON b.code = rw.code LEFT JOIN c ON c.n = lower(rw.name) AND c.county = rw.county""")
def j19(spark, d):
    s, c = table(spark, d, "supplier"), table(spark, d, "customer")
    far = [F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon")]
    st = s.select(F.col("s_suppkey").alias("station"), (F.col("s_suppkey") % 40).alias("code"), F.col("s_nationkey").cast("long").alias("county"), F.col("s_name").alias("name"), *far)
    rows = c.select(F.col("c_custkey").alias("row_id"), (F.col("c_custkey") % 50).alias("code"), F.col("c_nationkey").cast("long").alias("county"), F.concat(F.lit("Supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("name"), *far)
    return entity.crosswalk(rows, st).select("row_id", "station", "layer")


@query("j20_resolver")
def j20(spark, d):
    p = table(spark, d, "part")
    catalogue = p.select(F.col("p_name").alias("label")).distinct().withColumn("target", F.col("label"))
    names = p.select(F.col("p_partkey").alias("name_id"), F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" north"))).when(F.col("p_partkey") % 3 == 1, F.regexp_replace("p_name", "(.)$", "")).otherwise(F.upper("p_name")).alias("name"))
    return entity.resolve(names, catalogue, spark.createDataFrame([("tiny thing", "small ring")], "alias string, target string")).select("name_id", "target", "layer")


@query("j21_refresh", f"WITH {OBS}, a AS (SELECT site, MAX(ts) AS t FROM obs WHERE day < DATE '2024-01-25' GROUP BY 1), b AS (SELECT site, MAX(ts) AS t FROM obs WHERE method = 'error' GROUP BY 1) SELECT site, COALESCE(b.t, a.t) AS latest FROM a LEFT JOIN b USING (site)")
def j21(spark, d):
    o = observations(spark, d)
    a = o.where(F.col("day") < F.lit("2024-01-25").cast("date")).groupBy("site").agg(F.max("ts").alias("old"))
    b = o.where("method = 'error'").groupBy("site").agg(F.max("ts").alias("new"))
    return a.join(b, "site", "left").select("site", F.coalesce("new", "old").alias("latest"))


@query("j24_sibling_rollup", """WITH v AS (SELECT s_suppkey, s_nationkey, s_name FROM supplier WHERE s_acctbal > 5000), f AS (SELECT s_nationkey, arg_min(s_name, s_suppkey) AS s_name FROM v GROUP BY 1) SELECT s.s_suppkey AS site, CAST(s.s_nationkey AS BIGINT) AS parent, f.s_name AS name FROM supplier s LEFT JOIN f USING (s_nationkey)""")
def j24(spark, d):
    """Values are filtered so that some members take a sibling's."""
    s = table(spark, d, "supplier")
    parents = s.groupBy(F.col("s_nationkey").cast("long").alias("parent")).agg(F.sort_array(F.collect_list("s_suppkey")).alias("members"))
    values = s.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("site"), F.col("s_name").alias("name"))
    return serving.sibling_rollup(parents, values, "site", "name")


@query("j25_cells", f"WITH {place_sql()} SELECT site, CAST(round_even(lat * 10, 0) AS BIGINT) AS cell_lat, CAST(round_even(lon * 10, 0) AS BIGINT) AS cell_lon FROM pl")
def j25(spark, d):
    return places(spark, d).select("site", F.bround(F.col("lat") * 10, 0).cast("long").alias("cell_lat"), F.bround(F.col("lon") * 10, 0).cast("long").alias("cell_lon"))


@query("j26_upsert", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, o_totalprice * 2 FROM orders WHERE o_orderkey % 5 = 0")
def j26(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return dedupe.upsert(o, o.where("o_orderkey % 5 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2), ["o_orderkey"])


@query("j27_frame_difference", """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'left only' ELSE 'differs' END AS state FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 7 = 0""")
def j27(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    b = o.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_orderstatus")))
    return gates.frame_difference(o, b, ["o_orderkey"], ["o_orderstatus"]).select("o_orderkey", "state")


@query("j31_largest_differences", """WITH a AS (SELECT user_id, AVG(value) m FROM events WHERE event_type = 'view' GROUP BY 1), b AS (SELECT user_id, AVG(value) m FROM events WHERE event_type = 'click' GROUP BY 1) SELECT user_id, ROUND(a.m, 6) AS m_view, ROUND(b.m, 6) AS m_click, ROUND(abs(a.m - b.m), 6) AS difference FROM a JOIN b USING (user_id) ORDER BY abs(a.m - b.m) DESC, user_id LIMIT 25""")
def j31(spark, d):
    e = table(spark, d, "events")
    a, b = (e.where(F.col("event_type") == k).groupBy("user_id").agg(F.avg("value").alias(f"m_{k}")) for k in ("view", "click"))
    both = a.join(b, "user_id").withColumn("difference", F.abs(F.col("m_view") - F.col("m_click"))).orderBy(F.desc("difference"), "user_id").limit(25)
    return both.select("user_id", *[F.round(c, 6).alias(c) for c in ("m_view", "m_click", "difference")])


# --- places

_PAIR = "sin(radians((b.lat - a.lat) / 2)) ^ 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians((b.lon - a.lon) / 2)) ^ 2"


@query("j12_nearest", f"""WITH {place_sql("customer", "a")}, {place_sql("supplier", "b")}, p AS (SELECT a.site, b.site AS other, {_PAIR} AS h FROM a, b), q AS (SELECT site, other, ROUND({HAVERSINE}, 6) AS km FROM p) SELECT site, arg_min(other, ROW(km, other)) AS nearest_station, MIN(km) AS km FROM q GROUP BY 1""")
def j12(spark, d):
    right = places(spark, d).select(F.col("site").alias("station"), "lat", "lon")
    return spatial.nearest(places(spark, d, "customer"), right, "site", "station").select("site", "nearest_station", F.round("nearest_km", 6).alias("km"))


@query("j14_radius", f"""WITH {place_sql("customer", "a")}, {place_sql("supplier", "b")}, p AS (SELECT a.site, {_PAIR} AS h FROM a, b), q AS (SELECT site, {HAVERSINE} AS km FROM p) SELECT site, COUNT(*) FILTER (km <= 30) AS assets, COUNT(*) FILTER (km <= 10) AS assets_near, ROUND(MIN(km) FILTER (km <= 30), 6) AS nearest_km FROM q GROUP BY 1""")
def j14(spark, d):
    r = spatial.radius_features(places(spark, d, "customer"), places(spark, d), "site", 30.0, 10.0)
    return r.select("site", "assets", "assets_near", F.round("nearest_km", 6).alias("nearest_km"))


@query("j13_conflicts", f"""WITH {place_sql("customer", "a")}, {place_sql("supplier", "b")}, p AS (SELECT a.site, b.site AS other, {_PAIR} AS h FROM a, b), q AS (SELECT site, other, {HAVERSINE} AS km FROM p), m AS (SELECT site, arg_min(other, ROW(km, other)) AS station, MIN(km) AS km FROM q GROUP BY 1) SELECT station, site FROM m QUALIFY row_number() OVER (PARTITION BY station ORDER BY ROUND(km, 9), site) = 1""")
def j13(spark, d):
    right = places(spark, d).select(F.col("site").alias("station"), "lat", "lon")
    m = spatial.nearest(places(spark, d, "customer"), right, "site", "station").withColumn("km", F.round("nearest_km", 9))
    return spatial.resolve_conflicts(m, "nearest_station", "km", "site").select(F.col("nearest_station").alias("station"), "site")


@query("j15_shore_azimuth", f"""WITH {place_sql("customer", "a")}, {place_sql("customer", "b")}, p AS (SELECT a.site, a.lat, a.lon, (b.lon - a.lon) * 111320 * cos(radians(a.lat)) AS x, (b.lat - a.lat) * 110540 AS y, row_number() OVER (PARTITION BY a.site ORDER BY (b.lat - a.lat) * (b.lat - a.lat) + (b.lon - a.lon) * (b.lon - a.lon), b.site) AS k FROM a JOIN b ON a.site <> b.site),
 s AS (SELECT site, ANY_VALUE(lat) AS lat, ANY_VALUE(lon) AS lon, atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) / 2 AS t FROM p WHERE k <= 5 GROUP BY 1), n AS (SELECT *, CASE WHEN -sin(t) * (-120.5 - lon) * 111320 * cos(radians(lat)) + cos(t) * (37 - lat) * 110540 > 0 THEN 1 ELSE -1 END AS g FROM s)
 SELECT site, ROUND((degrees(atan2(g * -sin(t), g * cos(t))) + 360) % 360, 3) AS azimuth FROM n""")
def j15(spark, d):
    return spatial.shore_azimuth(places(spark, d, "customer"), "site").select("site", F.round("azimuth", 3).alias("azimuth"))


@query("o08_nearest_others", f"""WITH {place_sql("supplier", "a")}, {place_sql("supplier", "b")}, p AS (SELECT a.site, b.site AS other, (b.lat - a.lat) * (b.lat - a.lat) + (b.lon - a.lon) * (b.lon - a.lon) AS d2 FROM a JOIN b ON a.site <> b.site), r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY d2, other) AS place FROM p) SELECT site, other, CAST(place AS INTEGER) AS place FROM r WHERE place <= 5""")
def o08(spark, d):
    return spatial.neighbours(places(spark, d), "site", 5).select("site", F.col("r_site").alias("other"), "place")


@query("a13_parents", f"""WITH RECURSIVE {place_sql("customer", "a")}, {place_sql("customer", "b")}, e AS (SELECT a.site AS u, b.site AS v, {_PAIR} AS h FROM a JOIN b ON a.county = b.county), l AS (SELECT u, v FROM e WHERE {HAVERSINE} <= 40), r(u, v) AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u), g AS (SELECT u AS site, MIN(v) AS parent FROM r GROUP BY 1)
 SELECT county, parent, COUNT(*) AS stations, ROUND(AVG(lat), 6) AS lat, ROUND(AVG(lon), 6) AS lon, arg_max(name, ROW(length(name), -site)) AS name, MAX(CASE WHEN site % 2 = 0 THEN 'full' ELSE 'basic' END) AS status, string_agg(CAST(site AS VARCHAR), ',' ORDER BY site) AS members FROM a JOIN g USING (site) GROUP BY 1, 2""")
def a13(spark, d):
    p = places(spark, d, "customer").withColumn("status", F.when(F.col("site") % 2 == 0, "full").otherwise("basic"))
    r = spatial.parents(p, "site", "county", "name", "status", 40.0)
    return r.select("county", "parent", "stations", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "name", "status", F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"))


@query("a29_cell_features", f"""WITH {place_sql("customer", "pl")} SELECT CAST(floor(lat / 0.5) AS BIGINT) AS cy, CAST(floor(lon / 0.5) AS BIGINT) AS cx, COUNT(*) AS n, ROUND(median(lat), 6) AS mid_lat, ROUND(AVG(sin(radians(lon))), 6) AS s FROM pl GROUP BY 1, 2""")
def a29(spark, d):
    cy, cx = spatial.cells(F.col("lat"), F.col("lon"), 0.5)
    return places(spark, d, "customer").groupBy(cy.alias("cy"), cx.alias("cx")).agg(F.count(F.lit(1)).alias("n"), F.round(F.median("lat"), 6).alias("mid_lat"), F.round(F.avg(F.sin(F.radians("lon"))), 6).alias("s"))


# --- aggregations


@query("a01_spans", "SELECT user_id, COUNT(*) AS n, MAX(ts) AS newest, MIN(ts) AS oldest, CAST(CAST(MAX(ts) AS DATE) - CAST(MIN(ts) AS DATE) AS BIGINT) AS span_days FROM events GROUP BY 1")
def a01(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"), F.min("ts").alias("oldest"), F.datediff(F.max("ts"), F.min("ts")).cast("long").alias("span_days"))


@query("a04_named_aggregates", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS total, MIN(l_shipdate) AS first_day, MAX(l_shipdate) AS last_day FROM lineitem GROUP BY 1, 2")
def a04(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("total"), F.min("l_shipdate").alias("first_day"), F.max("l_shipdate").alias("last_day"))


@query("a06_first_and_mean", "SELECT user_id, CAST(ts AS DATE) AS day, arg_min(event_type, ts) AS first_type, ROUND(AVG(value), 6) AS mean FROM events GROUP BY 1, 2")
def a06(spark, d):
    return table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min_by("event_type", "ts").alias("first_type"), F.round(F.avg("value"), 6).alias("mean"))


@query("a14_medians", "SELECT c_nationkey, ROUND(median(c_acctbal), 6) AS mid, CASE WHEN COUNT(*) >= 60 THEN 'full' ELSE 'partial' END AS support FROM customer GROUP BY 1")
def a14(spark, d):
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.round(F.median("c_acctbal"), 6).alias("mid"), F.when(F.count(F.lit(1)) >= 60, "full").otherwise("partial").alias("support"))


@query("a15_unique_targets", "SELECT o_custkey, MIN(o_orderstatus) AS o_orderstatus FROM orders GROUP BY 1 HAVING COUNT(DISTINCT o_orderstatus) = 1")
def a15(spark, d):
    return dedupe.unique_lookup(table(spark, d, "orders").select("o_custkey", "o_orderstatus"), ["o_custkey"], "o_orderstatus")


@query("a16_value_counts", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def a16(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type").limit(3)


@query("a21_pool_agreement", f"""WITH {ADV} SELECT kind, COUNT(*) AS n, COUNT(*) FILTER (ended IS NULL) AS open, COUNT(*) FILTER (status = 'active') AS active FROM adv GROUP BY 1""")
def a21(spark, d):
    return advisories(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ended").isNull()).alias("open"), F.count_if(F.col("status") == "active").alias("active"))


@query("a25_bands", f"""WITH {OBS}, b AS (SELECT CASE WHEN ratio < 0.2 THEN 'low' WHEN ratio < 0.5 THEN 'moderate' ELSE 'high' END AS band FROM obs) SELECT band, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(*) FROM b)::DOUBLE, 6) AS share FROM b GROUP BY 1""")
def a25(spark, d):
    per = observations(spark, d).groupBy(core.risk_band(F.col("ratio")).alias("band")).agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))  # a row per band


@query("a26_freshness", f"""WITH {SHIP}, x AS (SELECT DISTINCT site, day FROM ship WHERE day <= DATE '2001-06-30'), g AS (SELECT site, day, CASE WHEN day >= DATE '2001-06-30' - 180 THEN day - LAG(day) OVER (PARTITION BY site ORDER BY day) END AS gap FROM x), a AS (SELECT site, COUNT(*) AS days, MAX(day) AS newest, median(gap)::DOUBLE AS median_gap FROM g GROUP BY 1)
 SELECT site, days, newest, median_gap, CAST(DATE '2001-06-30' - newest AS BIGINT) AS age, (DATE '2001-06-30' - newest) > GREATEST(14.0, 3 * COALESCE(median_gap, 0)) AS late FROM a""")
def a26(spark, d):
    return metrics.freshness(shipments(spark, d), "site", "day", "2001-06-30").select("site", "days", "newest", "median_gap", "age", "late")


@query("a27_fingerprint")
def a27(spark, d):
    o = observations(spark, d)
    f = metrics.fingerprint(o, F.col("site"), F.col("day"), F.col("exceeds"))
    return f.select("rows", "xor", F.col("total").cast("string").alias("total"))


@query("a30_date_ranges", f"WITH {SHIP} SELECT site, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS days FROM ship GROUP BY 1")
def a30(spark, d):
    return shipments(spark, d).groupBy("site").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("days"))


@query("a31_snapshot_row", f"WITH {OBS} SELECT COUNT(*) AS rows, COUNT(DISTINCT site) AS sites, COUNT(*) FILTER (exceeds) AS exceeding, MAX(day) AS newest FROM obs")
def a31(spark, d):
    return observations(spark, d).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("site").alias("sites"), F.count_if("exceeds").alias("exceeding"), F.max("day").alias("newest"))


@query("a32_group_transform", "SELECT o_orderkey, COUNT(*) OVER (PARTITION BY o_custkey) AS group_size, (SELECT COUNT(DISTINCT o_orderstatus) FROM orders i WHERE i.o_custkey = o.o_custkey) AS group_distinct FROM orders o")
def a32(spark, d):
    o = dedupe.group_size(table(spark, d, "orders"), ["o_custkey"])
    return dedupe.group_distinct(o, ["o_custkey"], "o_orderstatus").select("o_orderkey", "group_size", "group_distinct")


@query("a33_crosstab", """SELECT COALESCE(o_orderpriority, 'All') AS o_orderpriority, COUNT(*) FILTER (o_orderstatus = 'F') AS "F", COUNT(*) FILTER (o_orderstatus = 'O') AS "O", COUNT(*) FILTER (o_orderstatus = 'P') AS "P", COUNT(*) AS "All" FROM orders GROUP BY ROLLUP (orders.o_orderpriority)""")
def a33(spark, d):
    return metrics.crosstab_with_totals(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("a34_active_keys", "SELECT o_custkey FROM orders GROUP BY 1 HAVING MAX(o_orderdate) >= TIMESTAMP '2001-06-01'")
def a34(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("m")).where(F.col("m") >= datetime(2001, 6, 1)).select("o_custkey")


@query("a35_by_month", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, COUNT(*) AS n FROM orders GROUP BY 1, 2")
def a35(spark, d):
    return table(spark, d, "orders").groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("quarter")).agg(F.count(F.lit(1)).alias("n"))


# --- order and sets


@query("o01_sort", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey")
def o01(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate").orderBy("o_custkey", F.desc("o_orderdate"), "o_orderkey")


@query("o02_newest_per_site", "SELECT user_id AS site, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS INTEGER) AS position FROM events QUALIFY position <= 25")
def o02(spark, d):
    return serving.newest_per(observations(spark, d), ["site"], [F.desc("ts"), F.asc("event_id")], 25).select("site", "event_id", "position")


@query("o03_recent_and_active", f"WITH {ADV}, t AS (SELECT * FROM adv QUALIFY row_number() OVER (PARTITION BY site ORDER BY started DESC NULLS LAST, advisory) <= 3) SELECT advisory, site, kind FROM t UNION SELECT advisory, site, kind FROM adv WHERE status = 'active' AND ended IS NULL")
def o03(spark, d):
    active = (F.col("status") == "active") & F.col("ended").isNull()
    return serving.recent_and_active(advisories(spark, d), "site", active, "advisory", 3).select("advisory", "site", "kind")


@query("o04_largest", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def o04(spark, d):
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("u01_union_aligned", "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def u01(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return dedupe.union_aligned(s, table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")))


@query("u02_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def u02(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("u03_intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events")
def u03(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("k")).intersect(table(spark, d, "events").select("user_id"))


@query("u04_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def u04(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, d, "orders").where("o_totalprice > 300000").select("o_custkey"))


@query("u05_augment", f"WITH {SD} SELECT site, day, 'observed' AS tag FROM sd UNION ALL SELECT site, day, 'stale' FROM sd WHERE exceeds")
def u05(spark, d):
    sd = site_day(spark, d).select("site", "day", "exceeds")
    return sd.withColumn("tag", F.lit("observed")).unionByName(sd.where("exceeds").withColumn("tag", F.lit("stale"))).drop("exceeds")


@query("u06_expected_split", "SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'expected' ELSE 'unexpected' END AS part FROM orders")
def u06(spark, d):
    good = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("known"))
    return table(spark, d, "orders").join(good, "o_custkey", "left").select("o_orderkey", F.when(F.col("known"), "expected").otherwise("unexpected").alias("part"))


@query("u07_mirror_collapse", """WITH a AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate, l_quantity, l_linestatus, l_returnflag ORDER BY l_orderkey * 10 + l_linenumber) = 1)
 SELECT l_suppkey, l_shipdate, l_quantity, l_returnflag FROM a QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate, l_quantity ORDER BY CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, l_orderkey * 10 + l_linenumber) = 1""")
def u07(spark, d):
    rows = table(spark, d, "lineitem").withColumn("tie", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    r = dedupe.mirror_collapse(rows, ["l_suppkey", "l_shipdate", "l_quantity", "l_linestatus"], ["l_suppkey", "l_shipdate", "l_quantity"], "l_returnflag", ["R", "A"], "tie")
    return r.select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")


@query("u08_gap_fill", f"WITH {OBS}, base AS (SELECT DISTINCT site, day, 'lab' AS src FROM obs WHERE method = 'error'), extra AS (SELECT DISTINCT site, day, 'field' AS src FROM obs WHERE method = 'view') SELECT * FROM base UNION ALL SELECT * FROM extra e WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.site = e.site AND b.day = e.day)")
def u08(spark, d):
    o = observations(spark, d)
    base, extra = (o.where(F.col("method") == m).select("site", "day").distinct().withColumn("src", F.lit(s)) for m, s in (("error", "lab"), ("view", "field")))
    return dedupe.fill_gaps(base, extra, ["site", "day"])


@query("u09_refresh_part", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders""")
def u09(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"), F.lit(0).alias("version"))
    fresh = o.where("o_orderstatus = 'F'").withColumns({"price": F.col("price") + 1, "version": F.lit(1)})
    return dedupe.refresh_part(o, fresh, F.col("o_orderstatus") == "F", ["o_orderkey"], [F.desc("version")]).select("o_orderkey", "price")


@query("u10_carry_forward", f"WITH {OBS}, fresh AS (SELECT site, ts FROM obs WHERE method = 'view' AND day = DATE '2024-01-20'), old AS (SELECT site, ts FROM obs WHERE method = 'click') SELECT site, ts FROM fresh UNION ALL SELECT site, ts FROM old WHERE site NOT IN (SELECT site FROM fresh) AND ts >= TIMESTAMP '2024-01-20 00:00:00'")
def u10(spark, d):
    o = observations(spark, d)
    fresh = o.where((F.col("method") == "view") & (F.col("day") == F.lit("2024-01-20").cast("date"))).select("site", "ts")
    return dedupe.carry_forward(o.where("method = 'click'").select("site", "ts"), fresh, "site", "ts", datetime(2024, 1, 20))
