"""Normalisation, enrichment joins, candidates and export chains."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from littoral.functions import core
from littoral.operators import dedupe, metrics, models, normalize, rates, serving, spatial, temporal
from littoral.plans.registry import ADV, HAVERSINE, OBS, SCORED, SD, SHIP, advisories, observations, place_sql, places, query, scored, shipments, site_day, table

FAR = datetime(2030, 1, 1)


def _raw_lab(spark, d):
    """events as raw text rows, with bad values, foreign parameters and implausible days."""
    k = F.col("event_id") % 10
    result = F.when(k == 1, "nan").when(k == 2, "-5").when(k == 3, " 7.5 ").otherwise(F.col("value").cast("string"))
    day = F.when(k == 4, "1/1/1900").when(k == 5, "garbage").otherwise(F.date_format("ts", "M/d/yyyy"))
    return table(spark, d, "events").select("event_id", F.col("user_id").alias("site"), F.when(k == 6, "E. coli").otherwise("Enterococcus").alias("parameter"), day.alias("day"), F.date_format("ts", "HH:mm:ss").alias("time"), result.alias("result"), F.lit("MPN").alias("unit"), F.when(F.col("event_type") == "error", "ddPCR").otherwise("culture").alias("method"))


@query("p04_lab_results", """WITH r AS (SELECT user_id AS site, date_trunc('second', ts) AS sample_time, CASE event_id % 10 WHEN 3 THEN 7.5 ELSE value END AS value, event_type = 'error' AS pcr FROM events WHERE event_id % 10 NOT IN (1, 2, 4, 5, 6))
 SELECT site, sample_time, value, ROUND(value / CASE WHEN pcr THEN 1413.0::DOUBLE ELSE 104.0::DOUBLE END, 6) AS ratio, value > CASE WHEN pcr THEN 1413 ELSE 104 END AS exceeds FROM r""")
def p04(spark, d):
    return normalize.lab_results(_raw_lab(spark, d), F.lit(FAR)).select("site", "sample_time", "value", F.round("ratio", 6).alias("ratio"), "exceeds")


@query("p02_marine_filter", "SELECT p_partkey FROM part WHERE lower(p_type) IN ('economy', 'small') OR regexp_matches(lower(p_name), 'widget|bolt')")
def p02(spark, d):
    return table(spark, d, "part").where(normalize.is_marine(F.col("p_type"), F.col("p_name"), ["Economy", "SMALL"], ["Widget", "bolt"])).select("p_partkey")


@query("p03_stations", "WITH x AS (SELECT 'n' || s_nationkey || '-' || CASE WHEN s_suppkey % 3 = 0 THEN 'supplier-' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') ELSE 'common' END AS site, s_suppkey FROM supplier) SELECT site, CAST(MIN(s_suppkey) AS BIGINT) AS first_code, CASE WHEN MIN(s_suppkey) % 2 = 0 THEN 'inactive' ELSE 'unknown' END AS status FROM x GROUP BY 1")
def p03(spark, d):
    k = F.col("s_suppkey")
    raw = table(spark, d, "supplier").select(F.when(k % 3 == 0, F.col("s_name")).otherwise("Common").alias("beach_name"), F.lit("x").alias("station_name"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("county"), F.lpad(k.cast("string"), 9, "0").alias("code"), F.when(k % 2 == 0, "Inactive").alias("status"), F.lit("33.5").alias("lat"), F.lit("-999").alias("lon"))
    first = normalize.stations(raw).withColumn("site", F.regexp_replace("site", "-[0-9]+$", "")).groupBy("site").agg(F.min(F.struct("code", "status")).alias("m"))
    return first.select("site", F.col("m.code").cast("long").alias("first_code"), F.col("m.status").alias("status"))


@query("p05_advisories", """SELECT o_orderkey AS site, CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'historical' END AS status, CAST(o_orderdate AS DATE) AS started, CASE WHEN o_orderkey % 2 = 0 THEN 'https://a.example/' || o_orderkey WHEN o_orderstatus = 'P' THEN 'https://p.example' END AS url FROM orders""")
def p05(spark, d):
    o = table(spark, d, "orders")
    raw = o.select(F.col("o_orderkey").alias("site"), F.lit("posting").alias("kind"), F.date_format("o_orderdate", "M/d/yyyy").alias("started"), F.when(F.col("o_orderstatus") != "O", "2002-01-01").otherwise("").alias("ended"), F.lit("n/a").alias("cause"), F.col("o_orderstatus").alias("county"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://a.example/"), F.col("o_orderkey").cast("string"))).otherwise("nan").alias("website"))
    return normalize.advisory_rows(raw, {"P": "https://p.example"}).select("site", "status", F.to_date("started").alias("started"), "url")


@query("p06_preferred_value", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_totalprice WHEN 1 THEN 5.0 WHEN 2 THEN NULL ELSE 3.0 END AS v FROM orders")
def p06(spark, d):
    k = F.col("o_orderkey") % 4
    sub = F.when(k == 1, "5").when(k == 2, "-1000").otherwise("")
    raw = F.when(k == 3, "3").otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", normalize.preferred_value(sub, raw).alias("v"))


@query("p07_live_rows", "SELECT o_orderkey, s_suppkey AS site FROM orders JOIN supplier ON s_suppkey = o_custkey WHERE o_orderdate <= TIMESTAMP '2000-01-01'")
def p07(spark, d):
    lookup = table(spark, d, "supplier").select(F.col("s_suppkey").alias("o_custkey"), F.col("s_suppkey").alias("site"))
    return normalize.with_station(table(spark, d, "orders"), lookup, "o_custkey", F.lit(datetime(2000, 1, 1)), "o_orderdate").select("o_orderkey", "site")


@query("p08_county_direct", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_custkey IN (SELECT s_suppkey FROM supplier)")
def p08(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("county"), F.col("o_custkey").alias("site"))
    return normalize.county_direct(rows, table(spark, d, "supplier").select(F.col("s_suppkey").alias("site")), ["F", "P"]).select("o_orderkey")


@query("p10_plausible", "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-01-03'")
def p10(spark, d):
    return table(spark, d, "orders").where(normalize.plausible(F.col("o_orderdate"), F.lit(datetime(2001, 1, 1)))).select("o_orderkey")


@query("p18_variants", f"WITH {SD} SELECT 'all' AS variant, site, day, CASE WHEN exceeds THEN 0.0 ELSE ratio END AS ratio FROM sd UNION ALL SELECT 'low', site, day, CASE WHEN value < 10 THEN 0.0 ELSE ratio END FROM sd")
def p18(spark, d):
    v = normalize.censored_variants(site_day(spark, d).select("site", "day", "ratio", "exceeds", "value"), ["ratio"], {"all": F.col("exceeds"), "low": F.col("value") < 10})
    return dedupe.union_aligned(*[f.select(F.lit(n).alias("variant"), "site", "day", "ratio") for n, f in v.items()])


@query("p20_corrections", "SELECT p_partkey, regexp_replace(p_name, '(?i)\\bwidget\\b', 'gadget', 'g') AS name FROM part")
def p20(spark, d):
    return table(spark, d, "part").select("p_partkey", core.replace_word(F.col("p_name"), "widget", "gadget").alias("name"))


@query("p23_assets", "SELECT COALESCE(CASE WHEN p_partkey % 3 > 0 THEN p_brand END, CAST(p_partkey AS VARCHAR)) AS asset, CASE WHEN lower(p_name) LIKE '%bolt%' THEN 'pump' ELSE 'other' END AS asset_kind FROM part")
def p23(spark, d):
    raw = table(spark, d, "part").select(F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand")).otherwise(" ").alias("first"), F.col("p_partkey").alias("second"), F.regexp_replace(F.lower("p_name"), "bolt", "Pump").alias("t"))
    return normalize.assets(raw, ["absent", "first", "second"], "t").select("asset", "asset_kind")


@query("p24_listed_waters", "SELECT p_brand, COUNT(*) AS listed FROM part WHERE regexp_matches(p_name || ' ' || p_type, 'red|ECONOMY') GROUP BY 1")
def p24(spark, d):
    return normalize.listed_waters(table(spark, d, "part"), ["p_name", "p_type"], "red|ECONOMY", "p_brand")


@query("p27_canonical_key", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS key_day, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 9 HOURS END AS key_time FROM orders")
def p27(spark, d):
    t = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate") + F.expr("INTERVAL 9 HOURS")).when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate"))
    rows = table(spark, d, "orders").select("o_orderkey", t.alias("sample_time"), F.to_date("o_orderdate").alias("sample_date"))
    return normalize.canonical_key(rows).select("o_orderkey", "key_day", "key_time")


@query("p26_curated", f"WITH {SD}, {ADV}, a AS (SELECT site, COUNT(*) AS n FROM adv GROUP BY 1) SELECT sd.site, day, exceeds, COALESCE(n, 0) AS advisories, c_name AS name FROM sd LEFT JOIN a USING (site) LEFT JOIN customer ON c_custkey = sd.site")
def p26(spark, d):
    n = advisories(spark, d).groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("site"), F.col("c_name").alias("name"))
    return site_day(spark, d).join(n, "site", "left").join(names, "site", "left").select("site", "day", "exceeds", F.coalesce("n", F.lit(0)).alias("advisories"), "name")


_PAIR = "sin(radians((b.lat - a.lat) / 2)) ^ 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians((b.lon - a.lon) / 2)) ^ 2"


@query("j07_nearest_series", f"""WITH {place_sql("customer", "a")}, {place_sql("supplier", "b")}, {SHIP}, p AS (SELECT a.site, b.site AS other, {_PAIR} AS h FROM a, b), m AS (SELECT site, arg_min(other, ROW(ROUND({HAVERSINE}, 9), other)) AS st FROM p GROUP BY 1) SELECT m.site, ship.day, ship.rain FROM m JOIN ship ON ship.site = m.st""")
def j07(spark, d):
    right = places(spark, d).select(F.col("site").alias("station"), "lat", "lon")
    m = spatial.nearest(places(spark, d, "customer"), right, "site", "station").select(F.col("site").alias("place"), F.col("nearest_station").alias("site"))
    return m.join(shipments(spark, d), "site").select(F.col("place").alias("site"), "day", "rain")


@query("j30_two_level_lookup", f"""WITH {place_sql("customer", "a")}, {place_sql("supplier", "b")}, cell AS (SELECT CAST(round_even(lat, 0) AS BIGINT) y, CAST(round_even(lon, 0) AS BIGINT) x, AVG(site) AS v FROM b GROUP BY 1, 2), p AS (SELECT a.site, b.site AS other, {_PAIR} AS h FROM a, b), q AS (SELECT site, other, {HAVERSINE} AS km FROM p), m AS (SELECT site, arg_min(other, ROW(km, other)) FILTER (km < 10) AS near FROM q GROUP BY 1)
 SELECT a.site, COALESCE(CAST(m.near AS DOUBLE), ROUND(cell.v, 6)) AS value FROM a LEFT JOIN m USING (site) LEFT JOIN cell ON cell.y = CAST(round_even(a.lat, 0) AS BIGINT) AND cell.x = CAST(round_even(a.lon, 0) AS BIGINT)""")
def j30(spark, d):
    cell = (F.bround("lat", 0).cast("long").alias("y"), F.bround("lon", 0).cast("long").alias("x"))
    grid = places(spark, d).groupBy(*cell).agg(F.avg("site").alias("v"))
    near = spatial.nearest(places(spark, d, "customer"), places(spark, d).select(F.col("site").alias("station"), "lat", "lon"), "site", "station")
    out = near.select("site", F.when(F.col("nearest_km") < 10, F.col("nearest_station").cast("double")).alias("n"), *cell).join(grid, ["y", "x"], "left")
    return out.select("site", F.coalesce("n", F.round("v", 6)).alias("value"))


@query("j28_replace_column", f"WITH {OBS}, uv AS (SELECT site, ts, value * 2 AS uv FROM obs WHERE method = 'view') SELECT event_id, uv FROM obs LEFT JOIN uv USING (site, ts)")
def j28(spark, d):
    o = observations(spark, d).withColumn("uv", F.lit(-1.0))
    fresh = dedupe.keep_one(observations(spark, d).where("method = 'view'").select("site", "ts", (F.col("value") * 2).alias("uv"), "event_id"), ["site", "ts"], [F.desc("event_id")]).drop("event_id")
    return o.drop("uv").join(fresh, ["site", "ts"], "left").select("event_id", "uv")


@query("j29_metadata_chain", "SELECT l_orderkey, l_linenumber, p_brand, s_name, n_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey")
def j29(spark, d):
    p, s, n = (table(spark, d, t) for t in ("part", "supplier", "nation"))
    rows = table(spark, d, "lineitem")
    return rows.join(p, rows.l_partkey == p.p_partkey, "left").join(s, rows.l_suppkey == s.s_suppkey, "left").join(n, s.s_nationkey == n.n_nationkey, "left").select("l_orderkey", "l_linenumber", "p_brand", "s_name", "n_name")


@query("j23_reindex", f"WITH {SHIP}, n AS (SELECT DISTINCT day FROM ship) SELECT s_suppkey AS site, n.day, COALESCE(rain, 0) AS rain FROM supplier CROSS JOIN n LEFT JOIN ship ON ship.site = s_suppkey AND ship.day = n.day")
def j23(spark, d):
    """Every station on every day, in the order of the stations; the calendar is bounded."""
    series = shipments(spark, d)
    calendar = series.select("day").distinct().agg(F.collect_list("day").alias("days"))
    dense = table(spark, d, "supplier").select(F.col("s_suppkey").alias("site")).join(F.broadcast(calendar)).select("site", F.explode("days").alias("day"))
    return dense.join(series, ["site", "day"], "left").select("site", "day", F.coalesce("rain", F.lit(0.0)).alias("rain"))


@query("a07_rising_flow", """WITH c AS (SELECT DISTINCT CAST(ts AS DATE) AS day, CAST(ts AS DATE) + INTERVAL 13 HOURS AS cut FROM events) SELECT user_id AS site, c.day, ROUND(AVG(value), 6) AS mean_72h, ROUND(AVG(value) FILTER (ts >= cut - INTERVAL 6 HOURS), 6) AS mean_6h, COALESCE(AVG(value) FILTER (ts >= cut - INTERVAL 6 HOURS) > AVG(value), FALSE) AS rising FROM events JOIN c ON ts < cut AND ts >= cut - INTERVAL 72 HOURS GROUP BY 1, 2""")
def a07(spark, d):
    o = observations(spark, d)
    cuts = o.select("day").distinct().withColumn("cut", F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 13 HOURS"))
    r = temporal.window_to_cutoff(o, "site", "ts", "value", cuts, "cut", [6, 72])
    return r.select("site", "day", *[core.round_scaled(F.col(c), 6).alias(c) for c in ("mean_72h", "mean_6h")], F.coalesce(F.col("mean_6h") > F.col("mean_72h"), F.lit(False)).alias("rising"))


@query("m10_scoped_rate", f"""WITH {SCORED}, s AS (SELECT source, lang, COUNT(*) n, AVG(CAST(y AS INT)) r FROM sc GROUP BY 1, 2), l AS (SELECT lang, COUNT(*) n, AVG(CAST(y AS INT)) r FROM sc GROUP BY 1), g AS (SELECT AVG(CAST(y AS INT)) r FROM sc) SELECT source, lang, ROUND(CASE WHEN s.n >= 8 THEN s.r WHEN l.n >= 20 THEN l.r ELSE g.r END, 6) AS rate, CASE WHEN s.n >= 8 THEN 'source' WHEN l.n >= 20 THEN 'lang' ELSE 'global' END AS scope FROM s JOIN l USING (lang), g""")
def m10(spark, d):
    y = F.col("y").cast("int")
    s, ln, g = (scored(spark, d).groupBy(*k).agg(F.count(F.lit(1)).alias(f"n{i}"), F.avg(y).alias(f"r{i}")) for i, k in enumerate((["source", "lang"], ["lang"], [])))
    rows = s.join(ln, "lang").join(F.broadcast(g))
    own, mid = F.col("n0") >= 8, F.col("n1") >= 20
    return rows.select("source", "lang", F.round(F.when(own, F.col("r0")).when(mid, F.col("r1")).otherwise(F.col("r2")), 6).alias("rate"), F.when(own, "source").when(mid, "lang").otherwise("global").alias("scope"))


@query("m17_candidates", f"WITH {SD} SELECT site, COUNT(*) AS samples, MAX(day) AS newest, arg_max(ratio, day) AS ratio FROM sd GROUP BY 1 HAVING COUNT(*) >= 3 AND MAX(day) >= DATE '2024-01-25'")
def m17(spark, d):
    r = site_day(spark, d).groupBy("site").agg(F.count(F.lit(1)).alias("samples"), F.max("day").alias("newest"), F.max_by("ratio", "day").alias("ratio"))
    return r.where((F.col("samples") >= 3) & (F.col("newest") >= F.lit("2024-01-25").cast("date")))


@query("m21_serve_chain", f"""WITH {OBS}, daily AS (SELECT site, day, MAX(CAST(exceeds AS INT)) y FROM obs WHERE day >= DATE '2024-01-11' AND day < DATE '2024-01-25' GROUP BY 1, 2), g AS (SELECT SUM(y) / COUNT(*)::DOUBLE g FROM daily), r AS (SELECT u.site, (COALESCE(SUM(y), 0) + 5 * ANY_VALUE(g)) / (COUNT(y) + 5) AS p FROM (SELECT DISTINCT site FROM obs) u CROSS JOIN g LEFT JOIN daily USING (site) GROUP BY 1),
 l AS (SELECT site, arg_max(exceeds, ts) AS x FROM obs WHERE day < DATE '2024-01-25' GROUP BY 1), {ADV}, po AS (SELECT DISTINCT site FROM adv WHERE status = 'active' AND CAST(started AS DATE) <= DATE '1996-01-01'), f AS (SELECT r.site, CASE WHEN po.site IS NOT NULL THEN GREATEST(CASE WHEN x THEN GREATEST(p, 0.2) ELSE p END, 0.3) WHEN x THEN GREATEST(p, 0.2) ELSE p END AS s FROM r LEFT JOIN l USING (site) LEFT JOIN po ON po.site = r.site)
 SELECT site, ROUND(s, 6) AS p_served, CASE WHEN s < 0.2 THEN 'low' WHEN s < 0.5 THEN 'moderate' ELSE 'high' END AS band FROM f""")
def m21(spark, d):
    o, day = observations(spark, d), F.lit("2024-01-25").cast("date")
    r = rates.shrunk_rate(o, o, "site", "day", "exceeds", "2024-01-25", 14)
    last = o.where(F.col("day") < day).groupBy("site").agg(F.max_by("exceeds", "ts").alias("x"))
    posted = serving.posted_sites(advisories(spark, d), "site", F.lit("1996-01-01").cast("date")).withColumn("posted", F.lit(True))
    rows = r.join(last, "site", "left").join(posted, "site", "left")
    return serving.served(rows, F.col("p"), F.col("posted"), F.col("x"), F.lit(None).cast("double")).select("site", F.round("p_served", 6).alias("p_served"), "band")


@query("m22_export_chain")
def m22(spark, d):
    """Guard, calibrate, floor, band."""
    rows = scored(spark, d).withColumn("p", core.finite(F.col("p")))
    knots = models.isotonic_knots(rows, "p", "y", 20)
    out = serving.served(rows, models.calibrated(F.col("p"), knots), F.col("toxic") == 1, F.lit(False), F.lit(1.0))
    return out.select("doc_id", F.round("p_served", 5).alias("p_served"), "band")


@query("e03_by_lag", f"""WITH {SD}, x AS (SELECT site, day, exceeds, ratio, day - LAG(day) OVER (PARTITION BY site ORDER BY day) AS lag FROM sd) SELECT CASE WHEN lag < 2 THEN '1' WHEN lag < 4 THEN '2-3' ELSE '4+' END AS lag_bin, COUNT(*) AS n, ROUND(AVG((LEAST(ratio, 1) - CAST(exceeds AS INT)) ^ 2), 6) AS brier FROM x WHERE lag IS NOT NULL GROUP BY 1""")
def e03(spark, d):
    w = Window.partitionBy("site").orderBy("day")
    rows = site_day(spark, d).withColumn("lag", F.datediff("day", F.lag("day").over(w))).where("lag is not null")
    rows = rows.select(core.ladder(F.col("lag"), [2, 4], ["1", "2-3", "4+"]).alias("lag_bin"), F.least("ratio", F.lit(1.0)).alias("p"), F.col("exceeds").cast("int").alias("y"))
    return metrics.losses(rows, "p", "y", ["lag_bin"]).select("lag_bin", "n", F.round("brier", 6).alias("brier"))


@query("v02_station_list", f"WITH {place_sql()} SELECT pl.site, pl.name, r_name AS region, n_name AS county FROM pl JOIN nation ON n_nationkey = county JOIN region ON r_regionkey = n_regionkey")
def v02(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return places(spark, d).select("site", "name", F.col("county").alias("k")).join(n, F.col("k") == F.col("n_nationkey")).select("site", "name", F.col("r_name").alias("region"), F.col("n_name").alias("county"))


@query("v06_health", f"WITH {ADV} SELECT COUNT(*) AS advisories, COUNT(*) FILTER (status = 'active') AS active, COUNT(DISTINCT site) AS sites FROM adv")
def v06(spark, d):
    advisories(spark, d).createOrReplaceTempView("littoral_advisories")
    return spark.sql("SELECT COUNT(*) AS advisories, COUNT_IF(status = 'active') AS active, COUNT(DISTINCT site) AS sites FROM littoral_advisories")


@query("s28_point_read", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 42 ORDER BY o_orderdate DESC, o_orderkey LIMIT 5")
def s28(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("littoral_orders")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM littoral_orders WHERE o_custkey = :site ORDER BY o_orderdate DESC, o_orderkey LIMIT 5", args={"site": 42})


@query("s32_link_confidence", f"""WITH {place_sql("customer", "a")}, {place_sql("supplier", "b")}, p AS (SELECT a.site, {_PAIR} AS h FROM a, b), q AS (SELECT site, MIN({HAVERSINE}) AS km FROM p GROUP BY 1) SELECT site, CASE WHEN km <= 10 THEN 'high' WHEN km <= 30 THEN 'medium' ELSE 'low' END AS confidence FROM q""")
def s32(spark, d):
    m = spatial.nearest(places(spark, d, "customer"), places(spark, d).select(F.col("site").alias("station"), "lat", "lon"), "site", "station")
    return m.select("site", normalize.confidence(F.col("nearest_km")).alias("confidence"))


@query("w17_collapse_physical")
def w17b(spark, d):
    """Units of one physical sample across sources, within half an hour."""
    rows = table(spark, d, "events").select("event_id", F.col("user_id").alias("site"), F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("t"), F.floor(F.col("value") / 50).cast("double").alias("v"), F.col("event_type").alias("src"))
    return dedupe.collapse_physical(rows, ["site", "day"], "t", "v", "src", "event_id", 240).select("event_id", "site", "day")


@query("p09_national", "SELECT event_id, user_id AS site FROM events WHERE event_id % 10 NOT IN (1, 2, 6) AND event_type <> 'signup'")
def p09(spark, d):
    raw = _raw_lab(spark, d).withColumn("value", core.safe_float(F.col("result")))
    types = table(spark, d, "events").select("event_id", "event_type")
    rows = raw.where(F.lower("parameter").contains("enteroc") & (F.col("value") >= 0)).join(types, "event_id")
    return rows.where("event_type <> 'signup'").select("event_id", "site")


@query("m05_baseline")
def m05(spark, d):
    rows = scored(spark, d).withColumns({"label": F.col("y").cast("double"), "t": F.col("toxic").cast("double")})
    out = models.baseline(["p", "p0", "t"], "label").fit(rows).transform(rows)
    return out.select("doc_id", F.col("prediction").cast("int").alias("prediction"))


@query("m06_undersampled_ensemble")
def m06(spark, d):
    rows = scored(spark, d).select("doc_id", "p", "p0", F.col("y").cast("int").alias("label"))
    fitted = models.undersampled_ensemble(rows, ["p", "p0"], "label", draws=12, trees=250)
    return models.ensemble_probability(fitted, rows, ["p", "p0"]).select("doc_id", F.round("probability", 4).alias("probability"))


@query("m18_refresh_candidates", f"WITH {SD}, c AS (SELECT site, arg_max(ratio, day) AS frozen FROM sd GROUP BY 1), n AS (SELECT l_suppkey AS site, AVG(l_quantity) AS fresh FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' GROUP BY 1) SELECT site, ROUND(COALESCE(fresh, frozen), 6) AS covariate, fresh IS NOT NULL AS refreshed FROM c LEFT JOIN n USING (site)")
def m18(spark, d):
    frozen = site_day(spark, d).groupBy("site").agg(F.max_by("ratio", "day").alias("frozen"))
    fresh = table(spark, d, "lineitem").where(F.col("l_shipdate") >= datetime(2001, 1, 1)).groupBy(F.col("l_suppkey").alias("site")).agg(F.avg("l_quantity").alias("fresh"))
    return frozen.join(fresh, "site", "left").select("site", F.round(F.coalesce("fresh", "frozen"), 6).alias("covariate"), F.col("fresh").isNotNull().alias("refreshed"))


@query("e01_lookup_against_model", f"WITH {SCORED} SELECT COUNT(*) AS n, ROUND(AVG((p - CAST(y AS INT)) ^ 2), 6) AS brier_p, ROUND(AVG((p0 - CAST(y AS INT)) ^ 2), 6) AS brier_p0 FROM sc")
def e01b(spark, d):
    """Head to head on the same rows."""
    y = F.col("y").cast("int")
    return scored(spark, d).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.pow(F.col("p") - y, 2)), 6).alias("brier_p"), F.round(F.avg(F.pow(F.col("p0") - y, 2)), 6).alias("brier_p0"))
