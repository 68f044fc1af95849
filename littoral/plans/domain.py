"""Scalar functions, metrics, models, serving, gates, sources and sinks."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from littoral import schemas, sinks
from littoral.functions import core
from littoral.operators import gates, metrics, models, serving
from littoral.plans.registry import ADV, OBS, SCORED, SD, advisories, observations, query, scored, shared_path, site_day, table
from littoral.session import cut
from littoral.sources import readers

NOW = datetime(2000, 6, 1)
NOW_SQL = "TIMESTAMP '2000-06-01 00:00:00'"

# --- scalar functions


@query("f_slug", "SELECT p_partkey, left(trim(regexp_replace(lower(concat_ws('-', p_name, p_brand, p_type)), '[^a-z0-9]+', '-', 'g'), '-'), 120) AS slug FROM part")
def f_slug(spark, d):
    return table(spark, d, "part").select("p_partkey", core.slug(F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("slug"))


@query("f_short_id", "SELECT o_orderkey, left(sha1(concat_ws('|', CAST(o_orderkey AS VARCHAR), o_orderstatus)), 12) AS id FROM orders")
def f_short_id(spark, d):
    return table(spark, d, "orders").select("o_orderkey", core.short_id(F.col("o_orderkey").cast("string"), F.col("o_orderstatus")).alias("id"))


@query("f_assay", f"WITH {OBS} SELECT event_id, threshold, ROUND(ratio, 6) AS ratio, exceeds, method LIKE '%pcr%' OR method LIKE '%cop%' AS molecular FROM obs")
def f_assay(spark, d):
    return observations(spark, d).select("event_id", "threshold", F.round("ratio", 6).alias("ratio"), "exceeds", core.is_molecular(F.col("method")).alias("molecular"))


@query("f_logistic", f"WITH {SCORED}, x AS (SELECT doc_id, LEAST(GREATEST(p, 1e-6), 1 - 1e-6) AS q FROM sc) SELECT doc_id, ROUND(ln(q / (1 - q)), 6) AS logit, ROUND(1 / (1 + exp(-ln(q / (1 - q)))), 6) AS back FROM x")
def f_logistic(spark, d):
    x = scored(spark, d).withColumn("l", core.logit(F.col("p")))
    return x.select("doc_id", F.round("l", 6).alias("logit"), F.round(core.expit(F.col("l")), 6).alias("back"))


@query("f_season", "SELECT o_orderkey, ROUND(sin(2 * pi() * dayofyear(o_orderdate) / 365.25::DOUBLE), 6) AS s, ROUND(cos(2 * pi() * dayofyear(o_orderdate) / 365.25::DOUBLE), 6) AS c, ROUND(cos(2 * pi() * (dayofyear(o_orderdate) - 15) / 365.25::DOUBLE), 6) AS w, ROUND(1.5 * cos(2 * pi() * fmod(CAST(CAST(o_orderdate AS DATE) - DATE '2000-01-06' AS DOUBLE) + 29.530588 * 100, 29.530588) / 29.530588), 5) AS tide FROM orders")
def f_season(spark, d):
    s, c = core.season(F.to_date("o_orderdate"))
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", F.round(s, 6).alias("s"), F.round(c, 6).alias("c"), F.round(core.winter(day), 6).alias("w"), F.round(core.lunar_tide(day), 5).alias("tide"))


@query("f_cutoff", "SELECT DISTINCT CAST(ts AS DATE) AS day, timezone('UTC', timezone('America/Los_Angeles', CAST(ts AS DATE) + INTERVAL 5 HOURS)) AS cutoff FROM events")
def f_cutoff(spark, d):
    return table(spark, d, "events").select(F.to_date("ts").alias("day")).distinct().select("day", core.local_cutoff_utc(F.col("day")).cast("timestamp_ntz").alias("cutoff"))


@query("f_bands", f"""WITH {SCORED} SELECT doc_id, CASE WHEN p < 0.2 THEN 'low' WHEN p < 0.5 THEN 'moderate' ELSE 'high' END AS band, ROUND(LEAST(GREATEST(0.5 + 0.4 * (p * 2 - 1), 0.03), 0.97), 6) AS derived,
 ROUND(CASE WHEN toxic = 1 THEN GREATEST(CASE WHEN y THEN GREATEST(p, 0.2) ELSE p END, 0.3) WHEN y THEN GREATEST(p, 0.2) ELSE p END, 6) AS floored FROM sc""")
def f_bands(spark, d):
    p = F.col("p")
    return scored(spark, d).select("doc_id", core.risk_band(p).alias("band"), F.round(core.persistence_estimate(p * 2), 6).alias("derived"), F.round(core.serve_probability(p, F.col("toxic") == 1, F.col("y")), 6).alias("floored"))


@query("f_knots", f"""WITH {SCORED} SELECT doc_id, ROUND(CASE WHEN p <= 0.1 THEN 0.05 WHEN p <= 0.4 THEN 0.05 + (p - 0.1) * 0.5 WHEN p <= 0.8 THEN 0.2 + (p - 0.4) * 1.25 ELSE 0.7 END, 6) AS q FROM sc""")
def f_knots(spark, d):
    return scored(spark, d).select("doc_id", F.round(core.through_knots(F.col("p"), [(0.1, 0.05), (0.4, 0.2), (0.8, 0.7)]), 6).alias("q"))


@query("f_strip_tags", r"""WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>', ' ', 'g') AS h FROM pages), b AS (SELECT page_id, regexp_replace(h, '<[^>]*>', ' ', 'g') AS h FROM a)
 SELECT page_id, length(trim(regexp_replace(replace(replace(replace(replace(replace(replace(h, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))) AS n FROM b""")
def f_strip_tags(spark, d):
    return table(spark, d, "pages").select("page_id", F.length(core.strip_tags(F.col("html"))).cast("long").alias("n"))


@query("f_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def f_json(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("f_compass_wind", """SELECT event_id, list_extract(['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW'], CAST(floor(fmod(value, 360) / 22.5 + 0.5) AS INT) % 16 + 1) AS point, ROUND(-2 * sin(radians(value)), 6) AS u, ROUND(-2 * cos(radians(value)), 6) AS v, ROUND(2 * cos(radians(value - 250)), 6) AS onshore FROM events""")
def f_compass_wind(spark, d):
    u, v = core.wind_parts(F.lit(2.0), F.col("value"))
    return table(spark, d, "events").select("event_id", core.compass(F.col("value")).alias("point"), F.round(u, 6).alias("u"), F.round(v, 6).alias("v"), F.round(core.onshore(F.lit(2.0), F.col("value"), F.lit(250.0)), 6).alias("onshore"))


@query("f_coerce", """WITH x AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'nan' WHEN 1 THEN ' 12.5 ' WHEN 2 THEN '' WHEN 3 THEN 'abc' ELSE CAST(o_totalprice AS VARCHAR) END AS t FROM orders) SELECT o_orderkey, TRY_CAST(CASE WHEN lower(trim(t)) IN ('nan', '') THEN NULL ELSE trim(t) END AS DOUBLE) AS v FROM x""")
def f_coerce(spark, d):
    k = F.col("o_orderkey") % 5
    t = F.when(k == 0, "nan").when(k == 1, " 12.5 ").when(k == 2, "").when(k == 3, "abc").otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", core.safe_float(t).alias("v"))


@query("f_spatial_context", """SELECT s_suppkey AS site, ROUND(((-120 + (s_suppkey * 91 % 1000) / 400.0::DOUBLE) + 119) * (pi() * 6371.0 / 180 * cos(radians(33))), 4) AS east, ROUND(((32 + (s_suppkey * 37 % 1000) / 400.0::DOUBLE) - 33) * (pi() * 6371.0 / 180), 4) AS north FROM supplier""")
def f_spatial_context(spark, d):
    from littoral.plans.registry import places

    e, n = core.local_km(F.col("lat"), F.col("lon"), 33, -119)
    return places(spark, d).select("site", F.round(e, 4).alias("east"), F.round(n, 4).alias("north"))


@query("f_lag_kernel", f"""WITH {SD}, x AS (SELECT site, day, value, COALESCE(LAG(value) OVER w, 0) AS a, COALESCE(LAG(value, 2) OVER w, 0) AS b FROM sd WINDOW w AS (PARTITION BY site ORDER BY day)) SELECT site, day, ROUND(value + a * pow(0.5, 1 / 2.0) + b * 0.5, 6) AS kernel, CAST(value >= 2.54 AS INT) AS tenth, CAST(value >= 5.08 AS INT) AS fifth FROM x""")
def f_lag_kernel(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("site").orderBy("day")
    tenth, fifth = core.rain_flags(F.col("value"))
    lags = [F.col("value"), F.lag("value").over(w), F.lag("value", 2).over(w)]
    return site_day(spark, d).select("site", "day", F.round(core.distributed_lag(lags, 2.0), 6).alias("kernel"), tenth.alias("tenth"), fifth.alias("fifth"))


@query("p17_censor_columns", f"WITH {SD} SELECT site, day, CASE WHEN exceeds THEN 0.0 ELSE value END AS value, CASE WHEN exceeds THEN 0.0 ELSE ratio END AS ratio FROM sd")
def p17(spark, d):
    sd = site_day(spark, d).select("site", "day", "exceeds", "value", "ratio")
    history = [c for c in sd.columns if c in ("value", "ratio")]
    return sd.withColumns({c: F.when(F.col("exceeds"), 0.0).otherwise(F.col(c)) for c in history}).drop("exceeds")


@query("p22_conform", "SELECT user_id AS site, CAST(NULL AS DATE) AS day, CAST(NULL AS BOOLEAN) AS exceeds, value, CAST(NULL AS DOUBLE) AS ratio FROM events")
def p22(spark, d):
    return schemas.conform(table(spark, d, "events").withColumnRenamed("user_id", "site"), schemas.SITE_DAY)


@query("p16_stale_rows", "SELECT o_orderkey FROM orders WHERE COALESCE(DATE '2001-01-01' - CAST(o_orderdate AS DATE) >= 365, FALSE)")
def p16(spark, d):
    age = F.datediff(F.lit("2001-01-01").cast("date"), "o_orderdate")
    return table(spark, d, "orders").where(F.coalesce(age >= 365, F.lit(False))).select("o_orderkey")


# --- metrics


@query("e01_ranking", f"""WITH {SCORED}, s AS (SELECT p, SUM(CAST(y AS INT)) pos, SUM(CAST(NOT y AS INT)) neg FROM sc GROUP BY 1), c AS (SELECT *, SUM(pos) OVER (ORDER BY p DESC) tp, SUM(neg) OVER (ORDER BY p DESC) fp, SUM(pos) OVER () P_, SUM(neg) OVER () N_ FROM s)
 SELECT CAST(ANY_VALUE(P_ + N_) AS BIGINT) AS n, CAST(ANY_VALUE(P_) AS BIGINT) AS positives, ROUND(SUM(pos * (N_ - fp + neg / 2.0::DOUBLE)) / ANY_VALUE(P_ * N_), 6) AS auroc, ROUND(SUM(pos * tp / (tp + fp)::DOUBLE) / ANY_VALUE(P_), 6) AS average_precision FROM c""")
def e01(spark, d):
    r = metrics.ranking(scored(spark, d), "p", "y")
    return r.select("n", "positives", F.round("auroc", 6).alias("auroc"), F.round("average_precision", 6).alias("average_precision"))


_LOSS = "COUNT(*) AS n, ROUND(AVG((p - CAST(y AS INT)) ^ 2), 6) AS brier, ROUND(AVG(-(CAST(y AS INT) * ln(LEAST(GREATEST(p, 1e-6), 1 - 1e-6)) + (1 - CAST(y AS INT)) * ln(1 - LEAST(GREATEST(p, 1e-6), 1 - 1e-6)))), 6) AS log_loss, ROUND(sqrt(AVG((p - CAST(y AS INT)) ^ 2)), 6) AS rmse"


@query("e07_losses_by_source", f"WITH {SCORED} SELECT source, {_LOSS} FROM sc GROUP BY 1")
def e07(spark, d):
    r = metrics.losses(scored(spark, d).withColumn("y", F.col("y").cast("int")), "p", "y", ["source"])
    return r.select("source", "n", *[F.round(c, 6).alias(c) for c in ("brier", "log_loss", "rmse")])


_AUC = f"""WITH {SCORED}, s AS (SELECT source, p, SUM(CAST(y AS INT)) pos, SUM(CAST(NOT y AS INT)) neg FROM sc GROUP BY 1, 2), c AS (SELECT *, SUM(neg) OVER (PARTITION BY source ORDER BY p DESC) fp, SUM(pos) OVER (PARTITION BY source) P_, SUM(neg) OVER (PARTITION BY source) N_ FROM s),
 a AS (SELECT source, ANY_VALUE(P_) P_, ANY_VALUE(N_) N_, SUM(pos * (N_ - fp + neg / 2.0::DOUBLE)) / ANY_VALUE(P_ * N_) auc FROM c WHERE P_ > 0 AND N_ > 0 GROUP BY 1) """


@query("e02_within_group_pairs", _AUC + "SELECT COUNT(*) AS groups, ROUND(SUM(auc * P_ * N_) / SUM(P_ * N_), 6) AS within_auroc FROM a")
def e02(spark, d):
    return metrics.within_group_auroc(scored(spark, d), "p", "y", "source").select("groups", F.round("within_auroc", 6).alias("within_auroc"))


@query("e02_within_group_rows", _AUC + "SELECT COUNT(*) AS groups, ROUND(SUM(auc * (P_ + N_)) / SUM(P_ + N_), 6) AS within_auroc FROM a WHERE P_ + N_ >= 5")
def e02b(spark, d):
    return metrics.within_group_auroc(scored(spark, d), "p", "y", "source", 5, "rows").select("groups", F.round("within_auroc", 6).alias("within_auroc"))


_CUM = f"WITH {SCORED}, s AS (SELECT p, SUM(CAST(y AS INT)) pos, SUM(CAST(NOT y AS INT)) neg FROM sc GROUP BY 1), c AS (SELECT SUM(pos) OVER (ORDER BY p DESC) tp, SUM(neg) OVER (ORDER BY p DESC) fp, SUM(pos) OVER () P_, SUM(neg) OVER () N_ FROM s) "


@query("e04_sensitivity", _CUM + "SELECT ROUND(COALESCE(MAX(tp / P_::DOUBLE) FILTER (1 - fp / N_::DOUBLE >= 0.87), 0), 6) AS sensitivity FROM c")
def e04(spark, d):
    return metrics.sensitivity_at(scored(spark, d), "p", "y").select(F.round("sensitivity", 6).alias("sensitivity"))


@query("e05_precision", _CUM + "SELECT ROUND(MAX(tp / (tp + fp)::DOUBLE) FILTER (tp >= 0.8 * P_), 6) AS precision FROM c")
def e05(spark, d):
    return metrics.precision_at(scored(spark, d), "p", "y").select(F.round("precision", 6).alias("precision"))


@query("e06_bootstrap")
def e06(spark, d):
    found = metrics.bootstrap_pair(scored(spark, d), "source", "p", "p0", "y")
    return found.select("metric", "side", "replicates", *[F.round(c, 6).alias(c) for c in ("low", "low_90", "mid", "high_90", "high")])


@query("a22_brier_diagnostics", f"""WITH {SCORED}, x AS (SELECT *, CAST(y AS INT) z FROM sc) SELECT source, lang, COUNT(*) AS n, CAST(SUM(z) AS BIGINT) AS positives, ROUND(AVG(p) - AVG(z), 6) AS bias, ROUND(AVG((p - z) ^ 2), 6) AS brier, ROUND(AVG((p - z) ^ 2) - AVG((p0 - z) ^ 2), 6) AS delta FROM x GROUP BY 1, 2""")
def a22(spark, d):
    r = metrics.brier_diagnostics(scored(spark, d), "p", "p0", "y", ["source", "lang"])
    return r.select("source", "lang", "n", "positives", *[F.round(c, 6).alias(c) for c in ("bias", "brier", "delta")])


@query("a23_reliability", f"WITH {SCORED} SELECT LEAST(CAST(floor(p * 10) AS INT), 9) AS bin, COUNT(*) AS n, ROUND(AVG(p), 6) AS mean_forecast, ROUND(AVG(CAST(y AS INT)), 6) AS observed FROM sc GROUP BY 1")
def a23(spark, d):
    return metrics.reliability(scored(spark, d), "p", "y").select("bin", "n", F.round("mean_forecast", 6).alias("mean_forecast"), F.round("observed", 6).alias("observed"))


@query("a24_confusion", f"WITH {SCORED} SELECT lang, COUNT(*) FILTER (p >= 0.5 AND y) AS tp, COUNT(*) FILTER (p >= 0.5 AND NOT y) AS fp, COUNT(*) FILTER (p < 0.5 AND y) AS fn, COUNT(*) FILTER (p < 0.5 AND NOT y) AS tn FROM sc GROUP BY 1")
def a24(spark, d):
    return metrics.confusion(scored(spark, d), F.col("p") >= 0.5, F.col("y"), ["lang"])


@query("a28_slices", f"WITH {SCORED}, t AS (SELECT 'all' AS slice, * FROM sc UNION ALL SELECT 'toxic', * FROM sc WHERE toxic = 1 UNION ALL SELECT 'english', * FROM sc WHERE lang = 'en') SELECT slice, {_LOSS} FROM t GROUP BY 1")
def a28(spark, d):
    named = {"all": F.lit(True), "toxic": F.col("toxic") == 1, "english": F.col("lang") == "en"}
    r = metrics.slices(scored(spark, d).withColumn("y", F.col("y").cast("int")), named, "p", "y")
    return r.select("slice", "n", *[F.round(c, 6).alias(c) for c in ("brier", "log_loss", "rmse")])


# --- models


@query("m01_offset_logit")
def m01(spark, d):
    rows = scored(spark, d).withColumns({"offset": core.logit(F.col("p0"), 0.05), "x": F.col("p"), "t": F.col("toxic").cast("double")})
    model = models.OffsetLogit(["x", "t"], "offset").fit(rows, "y")
    return rows.select("doc_id", F.round(model.probability(), 5).alias("probability"))


@query("m03_isotonic", f"""WITH {SCORED}, per AS (SELECT ROUND(p, 4) AS s, AVG(CAST(y AS INT)) AS m, COUNT(*) AS n FROM sc GROUP BY 1), ix AS (SELECT s, m, n, row_number() OVER (ORDER BY s) AS i, SUM(m * n) OVER (ORDER BY s) AS cy, SUM(n) OVER (ORDER BY s) AS cn FROM per),
 b AS (SELECT j.i AS j, k.i AS k, (k.cy - j.cy + j.m * j.n) / (k.cn - j.cn + j.n) AS a FROM ix j JOIN ix k ON k.i >= j.i), lo AS (SELECT j, k, MIN(a) OVER (PARTITION BY j ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a FROM b), f AS (SELECT ix.s, MAX(lo.a) AS f FROM ix JOIN lo ON lo.j <= ix.i AND lo.k = ix.i GROUP BY 1),
 t AS (SELECT MAX(f) AS top FROM f), st AS (SELECT MIN(s) AS start, ANY_VALUE(top) AS top FROM f, t WHERE f >= top - 1e-9), c AS (SELECT COUNT(*) AS n FROM sc, st WHERE p >= start), low AS (SELECT COALESCE((SELECT MAX(f) FROM f, t WHERE f < top - 1e-9), (SELECT top FROM t)) AS below)
 SELECT doc_id, ROUND(CASE WHEN c.n < 20 THEN LEAST(f.f, below) ELSE f.f END, 5) AS calibrated FROM sc JOIN f ON f.s = ROUND(sc.p, 4), c, low""")
def m03(spark, d):
    rows = scored(spark, d)
    knots = models.isotonic_knots(rows, "p", "y", 20)
    return rows.select("doc_id", F.round(models.calibrated(F.col("p"), knots), 5).alias("calibrated"))


@query("m04_group_calibration")
def m04(spark, d):
    return models.group_calibration(scored(spark, d), "p", "y", ["lang", "source"]).select("doc_id", F.round("calibrated", 5).alias("calibrated"))


@query("m09_residual", f"WITH {SCORED}, r AS (SELECT source, CASE WHEN COUNT(*) >= 10 THEN LEAST(GREATEST(AVG(CAST(y AS INT) - p), -0.3), 0.3) ELSE 0 END AS m FROM sc GROUP BY 1) SELECT doc_id, ROUND(LEAST(GREATEST(p + m, 0.001), 0.999), 5) AS corrected FROM sc JOIN r USING (source)")
def m09(spark, d):
    return models.residual_correction(scored(spark, d), "source", "p", "y", 10).select("doc_id", F.round("corrected", 5).alias("corrected"))


@query("m11_coastal_cells")
def m11(spark, d):
    from littoral.plans.registry import places

    return models.coastal_cells(places(spark, d), "site", 4)


@query("m12_alpha_sweep", f"WITH {SCORED}, a AS (SELECT i / 10.0::DOUBLE AS alpha FROM range(11) t(i)) SELECT alpha, ROUND(AVG((p * alpha + p0 * (1 - alpha) - CAST(y AS INT)) ^ 2), 6) AS brier FROM sc, a GROUP BY 1")
def m12(spark, d):
    return models.alpha_sweep(scored(spark, d), "p", "p0", "y").select("alpha", F.round("brier", 6).alias("brier"))


@query("m13_blocked_split", f"WITH {SD}, r AS (SELECT day, (row_number() OVER (ORDER BY day) - 1) / (COUNT(*) OVER ())::DOUBLE AS pl FROM (SELECT DISTINCT day FROM sd)) SELECT site, day, CASE WHEN pl < 0.7 THEN 'train' WHEN pl < 0.85 THEN 'validation' ELSE 'test' END AS part FROM sd JOIN r USING (day)")
def m13(spark, d):
    return models.blocked_split(site_day(spark, d), "day").select("site", "day", "part")


@query("m14_leave_one_out", f"WITH {OBS}, per AS (SELECT method, COUNT(*) n, SUM(CAST(exceeds AS INT)) pos FROM obs GROUP BY 1), w AS (SELECT SUM(n) N_, SUM(pos) P_ FROM per) SELECT method, CAST(n AS BIGINT) n, CAST(pos AS BIGINT) pos, ROUND((P_ - pos + 2.5) / (N_ - n + 5), 6) AS held_out_rate FROM per, w")
def m14(spark, d):
    return models.leave_one_group_out(observations(spark, d), "method", "exceeds").select("method", "n", "pos", F.round("held_out_rate", 6).alias("held_out_rate"))


@query("m15_stratified_part", f"WITH {SCORED}, n AS (SELECT lang, COUNT(*) AS n, CAST(ceil(COUNT(*) * 0.2::DOUBLE) AS BIGINT) AS k FROM sc GROUP BY 1) SELECT lang, 'calibration' AS part, k AS n FROM n UNION ALL SELECT lang, 'fit', n - k FROM n WHERE n > k")
def m15(spark, d):
    r = models.stratified_part(scored(spark, d), ["lang"], "doc_id")
    return r.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"))


@query("m16_conformal", f"WITH {SCORED}, r AS (SELECT abs(CAST(y AS INT) - p) AS r FROM sc), k AS (SELECT r, row_number() OVER (ORDER BY r) AS i, COUNT(*) OVER () AS n FROM r) SELECT ROUND(MIN(r) FILTER (i >= ceil(0.9::DOUBLE * (n - 1)) + 1), 6) AS half_width FROM k")
def m16(spark, d):
    rows = scored(spark, d).withColumn("r", F.col("y").cast("int") - F.col("p"))
    return models.conformal_half_width(rows, "r").select(F.round("half_width", 6).alias("half_width"))


@query("m19_router", f"WITH {SD}, x AS (SELECT site, day, ratio, day - LAG(day) OVER (PARTITION BY site ORDER BY day) AS age FROM sd), w AS (SELECT site, day, ratio, CASE WHEN age IS NULL THEN 1.0 ELSE LEAST(GREATEST((age - 3) / 2.0::DOUBLE, 0), 1) END AS w FROM x) SELECT site, day, ROUND(ratio * (1 - w) + 0.1 * w, 6) AS routed FROM w")
def m19(spark, d):
    from pyspark.sql import Window

    age = F.datediff("day", F.lag("day").over(Window.partitionBy("site").orderBy("day")))
    rows = site_day(spark, d).withColumn("w", core.route_weight(age))
    return rows.select("site", "day", F.round(models.routed(F.col("ratio"), F.lit(0.1), F.col("w")), 6).alias("routed"))


@query("m20_drivers", f"WITH {SCORED} SELECT doc_id, array_to_string(list_transform(list_sort([{{'m': -abs(p * 1.5), 'n': 'p'}}, {{'m': -abs(p0 * -1.0), 'n': 'p0'}}, {{'m': -abs(toxic * 0.5::DOUBLE), 'n': 't'}}])[1:2], lambda x: x.n), ',') AS drivers FROM sc")
def m20(spark, d):
    return scored(spark, d).withColumn("t", F.col("toxic").cast("double")).select("doc_id", F.array_join(models.drivers({"p": 1.5, "p0": -1.0, "t": 0.5}, 2), ",").alias("drivers"))


@query("m24_walk_forward", """WITH per AS (SELECT o_orderpriority k, year(o_orderdate) * 12 + month(o_orderdate) m, COUNT(*) n, SUM(CAST(o_orderstatus = 'F' AS INT)) pos FROM orders GROUP BY 1, 2), pool AS (SELECT m, SUM(n) N_, SUM(pos) P_ FROM per GROUP BY 1), g AS (SELECT a.m, SUM(b.P_) / SUM(b.N_)::DOUBLE g FROM pool a JOIN pool b ON b.m < a.m AND b.m >= a.m - 48 GROUP BY 1),
 f AS (SELECT a.k, a.m, ANY_VALUE(a.n) n, ANY_VALUE(a.pos) pos, COALESCE(SUM(b.n), 0) fn, COALESCE(SUM(b.pos), 0) fp FROM per a LEFT JOIN per b ON a.k = b.k AND b.m < a.m AND b.m >= a.m - 48 GROUP BY 1, 2), q AS (SELECT f.*, (fp + 5 * g) / (fn + 5) p FROM f JOIN g USING (m))
 SELECT k AS o_orderpriority, CAST(m AS INTEGER) AS m, CAST(n AS BIGINT) n, ROUND(p, 6) AS p, ROUND((pos * (1 - p) ^ 2 + (n - pos) * p ^ 2) / n, 6) AS brier FROM q""")
def m24(spark, d):
    o = table(spark, d, "orders").withColumn("y", F.col("o_orderstatus") == "F")
    return models.walk_forward(o, "o_orderdate", "o_orderpriority", "y").select("o_orderpriority", "m", "n", F.round("p", 6).alias("p"), F.round("brier", 6).alias("brier"))


# --- serving


@query("p11_active_now", f"WITH {ADV} SELECT advisory FROM adv WHERE status = 'active' AND NOT COALESCE(ended <= {NOW_SQL}, FALSE) AND (kind = 'closure' OR started IS NULL OR started >= {NOW_SQL} - INTERVAL 7 DAYS)")
def p11(spark, d):
    return advisories(spark, d).where(serving.active_now(F.lit(NOW))).select("advisory")


@query("p12_zombies", f"WITH {ADV} SELECT advisory, CASE WHEN status = 'active' AND started < {NOW_SQL} - INTERVAL 14 DAYS AND kind NOT LIKE '%chronic%' THEN 'historical' ELSE status END AS status FROM adv")
def p12(spark, d):
    rows = advisories(spark, d).withColumn("last_seen", F.lit(None).cast("timestamp_ntz"))
    return serving.expire_zombies(rows, F.lit(NOW)).select("advisory", "status")


@query("p13_effective_end", f"WITH {ADV} SELECT advisory, COALESCE(ended, started + INTERVAL 14 DAYS) AS until FROM adv")
def p13(spark, d):
    return advisories(spark, d).select("advisory", core.effective_end(F.col("started"), F.col("ended")).alias("until"))


@query("p14_active_on", f"WITH {ADV} SELECT advisory FROM adv WHERE CAST(started AS DATE) <= DATE '1999-06-01' AND CAST(COALESCE(ended, started + INTERVAL 14 DAYS) AS DATE) >= DATE '1999-06-01'")
def p14(spark, d):
    return serving.active_on(advisories(spark, d), F.lit("1999-06-01").cast("date"), core.effective_end(F.col("started"), F.col("ended"))).select("advisory")


@query("p15_posted_sites", f"WITH {ADV} SELECT DISTINCT site FROM adv WHERE status = 'active' AND CAST(started AS DATE) <= DATE '1996-01-01'")
def p15(spark, d):
    return serving.posted_sites(advisories(spark, d), "site", F.lit("1996-01-01").cast("date"))


@query("v01_parent_cards", """WITH m AS (SELECT s_nationkey AS parent, s_suppkey AS site, ROUND((s_suppkey * 7 % 100) / 100.0::DOUBLE, 2) AS p, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS url FROM supplier)
 SELECT parent, COUNT(*) AS members, arg_max(site, ROW(p, -site)) AS worst, MAX(p) AS p_worst, CASE WHEN MAX(p) < 0.2 THEN 'low' WHEN MAX(p) < 0.5 THEN 'moderate' ELSE 'high' END AS band, COALESCE(string_agg(CAST(site AS VARCHAR), ',' ORDER BY site) FILTER (p >= 0.5), '') AS flagged, arg_min(url, site) FILTER (url IS NOT NULL) AS url FROM m GROUP BY 1""")
def v01(spark, d):
    k = F.col("s_suppkey")
    m = table(spark, d, "supplier").select(F.col("s_nationkey").alias("parent"), k.alias("site"), F.round((k * 7 % 100) / 100.0, 2).alias("p"), F.when(k % 2 == 0, F.col("s_name")).alias("url"))
    r = serving.parent_cards(m, "parent", "site", "p", F.col("p") >= 0.5, "url")
    return r.withColumn("flagged", F.array_join(F.transform("flagged", lambda x: x.cast("string")), ","))


@query("v03_forecast_for_day", f"""WITH {OBS}, f AS (SELECT site, day, ts AS issued, value FROM obs WHERE method = 'view') SELECT site, day, value, day <> DATE '2024-01-20' AS fallback, issued < TIMESTAMP '2024-01-21 00:00:00' - INTERVAL 48 HOURS AS late FROM f QUALIFY row_number() OVER (PARTITION BY site ORDER BY (day = DATE '2024-01-20') DESC, day DESC, issued DESC) = 1""")
def v03(spark, d):
    f = observations(spark, d).where("method = 'view'").select("site", "day", F.col("ts").alias("issued"), "value")
    r = serving.forecast_for(f, "site", "day", F.lit("2024-01-20").cast("date"), F.lit(datetime(2024, 1, 21)))
    return r.select("site", "day", "value", "fallback", "late")


@query("k03_last_issue", f"WITH {OBS} SELECT site, day, event_id FROM obs QUALIFY row_number() OVER (PARTITION BY site, day ORDER BY ts DESC, event_id DESC) = 1")
def k03(spark, d):
    o = observations(spark, d)
    path = shared_path(spark, "log")
    sinks.append_log(o, path)
    sinks.append_log(o.where("event_id % 2 = 0"), path)  # a repeated append changes nothing
    return sinks.read_log(spark, path, ["site", "day"], "ts").select("site", "day", "event_id")


@query("v04_served", f"""WITH {SD}, x AS (SELECT site, day, ratio, exceeds, LAG(exceeds) OVER (PARTITION BY site ORDER BY day) AS last_x FROM sd), q AS (SELECT *, LEAST(GREATEST(0.5 + 0.4 * (ratio - 1), 0.03), 0.97) AS p FROM x), f AS (SELECT site, day, CASE WHEN exceeds THEN GREATEST(CASE WHEN last_x THEN GREATEST(p, 0.2) ELSE p END, 0.3) WHEN last_x THEN GREATEST(p, 0.2) ELSE p END AS s FROM q)
 SELECT site, day, ROUND(s, 6) AS p_served, CASE WHEN s < 0.2 THEN 'low' WHEN s < 0.5 THEN 'moderate' ELSE 'high' END AS band FROM f""")
def v04(spark, d):
    from pyspark.sql import Window

    rows = site_day(spark, d).withColumn("last_x", F.lag("exceeds").over(Window.partitionBy("site").orderBy("day")))
    r = serving.served(rows, F.lit(None).cast("double"), F.col("exceeds"), F.col("last_x"), F.col("ratio"))
    return r.select("site", "day", F.round("p_served", 6).alias("p_served"), "band")


@query("v05_documents", f"""WITH {OBS}, t AS (SELECT site, event_id, row_number() OVER (PARTITION BY site ORDER BY ts DESC, event_id) AS position FROM obs) SELECT site, COUNT(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY position) AS ids FROM t WHERE position <= 10 GROUP BY 1""")
def v05(spark, d):
    o = observations(spark, d)
    part = serving.newest_per(o, ["site"], [F.desc("ts"), F.asc("event_id")], 10).select("site", "position", "event_id", "value")
    docs = serving.snapshot_entities(o.select("site").distinct(), {"observations": part}, "site")
    ids = F.from_json("document", "observations array<struct<event_id:long>>")["observations"]["event_id"]
    return docs.select("site", F.size(ids).cast("long").alias("n"), F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ids"))


@query("v08_latest_urls", f"WITH {ADV} SELECT site, COUNT(*) AS active, arg_max(url, ROW(started, advisory)) FILTER (url IS NOT NULL) AS url FROM adv WHERE status = 'active' GROUP BY 1")
def v08(spark, d):
    return serving.latest_urls(advisories(spark, d), "site", F.col("status") == "active", "advisory")


@query("v09_explanation", f"WITH {SCORED} SELECT doc_id, CASE WHEN p < 0.2 THEN 'Low' WHEN p < 0.5 THEN 'Moderate' ELSE 'High' END || ' risk: about ' || CAST(CAST(ROUND(p * 100) AS INT) AS VARCHAR) || ' in 100 (' || CAST(toxic AS VARCHAR) || ' samples in the past year)' AS text FROM sc")
def v09(spark, d):
    p = F.col("p")
    return scored(spark, d).select("doc_id", serving.explanation(p, core.risk_band(p), F.col("toxic")).alias("text"))


@query("f_closures_feed", f"WITH {ADV} SELECT advisory, s_name, left(sha1(concat_ws('|', CAST(site AS VARCHAR), kind, strftime(started, '%Y-%m-%d'))), 12) AS closure_id FROM adv JOIN supplier ON site = s_suppkey WHERE kind = 'closure' AND status = 'active'")
def closures(spark, d):
    pl = table(spark, d, "supplier").select(F.col("s_suppkey").alias("site"), "s_name")
    return serving.closures_feed(advisories(spark, d), pl, "site", (F.col("kind") == "closure") & (F.col("status") == "active")).select("advisory", "s_name", "closure_id")


# --- gates


@query("q02_null_profile", f"WITH {ADV} SELECT 'ended' AS column_name, COUNT(*) AS rows, COUNT(ended) AS filled, COUNT(ended) = 0 AS all_null FROM adv UNION ALL SELECT 'url', COUNT(*), COUNT(url), COUNT(url) = 0 FROM adv")
def q02(spark, d):
    return schemas.null_profile(advisories(spark, d), ["ended", "url"]).select("column_name", "rows", "filled", "all_null")


@query("q03_suspicious", "SELECT 'empty' AS column_name")
def q03(spark, d):
    p = schemas.null_profile(advisories(spark, d).withColumn("empty", F.lit(None).cast("double")), ["started", "url", "empty"])
    return schemas.suspicious_columns(p).select("column_name")


@query("q04_validity", f"WITH {SCORED} SELECT COUNT(*) AS rows, COUNT(*) FILTER (p < 0 OR p > 1) AS out_of_range, COUNT(DISTINCT p) AS levels, COUNT(*) >= 50 AND COUNT(DISTINCT p) > 1 AND COUNT(*) FILTER (p < 0 OR p > 1) = 0 AS valid FROM sc")
def q04(spark, d):
    f = scored(spark, d).withColumn("issued", F.lit(datetime(2024, 1, 1)))
    return gates.forecast_validity(f, "p", "issued", F.lit(datetime(2024, 1, 2))).select("rows", "out_of_range", "levels", "valid")


@query("q05_anomaly", f"WITH {SCORED} SELECT ROUND(AVG(p) / AVG(p0), 6) AS ratio FROM sc")
def q05(spark, d):
    s = scored(spark, d)
    now, before = (s.select(F.col(c).alias("p"), core.risk_band(F.col(c)).alias("band")) for c in ("p", "p0"))
    return gates.anomaly(now, before, "p", "band").select(F.round("ratio", 6).alias("ratio"))


@query("q07_resolution", "SELECT DISTINCT o_custkey FROM orders a WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1998-01-01')")
def q07(spark, d):
    o = table(spark, d, "orders").withColumn("ok", F.col("o_orderstatus") == "F")
    cut = datetime(1998, 1, 1)
    return gates.resolution_regression(o.where(F.col("o_orderdate") >= cut), o.where(F.col("o_orderdate") < cut), "o_custkey", "ok").distinct()


@query("q10_scraper_health", """WITH r AS (SELECT event_type, CAST(ts AS DATE) AS day, bool_and(value < 300) AS ok FROM events GROUP BY 1, 2) SELECT event_type, COUNT(*) AS days_run, CAST(MAX(day) - MIN(day) + 1 - COUNT(*) AS BIGINT) AS days_missed, COUNT(*) FILTER (NOT ok) AS days_failed, CAST(DATE '2024-01-30' - COALESCE(MAX(day) FILTER (NOT ok), MIN(day) - 1) AS BIGINT) AS clean_streak FROM r GROUP BY 1""")
def q10(spark, d):
    runs = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), (F.col("value") < 300).alias("ok"))
    return gates.scraper_health(runs, "event_type", "day", "ok", "2024-01-30").select("event_type", "days_run", "days_missed", "days_failed", "clean_streak")


@query("q11_served_freshness", "SELECT MAX(ts) FILTER (event_type = 'view') AS served, MAX(ts) AS committed FROM events")
def q11(spark, d):
    e = table(spark, d, "events")
    return gates.served_freshness(e.where("event_type = 'view'"), e, "ts").select("served", "committed")


# --- sources and sinks


@query("s01_csv_text", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def s01(spark, d):
    path = shared_path(spark, "csv")
    table(spark, d, "supplier").select("s_suppkey", "s_name").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, ["s_suppkey", "s_name"])


@query("s02_csv_since", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def s02(spark, d):
    path = shared_path(spark, "csv")
    table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).write.option("header", True).csv(path)
    return readers.read_csv_since(spark, path, "day", "2000-01-01", names=["o_orderkey", "day"]).select("o_orderkey")


@query("s04_missing_table", "SELECT COUNT(*) FILTER (FALSE) AS n FROM region")
def s04(spark, d):
    return readers.read_parquet_or_empty(spark, f"{d}/no_such_table.parquet", schemas.SITE_DAY).agg(F.count(F.lit(1)).alias("n"))


@query("s05_pruned_scan", "SELECT l_orderkey, l_quantity, CAST(NULL AS VARCHAR) AS note FROM lineitem WHERE l_suppkey = 7")
def s05(spark, d):
    return readers.read_parquet_where(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_quantity", "note"], "l_suppkey", 7)


@query("s11_json_records", "SELECT n_nationkey, n_name FROM nation")
def s11(spark, d):
    path = shared_path(spark, "json")
    whole = table(spark, d, "nation").agg(F.to_json(F.struct(F.collect_list(F.struct("n_nationkey", "n_name")).alias("results"))).alias("value"))
    whole.coalesce(1).write.text(path)
    return readers.read_json_records(spark, path, "struct<n_nationkey:int,n_name:string>")


@query("s12_html_rows", "SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_brand AS brand FROM part")
def s12(spark, d):
    row = F.concat(F.lit("<tr><td> "), F.col("p_partkey").cast("string"), F.lit("</td><TD><b>"), F.col("p_name"), F.lit("</b></TD><td>&nbsp;"), F.col("p_brand"), F.lit("</td></tr><tr><td>short</td></tr>"))
    return readers.html_rows(table(spark, d, "part").select(row.alias("html")), "html", ["code", "name", "brand"])


@query("s13_gauge_series", "SELECT CAST(user_id AS VARCHAR) AS gage, CASE WHEN event_id % 9 <> 0 THEN value END AS discharge, event_type = 'error' AS provisional FROM events")
def s13(spark, d):
    v = F.struct(F.when(F.col("event_id") % 9 == 0, "-999999").otherwise(F.col("value").cast("string")).alias("value"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("dateTime"), F.when(F.col("event_type") == "error", F.array(F.lit("P"))).otherwise(F.array(F.lit("A"))).alias("qualifiers"))
    per = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(v).alias("v"))
    series = F.struct(F.struct(F.array(F.struct(F.col("user_id").cast("string").alias("value"))).alias("siteCode")).alias("sourceInfo"), F.array(F.struct(F.col("v").alias("value"))).alias("values"))
    raw = per.select(F.to_json(F.struct(F.struct(F.array(series).alias("timeSeries")).alias("value"))).alias("value"))
    return readers.gauge_series(raw).select("gage", "discharge", "provisional")


@query("s15_hourly_archive", "SELECT user_id, date_trunc('minute', ts) AS time, value AS rain FROM events")
def s15(spark, d):
    per = table(spark, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("t"), "value"))).alias("x"))
    j = F.to_json(F.struct(F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.struct(F.transform("x", lambda r: r["t"]).alias("time"), F.transform("x", lambda r: r["value"]).alias("rain")).alias("hourly")))
    return readers.hourly_archive(per.select("user_id", j.alias("j")), "user_id", "j", ["rain"]).select("user_id", F.col("time").cast("timestamp_ntz").alias("time"), "rain")


@query("s20_spaced_text", "SELECT CAST(s_suppkey AS VARCHAR) AS station, CAST(s_nationkey AS VARCHAR) AS height FROM supplier")
def s20(spark, d):
    lines = table(spark, d, "supplier").select(F.explode(F.array(F.lit("# station height"), F.concat_ws("   ", "s_suppkey", "s_nationkey"), F.lit("short"))).alias("line"))
    return readers.spaced_rows(lines, "line", ["station", "height"])


@query("s23_geojson", "SELECT s_name AS name, CAST(s_suppkey AS DOUBLE) AS latitude, CAST(-s_suppkey AS DOUBLE) AS longitude FROM supplier")
def s23(spark, d):
    k = F.col("s_suppkey").cast("double")
    feature = F.struct(F.struct(F.col("s_name").alias("name")).alias("properties"), F.struct(F.lit("LineString").alias("type"), F.array(F.array(-k - 1, k - 1), F.array(-k + 1, k + 1)).alias("coordinates")).alias("geometry"))
    raw = table(spark, d, "supplier").select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("j"))
    return readers.geojson_features(raw, "j", "name:string")


@query("s25_kml", "SELECT s_name AS name, 'red' AS style, CAST(s_suppkey AS DOUBLE) AS latitude FROM supplier")
def s25(spark, d):
    k = F.col("s_suppkey").cast("string")
    doc = F.concat(F.lit("<kml><Placemark><name><![CDATA["), F.col("s_name"), F.lit("]]></name><styleUrl>#red</styleUrl><Point><coordinates> -1.5,"), k, F.lit(",0 </coordinates></Point></Placemark></kml>"))
    return readers.kml_placemarks(table(spark, d, "supplier").select(doc.alias("x")), "x").select("name", "style", "latitude")


@query("s25i_latest_above", f"WITH {OBS}, n AS (SELECT * FROM obs WHERE method IN ('view', 'error') QUALIFY row_number() OVER (PARTITION BY site, method ORDER BY day DESC, event_id DESC) = 1) SELECT site, method, value FROM n WHERE value >= CASE method WHEN 'view' THEN 20 ELSE 40 END QUALIFY row_number() OVER (PARTITION BY site ORDER BY method) = 1")
def s25i(spark, d):
    o = observations(spark, d).where(F.col("method").isin("view", "error"))
    return readers.latest_above(o, "site", "method", "day", "value", {"view": 20.0, "error": 40.0}, "event_id").select("site", "method", "value")


@query("s25o_open_notices", "SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'Posting' ELSE o_orderpriority END AS kind FROM orders WHERE o_orderstatus = 'O'")
def s25o(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "Rain").otherwise(F.col("o_orderpriority")).alias("kind"), F.when(F.col("o_orderstatus") != "O", "1999-01-01").otherwise(" ").alias("closed"))
    return readers.open_notices(rows, "closed", "kind").select("o_orderkey", "kind")


@query("k05_create_table", "SELECT s_suppkey, s_acctbal FROM supplier")
def k05(spark, d):
    sinks.create_table(table(spark, d, "supplier").select("s_suppkey", "s_acctbal"), "littoral_stations")
    return spark.table("littoral_stations")


@query("k06_strict_json", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '{\"v\":null}' ELSE '{\"v\":1.5}' END AS j FROM events")
def k06(spark, d):
    v = F.when(F.col("event_id") % 4 == 0, float("nan")).otherwise(1.5)
    return sinks.finite_columns(table(spark, d, "events").select("event_id", v.alias("v"))).select("event_id", sinks.strict_json("v").alias("j"))


@query("k07_documents_by_bucket", "SELECT s_suppkey, s_nationkey % 4 AS bucket FROM supplier")
def k07(spark, d):
    path = shared_path(spark, "documents")
    sinks.write_documents(table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 4).alias("bucket")), path, "bucket")
    return spark.read.schema("s_suppkey long, bucket int").json(path)


@query("k08_conditions", f"WITH {SD}, l AS (SELECT site, arg_max(ratio, day) AS ratio FROM sd GROUP BY 1), a AS (SELECT o_custkey AS site, COUNT(*) AS posted FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) SELECT site, GREATEST(CASE WHEN ratio < 0.2 THEN 0 WHEN ratio < 0.5 THEN 1 ELSE 2 END, CASE WHEN posted > 3 THEN 2 WHEN posted > 0 THEN 1 ELSE 0 END) AS severity FROM l LEFT JOIN a USING (site)")
def k08(spark, d):
    latest = site_day(spark, d).groupBy("site").agg(F.max_by("ratio", "day").alias("ratio"))
    posted = table(spark, d, "orders").where("o_orderstatus = 'O'").groupBy(F.col("o_custkey").alias("site")).agg(F.count(F.lit(1)).alias("posted"))
    band = F.when(F.col("ratio") < 0.2, 0).when(F.col("ratio") < 0.5, 1).otherwise(2)
    return latest.join(posted, "site", "left").select("site", F.greatest(band, F.when(F.col("posted") > 3, 2).when(F.col("posted") > 0, 1).otherwise(0)).alias("severity"))


# --- plug-ins


@query("x02_feature_builders", f"WITH {SD} SELECT site, COUNT(*) AS samples, COUNT(*) FILTER (exceeds) AS bad, 0 AS broken, 0 AS failing FROM sd GROUP BY 1")
def x02(spark, d):
    """Registered builders add a column each; one that fails gives zeros."""
    sd = site_day(spark, d)
    builders = {"samples": lambda x: x.groupBy("site").agg(F.count(F.lit(1)).alias("samples")), "bad": lambda x: x.where("exceeds").groupBy("site").agg(F.count(F.lit(1)).alias("bad")), "broken": lambda x: x.select("no_such_column"), "failing": lambda x: x.select("site", F.raise_error(F.lit("at run time")).cast("int").alias("failing"))}

    def add(base, item):
        name, build = item
        try:
            # computed here, so that a builder that fails at run time stops itself only
            extra = cut(build(sd))
            return base.join(extra, "site", "left").withColumn(name, F.coalesce(name, F.lit(0)))
        except Exception:  # a plug-in must not stop the run
            return base.withColumn(name, F.lit(0))

    return reduce(add, builders.items(), sd.select("site").distinct())


@query("e08_rates_by_group", f"WITH {OBS} SELECT method, COUNT(*) AS n, ROUND(AVG(CAST(exceeds AS INT)), 6) AS rate FROM obs GROUP BY 1")
def e08(spark, d):
    return observations(spark, d).groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("exceeds").cast("int")), 6).alias("rate"))


