"""Feeds, files, sinks, gates and plug-ins: raw text is made from the tables and read back."""

from __future__ import annotations

import re
from datetime import date, datetime

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf

from littoral import schemas, sinks
from littoral.functions import core
from littoral.operators import fits, gates, models, normalize, serving
from littoral.plans.registry import ADV, OBS, SCORED, SD, advisories, observations, places, query, scored, shared_path, site_day, table
from littoral.sources import county, datastore, readers

TODAY = date(2000, 6, 1)


def _files(spark, name):
    return shared_path(spark, name)


def _json(*columns, **named):
    return F.to_json(F.struct(*columns, *[v.alias(k) for k, v in named.items()]))


# --- files


@query("s03_second_csv", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def s03(spark, d):
    path = _files(spark, "csv")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment").write.option("header", True).csv(path)
    return readers.read_csv(spark, path)


@query("s06_projected_scan", "SELECT o_orderkey, o_totalprice FROM orders")
def s06(spark, d):
    return readers.read_parquet_where(spark, f"{d}/orders.parquet", ["o_orderkey", "o_totalprice"])


@query("s21_units_csv", "SELECT CAST(s_suppkey AS VARCHAR) AS station, CAST(s_nationkey AS VARCHAR) AS height FROM supplier")
def s21(spark, d):
    path = _files(spark, "csv")
    units = spark.createDataFrame([("UTC", "m")], "station string, height string")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("station"), F.col("s_nationkey").cast("string").alias("height"))
    units.unionByName(s).write.option("header", True).csv(path)
    return readers.read_units_csv(spark, path, "station", "UTC")


@query("s24_national_csv", "SELECT n_name AS region, CAST(c_custkey AS VARCHAR) AS site FROM customer JOIN nation ON n_nationkey = c_nationkey")
def s24(spark, d):
    """One file per region; regions without a file are skipped."""
    path = _files(spark, "csv")
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("region"), F.col("c_custkey").alias("site"))
    c.write.partitionBy("region").option("header", True).csv(path)
    names = [r.n_name for r in table(spark, d, "nation").select("n_name").collect()]
    frames = readers.read_csv_parts(spark, {n: f"{path}/region={n}" for n in [*names, "NO SUCH REGION"]}, "region", ["site"])
    return frames.select("region", "site")


@query("s27_static_csv", "SELECT CAST(p_partkey AS VARCHAR) AS venue, p_brand AS alias FROM part")
def s27(spark, d):
    path = _files(spark, "csv")
    p = table(spark, d, "part").select(F.concat_ws(",", "p_partkey", "p_brand").alias("value"))
    lines = spark.createDataFrame([("# hand-made",)], "value string").unionByName(p).unionByName(spark.createDataFrame([("# end",)], "value string"))
    lines.write.text(path)
    return readers.read_csv(spark, path, ["venue", "alias"], comment="#", header=False)


@query("s29_fixture_json", "SELECT n_nationkey, n_name FROM nation")
def s29(spark, d):
    """A fixture file is one object of named records."""
    path = _files(spark, "json")
    entries = table(spark, d, "nation").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), F.struct("n_name"))))).alias("value"))
    entries.coalesce(1).write.text(path)
    return readers.read_json_map(spark, path, "struct<n_name:string>").select(F.col("key").cast("int").alias("n_nationkey"), "n_name")


# --- remote feeds


def _pages(sql):
    """A transport that answers from the query alone: three results a station."""
    codes = sorted(int(x) for x in re.search(r"IN \(([^)]*)\)", sql)[1].replace("'", "").split(","))
    limit, offset = (int(re.search(rf"{w} (\d+)", sql)[1]) for w in ("LIMIT", "OFFSET"))
    rows = [(str(c), i, float(c * 10 + i)) for c in codes for i in range(3)]
    return rows[offset : offset + limit]


def _datastore(spark, d, name, batch, page):
    spark.dataSource.register(datastore.datastore(_pages, "code string, k int, value double", name))
    codes = ",".join(str(r[0]) for r in table(spark, d, "nation").select("n_nationkey").collect())  # stations of a request
    return spark.read.format(name).option("resource", "r").option("codes", codes).option("batch", batch).option("page", page).load()


@query("s07_remote_sql", "SELECT CAST(n_nationkey AS VARCHAR) AS code, CAST(k AS INTEGER) AS k, CAST(n_nationkey * 10 + k AS DOUBLE) AS value FROM nation, range(3) t(k)")
def s07(spark, d):
    return _datastore(spark, d, "littoral_remote_sql", 100, 1000)


@query("s08_paged_cache", "SELECT CAST(n_nationkey AS VARCHAR) AS code, CAST(k AS VARCHAR) AS k FROM nation, range(3) t(k)")
def s08(spark, d):
    """Batches of stations, pages of rows, a cache of text files, and repeated rows once."""
    path = _files(spark, "cache")
    _datastore(spark, d, "littoral_paged_cache", 4, 5).write.option("header", True).csv(path)
    return readers.read_csv(spark, path, ["code", "k", "value"]).dropDuplicates(["code", "k"]).select("code", "k")


@query("s09_paged_sql", "SELECT CAST(n_nationkey AS VARCHAR) AS code, COUNT(*) AS n, SUM(CAST(n_nationkey * 10 + k AS DOUBLE)) AS total FROM nation, range(3) t(k) GROUP BY 1")
def s09(spark, d):
    return _datastore(spark, d, "littoral_paged_sql", 7, 2).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("s10_package", "SELECT r_name AS package, n_name AS resource, 'CSV' AS format FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey % 3 > 0")
def s10(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    resource = F.struct(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 3 > 0, "CSV").otherwise("PDF").alias("format"), F.concat(F.lit("https://p.example/"), "n_name").alias("url"))
    raw = n.groupBy("r_name").agg(F.collect_list(resource).alias("resources")).select(F.to_json(F.struct(F.lit(True).alias("success"), F.struct(F.col("r_name").alias("title"), "resources").alias("result"))).alias("j"))
    return readers.package_resources(raw, "j", "CSV").select("package", "resource", "format")


@query("s14_precip_geojson", "SELECT CAST(s_suppkey AS VARCHAR) AS station, ROUND(s_nationkey * 0.001::DOUBLE * 1000, 6) AS mm, s_suppkey / 10.0::DOUBLE AS latitude FROM supplier")
def s14(spark, d):
    """Observations in metres become millimetres."""
    k = F.col("s_suppkey")
    feature = F.struct(F.struct(k.cast("string").alias("station"), (F.col("s_nationkey") * 0.001).alias("value"), F.lit("m").alias("units")).alias("properties"), F.struct(F.lit("Point").alias("type"), F.array(F.lit(-118.0), k / 10.0).alias("coordinates")).alias("geometry"))
    raw = table(spark, d, "supplier").select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("j"))
    rows = readers.geojson_features(raw, "j", "station:string, value:double, units:string")
    return rows.select("station", F.round(readers.to_millimetres(F.col("value"), F.col("units")), 6).alias("mm"), "latitude")


def _archive(spark, d, **variables):
    struct = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("t"), *[v.alias(k) for k, v in variables.items()])
    per = table(spark, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(struct)).alias("x"))
    arrays = [F.col("x.t").alias("time"), *[F.col(f"x.{k}").alias(k) for k in variables]]
    return per.select("user_id", F.to_json(F.struct(F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.struct(*arrays).alias("hourly"))).alias("j"))


@query("s16_solar_wind", "SELECT user_id, COUNT(*) AS n, ROUND(SUM(value * 2), 4) AS radiation, ROUND(MAX(event_id % 360), 4) AS direction FROM events GROUP BY 1")
def s16(spark, d):
    raw = _archive(spark, d, shortwave_radiation=F.col("value") * 2, wind_direction=(F.col("event_id") % 360).cast("double"))
    rows = readers.hourly_archive(raw, "user_id", "j", ["shortwave_radiation", "wind_direction"])
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("shortwave_radiation"), 4).alias("radiation"), F.round(F.max("wind_direction"), 4).alias("direction"))


@query("s17_uv_archive", "SELECT user_id, date_trunc('minute', ts) AS time, value AS uv_index FROM events WHERE ts >= TIMESTAMP '2024-01-10'")
def s17(spark, d):
    """Asked from before the archive starts: the request is clamped to its start."""
    rows = readers.hourly_archive(_archive(spark, d, uv_index=F.col("value")), "user_id", "j", ["uv_index"])
    start = readers.clamped_start(date(2023, 1, 1), date(2024, 1, 10))
    return rows.where(F.col("time") >= F.lit(start).cast("timestamp")).select("user_id", F.col("time").cast("timestamp_ntz").alias("time"), "uv_index")


@query("s18_marine_archive", "SELECT user_id, CAST(ts AS DATE) AS day, ROUND(MAX(value / 10), 6) AS wave_height, COUNT(*) FILTER (event_id % 4 > 0) AS periods FROM events GROUP BY 1, 2")
def s18(spark, d):
    raw = _archive(spark, d, wave_height=F.col("value") / 10, wave_period=F.when(F.col("event_id") % 4 > 0, 9.0))
    rows = readers.hourly_archive(raw, "user_id", "j", ["wave_height", "wave_period"])
    return rows.groupBy("user_id", F.to_date("time").alias("day")).agg(F.round(F.max("wave_height"), 6).alias("wave_height"), F.count("wave_period").alias("periods"))


@query("s22_zip_index", "SELECT CAST(c_custkey AS VARCHAR) AS zip, DATE '2024-03-05' AS day, CAST(c_nationkey AS DOUBLE) AS uv_index FROM customer WHERE c_custkey % 4 > 0")
def s22(spark, d):
    k = F.col("c_custkey")
    answer = F.when(k % 4 == 0, F.lit("[]")).otherwise(F.to_json(F.array(F.struct(F.lit("MAR/05/2024").alias("DATE"), F.col("c_nationkey").cast("string").alias("UV_INDEX"), F.lit("0").alias("UV_ALERT")), F.struct(F.lit("MAR/06/2024").alias("DATE"), F.lit("99").alias("UV_INDEX"), F.lit("1").alias("UV_ALERT")))))
    return county.zip_index(table(spark, d, "customer").select(k.cast("string").alias("zip"), answer.alias("j")), "j").select("zip", "day", "uv_index")


@query("s31_forecast_weather", "WITH p AS (SELECT s_suppkey AS site, round_even((32 + (s_suppkey * 37 % 1000) / 400.0::DOUBLE) * 10, 0) AS y, round_even((-120 + (s_suppkey * 91 % 1000) / 400.0::DOUBLE) * 10, 0) AS x FROM supplier) SELECT site, CASE WHEN site % 5 = 0 THEN CAST(site AS DOUBLE) ELSE ROUND(y * 2 - x, 6) END AS wind FROM p")
def s31(spark, d):
    """One answer per cell of a tenth of a degree, overridden by a buoy where a site has one."""
    p = places(spark, d).withColumns({"y": F.bround(F.col("lat") * 10, 0), "x": F.bround(F.col("lon") * 10, 0)})
    answers = p.select("y", "x").distinct().withColumn("cell_wind", F.col("y") * 2 - F.col("x"))
    buoys = p.where("site % 5 = 0").select("site", F.col("site").cast("double").alias("buoy_wind"))
    return p.join(answers, ["y", "x"], "left").join(buoys, "site", "left").select("site", F.coalesce("buoy_wind", F.round("cell_wind", 6)).alias("wind"))


# --- county pages


@query("s25a_event_list", """SELECT CAST(o_custkey AS VARCHAR) AS station, o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'Closure' WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-06-01') > 365 THEN 'Chronic Posting' ELSE 'Posting' END AS kind,
 CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 0 THEN 'Other - Tijuana River Associated' END AS cause FROM orders WHERE o_orderkey % 7 > 0""")
def s25a(spark, d):
    k = F.col("o_orderkey")
    site = F.struct(F.col("o_custkey").cast("string").alias("StationID"), F.when(k % 3 == 0, " Tijuana Slough ").otherwise("").alias("BeachName"), k.cast("string").alias("LocationName"))
    event = F.struct(F.when(k % 7 > 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("IssueDateTime"), F.when(k % 2 == 0, F.col("o_orderpriority")).otherwise(" ").alias("Reason"))
    answer = _json(versionInfo=F.struct(F.lit(False).alias("hasApiVersionChanged")), data=F.struct(F.struct(F.array(F.struct(site.alias("Site"), event.alias("Event"))).alias("List")).alias("List")))
    raw = table(spark, d, "orders").select(k.alias("id"), F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("event_kind"), answer.alias("j"))
    return county.event_list(raw, "j", F.col("event_kind"), F.lit(TODAY)).select("station", "id", "kind", "cause")


@query("s25a_sample_list", "SELECT CAST(user_id AS VARCHAR) AS station, CAST(ts AS DATE) AS day, COUNT(*) AS n, MAX(ROUND(value, 3)) AS worst FROM events WHERE event_id % 5 > 0 GROUP BY 1, 2")
def s25a_samples(spark, d):
    value = F.when(F.col("event_id") % 5 == 0, "pending").when(F.col("event_id") % 3 == 0, F.concat(F.lit("<"), F.round("value", 3).cast("string"))).otherwise(F.round("value", 3).cast("string"))
    item = F.struct(F.struct(F.col("user_id").cast("string").alias("StationID")).alias("Station"), F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("SampleDateTime"), value.alias("Enterococcus")).alias("Sample"))
    pages = table(spark, d, "events").groupBy((F.col("event_id") % 500).alias("page")).agg(F.collect_list(item).alias("items"))
    raw = pages.select("page", F.to_json(F.struct(F.struct(F.struct(F.col("items").alias("List")).alias("List")).alias("data"))).alias("j"))
    return county.sample_list(raw, "j").groupBy("station", "day").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("worst"))


@query("s25b_notice_sections", "SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'CLOSURES' ELSE 'WARNINGS' END AS section, CAST(o_orderdate AS DATE) AS started FROM orders WHERE o_orderstatus <> 'P'")
def s25b(spark, d):
    day = F.date_format("o_orderdate", "M/d/yyyy")
    entry = F.concat(F.lit("\n"), day, F.lit(" the cove\n"))
    text = F.concat(F.lit("CLOSURES "), F.when(F.col("o_orderstatus") == "F", entry).otherwise("No closures in effect. "), F.lit("WARNINGS "), F.when(F.col("o_orderstatus") == "O", entry).otherwise("There are no warnings in effect. "), F.lit("ADVISORIES none"))
    return readers.notice_sections(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), text.alias("page")), "page", ["CLOSURES", "WARNINGS", "ADVISORIES"]).select("id", "section", "started")


@query("s25d_bulletin_names", "SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT s_suppkey, 'Mother''s Beach' FROM supplier")
def s25d(spark, d):
    page = F.concat(F.lit("• "), "s_name", F.lit(" 100 yards up and down the coast\n● Mother's Beach (the entire beach)▪ Pt"))
    return readers.bulletin_names(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), page.alias("page")), "page").select("id", "name")


@query("s25e_avoided_sites", "SELECT s_suppkey AS id, 'Stinson Beach' AS area, DATE '2024-05-06' AS started FROM supplier WHERE s_nationkey % 3 = 1 AND s_suppkey % 2 = 0")
def s25e(spark, d):
    k = F.col("s_nationkey") % 3
    item = F.struct(F.lit("STINSON BEACH").alias("beach_name"), F.when(k == 1, " avoid").otherwise("OK").alias("inspection_result"), F.lit("2024-05-06T00:00:00").alias("inspection_week_date"), F.when(F.col("s_suppkey") % 2 == 0, "1").otherwise("0").alias("is_latest_inspection"))
    return county.avoided_sites(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.to_json(F.array(item)).alias("j")), "j").select("id", "area", "started")


@query("s25f_colour_table", "SELECT 'B-' || s_suppkey AS station, s_name AS area, CASE s_nationkey % 4 WHEN 1 THEN 'Posting' WHEN 2 THEN 'Posting' ELSE 'Closure' END AS kind, CASE s_nationkey % 4 WHEN 1 THEN 'Bacterial Standards Violation' WHEN 2 THEN 'Rain Advisory' ELSE 'Significant health risk' END AS cause, DATE '2024-07-04' AS started FROM supplier WHERE s_nationkey % 4 > 0")
def s25f(spark, d):
    k = F.col("s_nationkey") % 4
    colours = list(county.CELL_COLOURS)
    cell = [F.concat(F.lit(f'<TD style="background-color: {c.upper()}">'), F.when(k == i, "<b>●</b>").otherwise("&nbsp;"), F.lit("</td>")) for i, c in enumerate(colours)]
    row = F.concat(F.lit("<tr class=x><td> B-"), F.col("s_suppkey").cast("string"), F.lit("&nbsp;</td><td><i>"), "s_name", F.lit("</i></td>"), *cell, F.lit("</tr>"))
    page = F.concat(F.lit("<p>Website Updated: 7/4/2024</p><table><tr><td>Site</td><td>Name</td></tr>"), row, F.lit("</table>"))
    return county.colour_table(table(spark, d, "supplier").select(page.alias("page")), "page").select("station", "area", "kind", "cause", "started")


@query("s25g_alert_table", "SELECT s_suppkey AS id, CASE s_nationkey % 4 WHEN 3 THEN 'No dogs' ELSE s_name END AS area, CASE s_nationkey % 4 WHEN 1 THEN 'Closure' ELSE 'Posting' END AS kind, CASE s_nationkey % 4 WHEN 1 THEN 'Danger Advisory (Blue-Green Algae)' WHEN 2 THEN 'Caution Advisory (Blue-Green Algae)' ELSE 'Other' END AS cause FROM supplier WHERE s_nationkey % 4 > 0")
def s25g(spark, d):
    k = F.col("s_nationkey") % 4
    alert = F.when(k == 0, "No Advisory Posted").when(k == 1, "<b>Danger</b> Advisory").when(k == 2, "Caution Advisory").otherwise("Other")
    text = F.when(k == 3, "No dogs. Ever.").otherwise(F.concat("s_name", F.lit("&nbsp; Water Quality Conditions: poor")))
    page = F.concat(F.lit("<table><tr><th>Alert Level</th><th>Park</th><th>Description</th></tr><tr><td>"), alert, F.lit("</td><td>Park</td><td>"), text, F.lit("</td></tr></table>"))
    return county.alert_table(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), page.alias("page")), "page").select("id", "area", "kind", "cause")


@query("s25h_listed_names", "SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_nationkey % 2 = 1")
def s25h(spark, d):
    """A page that says nothing is posted gives no row; fragments of names are dropped."""
    page = F.when(F.col("s_nationkey") % 2 == 0, "There are currently no advisories posted.").otherwise(F.concat(F.lit("● "), "s_name", F.lit(", north of the pier\n● St")))
    raw = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), page.alias("page"))
    return readers.bulletin_names(raw.where(~F.col("page").rlike(r"(?i)\bno advisories posted")), "page").select("id", "name")


@query("s25k_status_features", "SELECT CAST(s_suppkey AS VARCHAR) AS station, CASE s_nationkey % 3 WHEN 1 THEN 'Closure' ELSE 'Posting' END AS kind, CASE WHEN s_suppkey % 2 = 0 THEN DATE '2024-02-03' ELSE DATE '2000-06-01' END AS started FROM supplier WHERE s_nationkey % 3 > 0")
def s25k(spark, d):
    k = F.col("s_nationkey") % 3
    feature = F.struct(F.struct(F.col("s_suppkey").cast("string").alias("Identifier"), F.col("s_name").alias("Beach_Name"), F.when(k == 0, "Open").when(k == 1, "CLOSED").otherwise("Warning: bacteria").alias("Beach_status"), F.when(F.col("s_suppkey") % 2 == 0, F.lit(1706918400000)).alias("StatusDate")).alias("attributes"))
    raw = table(spark, d, "supplier").select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("j"))
    return county.status_features(raw, "j", F.lit(TODAY)).select("station", "kind", "started")


@query("s25m_sheet_samples", """WITH r AS (SELECT CAST(user_id AS VARCHAR) AS station, CAST(ts AS DATE) AS day, CASE event_id % 4 WHEN 0 THEN 1.0::DOUBLE ELSE ROUND(value, 3) END AS value FROM events WHERE event_id % 4 <> 1 AND event_type <> 'signup' AND CAST(ts AS DATE) >= DATE '2024-01-06') SELECT station, day, MAX(value) AS value, MAX(value) > 104 AS exceeds FROM r GROUP BY 1, 2""")
def s25m(spark, d):
    k = F.col("event_id") % 4
    rows = table(spark, d, "events").select(F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("StationID"), F.when(F.col("event_type") == "signup", "Total Coliform").otherwise(" Enterococcus").alias("ParameterCode"), F.date_format("ts", "M/d/yyyy").alias("SampleDate"), F.when(k > 1, F.round("value", 3).cast("string")).alias("Result"), F.when(k == 0, "nd ").otherwise("").alias("Qualifier"))
    return county.sheet_samples(rows, F.lit(date(2024, 5, 5)), 120)


@query("s25n_dated_columns", "SELECT s_suppkey AS id, 'ENTEROCOCCUS' AS analyte, DATE '2024-03-04' + CAST(k * 7 AS INTEGER) AS day, CAST(s_nationkey + k AS DOUBLE) AS value FROM supplier, range(2) t(k) WHERE NOT (k = 1 AND s_suppkey % 3 = 0)")
def s25n(spark, d):
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    second = F.when(k % 3 == 0, "n/a").otherwise(F.concat(F.lit("&lt;".replace("&lt;", "<FONT>")), (n + 1).cast("string"), F.lit("</FONT>")))
    page = F.concat(F.lit("<table><tr><td>Analysis Name</td><td>3/5/2024</td><FONT </td>3/12/2024<td>Single Sample</td></tr><tr><td>Enterococcus</td><td> "), n.cast("string"), F.lit("</td><td>"), second, F.lit("</td><td>104</td></tr><tr><td>Fecal to total ratio</td><td>1</td><td>2</td></tr></table>"))
    return county.dated_columns(table(spark, d, "supplier").select(k.alias("id"), page.alias("page")), "page").select("id", "analyte", "day", "value")


# --- sinks


@query("k01_bundle", f"WITH {SD}, {ADV} SELECT 'sites' AS part, COUNT(*) AS n FROM sd UNION ALL SELECT 'advisories', COUNT(*) FROM adv")
def k01(spark, d):
    root = _files(spark, "bundle")
    sinks.write_bundle({"sites": site_day(spark, d), "advisories": advisories(spark, d)}, root, {"advisories": ["status"]})
    return spark.read.parquet(f"{root}/sites").select(F.lit("sites").alias("part")).unionByName(spark.read.parquet(f"{root}/advisories").select(F.lit("advisories").alias("part"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("k02_replace_atomically", "SELECT s_suppkey, s_acctbal * 2 AS s_acctbal FROM supplier")
def k02(spark, d):
    path, s = _files(spark, "swap"), table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    sinks.replace_atomically(s, path)
    sinks.replace_atomically(s.withColumn("s_acctbal", F.col("s_acctbal") * 2), path)
    return spark.read.parquet(path)


@query("k04_serving_snapshot", f"""WITH {SD}, {ADV}, z AS (SELECT COUNT(*) FILTER (status = 'active' AND kind NOT LIKE '%chronic%' AND started < TIMESTAMP '2000-05-18') AS zombies FROM adv), o AS (SELECT SUM(LEAST(n, 25)) AS n FROM (SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1)), e AS (SELECT SUM(LEAST(n, 10)) AS n FROM (SELECT site, COUNT(*) AS n FROM sd GROUP BY 1))
 SELECT 'beaches' AS name, COUNT(*) AS n FROM supplier UNION ALL SELECT 'parent_beaches', COUNT(DISTINCT s_nationkey) FROM supplier UNION ALL SELECT 'forecasts', COUNT(DISTINCT site) FROM sd UNION ALL SELECT 'latest_env', COUNT(DISTINCT site) FROM sd
 UNION ALL SELECT 'observations_recent', CAST(n AS BIGINT) FROM o UNION ALL SELECT 'recent_environment', CAST(n AS BIGINT) FROM e UNION ALL SELECT 'advisories_active', (SELECT COUNT(*) FROM adv WHERE status = 'active') - zombies FROM z""")
def k04(spark, d):
    """Seven tables in one folder, each sorted by its key for look-ups, and a health row; published as a whole."""
    root, day = _files(spark, "snapshot"), site_day(spark, d)
    beaches = places(spark, d)
    newest = day.groupBy("site").agg(F.max_by("ratio", "day").alias("p"), F.max("day").alias("day"))
    adv = serving.expire_zombies(advisories(spark, d).withColumn("last_seen", F.col("started")), F.lit(datetime(2000, 6, 1)))
    parts = {
        "beaches": (beaches, "site"), "parent_beaches": (beaches.groupBy("county").agg(F.to_json(F.sort_array(F.collect_list("site"))).alias("members")), "county"), "forecasts": (newest.withColumn("top_drivers", F.lit("[]")), "site"),
        "latest_env": (day.groupBy("site").agg(F.max_by(F.struct("value", "ratio"), "day").alias("env")).select("site", "env.*"), "site"),
        "observations_recent": (serving.newest_per(observations(spark, d), ["site"], [F.desc("ts"), F.desc("event_id")], 25), "site"), "recent_environment": (serving.newest_per(day, ["site"], [F.desc("day")], 10), "site"),
        "advisories_active": (adv.where("status = 'active'"), "site"),
    }
    sinks.write_snapshot(parts, root, {"generated_at": "2000-06-01", "sites": float("nan")})
    counts = [spark.read.parquet(f"{root}/{n}").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in parts]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("k09_report", "SELECT '| ' || r_name || ' | ' || COUNT(*) || ' |' AS line FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
def k09(spark, d):
    r = table(spark, d, "nation").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame([(x,) for x in sinks.markdown_table(r).split("\n")[2:]], "line string")


@query("k10_publish", "SELECT 'blocked' AS run, FALSE AS published, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'open', TRUE, COUNT(*) FROM supplier")
def k10(spark, d):
    root, s = _files(spark, "publish"), table(spark, d, "supplier")
    rows = []
    for name, blockers in (("blocked", ["too few rows"]), ("open", [])):
        done = sinks.publish_unless(blockers, s, f"{root}/{name}")
        rows.append((name, done, spark.read.parquet(f"{root}/{name}").count() if done else 0))
    return spark.createDataFrame(rows, "run string, published boolean, n long")


# --- projections, joins, order


@query("p01_column_or_default", "SELECT s_suppkey, s_name, 'unknown' AS agency FROM supplier")
def p01(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", schemas.column_or(s, "s_name", "none").alias("s_name"), schemas.column_or(s, "agency", "unknown").alias("agency"))


@query("p19_model_features", f"WITH {SD} SELECT site, day, ratio FROM sd")
def p19(spark, d):
    day = site_day(spark, d)
    names = normalize.feature_columns([c for c in day.columns if c not in ("site", "day")], ["event_id", "ts", "method", "threshold", "exceeds", "value"], ["value"])
    return day.select("site", "day", *names)


@query("p21_site_names", "SELECT s_suppkey, left(trim(regexp_replace(lower('n ' || s_nationkey || '-' || s_name), '[^a-z0-9]+', '-', 'g'), '-'), 120) AS site, regexp_replace(s_name, '#0*', ' ') AS friendly FROM supplier")
def p21(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", core.slug(F.concat(F.lit("n "), F.col("s_nationkey").cast("string")), F.col("s_name")).alias("site"), F.regexp_replace("s_name", "#0*", " ").alias("friendly"))


@query("p25_fill_and_tide", f"WITH {SD}, r AS (SELECT site, day, SUM(value) AS rain FROM obs WHERE method = 'view' GROUP BY 1, 2) SELECT site, day, ROUND(COALESCE(rain, 0), 6) AS rain, ROUND(1.5 * cos(2 * pi() * ((date_diff('day', DATE '2000-01-06', day) % 29.530588) / 29.530588)), 6) AS tide FROM sd LEFT JOIN r USING (site, day)")
def p25(spark, d):
    rain = observations(spark, d).where("method = 'view'").groupBy("site", "day").agg(F.sum("value").alias("rain"))
    out = site_day(spark, d).join(rain, ["site", "day"], "left").fillna({"rain": 0.0})
    return out.select("site", "day", F.round("rain", 6).alias("rain"), F.round(core.lunar_tide(F.col("day")), 6).alias("tide"))


@query("j04_different_names", "SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3")
def j04(spark, d):
    n = table(spark, d, "nation").where("n_regionkey < 3")
    return table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").drop("n_nationkey").select("c_custkey", "c_nationkey", "n_name")


@query("a02_size_per_key", "SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1")
def a02(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("o05_worst_rows", f"WITH {SCORED} SELECT doc_id, ROUND(abs(p - CAST(y AS INT)), 6) AS miss FROM sc ORDER BY abs(p - CAST(y AS INT)) DESC, doc_id LIMIT 20")
def o05(spark, d):
    miss = F.abs(F.col("p") - F.col("y").cast("int"))
    return scored(spark, d).orderBy(miss.desc(), "doc_id").limit(20).select("doc_id", F.round(miss, 6).alias("miss"))


@query("o06_sql_newest", "SELECT event_id FROM events ORDER BY ts DESC LIMIT 10")
def o06(spark, d):
    table(spark, d, "events").createOrReplaceTempView("littoral_events")
    return spark.sql("SELECT event_id FROM littoral_events ORDER BY ts DESC LIMIT 10")


@query("o07_worst_member", f"WITH {OBS}, m AS (SELECT site % 20 AS parent, site, MAX(ratio) AS p FROM obs GROUP BY 1, 2) SELECT parent, arg_max(site, ROW(p, -site)) AS member, ROUND(MAX(p), 6) AS p FROM m GROUP BY 1")
def o07(spark, d):
    m = observations(spark, d).groupBy((F.col("site") % 20).alias("parent"), "site").agg(F.max("ratio").alias("p"))
    return m.groupBy("parent").agg(F.max_by("site", F.struct("p", -F.col("site"))).alias("member"), F.round(F.max("p"), 6).alias("p"))


@query("v10_point_forecasts", "SELECT user_id, COUNT(*) AS hours, ROUND(MAX(value), 6) AS highest FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12' GROUP BY 1")
def v10(spark, d):
    """The hours of a day for every site, as the point look-up serves them."""
    hours = table(spark, d, "events").where(F.to_date("ts") == F.lit("2024-01-12").cast("date"))
    return hours.groupBy("user_id").agg(F.count(F.lit(1)).alias("hours"), F.round(F.max("value"), 6).alias("highest"))


# --- gates


@query("q01_schema_guard", "SELECT 'no table' AS name, 'error' AS level UNION ALL SELECT 'site', 'error' UNION ALL SELECT 'wave_height', 'warning' UNION ALL SELECT 'uv', 'warning'")
def q01(spark, d):
    """Findings on three frames: an empty one, one without its key, one with absent and empty features."""
    day = site_day(spark, d)
    found = []
    for frame in (day.limit(0), day.drop("site"), day.withColumn("uv", F.lit(None).cast("double"))):
        found += schemas.guard(frame, ["site", "day"], ["exceeds"], ["ratio", "wave_height", "uv"] if "uv" in frame.columns else ["ratio"])
    return spark.createDataFrame(found, "name string, level string")


@query("q06_agreement_gate", f"WITH {SD}, x AS (SELECT site % 10 AS pool, COUNT(*) FILTER (exceeds) AS acute, COUNT(*) FILTER (exceeds AND ratio > 1.2) AS agreeing FROM sd GROUP BY 1) SELECT pool, acute < 5 OR agreeing / acute >= 0.3 AS passes FROM x")
def q06(spark, d):
    pools = site_day(spark, d).groupBy((F.col("site") % 10).alias("pool")).agg(F.count_if("exceeds").alias("acute"), F.count_if(F.col("exceeds") & (F.col("ratio") > 1.2)).alias("agreeing")).collect()  # ten pools
    return spark.createDataFrame([(r.pool, gates.agreement(r.acute, r.agreeing)) for r in pools], "pool long, passes boolean")


@query("q08_retrain_due", "SELECT 'same' AS run, FALSE AS due UNION ALL SELECT 'few new', FALSE UNION ALL SELECT 'many new', COUNT(*) >= 100 FROM labels")
def q08(spark, d):
    from littoral.operators import metrics

    rows = table(spark, d, "labels")
    mark = lambda df: metrics.fingerprint(df, F.col("doc_id"), F.col("quality")).first().asDict()
    whole = mark(rows)
    runs = {"same": whole, "few new": mark(rows.unionByName(rows.limit(1).withColumn("doc_id", F.lit(-1).cast("long")))), "many new": mark(rows.limit(0))}
    return spark.createDataFrame([(k, gates.retrain_due(whole, v, 100)) for k, v in runs.items()], "run string, due boolean")


@query("q09_release", "SELECT 'complete' AS release, CAST(0 AS BIGINT) AS problems UNION ALL SELECT 'broken', CAST(4 AS BIGINT)")
def q09(spark, d):
    """A release needs its tables, rows in each, no private column and fresh forecasts."""
    s, day = table(spark, d, "supplier"), site_day(spark, d)
    whole = {"beaches": s.select("s_suppkey"), "forecasts": day.select("site", "day")}
    broken = {"beaches": s.select("s_suppkey", F.lit("x").alias("api_key")).limit(0), "forecasts": day.select("site", "day").where(F.col("day") < F.lit("2024-01-05").cast("date"))}
    rows = [(n, len(gates.release_problems(t, ["beaches", "forecasts"] + ["health"] * (n == "broken"), ["api_key"], "forecasts", "day", date(2024, 1, 30)))) for n, t in (("complete", whole), ("broken", broken))]
    return spark.createDataFrame(rows, "release string, problems long")


@query("q12_carry_health", "SELECT 'calibration' AS part, 'old' AS origin UNION ALL SELECT 'training', 'old' UNION ALL SELECT 'scrapers', 'new'")
def q12(spark, d):
    now = gates.carry_health({"training": "old", "calibration": "old", "scrapers": "old"}, {"scrapers": "new"})
    return spark.createDataFrame(sorted(now.items()), "part string, origin string")


# --- plug-ins


@query("x01_connector", "SELECT CAST(n_nationkey AS VARCHAR) AS code, CAST(n_nationkey * 10 AS DOUBLE) AS value FROM nation")
def x01(spark, d):
    return _datastore(spark, d, "littoral_connector", 3, 50).where("k = 0").select("code", "value")


@query("x03_scalar_map", f"WITH {OBS} SELECT event_id, CASE WHEN ratio < 0.5 THEN 'low' WHEN ratio < 1 THEN 'moderate' ELSE 'high' END AS band FROM obs")
def x03(spark, d):
    """A row-wise map of the user as an Arrow-batched function."""

    @pandas_udf("string")
    def band(ratio: pd.Series) -> pd.Series:
        return pd.cut(ratio, [-float("inf"), 0.5, 1.0, float("inf")], right=False, labels=["low", "moderate", "high"]).astype(str)

    return observations(spark, d).select("event_id", band("ratio").alias("band"))


@query("x04_group_apply", f"WITH {OBS} SELECT event_id, site, ROUND(value - AVG(value) OVER (PARTITION BY site, method), 6) AS centred FROM obs")
def x04(spark, d):
    """A function from a site's frame to a frame; a (site, method) group is small by its nature."""

    def centre(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(centred=(rows.value - rows.value.mean()).round(6))[["event_id", "site", "centred"]]

    return observations(spark, d).select("event_id", "site", "method", "value").groupBy("site", "method").applyInPandas(centre, "event_id long, site long, centred double")


@query("x05_reducers", f"WITH {OBS} SELECT site, ROUND((degrees(atan2(AVG(sin(radians(event_id % 360))), AVG(cos(radians(event_id % 360))))) + 360) % 360, 3) AS bearing FROM obs GROUP BY 1")
def x05(spark, d):
    """A reducer of the user's own: a grouped-aggregate function."""
    import numpy as np

    @pandas_udf("double")
    def mean_bearing(x: pd.Series) -> float:
        a = np.radians(x.to_numpy(float))
        return float((np.degrees(np.arctan2(np.sin(a).mean(), np.cos(a).mean())) + 360) % 360)

    return observations(spark, d).groupBy("site").agg(F.round(mean_bearing(F.col("event_id") % 360), 3).alias("bearing"))


@query("x06_table_function", "SELECT event_id, part, CAST(event_id % 3 AS VARCHAR) AS v FROM events, (VALUES ('a'), ('b')) t(part)")
def x06(spark, d):
    """Rows from a value by a table function of the user."""

    @udtf(returnType="part string, v string")
    class Parts:
        def eval(self, text: str):
            for p in text.split(";"):
                yield tuple(p.split("="))

    spark.udtf.register("littoral_parts", Parts)
    table(spark, d, "events").select("event_id", F.concat(F.lit("a="), (F.col("event_id") % 3).cast("string"), F.lit(";b="), (F.col("event_id") % 3).cast("string")).alias("text")).createOrReplaceTempView("littoral_texts")
    return spark.sql("SELECT event_id, part, v FROM littoral_texts, LATERAL littoral_parts(text)")


@query("x07_estimator", f"WITH {SCORED}, s AS (SELECT source, COUNT(*) AS n, SUM(CAST(y AS INT)) AS k FROM sc GROUP BY 1), g AS (SELECT SUM(k) / SUM(n)::DOUBLE AS g FROM s) SELECT doc_id, ROUND((k + 4 * g) / (n + 4), 6) AS p FROM sc JOIN s USING (source), g")
def x07(spark, d):
    """The estimator protocol: fit to a model, transform with it, site keys along."""
    rows = scored(spark, d).withColumn("label", F.col("y").cast("int"))
    return models.SiteRate("source", "label").fit(rows).transform(rows).select("doc_id", F.round("probability", 6).alias("p"))


# --- models


@query("m02_walk_back_fit")
def m02(spark, d):
    """The offset model on the last four years, served only if its weights are sane."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate", (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.round(F.col("o_totalprice") / 500000, 2).alias("x"), F.lit(0.0).alias("offset"))
    last = rows.agg(F.max("o_orderdate").alias("last"))  # one row
    recent = rows.join(F.broadcast(last), F.col("o_orderdate") >= F.add_months("last", -48).cast("timestamp_ntz")).drop("last")
    weights = fits.group_logits(fits.counted(recent.withColumn("g", F.lit(0)), ["g"], ["x"], "y", "offset"), "g", ["x"], "offset")
    sane = 0 in weights and all(abs(w) <= 3 for w in weights[0][:-1])
    return fits.with_probability(recent.withColumn("g", F.lit(0)), weights if sane else {}, "g", ["x"], "offset").select("o_orderkey", F.round("p", 5).alias("p"))


@query("m04_level_calibration")
def m04(spark, d):
    rows = scored(spark, d).withColumn("y", F.col("y").cast("int"))
    model = fits.LevelCalibrator("lang", "source", None, least=(24, 8, 16)).fit(rows, "p", "y")
    return model.transform(rows).select("doc_id", *[F.round(c, 5).alias(c) for c in ("calibrated", "low", "high")])


@query("m07_two_tier")
def m07(spark, d):
    rows = scored(spark, d).withColumns({"t": F.col("toxic").cast("double"), "y": F.col("y").cast("int")})
    out = fits.two_tier(rows.select("doc_id", "source", "p0", "t", "y"), "source", ["p0", "t"], "y", {"p0": F.lit(0.0)}, tie="doc_id")
    return out.select("doc_id", F.round("margin", 5).alias("margin"), F.round("p", 5).alias("p"))


@query("m09_station_residuals")
def m09(spark, d):
    rows = scored(spark, d).withColumn("y", F.col("y").cast("int"))
    return fits.station_residuals(rows, "source", "p", "y", ["p0", "toxic"]).select("doc_id", F.round("residual", 5).alias("residual"), F.round("corrected", 5).alias("corrected"))


@query("m10_scoped_fits")
def m10(spark, d):
    rows = scored(spark, d).withColumns({"y": F.col("y").cast("int"), "x": F.col("p")}).select("doc_id", "source", "lang", "x", "p0", "y")
    return fits.scoped_fits(rows, ["source", "lang"], ["x", "p0"], "y", 20).select("doc_id", "scope", F.round("p", 5).alias("p"))


@query("m14_held_out_fits")
def m14(spark, d):
    rows = scored(spark, d).withColumn("y", F.col("y").cast("int"))
    return fits.held_out_fits(rows.select("doc_id", "source", "p", "p0", "y"), "source", ["p", "p0"], "y").select("doc_id", "source", F.round("p", 5).alias("p"))


@query("m23_promotion", f"WITH {SCORED}, m AS (SELECT AVG((p - CAST(y AS INT)) ^ 2) AS a, AVG((p0 - CAST(y AS INT)) ^ 2) AS b FROM sc) SELECT b > a AS blocked FROM m")
def m23(spark, d):
    y = F.col("y").cast("int")
    r = scored(spark, d).agg(F.avg(F.pow(F.col("p") - y, 2)).alias("a"), F.avg(F.pow(F.col("p0") - y, 2)).alias("b")).first()
    reasons = models.promotion({"brier": r.b}, {"brier": r.a})
    return spark.createDataFrame([(reasons == ["brier"],)], "blocked boolean")


@query("m24_walk_forward_fits")
def m24(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.round(F.col("o_totalprice") / 500000, 1).alias("x"), F.substring("o_orderpriority", 1, 1).cast("double").alias("k"))
    return fits.walk_forward_fits(rows, "day", ["x", "k"], "y").select("o_orderkey", "month", F.round("p", 5).alias("p"))


@query("m25_two_arms", f"WITH {SCORED}, a AS (SELECT 'threshold' AS arm, AVG((LEAST(GREATEST(p * 1.1, 0.001), 0.999) - CAST(y AS INT)) ^ 2) AS brier FROM sc UNION ALL SELECT 'plain', AVG((p - CAST(y AS INT)) ^ 2) FROM sc) SELECT arm, ROUND(brier, 6) AS brier, brier = (SELECT MIN(brier) FROM a) AS wins FROM a")
def m25(spark, d):
    """An experiment's arms on the same rows, in one pass."""
    y = F.col("y").cast("int")
    arms = {"plain": F.col("p"), "threshold": core.clip(F.col("p") * 1.1, 0.001, 0.999)}
    r = scored(spark, d).agg(*[F.avg(F.pow(c - y, 2)).alias(n) for n, c in arms.items()]).select(F.explode(F.array(*[F.struct(F.lit(n).alias("arm"), F.col(n).alias("brier")) for n in arms])).alias("x"), F.least(*arms).alias("least"))
    return r.select("x.arm", F.round("x.brier", 6).alias("brier"), (F.col("x.brier") == F.col("least")).alias("wins"))
