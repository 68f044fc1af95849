"""County pages and feeds: rows of notices and samples from raw text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What colours and words of the sources mean.
CELL_COLOURS = {"#00cc00": ("OPEN", None), "#9bc2e6": ("Posting", "Bacterial Standards Violation"), "#ffff00": ("Posting", "Rain Advisory"), "#ff0000": ("Closure", "Significant health risk")}
ANALYTES = {"enterococcus": "ENTEROCOCCUS", "fecal coliform": "FECAL_COLIFORM", "total coliform": "TOTAL_COLIFORM"}


def plain(cell: Column) -> Column:
    """A table cell without markup, its white space as single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(cell, "<[^>]*>", " "), "&nbsp;| ", " "), r"\s+", " "))


def _rows(pages: DataFrame, html: str) -> DataFrame:
    return pages.select(*[c for c in pages.columns if c != html], F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.+?)</tr>"), F.lit(1))).alias("row_at", "row"))


def event_list(raw: DataFrame, column: str, kind: int | Column, now: Column) -> DataFrame:
    """Events of an application's JSON answer; an answer that reports a changed version or an exception gives none.

    Kind 2 is a closure, others are postings, chronic after a year. The cause is the reason that is stated,
    or the river where the name says so, or unknown.
    """
    item = "struct<Site:struct<StationID:string,BeachName:string,LocationName:string>,Event:struct<IssueDateTime:string,Reason:string>>"
    schema = f"struct<versionInfo:struct<hasApiVersionChanged:boolean>,exception:string,data:struct<List:struct<List:array<{item}>>>>"
    parsed = raw.withColumn("j", F.from_json(column, schema)).where(~F.coalesce("j.versionInfo.hasApiVersionChanged", F.lit(False)) & F.col("j.exception").isNull())
    rows = parsed.select(*[c for c in raw.columns if c != column], F.explode("j.data.List.List").alias("e"))
    beach, place = F.trim(F.coalesce("e.Site.BeachName", F.lit(""))), F.trim(F.coalesce("e.Site.LocationName", F.lit("")))
    started = F.try_to_timestamp("e.Event.IssueDateTime")
    reason = F.nullif(F.trim(F.coalesce("e.Event.Reason", F.lit(""))), F.lit(""))
    kind = F.lit(kind) if isinstance(kind, int) else kind
    notice = F.when(kind == 2, "Closure").when(F.datediff(now, started) > 365, "Chronic Posting").otherwise("Posting")
    river = F.when(F.lower(F.concat_ws(" ", beach, place)).contains("tijuana"), "Other - Tijuana River Associated")
    out = rows.withColumns({"station": F.nullif(F.col("e.Site.StationID"), F.lit("")), "area": F.when(beach != "", beach).otherwise(place), "kind": notice, "started": started, "cause": F.coalesce(reason, river)})
    return out.where(F.col("started").isNotNull()).drop("e")


def sample_list(raw: DataFrame, column: str) -> DataFrame:
    """Lab results of the same application: pages of a list of records."""
    item = "struct<Station:struct<StationID:string>,Sample:struct<SampleDateTime:string,Enterococcus:string>>"
    rows = raw.select(*[c for c in raw.columns if c != column], F.explode(F.from_json(column, f"struct<data:struct<List:struct<List:array<{item}>>>>")["data"]["List"]["List"]).alias("e"))
    out = rows.withColumns({"station": F.col("e.Station.StationID"), "day": F.to_date(F.try_to_timestamp("e.Sample.SampleDateTime")), "value": F.regexp_replace("e.Sample.Enterococcus", "[<>, ]", "").try_cast("double")})
    return out.where(F.col("day").isNotNull() & F.col("value").isNotNull()).drop("e")


def avoided_sites(raw: DataFrame, column: str) -> DataFrame:
    """S25e: latest inspections with the result to avoid; the remote filter is a filter on the parsed rows."""
    schema = "array<struct<beach_name:string,inspection_result:string,inspection_week_date:string,is_latest_inspection:string>>"
    rows = raw.select(*[c for c in raw.columns if c != column], F.explode(F.from_json(column, schema)).alias("e"))
    out = rows.where((F.trim(F.upper("e.inspection_result")) == "AVOID") & (F.coalesce("e.is_latest_inspection", F.lit("1")) == "1"))
    out = out.withColumns({"area": F.initcap("e.beach_name"), "kind": F.lit("Posting"), "started": F.to_date(F.try_to_timestamp("e.inspection_week_date")), "cause": F.lit("Bacterial Standards Violation")})
    return out.where(F.col("started").isNotNull()).drop("e")


def colour_table(pages: DataFrame, html: str) -> DataFrame:
    """S25f: a table with one marked cell of a colour per row; open sites give no row. The day is the page's own."""
    updated = F.regexp_extract(html, r"Website Updated:\s*(\d{1,2}/\d{1,2}/\d{2,4})", 1)
    day = F.to_date(F.coalesce(F.try_to_timestamp(updated, F.lit("M/d/yyyy")), F.try_to_timestamp(updated, F.lit("M/d/yy"))))
    rows = _rows(pages.withColumn("started", day), html)
    cells = F.regexp_extract_all("row", F.lit(r"(?is)(<td[^>]*>.*?)</td>"), F.lit(1))
    marked = F.get(F.filter(F.slice("cells", 3, 4), lambda c: c.contains("●")), F.lit(0))
    style = F.lower(F.regexp_extract("marked", "(?is)^(<td[^>]*>)", 1))
    kind, cause = F.lit(None).cast("string"), F.lit(None).cast("string")
    for colour, (name, why) in CELL_COLOURS.items():
        kind, cause = F.when(style.contains(colour), name).otherwise(kind), F.when(style.contains(colour), F.lit(why)).otherwise(cause)
    out = rows.withColumn("cells", cells).where(F.size("cells") >= 6).withColumn("marked", marked)
    out = out.withColumns({"station": F.regexp_extract(plain(F.get("cells", F.lit(0))), r"^(B-\d+)", 1), "area": plain(F.get("cells", F.lit(1))), "kind": kind, "cause": cause})
    return out.where((F.col("station") != "") & F.col("kind").isNotNull() & (F.col("kind") != "OPEN")).drop("row", "row_at", "cells", "marked")


def alert_table(pages: DataFrame, html: str) -> DataFrame:
    """S25g: alert level, park, description; the name stands before a fixed phrase of the description."""
    rows = _rows(pages, html).withColumn("cells", F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"), F.lit(1)), plain)).where(F.size("cells") >= 3)
    alert, text = F.get("cells", F.lit(0)), F.get("cells", F.lit(2))
    named = F.trim(F.regexp_extract(text, r"^(.+?)\s*Water Quality Conditions", 1))
    area = F.when(named != "", named).otherwise(F.substring(F.split(text, r"\.")[0], 1, 60))
    kind = F.when(alert.contains("Danger") & ~alert.contains("Caution"), "Closure").otherwise("Posting")
    cause = F.when(alert.contains("Caution"), "Caution Advisory (Blue-Green Algae)").when(alert.contains("Danger"), "Danger Advisory (Blue-Green Algae)").when(alert.contains("Water Advisory"), "Water Advisory").otherwise(alert)
    out = rows.withColumns({"alert": alert, "area": area, "kind": kind, "cause": cause})
    return out.where((F.col("alert") != "") & ~F.col("alert").contains("Alert Level") & ~F.col("alert").contains("No Advisory") & (F.col("area") != "")).drop("row", "row_at", "cells", "alert")


def status_features(raw: DataFrame, column: str, today: Column) -> DataFrame:
    """S25k: features of a map service with a status; open and unknown ones give no row, an error answer none at all."""
    schema = "struct<error:string,features:array<struct<attributes:struct<Identifier:string,Beach_Name:string,Beach_status:string,StatusDate:bigint>>>>"
    rows = raw.withColumn("j", F.from_json(column, schema)).where("j.error IS NULL").select(*[c for c in raw.columns if c != column], F.explode("j.features.attributes").alias("e"))
    status = F.lower(F.coalesce("e.Beach_status", F.lit("")))
    kind = F.when(status.contains("clos"), "Closure").when(status.contains("warning"), "Posting")
    started = F.when(F.coalesce("e.StatusDate", F.lit(0)) != 0, F.to_date(F.timestamp_millis("e.StatusDate"))).otherwise(today)
    out = rows.withColumns({"station": F.col("e.Identifier"), "area": F.trim(F.coalesce("e.Beach_Name", F.lit(""))), "kind": kind, "started": started, "cause": F.lit("Bacterial Standards Violation")})
    return out.where(F.col("kind").isNotNull()).drop("e")


def sheet_samples(rows: DataFrame, today: Column, days: int = 120, limit: float = 104.0) -> DataFrame:
    """S25m: rows of a results sheet; not-detected values are 1, and the worst of a station and day stands."""
    value = F.coalesce(F.col("Result").try_cast("double"), F.when(F.upper(F.trim("Qualifier")) == "ND", 1.0))
    day = F.to_date(F.coalesce(F.try_to_timestamp(F.col("SampleDate").cast("string")), F.try_to_timestamp(F.col("SampleDate").cast("string"), F.lit("M/d/yyyy"))))
    kept = rows.where(F.lower(F.trim("ParameterCode")) == "enterococcus").select(F.trim(F.col("StationID").cast("string")).alias("station"), day.alias("day"), value.alias("value"))
    kept = kept.where(F.col("station").isNotNull() & F.col("value").isNotNull() & (F.col("day") >= F.date_sub(today, days)))
    return kept.groupBy("station", "day").agg(F.max("value").alias("value")).withColumn("exceeds", F.col("value") > limit)


def dated_columns(pages: DataFrame, html: str) -> DataFrame:
    """S25n: tables with a column per day, whose headings are broken markup: days are read from the text between two
    phrases, and are a day late; rows of ratios and other analytes give nothing."""
    head = F.regexp_extract(html, r"(?is)Analysis Name(.*?)Single Sample", 1)
    found = pages.withColumn("days", F.transform(F.regexp_extract_all(head, F.lit(r"(\d{1,2}/\d{1,2}/20\d\d)"), F.lit(1)), lambda t: F.date_sub(F.to_date(F.try_to_timestamp(t, F.lit("M/d/yyyy"))), 1)))
    rows = _rows(found, html).withColumn("cells", F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)), plain))
    first, analyte = F.lower(F.get("cells", F.lit(0))), F.lit(None).cast("string")
    for name, code in reversed(ANALYTES.items()):
        analyte = F.when(first.contains(name), code).otherwise(analyte)
    rows = rows.where(~F.coalesce(first.contains("ratio"), F.lit(True))).withColumn("analyte", analyte).where("analyte IS NOT NULL AND size(days) > 0")
    width = F.least(F.size("days"), F.size("cells") - 1)
    rows = rows.where(width > 0).withColumn("k", F.explode(F.sequence(F.lit(1), width)))
    value = F.regexp_replace(F.get("cells", F.col("k")), "[<>, ]", "").try_cast("double")
    out = rows.withColumns({"day": F.get("days", F.col("k") - 1), "value": value})
    return out.where("value IS NOT NULL AND day IS NOT NULL").drop("days", "row", "row_at", "cells", "k")


def zip_index(raw: DataFrame, column: str) -> DataFrame:
    """An answer per postal code, of whose records the first counts; an empty answer gives no row."""
    first = F.get(F.from_json(column, "array<struct<DATE:string,UV_INDEX:string,UV_ALERT:string>>"), F.lit(0))
    rows = raw.withColumn("e", first).where("e IS NOT NULL").drop(column)
    return rows.withColumns({"day": F.to_date(F.try_to_timestamp(F.initcap("e.DATE"), F.lit("MMM/d/yyyy"))), "uv_index": F.col("e.UV_INDEX").try_cast("double"), "uv_alert": F.col("e.UV_ALERT")}).drop("e")
