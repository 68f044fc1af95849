"""Normalisation of raw text tables to the canonical observation, station and advisory schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from littoral.functions.core import action_value, any_timestamp, clean_text, exceeds, is_molecular, safe_float, slug, web_address
from littoral.operators.dedupe import keep_one

FORMATS = ("M/d/yyyy HH:mm:ss", "M/d/yyyy HH:mm", "M/d/yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def is_marine(kind: Column, body: Column, kinds: list[str], terms: list[str]) -> Column:
    """The class is listed, or the type holds a term; case does not matter."""
    return F.coalesce(F.lower(kind).isin([k.lower() for k in kinds]), F.lit(False)) | F.coalesce(F.lower(body).rlike("|".join(t.lower() for t in terms)), F.lit(False))


def stations(raw: DataFrame) -> DataFrame:
    """Raw (station_name, beach_name, county, code, status, lat, lon, agency): one row per id, the first by code."""
    name = F.coalesce(clean_text(F.col("beach_name")), clean_text(F.col("station_name")), clean_text(F.col("code")))
    status = F.when(F.lower("status").startswith("inact"), "inactive").when(F.col("status").isNull(), "unknown").otherwise("active")
    lat, lon = safe_float(F.col("lat")), safe_float(F.col("lon"))
    rows = raw.select(slug(F.col("county"), name, F.col("code")).alias("site"), name.alias("name"), clean_text(F.col("county")).alias("county"), clean_text(F.col("code")).alias("code"), status.alias("status"), F.when(lat.between(-90, 90), lat).alias("lat"), F.when(lon.between(-180, 180), lon).alias("lon"))
    return keep_one(rows, ["site"], [F.asc_nulls_last("code"), F.asc_nulls_last("name")])


def plausible(time: Column, now: Column) -> Column:
    """P10."""
    return F.coalesce(time.between(F.lit("2000-01-01").cast("timestamp_ntz"), now + F.expr("INTERVAL 2 DAYS")), F.lit(False))


def lab_results(raw: DataFrame, now: Column, analyte: str = "enterococcus", culture: float = 104.0, copies: float = 1413.0) -> DataFrame:
    """Raw text (site, parameter, day, time, result, unit, method): target analyte, readable plausible times, values not negative."""
    at = any_timestamp(F.concat_ws(" ", clean_text(F.col("day")), clean_text(F.col("time"))), FORMATS).cast("timestamp_ntz")
    value = safe_float(F.col("result"))
    rows = raw.where(F.lower("parameter").contains(analyte)).withColumns({"sample_time": at, "value": F.when(value >= 0, value)})
    rows = rows.where(plausible(F.col("sample_time"), now) & F.col("value").isNotNull())
    threshold = action_value(is_molecular(F.col("method"), F.col("unit")), culture, copies)
    return rows.select("site", "sample_time", F.to_date("sample_time").alias("sample_date"), F.lit(analyte).alias("analyte"), clean_text(F.col("method")).alias("method"), clean_text(F.col("unit")).alias("units"), "value", (F.col("value") / threshold).alias("ratio"), exceeds(F.col("value"), threshold).alias("exceeds"))


def advisory_rows(raw: DataFrame, county_sites: dict[str, str]) -> DataFrame:
    """P5: raw text (site, kind, started, ended, cause, county, website); an open end is active; addresses fall back to the county's."""
    start, end = (any_timestamp(clean_text(F.col(c)), FORMATS).cast("timestamp_ntz") for c in ("started", "ended"))
    fallback = F.element_at(F.create_map(*[F.lit(x) for kv in county_sites.items() for x in kv]), F.col("county")) if county_sites else F.lit(None).cast("string")
    return raw.select("site", clean_text(F.col("kind")).alias("kind"), start.alias("started"), end.alias("ended"), F.when(end.isNull(), "active").otherwise("historical").alias("status"), clean_text(F.col("cause")).alias("cause"), "county", F.coalesce(web_address(F.col("website")), fallback).alias("url"))


def preferred_value(sub: Column, raw: Column) -> Column:
    """The substituted result where there is one, the raw one otherwise; sentinels below 0 are null."""
    v = F.coalesce(safe_float(sub), safe_float(raw))
    return F.when(v >= 0, v)


def with_station(rows: DataFrame, lookup: DataFrame, code: str, now: Column, time: str) -> DataFrame:
    """Live rows get their site by station code; unknown codes and future times go. The lookup is one row per code."""
    return rows.join(lookup.select(code, "site"), code).where(F.col(time) <= now)


def county_direct(rows: DataFrame, known: DataFrame, counties: list[str]) -> DataFrame:
    """Listed counties, resolved and known sites only."""
    return rows.where(F.col("county").isin(counties) & F.col("site").isNotNull()).join(known.select("site"), "site", "left_semi")


def canonical_key(rows: DataFrame) -> DataFrame:
    """Day from the time or the date; a time at midnight means that only the date is known."""
    day = F.to_date(F.coalesce(F.col("sample_time"), F.col("sample_date").cast("timestamp_ntz")))
    timed = F.col("sample_time").isNotNull() & (F.date_format("sample_time", "HH:mm:ss") != "00:00:00")
    return rows.withColumns({"key_day": day, "key_time": F.when(timed, F.col("sample_time"))})


def assets(raw: DataFrame, id_columns: list[str], type_column: str) -> DataFrame:
    """Id from the first column present, a kind from words in the type, and a truthy flag."""
    found = [clean_text(F.col(c).cast("string")) for c in id_columns if c in raw.columns]
    t = F.lower(type_column)
    kind = F.when(t.rlike("outfall|drain"), "outfall").when(t.rlike("pump"), "pump").when(t.rlike("sewer|pipe"), "sewer").otherwise("other")
    return raw.withColumns({"asset": F.coalesce(*found), "asset_kind": kind})


def listed_waters(raw: DataFrame, columns: list[str], pattern: str, key: str) -> DataFrame:
    """Rows whose joined text matches, counted per key."""
    return raw.where(F.concat_ws(" ", *columns).rlike(pattern)).groupBy(key).agg(F.count(F.lit(1)).alias("listed"))


def feature_columns(columns: list[str], banned: list[str], raw_values: list[str]) -> list[str]:
    """Model features; a raw mixed-unit value among them is an error."""
    chosen = [c for c in columns if c not in banned]
    bad = [c for c in chosen if any(c == r or c.startswith(r + "_") for r in raw_values)]
    if bad:
        raise ValueError(f"raw values among the features: {bad}")
    return chosen


def censored_variants(df: DataFrame, history: list[str], cutoffs: dict[str, Column]) -> dict[str, DataFrame]:
    """One frame per cutoff, with history columns zero where it holds."""
    return {name: df.withColumns({c: F.when(cond, 0.0).otherwise(F.col(c)) for c in history}) for name, cond in cutoffs.items()}


def confidence(distance_km: Column) -> Column:
    """Class of a link by its distance."""
    return F.when(distance_km.isNull(), "none").when(distance_km <= 10, "high").when(distance_km <= 30, "medium").otherwise("low")
