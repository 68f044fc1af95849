"""File sources. Raw files are read as text columns and cast with null on failure."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(spark: SparkSession, path, names: list[str] | None = None, limit: int | None = None, **options) -> DataFrame:
    """All columns as text, byte order mark dropped, malformed lines skipped."""
    reader = spark.read.option("mode", "DROPMALFORMED").option("encoding", "UTF-8").options(**{"header": True, "enforceSchema": False, **options})
    out = reader.schema(text_schema(names)).csv(path) if names else reader.option("inferSchema", False).csv(path)
    return out if limit is None else out.limit(limit)


def read_csv_since(spark: SparkSession, path, day_column: str, since: str, fmt: str = "yyyy-MM-dd", **kw) -> DataFrame:
    """Rows from a day on; the filter reaches the scan. A file without the column passes whole."""
    df = read_csv(spark, path, **kw)
    return df.where(F.to_date(F.try_to_timestamp(day_column, F.lit(fmt))) >= F.lit(since).cast("date")) if day_column in df.columns else df


def read_units_csv(spark: SparkSession, path, first: str, units: str) -> DataFrame:
    """A second header line with units, told by its first cell, is dropped."""
    return read_csv(spark, path).where(F.coalesce(F.col(first) != units, F.lit(True)))


def read_static(spark: SparkSession, path) -> DataFrame:
    """Small tables with comment lines."""
    return read_csv(spark, path, comment="#")


def read_csv_parts(spark: SparkSession, paths: dict[str, str], name: str, names: list[str]) -> DataFrame:
    """One folder or file per part, the part's name as a column; absent ones are skipped."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    there = {k: v for k, v in paths.items() if hadoop(v).getFileSystem(conf).exists(hadoop(v))}
    out = spark.createDataFrame([], text_schema([name, *names]))
    for part, path in there.items():
        out = out.unionByName(read_csv(spark, path, names).withColumn(name, F.lit(part)))
    return out


def read_json_map(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one object of named records: (key, the record's columns)."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", f"map<string,{schema}>"))).select("key", "value.*")


def package_resources(raw: DataFrame, column: str, kind: str) -> DataFrame:
    """The resources of a package's metadata that are of one format; answers without success give none."""
    schema = "struct<success:boolean,result:struct<title:string,resources:array<struct<name:string,format:string,url:string>>>>"
    rows = raw.select(F.from_json(column, schema).alias("j")).where("j.success").select(F.col("j.result.title").alias("package"), F.explode("j.result.resources").alias("r"))
    return rows.where(F.upper("r.format") == kind.upper()).select("package", F.col("r.name").alias("resource"), "r.format", "r.url")


def to_millimetres(value: Column, units: Column) -> Column:
    """Metres and inches become millimetres; other units are taken as millimetres."""
    return F.when(F.lower(units) == "m", value * 1000.0).when(F.lower(units).isin("in", "inch", "inches"), value * 25.4).otherwise(value)


def clamped_start(wanted, archive_start):
    """A request starts no earlier than the archive."""
    return max(wanted, archive_start)


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An absent file is an empty frame of the declared schema."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_parquet_where(spark: SparkSession, path: str, columns: list[str], key: str | None = None, value=None) -> DataFrame:
    """Pruned to the columns that exist, absent ones null, an equality pushed to the scan."""
    df = spark.read.parquet(path)
    if key is not None:
        df = df.where(F.col(key) == value)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def read_json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON file that is a list, one object, or an object with ``results``."""
    raw = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", f"array<{schema}>")
    wrapped = F.from_json("value", f"struct<results:array<{schema}>>")["results"]
    single = F.array(F.from_json("value", schema))
    start = F.substring(F.ltrim("value"), 1, 1)
    rows = F.when(start == "[", listed).otherwise(F.coalesce(wrapped, single))
    return raw.select(F.explode(rows).alias("r")).select("r.*")


def gauge_series(raw: DataFrame, column: str = "value", sentinel: float = -999999.0) -> DataFrame:
    """Nested gauge series to rows; the sentinel is null, ``P`` marks provisional values."""
    schema = "struct<value:struct<timeSeries:array<struct<sourceInfo:struct<siteCode:array<struct<value:string>>>,values:array<struct<value:array<struct<value:string,dateTime:string,qualifiers:array<string>>>>>>>>>"
    series = raw.select(F.explode(F.from_json(column, schema)["value"]["timeSeries"]).alias("s"))
    rows = series.select(F.get("s.sourceInfo.siteCode.value", F.lit(0)).alias("gage"), F.explode(F.flatten("s.values.value")).alias("v"))
    v = F.col("v.value").try_cast("double")
    return rows.select("gage", F.try_to_timestamp("v.dateTime").alias("time"), F.when(v != sentinel, v).alias("discharge"), F.coalesce(F.array_contains("v.qualifiers", "P"), F.lit(False)).alias("provisional"))


def hourly_archive(raw: DataFrame, id_column: str, column: str, variables: list[str]) -> DataFrame:
    """Arrays of one length, zipped to rows."""
    schema = f"struct<latitude:double,longitude:double,hourly:struct<time:array<string>,{','.join(f'{v}:array<double>' for v in variables)}>>"
    h = raw.select(id_column, F.from_json(column, schema).alias("j"))
    zipped = F.explode(F.arrays_zip(F.col("j.hourly.time").alias("time"), *[F.col(f"j.hourly.{v}").alias(v) for v in variables])).alias("r")
    rows = h.select(id_column, F.col("j.latitude").alias("latitude"), F.col("j.longitude").alias("longitude"), zipped)
    return rows.select(id_column, "latitude", "longitude", F.coalesce(F.try_to_timestamp("r.time", F.lit("yyyy-MM-dd'T'HH:mm")), F.try_to_timestamp("r.time")).alias("time"), *[f"r.{v}" for v in variables])


def geojson_features(raw: DataFrame, column: str, properties: str) -> DataFrame:
    """Features to rows, with the mean of the coordinates as place (points, lines and rings)."""
    schema = f"struct<features:array<struct<properties:struct<{properties}>,attributes:struct<{properties}>,geometry:struct<type:string,coordinates:string,x:double,y:double>>>>"
    f = raw.select(F.explode(F.from_json(column, schema)["features"]).alias("f"))
    numbers = F.transform(F.regexp_extract_all("f.geometry.coordinates", F.lit(r"\[\s*-?[\d.eE+-]+\s*,\s*-?[\d.eE+-]+"), F.lit(0)), lambda s: F.split(F.regexp_replace(s, r"[\[\s]", ""), ","))

    def mean(i: int) -> Column:
        return F.aggregate(numbers, F.lit(0.0), lambda acc, p: acc + p[i].try_cast("double")) / F.size(numbers)

    lon, lat = F.coalesce("f.geometry.x", F.when(F.size(numbers) > 0, mean(0))), F.coalesce("f.geometry.y", F.when(F.size(numbers) > 0, mean(1)))
    names = [p.split(":")[0].strip() for p in properties.split(",")]
    return f.select(*[F.coalesce(f"f.properties.{n}", f"f.attributes.{n}").alias(n) for n in names], lat.alias("latitude"), lon.alias("longitude"))


def html_rows(raw: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Table rows with as many cells as names; tags and white space inside a cell go."""
    rows = raw.select(F.explode(F.regexp_extract_all(column, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("_row"))
    cells = F.regexp_extract_all("_row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1))
    plain = F.transform(cells, lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), "&nbsp;", " "), r"\s+", " ")))
    kept = rows.select(plain.alias("c")).where(F.size("c") == len(names))
    return kept.select(*[F.col("c")[i].alias(n) for i, n in enumerate(names)])


def spaced_rows(lines: DataFrame, column: str, names: list[str], comment: str = "#", separator: str = r"\s+") -> DataFrame:
    """Fixed or white-space separated text; comment lines and short lines are skipped."""
    cells = F.split(F.trim(column), separator)
    kept = lines.where(~F.trim(column).startswith(comment)).select(cells.alias("c")).where(F.size("c") >= len(names))
    return kept.select(*[F.col("c")[i].alias(n) for i, n in enumerate(names)])


def kml_placemarks(raw: DataFrame, column: str) -> DataFrame:
    """Name, style and place of each placemark."""
    marks = raw.select(F.explode(F.regexp_extract_all(column, F.lit(r"(?is)<Placemark[^>]*>(.*?)</Placemark>"), F.lit(1))).alias("m"))
    at = F.split(F.regexp_extract("m", r"(?is)<coordinates>\s*([^<]*)", 1), ",")
    return marks.select(F.trim(F.regexp_extract("m", r"(?is)<name>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</name>", 1)).alias("name"), F.regexp_extract("m", r"(?is)<styleUrl>#?([^<]*)", 1).alias("style"), F.get(at, F.lit(1)).try_cast("double").alias("latitude"), F.get(at, F.lit(0)).try_cast("double").alias("longitude"))


def notice_sections(pages: DataFrame, column: str, markers: list[str], sentinel: str = r"(?i)\bno\b[^.]*\bin effect\b") -> DataFrame:
    """Page text cut at its section markers; a section that says nothing is in effect gives no row.
    Dated entries of a section become rows."""
    alternatives = "|".join(markers)
    cut = F.regexp_extract_all(column, F.lit(rf"(?s)\b({alternatives})\b(.*?)(?=\b(?:{alternatives})\b|\z)"), F.lit(0))
    sections = pages.select("*", F.explode(cut).alias("_s")).withColumn("section", F.regexp_extract("_s", rf"^({alternatives})", 1)).where(~F.col("_s").rlike(sentinel))
    entry = F.explode(F.regexp_extract_all("_s", F.lit(r"\d{1,2}/\d{1,2}/\d{4}[^\n]*"), F.lit(0))).alias("entry")
    rows = sections.select(*[c for c in pages.columns if c != column], "section", entry)
    return rows.withColumn("started", F.to_date(F.try_to_timestamp(F.regexp_extract("entry", r"^\d{1,2}/\d{1,2}/\d{4}", 0), F.lit("M/d/yyyy"))))


def bulletin_names(pages: DataFrame, column: str, stop: str = r"(?i)\s*(?:\d+\s*(?:yards|feet)|,|\().*$") -> DataFrame:
    """S25d, S25h: bullets of a bulletin, cut at a distance phrase; fragments are dropped."""
    bullets = F.explode(F.split(column, r"[•●▪·\n]+")).alias("name")
    named = pages.select(*[c for c in pages.columns if c != column], bullets).withColumn("name", F.trim(F.regexp_replace("name", stop, "")))
    return named.where(F.length("name") >= 4)


def latest_above(samples: DataFrame, station: str, analyte: str, day: str, value: str, limits: dict[str, float], tie: str) -> DataFrame:
    """S25i: the latest sample per station and analyte, at or above the analyte's limit; one analyte per station."""
    from littoral.operators.dedupe import keep_one

    newest = keep_one(samples, [station, analyte], [F.desc(day), F.desc(tie)])
    limit = F.element_at(F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))]), F.col(analyte))
    return keep_one(newest.where(F.col(value) >= limit), [station], [F.asc(analyte), F.desc(tie)])


def open_notices(rows: DataFrame, closed: str, kind: str) -> DataFrame:
    """S25o: notices without a closing date; kinds are renamed."""
    renamed = F.when(F.col(kind) == "Rain", "Posting").when(F.col(kind) == "Chronic", "Chronic Posting").otherwise(F.col(kind))
    return rows.where(F.col(closed).isNull() | (F.trim(closed) == "")).withColumn(kind, renamed)
