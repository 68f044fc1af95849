"""Strictly prior features, as-of and interval joins, windows to a cutoff.

Range frames are in whole days over an integer day number and end at the day before, so rows
of the same day never see each other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from littoral.functions.core import circular_mean, clip


def day_number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def prior_days(keys: list[str], day: str, days: int) -> Window:
    return Window.partitionBy(*keys).orderBy(day_number(F.col(day))).rangeBetween(-days, -1)


def prior_rows(keys: list[str], day: str, rows: int | None = None) -> Window:
    return Window.partitionBy(*keys).orderBy(day).rowsBetween(-rows if rows else Window.unboundedPreceding, -1)


def exact_lags(df: DataFrame, keys: list[str], day: str, columns: list[str], lags: list[int]) -> DataFrame:
    """The value exactly n calendar days before; (keys, day) must be unique.

    One exchange on the keys serves all lags: each is a one-day range frame.
    """
    order = Window.partitionBy(*keys).orderBy(day_number(F.col(day)))
    return df.select("*", *[F.max(c).over(order.rangeBetween(-n, -n)).alias(f"{c}_lag_{n}") for c in columns for n in lags])


def rolling(df: DataFrame, keys: list[str], day: str, column: str) -> DataFrame:
    """Means over 7 and 30 prior days, spread over 7, trend, days since the row before."""
    week, month = prior_days(keys, day, 7), prior_days(keys, day, 30)
    before = Window.partitionBy(*keys).orderBy(day)
    out = df.withColumns({f"{column}_mean_7d": F.avg(column).over(week), f"{column}_mean_30d": F.avg(column).over(month), f"{column}_std_7d": F.stddev_samp(column).over(week)})
    return out.withColumns({f"{column}_trend": F.col(f"{column}_mean_7d") - F.col(f"{column}_mean_30d"), "days_since_sample": F.datediff(day, F.lag(day).over(before))})


def last_observed(df: DataFrame, keys: list[str], day: str, column: str) -> DataFrame:
    """The last value that is not null before the row, and its age in days."""
    w = prior_rows(keys, day)
    seen = F.last(F.when(F.col(column).isNotNull(), F.col(day)), ignorenulls=True).over(w)
    return df.withColumns({f"{column}_last": F.last(column, ignorenulls=True).over(w), f"{column}_age": F.datediff(day, seen)})


def regulatory_geomean(df: DataFrame, keys: list[str], day: str, column: str, floor: float = 1.0, limit: float = 30.0) -> DataFrame:
    """Geometric means over 30 and 42 prior days (two values at least), their flags, and the sample count."""
    out = {}
    logs = F.when(F.col(column).isNotNull(), F.log10(F.greatest(F.col(column), F.lit(floor))))
    for days in (30, 42):
        w = prior_days(keys, day, days)
        mean = F.when(F.count(logs).over(w) >= 2, F.pow(F.lit(10.0), F.avg(logs).over(w)))
        out |= {f"geomean_{days}d": mean, f"geomean_{days}d_above": F.coalesce(mean >= limit, F.lit(False))}
    month = prior_days(keys, day, 30)
    out["samples_30d"] = F.when(F.count(F.lit(1)).over(month) >= 1, F.count(column).over(month))
    return df.withColumns(out)


def wetness_index(df: DataFrame, keys: list[str], day: str, column: str, alpha: float = 0.2) -> DataFrame:
    """Exponentially weighted mean of the values before the row, the first taken as 0.

    With weights (1 - a)^k the recursion is a scaled running sum. So that the scale cannot overflow, a
    key's rows are cut into blocks after which a weight has fallen to 1e-20: what a block's end passes
    on counts in the next block and, in double precision, no further. Linear in the rows.
    """
    keep = 1 - alpha
    block = max(1, math.ceil(-46 / math.log(keep)))
    order = Window.partitionBy(*keys).orderBy(day)
    out = df.withColumn("_i", F.row_number().over(order) - 1).withColumn("_b", F.floor(F.col("_i") / block)).withColumn("_p", F.col("_i") % block)
    x, power = F.coalesce(F.col(column).cast("double"), F.lit(0.0)) * alpha, lambda e: F.pow(F.lit(keep), e)
    inside = Window.partitionBy(*keys, "_b").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.sum(x * power(block - 1 - F.col("_p"))).over(Window.partitionBy(*keys).orderBy("_b").rangeBetween(-1, -1))
    own = F.sum(x * power(-F.col("_p"))).over(inside) * power(F.col("_p") - 1)
    return out.withColumn("wetness", F.coalesce(own, F.lit(0.0)) + F.coalesce(passed, F.lit(0.0)) * power(F.col("_p"))).drop("_i", "_b", "_p")


def first_flush(df: DataFrame, keys: list[str], day: str, column: str, amount: float = 12.7) -> DataFrame:
    """Three dry rows before a wet one."""
    dry = F.coalesce(F.sum(column).over(prior_rows(keys, day, 3)), F.lit(0.0)) == 0
    return df.withColumn("first_flush", (dry & (F.coalesce(F.col(column), F.lit(0.0)) > amount)).cast("int"))


def days_since(df: DataFrame, keys: list[str], day: str, condition: Column, name: str, most: int = 30) -> DataFrame:
    """Days since the last prior row that met a condition, at most ``most``; null until one did."""
    last = F.last(F.when(condition, F.col(day)), ignorenulls=True).over(prior_rows(keys, day))
    return df.withColumn(name, clip(F.datediff(day, last), 0, most))


def extrema(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """Local highs and lows, strict to the left and not to the right; series ends have none."""
    w = Window.partitionBy(*keys).orderBy(time)
    before, after, x = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    kind = F.when((x > before) & (x >= after), "H").when((x < before) & (x <= after), "L")
    return df.withColumn("kind", kind).where("kind is not null")


def trailing_counts(queries: DataFrame, obs: DataFrame, key: str, day: str, hit: str, days: int = 365) -> DataFrame:
    """Samples and hits in [day - days, day), per key and pooled, for each query (key, day).

    Observations are reduced to one row per key and day first; queries and observations then
    share one window over their union, so no range join is needed.
    """
    daily = obs.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(hit).cast("long")).alias("_h"))
    rows = daily.withColumn("_q", F.lit(0)).unionByName(queries.select(key, day).distinct().select("*", F.lit(0).cast("long").alias("_n"), F.lit(0).cast("long").alias("_h"), F.lit(1).alias("_q")))
    own = prior_days([key], day, days)
    marked = rows.withColumns({"n": F.coalesce(F.sum("_n").over(own), F.lit(0)), "hits": F.coalesce(F.sum("_h").over(own), F.lit(0))}).where("_q = 1")
    # pooled: one row per distinct day
    pool = daily.groupBy(day).agg(F.sum("_n").alias("_n"), F.sum("_h").alias("_h"))
    asked = queries.select(day).distinct().withColumnRenamed(day, "_day")
    pooled = asked.join(F.broadcast(pool), (F.col(day) < F.col("_day")) & (F.col(day) >= F.date_sub("_day", days)), "left")  # days of history at most
    pooled = pooled.groupBy("_day").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("pool_n"), F.coalesce(F.sum("_h"), F.lit(0)).alias("pool_hits"))
    return marked.select(key, day, "n", "hits").join(F.broadcast(pooled), F.col(day) == F.col("_day")).drop("_day")


def asof_backward(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, columns: list[str], strict: bool = True) -> DataFrame:
    """The last right row before each left row (at it, too, unless strict).

    The sides are united and a running last carries right values forward: one exchange and
    sort, linear in rows, however many rows a key has on either side.
    """
    rank = 1 if strict else 0  # at equal times right rows come after, or before, left ones
    payload = F.struct(F.col(right_time).alias("_rt"), *columns)
    a = left.select("*", F.col(left_time).alias("_t"), F.lit(0 if strict else 1).alias("_o"), F.lit(None).cast(right.select(payload).schema[0].dataType).alias("_p"))
    b = right.select(F.col(key), F.col(right_time).alias("_t"), F.lit(rank).alias("_o"), payload.alias("_p"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_left", F.col("_p").isNull())
    w = Window.partitionBy(key).orderBy("_t", "_o").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_m", F.last("_p", ignorenulls=True).over(w)).where("_left")
    return carried.select(*left.columns, F.col("_m._rt").alias(f"asof_{right_time}"), *[F.col(f"_m.{c}").alias(f"asof_{c}") for c in columns])


def first_after(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str, column: str, days: int = 3) -> DataFrame:
    """The first right row in the ``days`` days after each left row; right is unique per (key, day).

    Each right row names the left days it can serve, so the join is on equal keys.
    """
    served = right.select(key, F.explode(F.sequence(F.lit(1), F.lit(days))).alias("_d"), F.col(right_day).alias("_rd"), F.col(column).alias("_v"))
    served = served.withColumn("_ld", F.date_sub("_rd", F.col("_d"))).groupBy(key, F.col("_ld").alias(left_day)).agg(F.min("_d").alias("lead_days"), F.min_by("_v", "_d").alias(column))
    return left.join(served, [key, left_day], "left")


def interval_features(days: DataFrame, spans: DataFrame, key: str, day: str, started: str, ended: str, window: int = 14, bucket: int = 28) -> DataFrame:
    """Whether an interval touched the window before a day, and days since the last one ended before it.

    Spans (open ends already filled) are cut into buckets of days, and each day names the
    buckets its window meets: an equi-join, so a key with a long history stays spread out.
    """
    start, end, now = day_number(F.to_date(started)), day_number(F.to_date(ended)), day_number(F.col(day))
    cut = spans.where(F.col(ended) >= F.col(started)).select(key, start.alias("_s"), end.alias("_e")).distinct()
    cut = cut.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_s") / bucket), F.floor(F.col("_e") / bucket))))
    asked = days.select(key, day).distinct().withColumn("_now", now)
    near = asked.withColumn("_b", F.explode(F.array_distinct(F.array(F.floor((F.col("_now") - window) / bucket), F.floor(F.col("_now") / bucket)))))
    met = near.join(cut, [key, "_b"]).where((F.col("_s") < F.col("_now")) & (F.col("_e") > F.col("_now") - window))
    met = met.groupBy(key, day).agg(F.count_distinct("_s", "_e").alias("overlaps"))
    closed = asof_backward(asked.select(key, day), spans.select(key, F.to_date(ended).alias("_end")), key, day, "_end", [], strict=True)
    since = closed.select(key, day, F.datediff(day, "asof__end").alias("days_since_end"))
    out = days.join(met, [key, day], "left").join(since, [key, day], "left")
    return out.withColumn("overlaps", F.coalesce("overlaps", F.lit(0)).cast("long")).withColumn("active", F.col("overlaps") > 0)


def window_to_cutoff(readings: DataFrame, key: str, time: str, value: str, cutoffs: DataFrame, cutoff: str, hours: list[int]) -> DataFrame:
    """Sums, means and maxima over the hours before each day's cutoff, half-open [cutoff - h, cutoff).

    Each reading names the days whose longest window holds it, so readings meet days on equal
    keys; cutoffs (a calendar, one row per day) must be shared by all keys and hold a column ``day``.
    Values are added in the order of time, equal times by value: a sum of doubles depends on its
    order, so results do not depend on how the readings are split. One task reads a key's window
    of one day, in running sums; its sort and its rows go to disk where they outgrow memory.
    """
    longest = max(hours)
    span = -(-longest // 24) + 1
    named = readings.select(key, F.col(time).alias("_t"), F.col(value).alias("_v"), F.explode(F.sequence(F.lit(0), F.lit(span))).alias("_k")).withColumn("day", F.date_add(F.to_date("_t"), F.col("_k")))
    since = {h: F.col("_t") >= F.col(cutoff) - F.expr(f"INTERVAL {h} HOURS") for h in hours}
    joined = named.join(F.broadcast(cutoffs), "day").where((F.col("_t") < F.col(cutoff)) & since[longest])
    rows = joined.select(key, "day", "_t", "_v", *[F.when(since[h], F.col("_v")).alias(f"_{h}") for h in hours if h != longest])
    order = Window.partitionBy(key, "day").orderBy("_t", "_v")
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    aggs = []
    for h in hours:
        v = "_v" if h == longest else f"_{h}"
        aggs += [F.coalesce(F.sum(v).over(run), F.lit(0.0)).alias(f"sum_{h}h"), F.avg(v).over(run).alias(f"mean_{h}h"), F.max(v).over(run).alias(f"max_{h}h")]
    rows = rows.select(key, "day", F.col("_v").alias("latest"), F.count("_v").over(run).alias("readings"), *aggs, F.lead(F.lit(1)).over(order).alias("_next"))
    return rows.where("_next is null").drop("_next")


def prior_by_difference(df: DataFrame, long: int, short: int, name: str) -> DataFrame:
    """A window before a window, by subtraction, floored at 0."""
    return df.withColumn(name, F.greatest(F.col(f"sum_{long}h") - F.col(f"sum_{short}h"), F.lit(0.0)))


def full_window(df: DataFrame, rows: int = 24) -> DataFrame:
    """A window that lacks readings gives no row."""
    return df.where(F.col("readings") >= rows)


def vector_mean_direction(speed: Column, bearing: Column) -> Column:
    """Direction a mean wind blows from, weighted by speed."""
    u, v = F.avg(-speed * F.sin(F.radians(bearing))), F.avg(-speed * F.cos(F.radians(bearing)))
    return F.pmod(F.degrees(F.atan2(-u, -v)), F.lit(360.0))


def uv_or_proxy(uv: Column, radiation: Column) -> tuple[Column, Column]:
    """A10: maximum index, from radiation where it was never measured, and whether it was."""
    return F.coalesce(F.max(uv), F.least(F.lit(15.0), F.max(radiation) / 80)), F.max(uv).isNull()


def history_tensor(df: DataFrame, keys: list[str], day: str, columns: list[str], length: int = 30, least: int = 3) -> DataFrame:
    """A dense calendar of the ``length`` days before each row, oldest first; days without a row hold zeros.

    ``history_days`` counts the days that have a row, whatever it holds.
    """
    w = prior_days(keys, day, length)
    rows = F.collect_list(F.struct(day_number(F.col(day)).alias("d"), F.array(*[F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")) for c in columns]).alias("x"))).over(w)
    zeros = F.array(*[F.lit(0.0).cast("float")] * len(columns))
    out = df.withColumn("_h", rows).where(F.size("_h") >= least).withColumn("_now", day_number(F.col(day)))
    out = out.withColumn("_m", F.map_from_entries(F.transform("_h", lambda r: F.struct(F.col("_now") - r["d"], r["x"]))))
    history = F.transform(F.sequence(F.lit(length), F.lit(1)), lambda k: F.coalesce(F.element_at("_m", k), zeros))
    return out.withColumns({"history": history, "history_days": F.size("_h").cast("long")}).drop("_h", "_m", "_now")


def nearest_in_time(df: DataFrame, keys: list[str], time: str, now, columns: list[str]) -> DataFrame:
    """The row nearest to an instant per key; of two equally near, the earlier."""
    gap = F.struct(F.abs(F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lit(now).cast("timestamp"))), F.col(time))
    return df.groupBy(*keys).agg(*[F.min_by(c, gap).alias(c) for c in [time, *columns]])


def daily_with_peak(df: DataFrame, keys: list[str], time: str, value: str, peak: str, carried: list[str], zone: str) -> DataFrame:
    """Means and maxima by local day, and the row of the highest ``peak`` (the first of equals)."""
    local = F.to_date(F.from_utc_timestamp(F.col(time).cast("timestamp"), zone))
    order = F.struct(F.col(peak), -F.unix_micros(F.col(time).cast("timestamp")))
    return df.groupBy(*keys, local.alias("day")).agg(F.avg(value).alias("mean"), F.max(value).alias("max"), *[F.max_by(c, F.when(F.col(peak).isNotNull(), order)).alias(f"peak_{c}") for c in carried])


def shallowest_daily(df: DataFrame, time: str, depth: str, columns: list[str]) -> DataFrame:
    """Per instant the shallowest non-null value per column, then the daily mean."""
    per = df.groupBy(time).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(depth))).alias(c) for c in columns])
    return per.groupBy(F.to_date(time).alias("day")).agg(*[F.avg(c).alias(c) for c in columns])


def circular_daily(df: DataFrame, key: str, time: str, bearing: str) -> DataFrame:
    return df.groupBy(key, F.to_date(time).alias("day")).agg(circular_mean(F.col(bearing)).alias("bearing"))
