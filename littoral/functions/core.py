"""Pure column builders; every one stays inside whole-stage code generation."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the monitored quantity by assay, and serving floors.
CULTURE_THRESHOLD, MOLECULAR_THRESHOLD = 104.0, 1413.0
OPEN_DAYS, ACTIVE_DAYS = 14, 7
POSTED_FLOOR, PERSISTENCE_FLOOR = 0.30, 0.20
EARTH_KM = 6371.0
LUNAR_DAYS = 29.530588
COMPASS = "N NNE NE ENE E ESE SE SSE S SSW SW WSW W WNW NW NNW".split()


def num(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# --- nulls, casts, text


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def finite(c: Column) -> Column:
    c = c.try_cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def round_scaled(c: Column, places: int) -> Column:
    """Rounded as SQL engines do, the scaled double half away from zero; Spark rounds the shortest decimal. Doubles only."""
    scale = float(10**places)
    return F.coalesce(finite(F.round(c * scale, 0) / scale), c)


def clean_text(c: Column) -> Column:
    """Trimmed text; tokens that stand for nothing become null."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin("", "nan", "none", "null", "n/a", "na", "<na>", "nat"), t)


def safe_float(c: Column) -> Column:
    return finite(clean_text(c))


def safe_int(c: Column) -> Column:
    return F.floor(finite(clean_text(c))).cast("long")


def safe_bool(c: Column) -> Column:
    t = F.lower(clean_text(c))
    return F.when(t.isin("true", "1", "yes", "y", "t"), True).when(t.isin("false", "0", "no", "n", "f"), False)


def web_address(c: Column) -> Column:
    t = clean_text(c)
    return F.when(F.lower(t).rlike("^https?://"), t)


def slug(*parts: Column, limit: int = 120) -> Column:
    dashed = F.regexp_replace(F.lower(F.concat_ws("-", *parts)), "[^a-z0-9]+", "-")
    return F.left(F.trim(dashed, F.lit("-")), F.lit(limit))


def replace_word(c: Column, wrong: str, right: str) -> Column:
    return F.regexp_replace(c, rf"(?i)\b{wrong}\b", right)


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "), " "), lambda t: t != "")


def starts_with_tokens(long: Column, short: Column) -> Column:
    """The whole token list of ``short`` opens that of ``long``."""
    return (F.size(short) > 0) & (F.slice(long, F.lit(1), F.size(short)) == short)


def strip_tags(c: Column) -> Column:
    no_tags = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", " "), "<[^>]*>", " ")
    plain = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")], no_tags)
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def short_id(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, 12)


# --- numbers


def clip(c: Column, low=None, high=None) -> Column:
    """``greatest``/``least`` skip nulls; a null stays null here."""
    out = c
    if low is not None:
        out = F.greatest(out, num(low))
    if high is not None:
        out = F.least(out, num(high))
    return F.when(c.isNotNull(), out)


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.ln(q / (1 - q))


def expit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def ladder(c: Column, edges: list[float], labels: list[str], unknown: str | None = "unknown") -> Column:
    """Right-open bins: below edges[0] the first label, and so on; null gets ``unknown``."""
    out = F.when(c.isNull(), F.lit(unknown))
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(c < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def through_knots(x: Column, knots: list[tuple[float, float]]) -> Column:
    """Piecewise-linear through the knots, constant beyond them."""
    (x0, y0), out = knots[0], None
    out = F.when(x <= x0, F.lit(float(y0)))
    for (a, b), (c, d) in zip(knots, knots[1:], strict=False):
        out = out.when(x <= c, F.lit(float(b)) + (x - a) * ((d - b) / (c - a) if c > a else 0.0))
    return F.when(x.isNotNull(), out.otherwise(F.lit(float(knots[-1][1]))))


# --- assay


def is_molecular(method: Column, units: Column | None = None) -> Column:
    text = F.lower(F.concat_ws(" ", method, units) if units is not None else F.coalesce(method, F.lit("")))
    return text.contains("pcr") | text.contains("cop")


def action_value(molecular: Column, culture: float = CULTURE_THRESHOLD, copies: float = MOLECULAR_THRESHOLD) -> Column:
    return F.when(molecular, F.lit(copies)).otherwise(F.lit(culture))


def exceeds(value: Column, threshold: Column) -> Column:
    """Strictly above; null never exceeds."""
    return F.coalesce(value > threshold, F.lit(False))


# --- place and direction


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p, q = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((q - p) / 2), 2) + F.cos(p) * F.cos(q) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def local_km(lat: Column, lon: Column, lat0: float, lon0: float) -> tuple[Column, Column]:
    """East and north of an origin."""
    per = math.pi * EARTH_KM / 180
    return (lon - lon0) * (per * math.cos(math.radians(lat0))), (lat - lat0) * per


def compass(bearing: Column) -> Column:
    at = F.pmod(F.floor(F.pmod(bearing, F.lit(360.0)) / 22.5 + 0.5).cast("int"), F.lit(16))
    return F.when(bearing.isNotNull(), F.element_at(F.array(*map(F.lit, COMPASS)), at + 1))


def circular_mean(bearing: Column) -> Column:
    """Aggregate: mean direction in degrees, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(F.radians(bearing))), F.avg(F.cos(F.radians(bearing))))), F.lit(360.0))


def wind_parts(speed: Column, from_degrees: Column) -> tuple[Column, Column]:
    """East and north parts of a wind that blows from a direction."""
    return -speed * F.sin(F.radians(from_degrees)), -speed * F.cos(F.radians(from_degrees))


def onshore(speed: Column, from_degrees: Column, seaward_degrees: Column) -> Column:
    return speed * F.cos(F.radians(from_degrees - seaward_degrees))


# --- time


def local_cutoff_utc(day: Column, hour: int = 5, zone: str = "America/Los_Angeles") -> Column:
    """The instant, in UTC, of an hour of local time on a day; follows daylight saving."""
    return F.to_utc_timestamp(day.cast("timestamp") + F.expr(f"INTERVAL {hour} HOURS"), zone)


def any_timestamp(c: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def effective_end(started: Column, ended: Column, days: int = OPEN_DAYS) -> Column:
    return F.coalesce(ended, started + F.expr(f"INTERVAL {days} DAYS"))


def season(day: Column) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * F.dayofyear(day) / 365.25
    return F.sin(angle), F.cos(angle)


def winter(day: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * (F.dayofyear(day) - 15) / 365.25)


def lunar_tide(day: Column, epoch: str = "2000-01-06") -> Column:
    phase = F.pmod(F.datediff(day, F.lit(epoch).cast("date")).cast("double"), F.lit(LUNAR_DAYS)) / LUNAR_DAYS
    return F.lit(1.5) * F.cos(2 * math.pi * phase)


def freshness(age_days: Column) -> Column:
    return F.when(age_days.isNull(), 0.0).otherwise(F.exp(-(age_days - 1) / 3.0))


# --- bands and serving rules


def risk_band(p: Column) -> Column:
    return ladder(p, [0.2, 0.5], ["low", "moderate", "high"], None)


def recency_band(age: Column) -> Column:
    return ladder(age, [4, 8, 15, 31], ["fresh", "recent", "aging", "stale", "old"])


def serve_probability(p: Column, posted: Column, last_exceeded: Column) -> Column:
    """A posted site is at least at the posted floor, one whose last sample exceeded at the lower floor."""
    out = F.when(F.coalesce(last_exceeded, F.lit(False)), F.greatest(p, F.lit(PERSISTENCE_FLOOR))).otherwise(p)
    return F.when(F.coalesce(posted, F.lit(False)), F.greatest(out, F.lit(POSTED_FLOOR))).otherwise(out)


def persistence_estimate(ratio: Column) -> Column:
    return clip(0.5 + 0.4 * (ratio - 1), 0.03, 0.97)


def route_weight(age: Column) -> Column:
    """0 for fresh samples, 1 for stale ones, a ramp between 3 and 5 days; unknown age is stale."""
    return F.when(age.isNull(), 1.0).otherwise(F.least(F.greatest((age - 3) / 2.0, F.lit(0.0)), F.lit(1.0)))


def distributed_lag(columns: list[Column], half_life: float) -> Column:
    """Sum of lagged values with weights that halve."""
    return sum((F.coalesce(c, F.lit(0.0)) * (0.5 ** (i / half_life)) for i, c in enumerate(columns)), F.lit(0.0))


def rain_flags(mm: Column) -> tuple[Column, Column]:
    """Advisory rules at a tenth and a fifth of an inch."""
    return (F.coalesce(mm, F.lit(0.0)) >= 2.54).cast("int"), (F.coalesce(mm, F.lit(0.0)) >= 5.08).cast("int")
