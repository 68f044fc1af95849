"""Nearest, radius and neighbour joins, and parent groups.

Points meet through grid cells, so work follows the number of near pairs; no side is broadcast.
Bands of latitude are as high as the radius, and every band has as many cells of longitude as
are wide enough at its end towards the pole, counted around the globe. Nearest joins search a
radius that grows until the answer lies inside it, for those places that have none yet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from littoral.functions.core import haversine_km
from littoral.session import cut

KM_PER_DEGREE = math.pi * 6371.0 / 180
#: Half the way around the globe: no two places are further apart.
FARTHEST_KM = 180 * KM_PER_DEGREE


def cells(lat: Column, lon: Column, degrees: float) -> tuple[Column, Column]:
    """Numbers of the square cells of a grid in degrees."""
    return F.floor(lat / degrees).cast("long"), F.floor(lon / degrees).cast("long")


def _bands(km: float) -> float:
    """Height of a band in degrees, a little more than the radius."""
    return km / KM_PER_DEGREE * 1.001


def _cells_of(band: Column, km: float) -> Column:
    """Cells of longitude in a band: as wide as the radius or more at its end towards the pole."""
    step = _bands(km)
    edge = F.least(F.lit(90.0), F.greatest(F.abs(band * step), F.abs((band + 1) * step)))
    return F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(edge)) * (KM_PER_DEGREE / km))).cast("long")


def _cell(lon: Column, count: Column) -> Column:
    return F.pmod(F.floor((lon + 180.0) / 360.0 * count).cast("long"), count)


def within_km(left: DataFrame, right: DataFrame, km: float, lat: str = "lat", lon: str = "lon", same: list[str] | None = None) -> DataFrame:
    """Pairs within ``km`` that agree in the columns ``same``, with the distance ``km``. Right columns get the prefix ``r_``.

    A left place looks into the cells of its own band and both next to it that its circle can reach
    at its latitude, around the date line and, near a pole, all around; the exact distance decides.
    """
    step, angle = _bands(km), math.radians(km / KM_PER_DEGREE * 1.001)
    # half the width of a circle of this radius in longitude; beyond a pole it is all around
    if angle < math.pi / 2:
        ratio = math.sin(angle) / F.cos(F.radians(lat))
        reach = F.when(F.abs(lat) + math.degrees(angle) >= 90, F.lit(360.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), ratio))) + 1e-9)
    else:
        reach = F.lit(360.0)
    a = left.withColumn("_band", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda k: F.floor(F.col(lat) / step).cast("long") + k)))
    a = a.withColumn("_count", _cells_of(F.col("_band"), km)).withColumn("_reach", reach)
    first = F.floor((F.col(lon) - F.col("_reach") + 180.0) / 360.0 * F.col("_count")).cast("long")
    last = F.floor((F.col(lon) + F.col("_reach") + 180.0) / 360.0 * F.col("_count")).cast("long")
    around = F.when(last - first + 1 >= F.col("_count"), F.sequence(F.lit(0).cast("long"), F.col("_count") - 1)).otherwise(F.transform(F.sequence(first, last), lambda c: F.pmod(c, F.col("_count"))))
    a = a.withColumn("_cell", F.explode(around)).drop("_count", "_reach")
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withColumn("_band", F.floor(F.col(f"r_{lat}") / step).cast("long"))
    b = b.withColumn("_cell", _cell(F.col(f"r_{lon}"), _cells_of(F.col("_band"), km)))
    distance = haversine_km(F.col(lat), F.col(lon), F.col(f"r_{lat}"), F.col(f"r_{lon}"))
    agree = [f"_same{i}" for i in range(len(same or []))]
    a, b = (side.withColumns({n: F.col(prefix + c) for n, c in zip(agree, same or [], strict=True)}) for side, prefix in ((a, ""), (b, "r_")))
    return a.join(b, ["_band", "_cell", *agree]).withColumn("km", distance).where(F.col("km") <= km).drop("_band", "_cell", *agree)


def radius_features(left: DataFrame, right: DataFrame, id_column: str, km: float = 10.0, near: float = 1.0) -> DataFrame:
    """Counts within two radii and the least distance; points without a neighbour get 0 and null.

    Equal places act as one with their count, so pairs are those of different places.
    """
    spot = ["lat", "lon"]
    pairs = within_km(left.select(*spot).distinct(), right.groupBy(*spot).agg(F.count(F.lit(1)).alias("n")), km)
    per = pairs.groupBy(*spot).agg(F.sum("r_n").alias("_n"), F.sum(F.when(F.col("km") <= near, F.col("r_n")).otherwise(0)).alias("_near"), F.min("km").alias("_km"))
    per = left.select(id_column, *spot).join(per, spot).groupBy(id_column).agg(F.sum("_n").alias("assets"), F.sum("_near").alias("assets_near"), F.min("_km").alias("nearest_km"))
    return left.join(per, id_column, "left").withColumns({"assets": F.coalesce("assets", F.lit(0)), "assets_near": F.coalesce("assets_near", F.lit(0))})


def _spacing(points: DataFrame, lat: str, lon: str) -> float:
    """About the distance in degrees between neighbours, were the places spread evenly; 0 without places."""
    n, south, north, west, east = points.agg(F.count(F.lit(1)), F.min(lat), F.max(lat), F.min(lon), F.max(lon)).first()
    return math.sqrt(max((north - south) * (east - west), 1e-9) / n) if n else 0.0


def nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, most_km: float | None = None, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The nearest right place of each left one (the least id of equals), null beyond ``most_km``.

    The radius starts at the spacing of the right places and doubles for the left places that have
    found none, up to ``most_km`` or all around the globe. Rounds are checkpointed, and the last one
    that can matter ends it, so the result is the same at any size.
    """
    right = right.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(right_id, lat, lon)
    limit, spacing = min(most_km or FARTHEST_KM, FARTHEST_KM), _spacing(right, lat, lon)
    todo = left.select(left_id, lat, lon).where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).distinct()
    none = F.lit(None).cast(right.schema[right_id].dataType)
    found = left.select(left_id, none.alias("_id"), F.lit(None).cast("double").alias("_km")).limit(0)
    km = max(spacing * KM_PER_DEGREE, 0.01)
    while spacing:
        km = min(km, limit)
        best = cut(within_km(todo, right, km, lat, lon).groupBy(left_id).agg(F.min(F.struct("km", F.col(f"r_{right_id}").alias("id"))).alias("_m")))
        found = found.unionByName(best.select(left_id, F.col("_m.id").alias("_id"), F.col("_m.km").alias("_km")))
        todo = cut(todo.join(best.select(left_id), left_id, "left_anti"))
        if km >= limit or todo.isEmpty():
            break
        km *= 2
    return left.join(found.select(left_id, F.col("_id").alias(f"nearest_{right_id}"), F.col("_km").alias("nearest_km")), left_id, "left")


def neighbours(points: DataFrame, id_column: str, k: int, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(id, r_id, r_lat, r_lon, d2, place) of the k nearest others by squared difference in degrees, ties by id.

    The points of one spot share its k + 1 nearest points, less the point itself, and no spot gives more than its
    k + 1 least ids, so only spots are compared. Square cells as wide as the search radius; the radius doubles for
    spots with fewer points inside it.
    """
    points = points.select(id_column, lat, lon).where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    other, total = f"r_{id_column}", points.count()
    least = points.withColumn("_r", F.row_number().over(Window.partitionBy(lat, lon).orderBy(id_column))).where(F.col("_r") <= k + 1).drop("_r")
    right = cut(least.select(*[F.col(c).alias(f"r_{c}") for c in (id_column, lat, lon)]))
    todo, found = right.select(F.col(f"r_{lat}").alias(lat), F.col(f"r_{lon}").alias(lon)).distinct(), None
    width = _spacing(todo, lat, lon) * math.sqrt(k + 1)
    a, b = F.col(f"r_{lat}") - F.col(lat), F.col(f"r_{lon}") - F.col(lon)
    while True:
        cell = [F.floor(F.col(c) / width).cast("long") for c in (lat, lon)]
        spread = [F.explode(F.sequence(c - 1, c + 1)).alias(n) for c, n in zip(cell, ("_y", "_x"), strict=True)]
        near = todo.select("*", spread[0]).select("*", spread[1]).join(right.withColumns({"_y": F.floor(F.col(f"r_{lat}") / width).cast("long"), "_x": F.floor(F.col(f"r_{lon}") / width).cast("long")}), ["_y", "_x"])
        near = near.drop("_y", "_x").withColumn("d2", a * a + b * b)
        whole = width >= 360  # every place is in reach
        near = near if whole else near.where(F.col("d2") <= width * width)
        ranked = cut(near.withColumn("_place", F.row_number().over(Window.partitionBy(lat, lon).orderBy("d2", other))).where(F.col("_place") <= k + 1))
        full = ranked.groupBy(lat, lon).agg(F.count(F.lit(1)).alias("n")).where(F.lit(whole) | (F.col("n") >= min(k + 1, total))).select(lat, lon)
        done = ranked.join(full, [lat, lon], "left_semi")
        found = done if found is None else found.unionByName(done)
        todo = cut(todo.join(full, [lat, lon], "left_anti"))
        if whole or todo.isEmpty():
            break
        width *= 2
    lists = found.groupBy(lat, lon).agg(F.sort_array(F.collect_list(F.struct("_place", other, f"r_{lat}", f"r_{lon}", "d2"))).alias("_near"))
    own = points.join(lists, [lat, lon])
    others = F.slice(F.filter("_near", lambda x: x[other] != F.col(id_column)), 1, k)
    out = own.select(id_column, lat, lon, F.posexplode(others).alias("_i", "_o"))
    return out.select(id_column, lat, lon, *[F.col(f"_o.{c}").alias(c) for c in (other, f"r_{lat}", f"r_{lon}", "d2")], (F.col("_i") + 1).alias("place"))


def resolve_conflicts(matches: DataFrame, target: str, distance: str, tie: str) -> DataFrame:
    """The closest claimant keeps a target; the others lose it."""
    w = Window.partitionBy(target).orderBy(distance, tie)
    return matches.where(F.col(target).isNotNull()).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def shore_azimuth(points: DataFrame, id_column: str, k: int = 5, inland: tuple[float, float] = (37.0, -120.5), otherwise: float = 270.0) -> DataFrame:
    """The onshore direction of each place, in degrees clockwise from north.

    The shore runs along the principal axis of the k nearest other places (in local metres), which
    for a 2x2 covariance has a closed form: half the angle of (2 Sxy, Sxx - Syy). Of both normals the
    one that points to a place inland is onshore. Fewer than two neighbours give ``otherwise``.
    """
    scale = 111_320 * F.cos(F.radians("lat"))
    x, y = (F.col("r_lon") - F.col("lon")) * scale, (F.col("r_lat") - F.col("lat")) * 110_540
    near = neighbours(points, id_column, k).withColumns({"_x": x, "_y": y}).groupBy(id_column)
    near = near.agg(F.covar_pop("_x", "_y").alias("_xy"), F.var_pop("_x").alias("_xx"), F.var_pop("_y").alias("_yy"), F.count(F.lit(1)).alias("neighbours"))
    out = points.select(id_column, "lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).join(near, id_column, "left")
    angle = F.atan2(2 * F.col("_xy"), F.col("_xx") - F.col("_yy")) / 2  # of the shore, from east
    nx, ny = -F.sin(angle), F.cos(angle)
    inward = nx * (inland[1] - F.col("lon")) * scale + ny * (inland[0] - F.col("lat")) * 110_540
    sign = F.when(inward > 0, 1.0).otherwise(-1.0)
    azimuth = F.pmod(F.degrees(F.atan2(sign * nx, sign * ny)) + 360, F.lit(360.0))
    return out.select(id_column, F.coalesce("neighbours", F.lit(0)).alias("neighbours"), F.when(F.col("neighbours") >= 2, azimuth).otherwise(F.lit(float(otherwise))).alias("azimuth"))


def parent_groups(points: DataFrame, id_column: str, group: str, km: float = 3.0) -> DataFrame:
    """Connected places within ``km`` of each other inside a group: (id, parent), the parent being the least id.

    A round takes the least label among a place and its neighbours, then the label of that label, so
    chains shorten by half; it ends when a round changes nothing. Rounds are checkpointed. A group's
    points at one spot are one node; a point without a place or a group is its own parent.
    """
    known = F.lit(True)
    for c in ("lat", "lon"):
        known = known & F.col(c).isNotNull() & ~F.isnan(c)
    placed = points.where(known & F.col(group).isNotNull())
    spots = cut(placed.groupBy(group, "lat", "lon").agg(F.min(id_column).alias(id_column)))
    pairs = within_km(spots, spots, km, same=[group])
    edges = cut(pairs.select(F.col(id_column).alias("a"), F.col(f"r_{id_column}").alias("b")).where("a != b"))
    labels = cut(spots.select(F.col(id_column).alias("a"), F.col(id_column).alias("parent")))
    while True:
        spread = edges.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("parent").alias("low"))
        near = labels.join(spread, "a", "left").select("a", F.col("parent").alias("old"), F.least("parent", F.coalesce("low", "parent")).alias("near"))
        # the least label that reaches a place through those it labels, and the label of its own label
        through = near.groupBy(F.col("old").alias("a")).agg(F.min("near").alias("under"))
        pulled = near.join(through, "a", "left").select("a", "old", F.least("near", F.coalesce("under", "near")).alias("parent"))
        jump = pulled.select(F.col("a").alias("parent"), F.col("parent").alias("further"))
        new = cut(pulled.join(jump, "parent").select("a", F.least("parent", "further").alias("parent"), (F.least("parent", "further") < F.col("old")).alias("moved")))
        labels = new.drop("moved")
        if new.where("moved").isEmpty():
            break
    found = spots.join(labels.withColumnRenamed("a", id_column), id_column).drop(id_column)
    grouped = placed.select(id_column, group, "lat", "lon").join(found, [group, "lat", "lon"]).select(id_column, "parent")
    return grouped.unionByName(points.where(~known | F.col(group).isNull()).select(id_column, F.col(id_column).alias("parent")))


def parents(points: DataFrame, id_column: str, group: str, name: str, status: str, km: float = 3.0) -> DataFrame:
    """One row per parent: members, count, mean place, the longest name, the best status."""
    rows = points.join(parent_groups(points, id_column, group, km), id_column)
    best_name = F.max_by(name, F.struct(F.length(name), -F.col(id_column)))
    return rows.groupBy(group, "parent").agg(
        F.sort_array(F.collect_list(id_column)).alias("members"), F.count(F.lit(1)).alias("stations"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"),
        best_name.alias("name"), F.max(status).alias("status"),
    )
