"""Matching of stations and names."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from littoral.functions.core import tokens
from littoral.operators.dedupe import unique_lookup
from littoral.operators.spatial import within_km


def cascade(rows: DataFrame, row_id: str, layers: list[DataFrame], target: str) -> DataFrame:
    """The match of the first layer that has one; each layer holds (row_id, target)."""
    tagged = reduce(lambda a, b: a.unionByName(b), [m.select(row_id, F.col(target), F.lit(i).alias("layer")) for i, m in enumerate(layers)])
    best = tagged.where(F.col(target).isNotNull()).groupBy(row_id).agg(F.min(F.struct("layer", target)).alias("_m"))
    return rows.join(best, row_id, "left").withColumns({target: F.col(f"_m.{target}"), "layer": F.col("_m.layer")}).drop("_m")


def crosswalk(rows: DataFrame, stations: DataFrame, km: float = 0.5) -> DataFrame:
    """Rows (row_id, code, county, name, lat, lon) to stations (station, code, county, name, lat, lon):
    code and county, then a code that is unique, then the name in the county, then the nearest within ``km``."""
    by_code = rows.join(unique_lookup(stations, ["code", "county"], "station"), ["code", "county"])
    by_unique = rows.join(unique_lookup(stations, ["code"], "station"), "code")
    lower = stations.withColumn("_n", F.lower("name"))
    by_name = rows.withColumn("_n", F.lower("name")).join(unique_lookup(lower, ["_n", "county"], "station"), ["_n", "county"])
    near = within_km(rows.select("row_id", "county", "lat", "lon"), stations.select("station", "county", "lat", "lon"), km).where(F.col("county") == F.col("r_county"))
    by_place = near.groupBy("row_id").agg(F.min(F.struct("km", F.col("r_station").alias("s")))["s"].alias("station"))
    return cascade(rows, "row_id", [by_code, by_unique, by_name, by_place], "station")


def token_set_ratio(a: list[str], b: list[str]) -> float:
    """Likeness of two token lists, 0 to 100: the best ratio between what they share and either with its rest."""
    x, y = set(a), set(b)
    if not x or not y:
        return 0.0
    shared, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if shared and (not left or not right):
        return 100.0
    one, two = (f"{shared} {left}".strip(), f"{shared} {right}".strip())
    return max(indel_ratio(shared, one) if shared else 0.0, indel_ratio(shared, two) if shared else 0.0, indel_ratio(one, two))


def indel_ratio(a: str, b: str) -> float:
    """100 times twice the longest common subsequence over the total length."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for ch in a:
        before = 0
        for j, other in enumerate(b, 1):
            keep = row[j]
            row[j] = before + 1 if ch == other else max(row[j], row[j - 1])
            before = keep
    return 200.0 * row[-1] / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(list(x), list(y)) for x, y in zip(a, b, strict=True)])


def _can_be_like(a: Column, b: Column, least: float) -> Column:
    """Whether the likeness of two token arrays can reach ``least``: edits are no more than the characters apart."""
    shared, left, right = (F.array_join(F.array_sort(x), " ") for x in (F.array_intersect(a, b), F.array_except(a, b), F.array_except(b, a)))
    one, two = F.trim(F.concat_ws(" ", shared, left)), F.trim(F.concat_ws(" ", shared, right))

    def near(x: Column, y: Column) -> Column:
        return F.levenshtein(x, y) <= (1 - least / 100) * (F.length(x) + F.length(y)) + 1e-9

    return (left == "") | (right == "") | near(one, two) | ((shared != "") & (near(shared, one) | near(shared, two)))


def resolve(names: DataFrame, catalogue: DataFrame, aliases: DataFrame, least: float = 90.0, margin: float = 20.0) -> DataFrame:
    """Names (name_id, name) to a catalogue (target, label) and aliases (alias, target).

    Layers: the exact normalised label, an alias, a label whose tokens open the name (the
    longest), then the best likeness of at least ``least`` that leads the next by ``margin``.
    Equal names are resolved once. Labels and names meet on a shared token, never all against all, and pairs
    whose edit distance rules out a likeness that could matter go before any is scored in Python.
    """
    key: Column = F.array_join(tokens(F.col("name")), " ")
    left = names.withColumns({"_key": key, "_tok": tokens(F.col("name"))})
    labels = catalogue.withColumns({"_key": F.array_join(tokens(F.col("label")), " "), "_ltok": tokens(F.col("label"))})
    exact = left.join(unique_lookup(labels, ["_key"], "target"), "_key")
    other = left.join(unique_lookup(aliases.withColumn("_key", F.array_join(tokens(F.col("alias")), " ")), ["_key"], "target"), "_key")
    # anchored: the label's first token opens the name
    opened = left.withColumn("_first", F.get("_tok", F.lit(0))).join(labels.select("target", "_ltok", F.get("_ltok", F.lit(0)).alias("_first")), "_first")
    opened = opened.where(F.slice("_tok", F.lit(1), F.size("_ltok")) == F.col("_ltok"))
    longest = opened.groupBy("name_id").agg(F.max_by("target", F.struct(F.size("_ltok"), -F.xxhash64("target"))).alias("target"))
    done = exact.select("name_id").union(other.select("name_id")).union(longest.select("name_id")).distinct()
    open_ = left.join(done, "name_id", "left_anti")
    distinct = open_.select("_key", "_tok").distinct()
    met = distinct.withColumn("_t", F.explode(F.array_distinct("_tok"))).join(labels.select("target", "_ltok", F.explode(F.array_distinct("_ltok")).alias("_t")), "_t").select("_key", "_tok", "target", "_ltok")
    # a likeness below ``least - margin`` neither wins nor takes the lead from a winner
    met = met.where(_can_be_like(F.col("_tok"), F.col("_ltok"), least - margin)).distinct()
    w = Window.partitionBy("_key").orderBy(F.desc("s"), "target")
    scored = met.withColumn("s", likeness("_tok", "_ltok")).withColumns({"_r": F.row_number().over(w), "_next": F.lead("s").over(w)})
    best = scored.where((F.col("_r") == 1) & (F.col("s") >= least) & (F.col("s") - F.coalesce("_next", F.lit(0.0)) >= margin))
    fuzzy = open_.select("name_id", "_key").join(best.select("_key", "target"), "_key")
    return cascade(names, "name_id", [exact, other, longest, fuzzy], "target")
