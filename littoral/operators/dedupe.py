"""Duplicate handling and merges of sources."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under an order; give a tiebreak in it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def worst_of_day(obs: DataFrame, keys: list[str], exceeds: str, value: str, time: str, tie: str) -> DataFrame:
    """The worst sample of a site and day: exceeding first, then the highest value, then the last."""
    return keep_one(obs, keys, [F.desc(exceeds), F.desc_nulls_last(value), F.desc_nulls_last(time), F.desc(tie)])


def last_values(df: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """The last non-null value per column, not the last row."""
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def union_aligned(*frames: DataFrame) -> DataFrame:
    """Union all by name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fill_gaps(base: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """U8: rows of ``extra`` whose key ``base`` lacks are added; nothing is displaced."""
    return base.unionByName(extra.join(base.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def refresh_part(base: DataFrame, fresh: DataFrame, part: Column, keys: list[str], order: list[Column]) -> DataFrame:
    """Within one part of the table, old and fresh rows merge by key; the rest is untouched."""
    merged = keep_one(base.where(part).unionByName(fresh, allowMissingColumns=True), keys, order)
    return base.where(~F.coalesce(part, F.lit(False))).unionByName(merged, allowMissingColumns=True)


def mirror_collapse(df: DataFrame, exact: list[str], mirror: list[str], source: str, priority: list[str], tie: str) -> DataFrame:
    """First copies within a source go, then copies of one sample across sources; the earlier source in ``priority`` stays."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, priority)), F.col(source)).cast("int"), F.lit(0))
    once = keep_one(df, [*exact, source], [F.asc(tie)])
    return keep_one(once.withColumn("_p", F.when(rank == 0, len(priority) + 1).otherwise(rank)), mirror, [F.asc("_p"), F.asc(tie)]).drop("_p")


def unique_lookup(pairs: DataFrame, keys: list[str], target: str) -> DataFrame:
    """Key to target where the key names one target only."""
    return pairs.where(F.col(target).isNotNull()).groupBy(*keys).agg(F.min(target).alias(target), F.count_distinct(target).alias("_targets")).where("_targets = 1").drop("_targets")


def rebind(df: DataFrame, pairs: DataFrame, keys: list[str], target: str) -> DataFrame:
    """``target`` from the unambiguous lookup where there is one, else as it was."""
    found = unique_lookup(pairs, keys, target).withColumnRenamed(target, "_new")
    return df.join(found, keys, "left").withColumn(target, F.coalesce("_new", target)).drop("_new")


def carry_forward(old: DataFrame, fresh: DataFrame, key: str, time: str, now) -> DataFrame:
    """Still-future rows of keys that are missing from ``fresh`` are kept."""
    kept = old.join(fresh.select(key).distinct(), key, "left_anti").where(F.col(time) >= now)
    return fresh.unionByName(kept, allowMissingColumns=True)


def group_size(df: DataFrame, keys: list[str], name: str = "group_size") -> DataFrame:
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def group_distinct(df: DataFrame, keys: list[str], column: str, name: str = "group_distinct") -> DataFrame:
    """Distinct counts in a window are not supported, a set's size is."""
    return df.withColumn(name, F.size(F.collect_set(column).over(Window.partitionBy(*keys))).cast("long"))


def gap_clusters(df: DataFrame, keys: list[str], time: str, minutes: int, tie: str) -> DataFrame:
    """A new cluster starts where the gap to the row before exceeds ``minutes``."""
    w = Window.partitionBy(*keys).orderBy(time, tie)
    gap = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lag(time).over(w).cast("timestamp"))
    start = F.when(gap > minutes * 60_000_000, 1).otherwise(0)
    return df.withColumn("_start", start).withColumn("cluster", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_start")


def collapse_physical(df: DataFrame, keys: list[str], time: str, value: str, source: str, tie: str, minutes: int = 30) -> DataFrame:
    """Samples of several sources that describe one physical sample become one.

    Two rows of different sources are one sample if their values agree and they lie within
    ``minutes`` of the unit's first row; each unit holds a source at most once. Units form
    greedily in order of time and tie. Only rows of one value without a gap of more than ``minutes``
    can be a unit, so clusters of one row or one source never enter Python; the others pass
    through it in order, in one step a row. Rows without a value are units of their own.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    w = Window.partitionBy(*keys, value).orderBy(time, tie)
    marked = df.withColumn("_new", F.when(at - F.lag(at).over(w) <= minutes * 60_000_000, 0).otherwise(1)).withColumn("_cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy(*keys, value, "_cluster")
    marked = marked.withColumn("_mixed", F.col(value).isNotNull() & (F.min(source).over(own) != F.max(source).over(own)))
    alone = marked.where("not coalesce(_mixed, false)").select(*df.columns)
    within, columns = minutes * 60_000_000, df.columns

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sources join a cluster's units in the order in which these began, so ``following``, the first unit
        # that a source has not joined, tells which one a row joins; ``begun`` holds times of units in reach.
        begun: deque[int] = deque()
        following: dict = {}
        gone = 0
        for batch in batches:
            kept = []
            for new, t, s in zip(*(batch.column(c).to_pylist() for c in ("_new", "_at", source)), strict=True):
                if new:
                    begun.clear()
                    following.clear()
                    gone = 0
                while begun and t - begun[0] > within:
                    begun.popleft()
                    gone += 1
                unit = max(following.get(s, 0), gone)
                following[s] = unit + 1
                fresh = unit == gone + len(begun)
                if fresh:
                    begun.append(t)
                kept.append(fresh)
            yield batch.select(columns).filter(pa.array(kept, pa.bool_()))

    many = marked.where("_mixed").withColumn("_at", at).repartition(*keys, value, "_cluster").sortWithinPartitions(*keys, value, "_cluster", time, tie)
    return alone.unionByName(many.drop("_mixed", "_cluster").mapInArrow(collapse, df.schema))
