"""Mixing sources to target weights [native].

Sizes are summed per source (map-side combined, so a source that holds a third of all rows
costs one row per task), targets are water-filled under a cap, and every document is emitted
``floor(rate)`` times plus one hash-seeded Bernoulli copy whose probability is the fraction.

Defined cases: a null or empty text has size 0 and is emitted by the same law as its source;
a null source is a source of its own that sorts last; repeated rows (same id, text and source)
share one coin; a very long text is one document, so a source of few documents can miss its target
by up to one copy of each; sources with equal ratios keep their order; an empty table gives an
empty mix. ``plan_mix`` replaces columns that bear the name of an output column and keeps all
others; ``mix`` gives back the input's columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from littoral.llm.common import WORD, Kept, Scratch, documents

#: The per-source table is broadcast up to this many rows and joined by shuffle beyond it.
BROADCAST_SOURCES = 20_000
SALTS = 32
WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0
PLAN = ("size", "source_size", "target", "rate", "copies")


def text_size(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> + target, rate.

    The rank of a source, which gives its weight, is its rank within a part of the sorted sources
    plus the rows of the parts before. Resharing the excess of capped sources by weight means one
    level: a target is ``min(cap * size, level * weight)``. Each round raises the level by what the
    sources over their cap leave, until none is added; sums are decimal, so reruns agree.
    """
    scratch = Scratch(sizes.sparkSession, "targets")
    order = F.col("source").asc_nulls_last()
    dealt = scratch.save(sizes.select("source", "source_size").repartitionByRange(order).withColumn("part", F.spark_partition_id()), "dealt")
    before, at = {}, 0
    for r in sorted(dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):  # a row per partition
        before[r.part], at = at, at + r.n
    if not before:
        return sizes.select("source", "source_size", F.lit(0.0).alias("target"), F.lit(1.0).alias("rate"))
    start = F.element_at(F.create_map(*[F.lit(x) for item in before.items() for x in item]), F.col("part"))
    rank = start + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(rank, F.lit(len(weights))).cast("int") + 1)
    table = scratch.save(dealt.withColumn("w", w).withColumn("most", F.lit(float(cap)) * F.col("source_size")), "weighed")
    exact = "decimal(38,6)"
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, over = 0.0, -1
    while True:
        free = F.lit(level) * F.col("w") <= F.col("most")
        capped, weight, n = table.agg(F.sum(F.when(~free, F.col("most").cast(exact))), F.sum(F.when(free, F.col("w").cast(exact))), F.count(F.when(~free, 1))).first()
        if n == over or not weight:
            break
        level, over = (total - float(capped or 0)) / float(weight), n
    target = F.least(F.col("most"), F.lit(level) * F.col("w"))
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), target / F.col("source_size"))).otherwise(F.lit(1.0))
    return table.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def plan_mix(docs: DataFrame, weights=WEIGHTS, cap: float = CAP, seed: int = 17) -> DataFrame:
    """Every document once, with ``size, source_size, target, rate, copies``."""
    kept = Kept(docs, "doc_id", "source", "text")
    return kept.back(_planned(kept.frame, weights, cap, seed), *PLAN)


def _planned(docs: DataFrame, weights, cap: float, seed: int) -> DataFrame:
    sized = docs.withColumn("size", text_size(F.col("text")))
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    table = Scratch(docs.sparkSession, "mix").save(targets(totals, weights, cap), "targets").withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    if table.count() <= BROADCAST_SOURCES:
        out = sized.join(F.broadcast(table), same, "left").drop("of")
    else:  # every source in SALTS parts, as one may hold a third of all rows
        sized = sized.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int"))
        spread = table.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = sized.join(spread, same & (F.col("salt") == F.col("of_salt"))).drop("of", "salt", "of_salt")
    coin = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "source", "text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    whole = F.floor("rate")
    return out.withColumn("copies", (whole + (coin < F.col("rate") - whole).cast("int")).cast("long"))


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = CAP, seed: int = 17) -> DataFrame:
    """The mixed corpus: each document as often as its plan says, with the columns of ``docs`` and no others."""
    kept = Kept(docs, "doc_id", "source", "text")
    planned = _planned(kept.frame, weights, cap, seed).where(F.col("copies") > 0)
    return kept.back(planned.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))))


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan_mix(documents(spark, sf_dir))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
