"""Forecast metrics over distinct scores.

Rows are first counted per distinct score (map-side combined), so the ordered part runs over
scores, not rows, and ties need no special care.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by_score(rows: DataFrame, score: str, label: str, keys: list[str]) -> DataFrame:
    y = F.col(label).cast("int")
    per = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*keys, F.col(score).alias("_s")).agg(F.sum(y).alias("_p"), F.sum(1 - y).alias("_n"))
    return _running(per, keys)


def _running(per: DataFrame, keys: list[str]) -> DataFrame:
    up = Window.partitionBy(*keys).orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    return per.withColumns({"_tp": F.sum("_p").over(up), "_fp": F.sum("_n").over(up), "_all_p": F.sum("_p").over(whole), "_all_n": F.sum("_n").over(whole)})


def ranking(rows: DataFrame, score: str, label: str, keys: list[str] = ()) -> DataFrame:
    """AUROC (ties count half) and average precision, per key; null where a class is missing."""
    per = _by_score(rows, score, label, list(keys))
    wins = F.sum(F.col("_p") * (F.col("_all_n") - F.col("_fp") + F.col("_n") / 2))
    precision = F.sum(F.col("_p") * F.col("_tp") / (F.col("_tp") + F.col("_fp")))
    pos, neg = F.max("_all_p"), F.max("_all_n")
    aggs = [(pos + neg).cast("long").alias("n"), pos.cast("long").alias("positives"), F.when((pos > 0) & (neg > 0), wins / (pos * neg)).alias("auroc"), F.when(pos > 0, precision / pos).alias("average_precision")]
    return per.groupBy(*keys).agg(*aggs) if keys else per.agg(*aggs)


def losses(rows: DataFrame, score: str, label: str, keys: list[str] = (), eps: float = 1e-6) -> DataFrame:
    """Brier score, log loss, root mean square error."""
    p, y = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps)), F.col(label).cast("double")
    square = F.avg(F.pow(F.col(score) - y, 2))
    aggs = [F.count(F.lit(1)).alias("n"), square.alias("brier"), F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"), F.sqrt(square).alias("rmse")]
    return rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)


def within_group_auroc(rows: DataFrame, score: str, label: str, key: str, least: int = 20, weight: str = "pairs") -> DataFrame:
    """Mean AUROC of groups; weighted by pairs of unlike rows, or by rows over groups of ``least`` rows."""
    per = ranking(rows, score, label, [key]).where("auroc is not null")
    if weight == "pairs":
        w = F.col("positives") * (F.col("n") - F.col("positives"))
    else:
        per, w = per.where(F.col("n") >= least), F.col("n")
    return per.agg(F.count(F.lit(1)).alias("groups"), (F.sum(F.col("auroc") * w) / F.sum(w)).alias("within_auroc"))


def sensitivity_at(rows: DataFrame, score: str, label: str, specificity: float = 0.87) -> DataFrame:
    """The highest sensitivity at a specificity of at least the wanted one."""
    per = _by_score(rows, score, label, [])
    ok = 1 - F.col("_fp") / F.col("_all_n") >= specificity
    return per.agg(F.coalesce(F.max(F.when(ok, F.col("_tp") / F.col("_all_p"))), F.lit(0.0)).alias("sensitivity"))


def precision_at(rows: DataFrame, score: str, label: str, recall: float = 0.8) -> DataFrame:
    """E5: the highest precision at a recall of at least the wanted one."""
    per = _by_score(rows, score, label, [])
    return per.agg(F.max(F.when(F.col("_tp") >= recall * F.col("_all_p"), F.col("_tp") / (F.col("_tp") + F.col("_fp")))).alias("precision"))


def reliability(rows: DataFrame, score: str, label: str, edges: list[float] | None = None, bins: int = 10) -> DataFrame:
    """Mean forecast and observed rate per bin, of given edges or equal width; the last bin is closed."""
    if edges is None:
        index = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    else:
        index = sum(((F.col(score) >= e).cast("int") for e in edges[1:-1]), F.lit(0))
    binned = rows.withColumn("bin", index)
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_forecast"), F.avg(F.col(label).cast("double")).alias("observed"))


def brier_diagnostics(rows: DataFrame, score: str, baseline: str, label: str, keys: list[str]) -> DataFrame:
    """Per group rows, positives, rates, bias, Brier scores and their difference."""
    y = F.col(label).cast("double")
    mine, base = F.avg(F.pow(F.col(score) - y, 2)), F.avg(F.pow(F.col(baseline) - y, 2))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("positives"), F.avg(y).alias("rate"), F.avg(score).alias("mean_forecast"), (F.avg(score) - F.avg(y)).alias("bias"),
        mine.alias("brier"), base.alias("brier_baseline"), (mine - base).alias("delta"),
    )


def confusion(rows: DataFrame, warned: Column, truth: Column, keys: list[str] = ()) -> DataFrame:
    """A21 and A24."""
    aggs = [F.count_if(warned & truth).alias("tp"), F.count_if(warned & ~truth).alias("fp"), F.count_if(~warned & truth).alias("fn"), F.count_if(~warned & ~truth).alias("tn")]
    return rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)


def crosstab_with_totals(rows: DataFrame, a: str, b: str, values: list[str]) -> DataFrame:
    """Counts of a by b, with a row and a column of totals named ``All``."""
    both = rows.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    named = both.select(F.when(F.col("_ga") == 1, "All").otherwise(F.col(a)).alias(a), F.when(F.col("_gb") == 1, "All").otherwise(F.col(b)).alias("_b"), "n")
    return named.groupBy(a).pivot("_b", [*values, "All"]).agg(F.sum("n")).na.fill(0, [*values, "All"])


def slices(rows: DataFrame, named: dict[str, Column], score: str, label: str) -> DataFrame:
    """Losses of overlapping populations in one pass: each row names the slices it is in."""
    tags = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in named.items()])))
    return losses(rows.withColumn("slice", tags), score, label, ["slice"])


def bootstrap(rows: DataFrame, cluster: str, score: str, label: str, replicates: int = 200, seed: int = 11) -> DataFrame:
    """Interval of the Brier score under resampled clusters.

    Clusters are summed once; each replicate weighs them by a Poisson(1) draw taken from a hash
    of (seed, replicate, cluster), so draws are the same in any partitioning.
    """
    y = F.col(label).cast("double")
    per = rows.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.pow(F.col(score) - y, 2)).alias("_e"))
    drawn = draws(per, cluster, replicates, seed)
    scores = drawn.groupBy("replicate").agg((F.sum(F.col("_e") * F.col("_w")) / F.sum(F.col("_n") * F.col("_w"))).alias("brier"))
    return scores.agg(F.count(F.lit(1)).alias("replicates"), F.percentile("brier", F.lit(0.025)).alias("low"), F.percentile("brier", F.lit(0.5)).alias("mid"), F.percentile("brier", F.lit(0.975)).alias("high"))


def draws(per: DataFrame, cluster: str, replicates: int, seed: int) -> DataFrame:
    """Every row of ``per`` once for each ``replicate``, with its cluster's draw ``_w``."""
    u = F.pmod(F.xxhash64(F.lit(seed), "replicate", cluster), F.lit(1 << 40)) / float(1 << 40)
    weight, total, term = F.lit(0), 0.0, 0.36787944117144233
    for k in range(1, 8):
        total += term
        weight = weight + (u >= total).cast("int")
        term /= k
    return per.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("_w", weight)


def bootstrap_pair(rows: DataFrame, cluster: str, a: str, b: str, label: str, replicates: int = 500, seed: int = 11) -> DataFrame:
    """Intervals of two models' metrics and of their paired gap under the same resampled clusters.

    One row per metric (aucpr, auroc, brier, within_auroc) and ``side`` (a, b, delta = a - b), with quantiles
    at 0.025, 0.05, 0.5, 0.95 and 0.975. Rows are counted per cluster, model and score; a replicate weighs
    these counts by its draws. Replicates without both classes are left out; fewer than two clusters give none.
    """
    y, name = F.col(label).cast("int"), F.coalesce(F.col(cluster).cast("string"), F.lit("\0"))
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("side"), F.col(c).cast("double").alias("_s")) for k, c in (("a", a), ("b", b))])).alias("x")
    valid = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull() & y.isNotNull()).select(name.alias("_c"), y.alias("_y"), both)
    per = valid.groupBy("_c", "x.side", "x._s").agg(F.sum("_y").alias("_p"), F.sum(1 - F.col("_y")).alias("_n"))
    enough = per.agg((F.count_distinct("_c") > 1).alias("_enough"))  # one row
    per = per.join(F.broadcast(enough)).where("_enough").drop("_enough")
    wins = F.sum(F.col("_p") * (F.col("_all_n") - F.col("_fp") + F.col("_n") / 2))
    pos, neg = F.max("_all_p"), F.max("_all_n")

    drawn = draws(per, "_c", replicates, seed).where("_w > 0")
    pooled = drawn.groupBy("replicate", "side", "_s").agg(F.sum(F.col("_p") * F.col("_w")).alias("_p"), F.sum(F.col("_n") * F.col("_w")).alias("_n"))
    ranked = _running(pooled, ["replicate", "side"]).where("_all_p > 0 and _all_n > 0").groupBy("replicate", "side")
    whole = ranked.agg(
        (F.sum(F.col("_p") * F.col("_tp") / (F.col("_tp") + F.col("_fp"))) / pos).alias("aucpr"), (wins / (pos * neg)).alias("auroc"),
        (F.sum(F.col("_p") * F.pow(1 - F.col("_s"), 2) + F.col("_n") * F.pow("_s", F.lit(2.0))) / (pos + neg)).alias("brier"),
    )
    groups = _running(per, ["_c", "side"]).groupBy("_c", "side").agg(wins.alias("_wins"), (pos * neg).alias("_pairs")).where("_pairs > 0")
    inner = draws(groups, "_c", replicates, seed).where("_w > 0").groupBy("replicate", "side").agg((F.sum(F.col("_wins") * F.col("_w")) / F.sum(F.col("_pairs") * F.col("_w"))).alias("within_auroc"))

    names = ("aucpr", "auroc", "brier", "within_auroc")
    tall = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in names])).alias("x")
    found = whole.join(inner, ["replicate", "side"], "left").select("replicate", "side", tall).where("x.v is not null").groupBy("replicate", "x.metric")
    sides = found.agg(F.max(F.when(F.col("side") == "a", F.col("x.v"))).alias("a"), F.max(F.when(F.col("side") == "b", F.col("x.v"))).alias("b")).withColumn("delta", F.col("a") - F.col("b"))
    each = sides.select("metric", F.explode(F.array(*[F.struct(F.lit(k).alias("side"), F.col(k).alias("v")) for k in ("a", "b", "delta")])).alias("x"))
    at = {"low": 0.025, "low_90": 0.05, "mid": 0.5, "high_90": 0.95, "high": 0.975}
    return each.groupBy("metric", "x.side").agg(F.count("x.v").alias("replicates"), *[F.percentile("x.v", F.lit(q)).alias(k) for k, q in at.items()])


def fingerprint(rows: DataFrame, *columns: Column) -> DataFrame:
    """One row that names a set of rows, the same for any order; sums of hashes need no sort."""
    h = F.xxhash64(*columns)
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("xor"), F.sum(h.cast("decimal(38,0)")).alias("total"))


def freshness(obs: DataFrame, key: str, day: str, today: str, window: int = 180) -> DataFrame:
    """Distinct days, the newest one, the median gap in the window, and whether the key is late."""
    now = F.lit(today).cast("date")
    days = obs.select(key, day).where(F.col(day) <= now).distinct()
    w = Window.partitionBy(key).orderBy(day)
    gaps = days.withColumn("_gap", F.when(F.col(day) >= F.date_sub(now, window), F.datediff(day, F.lag(day).over(w))))
    out = gaps.groupBy(key).agg(F.count(F.lit(1)).alias("days"), F.max(day).alias("newest"), F.median("_gap").alias("median_gap"))
    limit = F.greatest(F.lit(14.0), 3 * F.coalesce("median_gap", F.lit(0.0)))
    return out.withColumns({"age": F.datediff(now, "newest").cast("long"), "limit": limit}).withColumn("late", F.col("age") > F.col("limit"))
