"""Logistic fits by group, calibration by level, and boosted residuals.

Fits need sums only: each Newton step is one aggregation over all rows of all groups at once, so
neither the number of rows nor a hot group meets a limit. Rows with equal features are counted
first. Coefficients are as many as groups times features and are solved on the driver.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from littoral.functions.core import clip, expit, logit
from littoral.session import cut

STEPS = 25


def counted(rows: DataFrame, keys: list[str], features: list[str], label: str, offset: str | None = None) -> DataFrame:
    """One row per distinct keys, features and offset with the counts ``_n`` and ``_pos``."""
    same = [*keys, *features, *([offset] if offset else [])]
    return rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("long")).alias("_pos"))


def _linear(features: list[str], weights: Column, offset: str | None) -> Column:
    """The intercept is the last weight."""
    start = F.col(offset) if offset else F.lit(0.0)
    return reduce(lambda acc, x: acc + x, [F.col(c) * F.get(weights, F.lit(i)) for i, c in enumerate(features)], start + F.get(weights, F.lit(len(features))))


def group_logits(cells: DataFrame, group: str, features: list[str], offset: str | None = None, ridge: float = 1e-4, intercept_ridge: float = 0.0) -> dict:
    """cells: (group, features, _n, _pos). Weights of each group, the intercept last; groups of one class have none.

    Minimises the log loss plus ``ridge / 2`` times the squared weights, by Newton's method with halved steps.
    """
    spark, size = cells.sparkSession, len(features) + 1
    cells = cut(cells)  # read by every step
    kind = cells.schema[group].dataType.simpleString()
    # one row per group
    known = {r[group]: (r._n, r._pos) for r in cells.groupBy(group).agg(F.sum("_n").alias("_n"), F.sum("_pos").alias("_pos")).collect()}
    weights = {g: np.zeros(size) for g, (n, pos) in known.items() if 0 < pos < n}
    penalty = np.array([ridge] * len(features) + [intercept_ridge])
    best: dict = {}
    todo, step = set(weights), {g: np.zeros(size) for g in weights}
    x = [F.col(c).cast("double") for c in features] + [F.lit(1.0)]
    for _ in range(4 * STEPS):
        if not todo:
            break
        table = spark.createDataFrame([(g, [float(w) for w in weights[g]]) for g in todo], f"`{group}` {kind}, _w array<double>")
        at = cells.join(F.broadcast(table), group).withColumn("_z", _linear(features, F.col("_w"), offset)).withColumn("_p", 1 / (1 + F.exp(-F.col("_z"))))
        # log(1 + exp(z)) without overflow
        loss = F.sum(F.col("_n") * (F.greatest(F.col("_z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_z")))) - F.col("_pos") * F.col("_z"))
        curve = F.col("_n") * F.col("_p") * (1 - F.col("_p"))
        sums = [F.sum(a * (F.col("_n") * F.col("_p") - F.col("_pos"))) for a in x] + [F.sum(curve * x[i] * x[j]) for i in range(size) for j in range(i, size)]
        for row in at.groupBy(group).agg(loss.alias("loss"), *[s.alias(f"s{i}") for i, s in enumerate(sums)]).collect():
            g, w = row[group], weights[row[group]]
            now = row.loss + float(penalty @ (w * w)) / 2
            if g in best and now > best[g][0] + 1e-12 * abs(now):  # too far: half the step
                step[g] = step[g] / 2
                weights[g] = best[g][1] - step[g]
                if np.abs(step[g]).max() < 1e-8:
                    weights[g] = best[g][1]
                    todo.discard(g)
                continue
            best[g] = (now, w.copy())
            grad = np.array([row[f"s{i}"] for i in range(size)]) + penalty * w
            hessian = np.zeros((size, size))
            hessian[np.triu_indices(size)] = [row[f"s{size + i}"] for i in range(size * (size + 1) // 2)]
            hessian = hessian + np.triu(hessian, 1).T + np.diag(penalty)
            step[g] = np.linalg.lstsq(hessian, grad, rcond=None)[0]
            weights[g] = w - step[g]
            if grad @ step[g] <= 1e-10 * max(1.0, abs(now)):  # what is left to gain is lost in rounding
                best[g] = (now, weights[g])
                todo.discard(g)
    return {g: [float(v) for v in best[g][1]] for g in best}


def weight_table(rows: DataFrame, weights: dict, group: str) -> DataFrame:
    kind = rows.schema[group].dataType.simpleString()
    return rows.sparkSession.createDataFrame([(g, w) for g, w in weights.items()], f"`{group}` {kind}, _w array<double>")


def with_probability(rows: DataFrame, weights: dict, group: str, features: list[str], offset: str | None = None) -> DataFrame:
    """``rows`` with ``p`` by the weights of their group; null where it has none."""
    table = weight_table(rows, weights, group)
    return rows.join(F.broadcast(table), group, "left").withColumn("p", F.when(F.col("_w").isNotNull(), expit(_linear(features, F.col("_w"), offset)))).drop("_w")


def walk_forward_fits(rows: DataFrame, day: str, features: list[str], label: str, years: int = 4, ridge: float = 1e-4) -> DataFrame:
    """Every month scored by a logistic fit on the ``years`` before it. Adds ``month`` (its first day) and ``p``.

    All months are fitted together: a counted row names the later months whose window it is in.
    """
    rows = rows.withColumn("month", F.trunc(day, "month"))
    months = sorted(r.month for r in rows.select("month").distinct().collect())  # one row per month
    listed = F.array(*[F.lit(m) for m in months])
    cells = counted(rows, ["month"], features, label)
    window = F.filter(listed, lambda m: (m > F.col("month")) & (F.add_months(m, -12 * years) <= F.col("month")))
    fits = group_logits(cells.withColumn("refit", F.explode(window)).drop("month").groupBy("refit", *features).agg(F.sum("_n").alias("_n"), F.sum("_pos").alias("_pos")), "refit", features, ridge=ridge)
    return with_probability(rows, fits, "month", features)


def held_out_fits(rows: DataFrame, group: str, features: list[str], label: str, ridge: float = 1e-4) -> DataFrame:
    """Every row scored by a logistic fit on all other groups, as ``p``; folds are fitted together."""
    cells = counted(rows, [group], features, label)
    folds = [r[group] for r in cells.select(group).distinct().collect()]  # one row per fold
    other = F.filter(F.array(*[F.lit(g) for g in folds]), lambda g: g != F.col(group))
    spread = cells.withColumn("fold", F.explode(other)).groupBy("fold", *features).agg(F.sum("_n").alias("_n"), F.sum("_pos").alias("_pos"))
    fits = group_logits(spread, "fold", features, ridge=ridge)
    return with_probability(rows, fits, group, features)


def scoped_fits(rows: DataFrame, scopes: list[str], features: list[str], label: str, least: int = 50, ridge: float = 1e-4) -> DataFrame:
    """Logistic fits per scope, the finest first, and over all rows; a row is scored by the finest scope that has
    ``least`` rows and both outcomes. Adds ``scope`` and ``p``."""
    out = rows.withColumn("scope", F.lit(None).cast("string")).withColumn("p_scoped", F.lit(None).cast("double"))
    for name in [*scopes, None]:
        keyed, key = (out, name) if name else (out.withColumn("_all", F.lit(0)), "_all")
        cells = counted(keyed.where(F.col(key).isNotNull()), [key], features, label)
        enough = cells.groupBy(key).agg(F.sum("_n").alias("_rows")).where(F.col("_rows") >= (least if name else 1)).select(key)
        weights = group_logits(cells.join(enough, key, "left_semi"), key, features, ridge=ridge)
        table = weight_table(keyed, weights, key).withColumnRenamed("_w", "_own")
        own = expit(_linear(features, F.col("_own"), None))
        better = F.col("scope").isNull() & F.col("_own").isNotNull()
        joined = keyed.join(F.broadcast(table), key, "left").withColumn("p_scoped", F.when(better, own).otherwise(F.col("p_scoped")))
        out = joined.withColumn("scope", F.when(better, F.lit(name or "all")).otherwise(F.col("scope"))).select(*rows.columns, "scope", "p_scoped")
    return out.withColumn("p", F.col("p_scoped")).drop("p_scoped")


class LevelCalibrator:
    """M4: calibration of log-odds with partial pooling: county slope and intercept shrink to the whole, site and
    station intercepts to their county, by their rows.

    The fits have a unit ridge on the slope, as the usual default of that learner.
    """

    def __init__(self, outer: str = "county", inner: str = "site", last: str | None = "station", strengths: tuple[float, float, float] = (64.0, 24.0, 24.0), least: tuple[int, int, int] = (24, 8, 16)):
        self.outer, self.inner, self.last, self.strengths, self.least = outer, inner, last, strengths, least
        self.whole, self.outers, self.offsets, self.variance = (0.0, 1.0), None, {}, 0.05

    def fit(self, rows: DataFrame, score: str, label: str) -> LevelCalibrator:
        rows = rows.withColumn("l", logit(F.col(score))).withColumn("y", F.col(label).cast("long"))
        self.p = score
        every = group_logits(counted(rows.withColumn("g", F.lit(0)), ["g"], ["l"], "y"), "g", ["l"], ridge=1.0)
        if 0 in every:
            self.whole = (every[0][1], every[0][0])
        cells = counted(rows, [self.outer], ["l"], "y").where(F.col(self.outer).isNotNull())
        sizes = cells.groupBy(self.outer).agg(F.sum("_n").alias("rows"))
        enough = cells.join(sizes.where(F.col("rows") >= self.least[0]).select(self.outer), self.outer, "left_semi")
        fits = group_logits(enough, self.outer, ["l"], ridge=1.0)
        table = weight_table(rows, fits, self.outer).join(sizes, self.outer)
        weight = F.col("rows") / (F.col("rows") + self.strengths[0])

        def pooled(i: int, base: float) -> Column:
            return F.lit(base) * (1 - weight) + F.get("_w", F.lit(i)) * weight

        self.outers = table.select(self.outer, pooled(1, self.whole[0]).alias("outer_a"), pooled(0, self.whole[1]).alias("outer_b"), F.col("rows").alias("outer_n"))
        for i, name in enumerate([self.inner, self.last][: 2 if self.last else 1], 1):
            z = self._linear(rows)  # the first offsets count for the second level, as they are fitted in turn
            per = z.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"), F.sum("y").alias("_p"), F.avg(expit(F.col("z" if i == 1 else "z_outer"))).alias("_m"))
            offset = (logit((F.col("_p") + 0.5) / (F.col("_n") + 1)) - logit(F.col("_m"))) * F.col("_n") / (F.col("_n") + self.strengths[i])
            self.offsets[name] = per.where(F.col("_n") >= self.least[i]).select(name, offset.alias(f"offset_{i}"), F.col("_n").alias(f"n_{i}"))
        miss = F.col("y") - expit(F.col("z"))
        self.variance = max(0.01, self._linear(rows).agg(F.var_pop(miss)).first()[0] or 0.01)
        return self

    def _linear(self, rows: DataFrame) -> DataFrame:
        out = rows.withColumn("l", logit(F.col(self.p))).join(self.outers, self.outer, "left")
        out = out.withColumn("z_outer", F.coalesce("outer_a", F.lit(self.whole[0])) + F.coalesce("outer_b", F.lit(self.whole[1])) * F.col("l")).withColumn("z", F.col("z_outer"))
        for i, (name, table) in enumerate(self.offsets.items(), 1):
            out = out.join(table, name, "left").withColumn("z", F.col("z") + F.coalesce(f"offset_{i}", F.lit(0.0)))
        return out

    def transform(self, rows: DataFrame, z: float = 1.64) -> DataFrame:
        """``rows`` with ``calibrated, low, high``; unknown keys have the calibration of the level above."""
        out, counts = self._linear(rows), ["outer_n", "n_1", "n_2"]
        spread = reduce(lambda acc, c: acc + (1 / (F.coalesce(c, F.lit(0)) + 1) if c in out.columns else F.lit(1.0)), counts, F.lit(self.variance))
        half = z * F.sqrt(spread)
        return out.select(*rows.columns, expit(F.col("z")).alias("calibrated"), expit(F.col("z") - half).alias("low"), expit(F.col("z") + half).alias("high"))


def two_tier(rows: DataFrame, key: str, features: list[str], label: str, stale: dict[str, Column], draws: int = 12, ratio: float = 2.0, strength: float = 4.0, ridge: float = 1e-4, tie: str | None = None) -> DataFrame:
    """M7: level and deviation: each site's shrunk log-odds are a fixed offset, on top of which an ensemble explains
    departures from it. ``stale`` replaces features in a second copy of the rows, as they look on days without a sample.

    Every draw takes all positives and a hash-drawn share of the negatives; all draws are fitted together. The
    learner is a logistic one. Returns ``rows`` with ``margin`` and ``p``, the mean of the draws.
    """
    y = F.col(label).cast("int")
    per = rows.groupBy(key).agg(F.sum(y).alias("_p"), F.count(F.lit(1)).alias("_n"))
    whole = per.agg((F.sum("_p") / F.sum("_n")).alias("_g"))  # one row
    margin = logit((F.col("_p") + strength * F.col("_g")) / (F.col("_n") + strength))
    margins = per.join(F.broadcast(whole)).select(key, margin.alias("margin"))
    fresh = rows.join(margins, key)
    both = fresh.withColumn("_copy", F.lit(0)).unionByName(fresh.withColumns(stale).withColumn("_copy", F.lit(1)))
    counts = {int(r["y"]): r["n"] for r in both.groupBy(y.alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = min(1.0, ratio * counts.get(1, 0) / max(1, counts.get(0, 1)))
    names = F.array(*[F.lit(i) for i in range(draws)])
    own = [tie] if tie else [key, *features]
    taken = F.filter(names, lambda i: (y == 1) | (F.pmod(F.xxhash64(i, "_copy", *own), F.lit(1 << 20)) < share * (1 << 20)))
    cells = counted(both.withColumn("draw", F.explode(taken)), ["draw"], features, label, "margin")
    fits = group_logits(cells, "draw", features, "margin", ridge=ridge)
    z = [expit(_linear(features, F.array(*[F.lit(float(w)) for w in weights]), "margin")) for _, weights in sorted(fits.items())]
    return fresh.withColumn("p", reduce(lambda a, b: a + b, z) / len(z) if z else expit(F.col("margin")))


# --- boosted residuals


def _tree(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, depth: int, least: int, l2: float, rows: np.ndarray) -> list | float:
    """A tree over binned features: [feature, last bin on the left, left, right] or a leaf's value."""
    n, total = weight[rows].sum(), (target[rows] * weight[rows]).sum()
    leaf = total / (n + l2)
    if not depth:
        return float(leaf)
    best = (1e-12, None)
    for f in range(bins.shape[1]):
        w = np.bincount(bins[rows, f], weight[rows])
        t = np.bincount(bins[rows, f], target[rows] * weight[rows])
        wl, tl = np.cumsum(w)[:-1], np.cumsum(t)[:-1]
        ok = (wl >= least) & (n - wl >= least)
        if ok.any():
            gain = np.where(ok, tl**2 / (wl + l2) + (total - tl) ** 2 / (n - wl + l2) - total**2 / (n + l2), -1)
            at = int(gain.argmax())
            if gain[at] > best[0] * (1 + 1e-9):
                best = (float(gain[at]), (f, at))
    if best[1] is None:
        return float(leaf)
    f, at = best[1]
    left = bins[rows, f] <= at
    return [f, at, _tree(bins, target, weight, depth - 1, least, l2, rows[left]), _tree(bins, target, weight, depth - 1, least, l2, rows[~left])]


def _leaves(tree: list | float, bins: np.ndarray) -> np.ndarray:
    if not isinstance(tree, list):
        return np.full(len(bins), tree)
    f, at, low, high = tree
    return np.where(bins[:, f] <= at, _leaves(low, bins), _leaves(high, bins))


def boosted(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 50, rate: float = 0.05, depth: int = 3, least: int = 8, l2: float = 1.0) -> np.ndarray:
    """Fitted values of shallow trees boosted on squared error over weighted cells; the start is the weighted mean."""
    out = np.full(len(target), np.average(target, weights=weight))
    for _ in range(rounds):
        out = out + rate * _leaves(_tree(bins, target - out, weight, depth, least, l2, np.arange(len(target))), bins)
    return out


def _below(column: str):
    return lambda x: x < F.col(column)


def station_residuals(rows: DataFrame, key: str, score: str, label: str, features: list[str], least: int = 30, bound: float = 0.30, bins: int = 32) -> DataFrame:
    """M9: per station a boosted correction of the residual, for stations with enough rows whose residuals vary.

    Features are cut into bins at common quantiles and rows are summed per station and cell first, so a
    station's task holds cells, however many rows it has. Adds ``residual`` (within the bound) and
    ``corrected`` (0.001 to 0.999 where there is a correction).
    """
    cut = [f"{c}_bin" for c in features]
    edges = rows.approxQuantile(features, [i / bins for i in range(1, bins)], 0.001)  # bins - 1 numbers per feature
    for c, name, e in zip(features, cut, edges, strict=True):
        # a missing value has the last bin of its own
        place = F.size(F.filter(F.array(*[F.lit(float(x)) for x in sorted(set(e))] or [F.lit(0.0)]), _below(c)))
        rows = rows.withColumn(name, F.when(F.col(c).isNull(), bins).otherwise(place))
    miss = F.col(label).cast("double") - F.col(score)
    cells = rows.groupBy(key, *cut).agg(F.count(F.lit(1)).alias("n"), F.sum(miss).alias("miss"))
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.stddev_pop(miss).alias("spread")).where((F.col("rows") >= least) & (F.col("spread") >= 1e-4))
    kind = rows.schema[key].dataType.simpleString()

    def fit(of: pd.DataFrame) -> pd.DataFrame:
        of = of.sort_values(cut, kind="stable")
        weight = of.n.to_numpy(float)
        value = boosted(of[cut].to_numpy(np.int64), of.miss.to_numpy() / weight, weight)
        return of[[key, *cut]].assign(residual=np.clip(value, -bound, bound))

    schema = ", ".join([f"`{key}` {kind}", *[f"`{c}` int" for c in cut], "residual double"])
    found = cells.join(sizes.select(key), key, "left_semi").groupBy(key).applyInPandas(fit, schema)
    out = rows.join(found, [key, *cut], "left").drop(*cut)
    return out.withColumn("corrected", F.when(F.col("residual").isNull(), F.col(score)).otherwise(clip(F.col(score) + F.col("residual"), 0.001, 0.999))).withColumn("residual", F.coalesce("residual", F.lit(0.0)))

