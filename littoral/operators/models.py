"""Estimators and the rules around them."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from littoral.functions.core import clip, expit, through_knots
from littoral.operators import boosting


class OffsetLogit:
    """M1: logistic regression around a fixed log-odds offset, with a light ridge."""

    def __init__(self, features: list[str], offset: str, ridge: float = 1e-4):
        self.features, self.offset, self.ridge = features, offset, ridge
        self.weights: list[float] = []
        self.intercept = 0.0

    def fit(self, rows: DataFrame, label: str) -> OffsetLogit:
        ready = VectorAssembler(inputCols=self.features, outputCol="_x", handleInvalid="skip").transform(rows.withColumn("_y", F.col(label).cast("double")))
        model = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="_x", labelCol="_y", offsetCol=self.offset, regParam=self.ridge).fit(ready)
        self.weights, self.intercept = [float(w) for w in model.coefficients], float(model.intercept)
        return self

    def sane(self, most: float = 3.0) -> bool:
        """M2: a fit with a wild coefficient is not served."""
        return all(abs(w) <= most for w in self.weights)

    def probability(self) -> Column:
        return expit(F.col(self.offset) + self.intercept + sum((F.col(c) * w for c, w in zip(self.features, self.weights, strict=True)), F.lit(0.0)))


def isotonic_knots(rows: DataFrame, score: str, label: str, least_top: int = 0) -> list[tuple[float, float]]:
    """M3: knots of an isotonic fit; a top step that rests on fewer than ``least_top`` rows is cut to the step below."""
    per = rows.groupBy(F.round(score, 4).alias("_s")).agg(F.avg(F.col(label).cast("double")).alias("_y"), F.count(F.lit(1)).cast("double").alias("_w"))
    model = IsotonicRegression(featuresCol="_s", labelCol="_y", weightCol="_w").fit(per)
    knots = list(zip(model.boundaries.toArray().tolist(), model.predictions.toArray().tolist(), strict=True))
    if least_top and len(knots) > 1:
        top = max(y for _, y in knots)
        start = min(x for x, y in knots if y == top)
        if rows.where(F.col(score) >= start).count() < least_top:
            below = max((y for _, y in knots if y < top), default=top)
            knots = [(x, min(y, below)) for x, y in knots]
    return knots


def calibrated(score: Column, knots: list[tuple[float, float]]) -> Column:
    return through_knots(score, knots) if knots else score


def group_calibration(rows: DataFrame, score: str, label: str, levels: list[str], least: int = 30, k: float = 20.0) -> DataFrame:
    """M4: an offset in probability per level, from the whole down; each shrinks to the level above by its rows."""
    out = rows.withColumn("calibrated", F.col(score))
    for keys in [levels[:i] for i in range(len(levels) + 1)]:
        miss = F.avg(F.col(label).cast("double") - F.col("calibrated"))
        per = out.groupBy(*keys).agg((miss * F.count(F.lit(1)) / (F.count(F.lit(1)) + k)).alias("_d"), F.count(F.lit(1)).alias("_n")) if keys else out.agg(miss.alias("_d"), F.count(F.lit(1)).alias("_n"))
        out = out.join(per, keys, "left") if keys else out.join(F.broadcast(per))
        out = out.withColumn("calibrated", clip(F.col("calibrated") + F.when(F.col("_n") >= least, F.col("_d")).otherwise(0.0), 0.001, 0.999)).drop("_d", "_n")
    return out


def blocked_split(rows: DataFrame, day: str, shares: tuple[float, float] = (0.70, 0.85)) -> DataFrame:
    """Train, validation and test by distinct days in order; a day is never split."""
    days = rows.select(day).distinct()
    ranked = days.withColumn("_r", F.row_number().over(Window.orderBy(day))).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))  # one row per day
    at = (F.col("_r") - 1) / F.col("_n")
    part = F.when(at < shares[0], "train").when(at < shares[1], "validation").otherwise("test")
    return rows.join(F.broadcast(ranked.select(day, part.alias("part"))), day)


def leave_one_group_out(rows: DataFrame, group: str, label: str, k: float = 5.0) -> DataFrame:
    """The rate of all other groups, for each group, from one pass of sums."""
    per = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    whole = per.agg(F.sum("n").alias("_all"), F.sum("pos").alias("_hits"))
    return per.join(F.broadcast(whole)).select(group, "n", "pos", ((F.col("_hits") - F.col("pos") + k * 0.5) / (F.col("_all") - F.col("n") + k)).alias("held_out_rate"))


def stratified_part(rows: DataFrame, strata: list[str], tie: str, share: float = 0.2, seed: int = 3) -> DataFrame:
    """A fixed share of every stratum, by hash order."""
    w = Window.partitionBy(*strata).orderBy(F.xxhash64(F.lit(seed), tie), tie)
    ranked = rows.withColumns({"_r": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy(*strata))})
    return ranked.withColumn("part", F.when(F.col("_r") <= F.ceil(F.col("_n") * share), "calibration").otherwise("fit")).drop("_r", "_n")


def conformal_half_width(rows: DataFrame, residual: str, q: float = 0.9) -> DataFrame:
    """The next-higher order statistic at q, by counts per distinct residual instead of one sorted list."""
    per = rows.groupBy(F.abs(residual).alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    run = per.withColumns({"_c": F.sum("_n").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)), "_t": F.sum("_n").over(Window.partitionBy())})
    return run.agg(F.min(F.when(F.col("_c") >= F.ceil(F.lit(q) * (F.col("_t") - 1)) + 1, F.col("_r"))).alias("half_width"))


def routed(fresh: Column, stale: Column, weight: Column) -> Column:
    """M19."""
    return fresh * (1 - weight) + stale * weight


def alpha_sweep(rows: DataFrame, a: str, b: str, label: str, steps: int = 10) -> DataFrame:
    """Brier score of each blend, in one pass."""
    y = F.col(label).cast("double")
    scored = rows.agg(*[F.avg(F.pow(F.col(a) * (i / steps) + F.col(b) * (1 - i / steps) - y, 2)).alias(str(i)) for i in range(steps + 1)])
    return scored.select(F.explode(F.array(*[F.struct(F.lit(i / steps).alias("alpha"), F.col(str(i)).alias("brier")) for i in range(steps + 1)])).alias("x")).select("x.*")


def drivers(features: dict[str, float], top: int = 3) -> Column:
    """Names of the features whose removal moves a linear score most; ties by name."""
    each = F.array(*[F.struct(-F.abs(F.coalesce(F.col(c), F.lit(0.0)) * w).alias("move"), F.lit(c).alias("name")) for c, w in sorted(features.items())])
    return F.transform(F.slice(F.array_sort(each), 1, top), lambda x: x["name"])


def baseline(features: list[str], label: str, kind: str = "logistic") -> Pipeline:
    """M5: median imputation, scaling, and a logistic, elastic-net or boosted learner."""
    filled = [f"_{c}" for c in features]
    steps = [Imputer(strategy="median", inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True)]
    last = {"logistic": lambda: LogisticRegression(featuresCol="_x", labelCol=label), "elastic": lambda: LogisticRegression(featuresCol="_x", labelCol=label, regParam=0.01, elasticNetParam=0.5), "boosted": lambda: GBTClassifier(featuresCol="_x", labelCol=label, maxIter=10, seed=1)}
    return Pipeline(stages=[*steps, last[kind]()])


#: Distinct rows up to which an ensemble's member is fitted inside one task.
DISTINCT_ROWS = 250_000


def undersampled_ensemble(rows: DataFrame, features: list[str], label: str, draws: int = 12, ratio: float = 2.0, trees: int = 10) -> list:
    """M6: boosted trees on all positives and a hash-drawn share of the negatives per draw.

    A draw takes or leaves equal rows together, so a fit needs distinct rows and their counts: up to ``DISTINCT_ROWS``
    of them a task fits a draw, beyond that Spark's distributed learner does.
    """
    names = [f"_f{i}" for i in range(len(features))]
    slim = rows.select(*[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)], F.col(label).cast("int").alias("_label"), *[F.col(c).alias(f"_r{i}") for i, c in enumerate(features)])
    whole = [F.col(n).isNotNull() & ~F.isnan(n) for n in names]
    counts = {int(r["_label"]): r["count"] for r in slim.groupBy("_label").count().collect()}
    share = min(1.0, ratio * counts.get(1, 0) / max(1, counts.get(0, 1)))

    def drawn(d: int, columns: list[str]) -> Column:
        return F.pmod(F.xxhash64(F.lit(d), *columns), F.lit(1 << 20)) / float(1 << 20) < share

    raw = [f"_r{i}" for i in range(len(features))]
    distinct = reduce(lambda df, c: df.where(c), whole, slim).groupBy(*names, "_label", *raw).agg(F.count(F.lit(1)).alias("_n"))
    taken = distinct.select(*names, "_label", "_n", *[((F.col("_label") == 1) | drawn(d, raw)).alias(f"_d{d}") for d in range(draws)])
    few = taken.limit(DISTINCT_ROWS + 1).toPandas()
    if few.empty:
        raise ValueError("an ensemble needs rows whose features are known")
    if len(few) <= DISTINCT_ROWS:
        x, y, n, chosen = few[names].to_numpy(float), few["_label"].to_numpy(), few["_n"].to_numpy(float), few[[f"_d{d}" for d in range(draws)]].to_numpy(bool)

        def fit_draws(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for d in batch["draw"]:
                    k = chosen[:, d]
                    yield pd.DataFrame({"draw": [d], "model": [pickle.dumps(vars(boosting.fit(x[k], y[k], n[k], trees)))]})

        fitted = rows.sparkSession.range(0, draws, 1, draws).withColumnRenamed("id", "draw").mapInPandas(fit_draws, "draw long, model binary").collect()
        return [boosting.BoostedTrees(**pickle.loads(r["model"])) for r in sorted(fitted, key=lambda r: r["draw"])]
    ready = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="skip").transform(rows)

    def fit(d: int):
        return GBTClassifier(featuresCol="_x", labelCol=label, maxIter=trees, seed=d).fit(ready.where((F.col(label) == 1) | drawn(d, features)))

    with ThreadPool(4) as pool:  # draws do not depend on each other
        return pool.map(fit, range(draws))


def ensemble_probability(models: list, rows: DataFrame, features: list[str]) -> DataFrame:
    """``rows`` with the mean ``probability`` of the models."""
    if all(isinstance(m, boosting.BoostedTrees) for m in models):

        @F.pandas_udf(T.DoubleType())
        def mean_probability(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(float, na_value=np.nan) for c in columns])
            different, back = np.unique(x, axis=0, return_inverse=True)
            return pd.Series(np.mean([m.probability(different) for m in models], axis=0)[back.reshape(-1)])

        return rows.withColumn("probability", mean_probability(*[F.col(c).cast("double") for c in features]))
    out = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep").transform(rows)
    for i, m in enumerate(models):
        out = m.copy({m.predictionCol: f"_p{i}", m.rawPredictionCol: f"_r{i}", m.probabilityCol: f"_q{i}"}).transform(out)
        out = out.withColumn(f"_m{i}", vector_to_array(f"_q{i}")[1]).drop(f"_p{i}", f"_r{i}", f"_q{i}")
    mean = sum((F.col(f"_m{i}") for i in range(len(models))), F.lit(0.0)) / len(models)
    return out.withColumn("probability", mean).drop("_x", *[f"_m{i}" for i in range(len(models))])


class SiteRate(Estimator):
    """The estimator protocol with site keys: each site's rate, shrunk to the whole; unknown sites have the whole's."""

    def __init__(self, key: str, label: str, strength: float = 4.0):
        super().__init__()
        self.key, self.label, self.strength = key, label, strength

    def _fit(self, dataset: DataFrame) -> SiteRateModel:
        per = dataset.groupBy(self.key).agg(F.count(F.lit(1)).alias("_n"), F.sum(self.label).alias("_k"))
        whole = per.agg((F.sum("_k") / F.sum("_n")).alias("_g"))  # one row
        rate = (F.col("_k") + self.strength * F.col("_g")) / (F.col("_n") + self.strength)
        return SiteRateModel(self.key, per.join(F.broadcast(whole)).select(self.key, rate.alias("_rate")), whole)


class SiteRateModel(Model):
    def __init__(self, key: str, rates: DataFrame, whole: DataFrame):
        super().__init__()
        self.key, self.rates, self.whole = key, rates, whole

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.join(self.rates, self.key, "left").join(F.broadcast(self.whole))
        return out.withColumn("probability", F.coalesce("_rate", "_g")).drop("_rate", "_g")


def residual_correction(rows: DataFrame, key: str, score: str, label: str, least: int = 30, cap: float = 0.30) -> DataFrame:
    """M9: per site the mean miss, for sites with enough rows, within a cap; the result stays in 0.001 to 0.999."""
    miss = F.avg(F.col(label).cast("double") - F.col(score))
    per = rows.groupBy(key).agg(F.when(F.count(F.lit(1)) >= least, clip(miss, -cap, cap)).otherwise(0.0).alias("residual"))
    return rows.join(per, key).withColumn("corrected", clip(F.col(score) + F.col("residual"), 0.001, 0.999))


def coastal_cells(points: DataFrame, id_column: str, k: int, seed: int = 5) -> DataFrame:
    """K-means cells over place coordinates."""
    ready = VectorAssembler(inputCols=["lat", "lon"], outputCol="_x").transform(points)
    return KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cell").fit(ready).transform(ready).select(id_column, "cell")


def promotion(candidate: dict[str, float], current: dict[str, float], tolerance: float = 0.0) -> list[str]:
    """Reasons against promotion: a lower ranking metric or a higher loss."""
    worse = [k for k in ("auroc", "average_precision", "within_auroc") if candidate.get(k, 0) < current.get(k, 0) - tolerance]
    return worse + [k for k in ("brier", "log_loss") if candidate.get(k, 1) > current.get(k, 1) + tolerance]


def walk_forward(rows: DataFrame, day: str, key: str, label: str, years: int = 4, k: float = 5.0) -> DataFrame:
    """For every month a rate refitted on the trailing years, scored on that month.

    Monthly sums per key are windowed by month number, so all refits share one pass.
    """
    month = F.year(day) * 12 + F.month(day)
    per = rows.groupBy(key, month.alias("m")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    back = Window.partitionBy(key).orderBy("m").rangeBetween(-12 * years, -1)
    pool = per.groupBy("m").agg(F.sum("n").alias("_N"), F.sum("pos").alias("_P"))
    trail = Window.orderBy("m").rangeBetween(-12 * years, -1)  # one row per month
    pool = pool.select("m", (F.sum("_P").over(trail) / F.sum("_N").over(trail)).alias("g"))
    fitted = per.select(key, "m", "n", "pos", F.coalesce(F.sum("n").over(back), F.lit(0)).alias("fit_n"), F.coalesce(F.sum("pos").over(back), F.lit(0)).alias("fit_pos"))
    out = fitted.join(F.broadcast(pool), "m").where("g is not null").withColumn("p", (F.col("fit_pos") + k * F.col("g")) / (F.col("fit_n") + k))
    brier = (F.col("pos") * F.pow(1 - F.col("p"), 2) + (F.col("n") - F.col("pos")) * F.pow(F.col("p"), 2)) / F.col("n")
    return out.withColumn("brier", brier)
