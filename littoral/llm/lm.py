"""LM scoring by masked pseudo-likelihood.

A small network predicts every word of a text from the two words on either side: their
embeddings are summed, pass a tanh layer, and a two-step softmax gives first the group and
then the class within the group. Frequent words are classes of their own; all others share
hashed classes, within which a word's probability is its share of the class total by its count
over all documents. How many classes and groups there are and how wide the layer is, is the
``Shape`` of the model, a parameter. Shares of the most frequent words, ``cached`` at most, travel
with the model, those of all other words are joined by word. Training starts from a bounded sample
on the driver (WARM_DOCS documents of WARM_WORDS words at most); then every partition goes on over
all windows of its documents, and the parameters are averaged, weighted by words. Their sums are
taken in fixed point by a tree of tasks, so their order does not matter; the model does depend on
how the table is split. A document's score is the sum of its words' conditional log-probabilities;
beside it stands how often the rarest of its words occurs in the corpus, which is what tells a
text that the model has seen more than once.

Defined cases: a null, empty or blank text has no words, ``log_prob`` 0 and a null mean; places
before the first and after the last word are a class of their own as context; equal texts get
equal scores; texts of any length are scored whole; repeated rows count as often as they stand; an
empty table gives no rows; input columns that bear the name of an output column are replaced, all
others but the text are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.llm.common import Kept, Scratch, bucket, documents, give_back, giving_back, literal, words

REACH = (-2, -1, 1, 2)
BATCH = STEP = 8192
#: Documents, and words of each, that the first parameters are trained on, at most.
WARM_DOCS, WARM_WORDS = 1000, 5000
FIXED = 1 << 20
#: Parameter vectors that one task adds up.
FAN = 16


class Shape(NamedTuple):
    """Words with a class of their own, classes of all others, groups of classes, width of the layer, words in the cache."""

    known: int = 768
    hashed: int = 256
    groups: int = 32
    hidden: int = 16
    cached: int = 1 << 18

    @property
    def classes(self) -> int:
        return self.known + self.hashed

    @property
    def members(self) -> int:
        return -(-self.classes // self.groups)

    @property
    def arrays(self) -> dict[str, tuple[int, ...]]:
        return {
            "embed": (len(REACH), self.classes + 1, self.hidden), "bias": (self.hidden,), "group": (self.hidden, self.groups), "group_bias": (self.groups,),
            "member": (self.groups, self.hidden, self.members), "member_bias": (self.groups, self.members),
        }

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.arrays.values())


class Net:
    """Parameters in one flat vector, with views by name."""

    def __init__(self, shape: Shape, flat: np.ndarray | None = None, sums: np.ndarray | None = None):
        self.shape = shape
        if flat is None:
            rng = np.random.default_rng(7)
            flat = rng.normal(0, 0.1, shape.size).astype(np.float32)
        self.flat = flat.astype(np.float32)  # a copy
        self.of = self.views(self.flat)
        self.sums = np.full(shape.size, 1e-8, np.float32) if sums is None else sums.copy()  # of squared gradients

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shape.arrays.items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def hidden(self, context: np.ndarray) -> np.ndarray:
        total = self.of["bias"] + sum(self.of["embed"][k][context[:, k]] for k in range(len(REACH)))
        return np.tanh(total)

    def run(self, context: np.ndarray, target: np.ndarray, learn: float = 0.0) -> np.ndarray:
        """Log-probability of each target; with ``learn`` also a step of Adagrad."""
        n, groups, members = len(target), self.shape.groups, self.shape.members
        order = np.argsort((target // members).astype(np.uint16), kind="stable")  # rows of a group lie together; sixteen bits are sorted by counting
        context, target = context[order], target[order]
        group, member, rows = target // members, target % members, np.arange(n)
        h = self.hidden(context)

        def soft(x: np.ndarray) -> np.ndarray:
            np.exp(np.clip(x, -60, 60, out=x), out=x)
            x /= (x @ np.ones(x.shape[1], np.float32))[:, None]
            return x

        first = soft(h @ self.of["group"] + self.of["group_bias"])
        edges = np.searchsorted(group, np.arange(groups + 1))
        second = np.empty((n, members), np.float32)
        for g in range(groups):
            part = slice(edges[g], edges[g + 1])
            if part.start < part.stop:
                second[part] = soft(h[part] @ self.of["member"][g] + self.of["member_bias"][g])
        out = np.empty(n)
        out[order] = np.log(np.maximum(first[rows, group], 1e-30)) + np.log(np.maximum(second[rows, member], 1e-30))
        if learn:
            first[rows, group] -= 1
            second[rows, member] -= 1
            grad = np.zeros(self.shape.size, np.float32)
            to = self.views(grad)
            to["group"][:] = h.T @ first
            to["group_bias"][:] = first.sum(0)
            back = first @ self.of["group"].T
            for g in range(groups):
                part = slice(edges[g], edges[g + 1])
                if part.start < part.stop:
                    to["member"][g] = h[part].T @ second[part]
                    to["member_bias"][g] = second[part].sum(0)
                    back[part] += second[part] @ self.of["member"][g].T
            back *= 1 - h * h
            to["bias"][:] = back.sum(0)
            for k in range(len(REACH)):
                by = np.argsort(context[:, k].astype(np.uint16) if self.shape.classes < 65535 else context[:, k], kind="stable")
                own = context[by, k]
                start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                ids = own[start]
                to["embed"][k][ids] = np.add.reduceat(back[by], start, axis=0)
            grad /= n
            self.sums += grad * grad
            self.flat -= learn * grad / np.sqrt(self.sums)
        return out


def windows(ids: np.ndarray, sizes: np.ndarray, outside: int) -> np.ndarray:
    """ids: the classes of all texts in a row; sizes: words per text; outside: the class of no word. The contexts of all words."""
    pad = max(REACH)
    starts = np.cumsum(sizes + pad) - sizes
    place = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(ids))
    line = np.full(len(ids) + pad * (len(sizes) + 1), outside, np.int32)
    line[place] = ids
    return np.stack([line[place + k] for k in REACH], 1)


class Vocabulary:
    """Numbers of words: the rank of the most frequent, ``cached`` at most, and ``cached`` plus a hash for all others.

    ``classes``, ``shares`` and ``counts`` give for a number its class, the logarithm of the word's share of the class
    total and its count; words outside the cache have theirs in ``others``, by word, and 0 and no count here.
    """

    def __init__(self, counts: DataFrame, shape: Shape):
        spark, self.shape = counts.sparkSession, shape
        known, cached, hashed = shape.known, shape.cached, shape.hashed
        often = counts.orderBy(F.desc("n"), "w").limit(known)
        least, room = 1 << 62, cached - known
        for r in sorted(counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect(), key=lambda r: -r.n):  # one row per distinct count
            room -= r.k
            if room < 0:
                break
            least = r.n
        rows = ("w", "n", self.hashed(F.col("w")).alias("c"))
        top = sorted({*often.select(*rows).collect(), *counts.where(F.col("n") >= least).select(*rows).collect()}, key=lambda r: (-r.n, r.w))
        self.buckets = 1 << max(4, cached.bit_length() - 3)  # a power of two, as hashes are signed in Spark
        maps: list[dict[str, int]] = [{} for _ in range(self.buckets)]
        self.classes = np.append(np.zeros(cached, np.int32), np.arange(known, shape.classes, dtype=np.int32))
        self.counts = np.full(cached + hashed, 1 << 62)
        for i, r in enumerate(top):
            maps[xxhash.xxh64_intdigest(r.w.encode(), 42) % self.buckets][r.w] = i
            self.classes[i] = i if i < known else r.c
            self.counts[i] = r.n
        self.table = literal(spark.createDataFrame([(maps,)], "v array<map<string,int>>"))
        exact = np.zeros(shape.classes, np.int64)
        for r in counts.groupBy(self.hashed(F.col("w")).alias("c")).agg(F.sum("n").alias("n")).collect():  # a row per hashed class
            exact[r.c] = r.n
        for i, r in enumerate(top[:known]):
            exact[i] = r.n
            exact[r.c] -= r.n
        self.totals = exact + 1.0
        self.shares = np.zeros(cached + hashed)
        for i, r in enumerate(top):
            self.shares[i] = np.log(r.n / exact[self.classes[i]])
        totals = literal(spark.createDataFrame([(np.log(np.maximum(exact[known:], 1)).tolist(),)], "v array<double>"))
        of_class = F.get(totals, self.hashed(F.col("w")) - known)
        self.others = counts.select("w", "n", F.round((F.log("n") - of_class) * FIXED).cast("long").alias("share"))

    def hashed(self, word: Column) -> Column:
        return (F.pmod(F.xxhash64(word, F.lit(1)), F.lit(self.shape.hashed)) + self.shape.known).cast("int")

    def number(self, word: Column) -> Column:
        own = F.element_at(F.get(self.table, bucket(word, self.buckets)), word)
        return F.coalesce(own, self.hashed(word) + (self.shape.cached - self.shape.known))


def _batches(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.diff(lists.offsets.to_numpy()).astype(np.int64)


def _train(net: Net, ids: np.ndarray, sizes: np.ndarray, learn: float) -> None:
    context = windows(ids, sizes, net.shape.classes)
    order = np.random.default_rng(len(ids)).permutation(len(ids))
    for at in range(0, len(ids), STEP):
        some = order[at : at + STEP]
        net.run(context[some], ids[some], learn)


def _added(vectors: DataFrame, parts: int) -> DataFrame:
    """The sum of parameter vectors, FAN of them to a task, until one is left."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(batch.num_rows):
                own = batch.column(0)[k].values.to_numpy()
                total = own.copy() if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total))], names=["sums"])

    while parts > 1:
        parts = -(-parts // FAN)
        vectors = vectors.repartition(parts).mapInArrow(giving_back(add), "sums array<long>")
    return vectors


def fit(tokens: DataFrame, vocabulary: Vocabulary, scratch: Scratch) -> Net:
    """tokens: (ids array<int>) of all documents."""
    shape, classes, totals = vocabulary.shape, vocabulary.classes, vocabulary.totals
    net = Net(shape)
    by_group = np.append(totals, np.full(shape.groups * shape.members - shape.classes, 1e-3)).reshape(shape.groups, shape.members)
    net.of["group_bias"][:] = np.log(by_group.sum(1) / by_group.sum())
    net.of["member_bias"][:] = np.log(by_group / by_group.sum(1, keepdims=True))
    total = tokens.count()
    one_in = max(1, -(-total * 5 // (WARM_DOCS * 4)))
    warm = tokens.where((F.pmod(F.xxhash64("ids"), F.lit(one_in)) == 0) & (F.size("ids") <= WARM_WORDS)).select("ids").limit(WARM_DOCS).toArrow()
    if warm.num_rows:
        ids, sizes = _batches(warm.column(0).combine_chunks())
        for learn in (0.1, 0.1, 0.05):
            _train(net, classes[ids], sizes, learn)
    start = tokens.sparkSession.sparkContext.broadcast((net.flat, net.sums, classes))  # twice the model's size, and the cache

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, squares, classes = start.value
        own, seen = Net(shape, flat, squares), 0
        for batch in batches:
            ids, sizes = _batches(batch.column(0))
            if len(ids):
                _train(own, classes[ids], sizes, 0.05)
                seen += len(ids)
        if seen:
            weight = -(-seen // 1000)
            fixed = np.round(own.flat.astype(np.float64) * FIXED).astype(np.int64) * weight
            row = pa.array(np.append(fixed, weight)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row)], names=["sums"])

    slim = tokens.select("ids")
    trained = scratch.save(slim.mapInArrow(giving_back(go_on), "sums array<long>"), "trained")
    sums = _added(trained, trained.count()).toArrow()  # one row
    if sums.num_rows:
        vector = sums.column(0).combine_chunks().flatten().to_numpy()
        net = Net(shape, vector[:-1] / (FIXED * float(vector[-1])))
    return net


def score(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:  # noqa: B008  a constant
    """``docs`` without their text, with ``n_words, log_prob, mean_log_prob, least_count``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    kept = Kept(docs, "text")
    docs = kept.frame
    counts = docs.select(F.explode(words(F.lower("text"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = Vocabulary(scratch.save(counts, "counts"), shape)
    keep = [c for c in docs.columns if c != "text"]
    split = docs.select(*keep, words(F.lower("text")).alias("words"))
    coded = split.withColumn("ids", F.transform("words", vocabulary.number)).withColumn("row", F.monotonically_increasing_id())
    rest = F.filter("words", lambda w, i: F.get(F.col("ids"), i) >= shape.cached)
    tokens = scratch.save(coded.withColumn("rest", rest).drop("words"), "tokens")
    net = fit(tokens, vocabulary, scratch)
    model = spark.sparkContext.broadcast((net.flat, vocabulary.classes, vocabulary.shares, vocabulary.counts))

    @F.arrow_udf("log_prob double, least long")
    def log_prob(lists: pa.Array) -> pa.Array:
        flat, classes, shares, counts = model.value
        ids, sizes = _batches(lists)
        own, out = Net(shape, flat), np.zeros(len(ids))
        of = classes[ids]
        context = windows(of, sizes, shape.classes)
        for at in range(0, len(ids), BATCH):
            part = slice(at, at + BATCH)
            out[part] = own.run(context[part], of[part]) + shares[ids[part]]
        owner, least = np.repeat(np.arange(len(sizes)), sizes), np.full(len(sizes), 1 << 62)
        np.minimum.at(least, owner, counts[ids])
        total = np.bincount(owner, out, minlength=len(sizes)).round(3)
        give_back()
        return pa.StructArray.from_arrays([pa.array(total), pa.array(least)], names=["log_prob", "least"])

    joined = tokens.select("row", F.explode("rest").alias("w")).join(vocabulary.others, "w")
    rare = joined.groupBy("row").agg(F.sum("share").alias("rest"), F.min("n").alias("n"))  # in fixed point, so equal texts get equal sums
    scored = tokens.drop("rest").withColumn("x", log_prob(F.col("ids"))).withColumn("n_words", F.size("ids").cast("long")).drop("ids")
    scored = scored.join(rare, "row", "left").withColumn("log_prob", F.round(F.col("x.log_prob") + F.coalesce("rest", F.lit(0)) / FIXED, 3))
    scored = scored.withColumn("least_count", F.when(F.col("n_words") > 0, F.least(F.col("x.least"), F.coalesce("n", F.col("x.least")))))
    scored = scored.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.round(F.col("log_prob") / F.col("n_words"), 6)))
    return kept.back(scored, "n_words", "log_prob", "mean_log_prob", "least_count", without=("text",))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_words", "log_prob", "mean_log_prob", "least_count")
