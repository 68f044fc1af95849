"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors form one node. Vectors are turned onto the principal axes of a bounded sample,
and the leading coordinates cut space into leaves, leaves into tiles in the order of their first
coordinate. Two tiles are compared only if their boxes are near enough for the threshold. In a
pair of tiles, block by block, the products of the leading dimensions are accumulated first; what
the rest can add is at most the product of the suffix norms, and blocks and pairs whose bound
stays below the threshold are given up. Pairs that remain are decided by their cosine in double
precision on the original components. The sample steers the order of work only: every pair is
either decided or excluded by a bound.

A tile travels once for each tile it is compared with, so tiles grow with the table up to a size
that fits a task. Vectors that no bound tells apart, such as evenly spread ones, need all pairs of
tiles, which no exact method avoids. A pair of tiles gives link counts and a spanning forest,
never its pairs; copies weigh by their number.

Defined cases: null or zero vectors and vectors with null or non-finite components link with
nothing and are their own component; shorter vectors are taken as padded with zeros; ties of
the least id cannot matter; repeated rows are copies; rows with a null id count as links of others
and get the component of their vector; an empty table gives no rows; the input's other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.llm.common import Scratch, giving_back
from littoral.llm.components import components, forest

THRESHOLD = 0.95
#: Vectors that the axes and leaves are fitted on, at most; so a leaf's cut rests on LEAF_SAMPLE of them at least.
SAMPLE, LEAF_SAMPLE = 20_000, 32
#: Leading coordinates that leaves are cut on and boxes have.
BOX = 8
#: Vectors of one tile: a sixth of all, between these; vectors of a block of a tile.
TILE, MOST, BLOCK = 2048, 16_384, 2048
STEPS = (8, 16, 32)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of doubles, padded with zeros."""
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lists.offsets.to_numpy()
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)] = flat
    return out


class Plan:
    """Principal axes and a tree of median cuts over the leading coordinates."""

    def __init__(self, sample: np.ndarray, total: int, width: int, tile: int):
        self.width = width
        self.axes = np.eye(width)
        if len(sample) > 1:
            self.axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
        self.cuts: list[tuple[int, float, int, int] | None] = []
        self.leaves = 0
        want = max(1, min(-(-total // tile), len(sample) // LEAF_SAMPLE))
        self._grow((sample @ self.axes)[:, :BOX], want)

    def _grow(self, points: np.ndarray, want: int) -> int:
        at = len(self.cuts)
        self.cuts.append(None)
        spread = np.ptp(points, 0) if len(points) else np.zeros(1)
        axis = int(spread.argmax())
        cut = float(np.median(points[:, axis])) if len(points) else 0.0
        if want < 2 or len(points) < LEAF_SAMPLE or not (points[:, axis] < cut).any():
            self.cuts[at] = (-1, 0.0, self.leaves, 0)
            self.leaves += 1
            return at
        low = points[:, axis] < cut
        left = self._grow(points[low], want // 2)
        right = self._grow(points[~low], want - want // 2)
        self.cuts[at] = (axis, cut, left, right)
        return at

    def place(self, turned: np.ndarray) -> np.ndarray:
        out = np.zeros(len(turned), np.int32)
        todo = [(0, np.arange(len(turned)))]
        while todo:
            at, rows = todo.pop()
            axis, cut, left, right = self.cuts[at]
            if axis < 0:
                out[rows] = left
            elif len(rows):
                low = turned[rows, axis] < cut
                todo += [(left, rows[low]), (right, rows[~low])]
        return out


class Turned:
    """Unit rows, the same on the principal axes, and the norms of what follows each step."""

    def __init__(self, rows: np.ndarray, axes: np.ndarray):
        self.rows, self.turned = rows, rows @ axes
        self.ends = [*(s for s in STEPS if s < rows.shape[1]), rows.shape[1]]
        self.rest = [np.sqrt(np.maximum((self.turned[:, end:] ** 2).sum(1), 0)) for end in self.ends]

    def block(self, at: int) -> Turned:
        out, part = object.__new__(Turned), slice(at, at + BLOCK)
        out.rows, out.turned, out.ends, out.rest = self.rows[part], self.turned[part], self.ends, [r[part] for r in self.rest]
        return out


def near_pairs(x: Turned, y: Turned, threshold: float = THRESHOLD) -> np.ndarray:
    """Mask of the pairs of rows with a cosine of at least ``threshold``."""
    products, done, alive = np.zeros((len(x.rows), len(y.rows))), 0, None
    for end, left, right in zip(x.ends, x.rest, y.rest, strict=True):
        products += x.turned[:, done:end] @ y.turned[:, done:end].T
        done = end
        alive = products + left[:, None] * right[None, :] >= threshold - 1e-9
        count = int(np.count_nonzero(alive))
        if not count:
            return alive
        if count < 0.02 * alive.size:
            break
    out = np.zeros(alive.shape, bool)
    i, j = np.nonzero(alive)
    for at in range(0, len(i), 1 << 16):
        p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        out[p, q] = np.einsum("ij,ij->i", x.rows[p], y.rows[q]) >= threshold
    return out


def _can_link() -> Column:
    good = F.col("embedding").isNotNull() & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("embedding", lambda v: v != 0)
    return F.coalesce(good, F.lit(False))


def _nodes(vectors: DataFrame) -> DataFrame:
    """(embedding, copies, least, node) for each distinct vector that can link; ``node`` numbers them, so none share one."""
    named = vectors.where(_can_link()).groupBy("embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    return named.withColumn("node", F.monotonically_increasing_id())


def _leaves(nodes: DataFrame, plan: Plan) -> DataFrame:
    """nodes with their leaf and leading coordinates."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                turned = (unit(matrix(batch.column(2), plan.width)) @ plan.axes)[:, :BOX]
                wide = np.zeros((len(turned), BOX))
                wide[:, : turned.shape[1]] = turned
                box = pa.ListArray.from_arrays(pa.array(np.arange(len(turned) + 1) * BOX, pa.int32()), pa.array(wide.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(plan.place(turned)), box], names=["node", "copies", "embedding", "leaf", "box"])

    kind = nodes.schema["embedding"].dataType.simpleString()
    return nodes.select("node", "copies", "embedding").mapInArrow(giving_back(place), f"node long, copies long, embedding {kind}, leaf int, box array<double>")


def _compare(tiles: DataFrame, plan: Plan, threshold: float) -> DataFrame:
    """tiles: (left, right). Rows (u, v, null) of a forest and (u, null, n) of link counts."""

    def side(values: pa.StructArray) -> tuple[np.ndarray, np.ndarray, Turned]:
        return values.field(0).to_numpy(), values.field(1).to_numpy(), Turned(unit(matrix(values.field(2), plan.width)), plan.axes)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                left, right = (batch.column(c)[k] for c in (0, 1))
                same = not right.is_valid
                ids, copies, x = side(left.values)
                other_ids, other_copies, y = (ids, copies, x) if same else side(right.values)
                links, other_links, edges = np.zeros(len(ids), np.int64), np.zeros(len(other_ids), np.int64), []
                for i in range(0, len(ids), BLOCK):
                    for j in range(i if same else 0, len(other_ids), BLOCK):
                        own = same and i == j
                        near = near_pairs(x.block(i), y.block(j), threshold)
                        if own:
                            np.fill_diagonal(near, False)
                        if not near.any():
                            continue
                        a, b = slice(i, i + BLOCK), slice(j, j + BLOCK)
                        links[a] += near @ other_copies[b]
                        if not own:
                            (links if same else other_links)[b] += copies[a] @ near
                        edges += forest(ids[a], other_ids[b], near, own)
                u = [ids[links > 0], other_ids[other_links > 0]]
                n = np.concatenate([links[links > 0], other_links[other_links > 0]])
                u = np.concatenate([*u, np.array([e[0] for e in edges], np.int64)])
                v = pa.array([None] * len(n) + [e[1] for e in edges], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), v, pa.array([*n.tolist(), *[None] * len(edges)], pa.int64())], names=["u", "v", "n"])

    return tiles.mapInArrow(giving_back(compare), "u long, v long, n long")


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    vectors = vectors.select("vec_id", "embedding")
    nodes = scratch.save(_nodes(vectors), "nodes")
    total, width = nodes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if total:
        one_in = max(1, -(-total * 5 // (SAMPLE * 4)))
        sample = nodes.where(F.pmod(F.xxhash64("embedding", F.lit(3)), F.lit(one_in)) == 0).select("embedding").limit(SAMPLE).toArrow()
        points = unit(matrix(sample.column(0).combine_chunks(), width)) if sample.num_rows else np.zeros((0, width))
        tile = min(MOST, max(TILE, -(-total // 6)))
        plan = Plan(points, total, width, tile)
        placed = scratch.save(_leaves(nodes, plan), "placed")
        # in a leaf, tiles in the order of the first coordinate, which the leaf's range is cut into evenly by count
        sizes = {r.leaf: r.n for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # as many rows as leaves
        parts = spark.createDataFrame([(k, -(-n // tile)) for k, n in sorted(sizes.items())], "leaf int, tiles int")
        dealt = placed.join(F.broadcast(parts), "leaf")
        if max(sizes.values()) > tile:
            first = F.col("box")[0]
            cuts = dealt.where("tiles > 1").groupBy("leaf").agg(F.percentile_approx(first, F.array(*[F.lit(i / 64) for i in range(1, 64)]), F.lit(1000)).alias("cuts"))
            dealt = dealt.join(F.broadcast(cuts), "leaf", "left")  # 63 numbers a leaf
            rank = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<double>")), lambda c: c <= first)) / 64  # 0 to 63 / 64
            within = F.floor((rank + F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / float(1 << 26)) * F.col("tiles"))
            ordered = dealt.withColumn("tile", F.least(F.col("tiles") - 1, within).cast("int")).drop("cuts")
            if ordered.groupBy("leaf", "tile").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * tile).isEmpty():
                dealt = ordered
            else:  # very many vectors share a first coordinate
                dealt = dealt.drop("cuts").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        else:
            dealt = dealt.withColumn("tile", F.lit(0))
        dealt = scratch.save(dealt.select("node", "copies", "embedding", "leaf", "tile", "box"), "dealt")
        ends = [f(F.col("box")[i]).alias(f"{f.__name__}{i}") for i in range(BOX) for f in (F.min, F.max)]
        rows = sorted(dealt.groupBy("leaf", "tile").agg(*ends).collect())  # as many rows as tiles
        low, high = (np.array([[r[f"{f}{i}"] for i in range(BOX)] for r in rows]) for f in ("min", "max"))
        names = np.array([(r.leaf, r.tile) for r in rows], np.int32)
        boxes = spark.sparkContext.broadcast((low, high, names))  # a box per tile

        def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high, names = boxes.value
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    gap = np.maximum(0, np.maximum(low[i] - high[i:], low[i:] - high[i]))
                    j = i + np.flatnonzero((gap**2).sum(1) <= 2 - 2 * threshold + 1e-9)
                    own = [np.full(len(j), x, np.int32) for x in names[i]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*own, names[j, 0], names[j, 1])], names=["li", "ti", "lj", "tj"])

        numbers = spark.range(0, len(rows), 1, -(-len(rows) // 64))
        pairs = scratch.save(numbers.mapInArrow(giving_back(partners), "li int, ti int, lj int, tj int"), "pairs")
        tiles = dealt.groupBy("leaf", "tile").agg(F.collect_list(F.struct("node", "copies", "embedding")).alias("side"))
        tiles = scratch.save(tiles, "tiles")
        key = ["li", "ti", "lj", "tj"]
        first = pairs.join(tiles.select(F.col("leaf").alias("li"), F.col("tile").alias("ti"), F.col("side").alias("left")), ["li", "ti"])
        second = pairs.where("li <> lj or ti <> tj").join(tiles.select(F.col("leaf").alias("lj"), F.col("tile").alias("tj"), F.col("side").alias("right")), ["lj", "tj"])
        both = first.join(second.select(*key, "right"), key, "left").select("left", "right")
        found = scratch.save(_compare(both, plan, threshold), "found")
    else:
        found = spark.createDataFrame([], "u long, v long, n long")
    linked = found.where("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    joined = components(found.where("v is not null").select("u", "v"), scratch)
    classes = joined.join(nodes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("class"))
    of_node = joined.join(classes, "root").select("node", "class")
    table = nodes.select("node", "copies", "least").join(of_node, "node", "left").join(linked, "node", "left")
    table = scratch.save(table.select("node", F.coalesce("class", "least").alias("class"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "table")
    table = table.join(nodes.select("node", "embedding"), "node").drop("node")
    out = vectors.join(table, "embedding", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("class")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
