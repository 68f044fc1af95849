"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles; documents with equal sets form one node.
In each run a node walks to the shingles that a hash shared by all nodes picks with probability
``1 / (threshold * size)``, so similar nodes meet with a constant probability. Buckets that are
too large are split again on sampled coordinates of a 128-value signature, in repeated runs;
a bucket that does not fall apart (most of it agrees) or is still large at the last level is
compared whole, in tiles. The number of runs follows from the recall wanted. A coordinate is the
token of the set that is least under one of 128 hash functions, by one byte, so a further split is
on sampled shared tokens too, without the sets at hand. Members of a bucket that very many share
stay where they are and learn its size by broadcast.

Buckets are compared by signature and give a spanning forest of the pairs that can reach the
threshold, never all pairs. Within the components of that forest every pair is then compared
exactly, tile by tile, which counts links without writing them and finds any link that a run
missed. Copies share a node, whose multiplicity weighs in the counts.

Defined cases: a null text, an empty one and one without words have no shingles and link with
nothing (their class is their own id); texts of one to four words have one shingle, of all
their words; very long texts are one set, compared in parts of a bounded size; equal rows are
links of each other; ids may be of any type that can be ordered, and the least is the class of a
group; a null id carries its class; an empty table gives no rows; the join ignores the input's
other columns, ``drop_near_copies`` keeps them, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.llm.common import Kept, Scratch, documents, giving_back, join_counts, mix64, words
from littoral.llm.components import components, forest

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Coordinates of the signature, one byte each.
COORDINATES = 128
#: Nodes that one comparison of a bucket holds per side.
TILE = 512
LEVELS = 3
#: Documents whose sets are in memory at once.
SLICE = 256
#: Shingles that one exact comparison holds per side, about.
EXACT = 1 << 17
#: Signatures agree on the coordinates with the similarity as probability, or 1/256 by chance;
#: four standard deviations below the threshold.
SKETCH = THRESHOLD - 4 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / COORDINATES)

_SEEDS = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = mix64(np.arange(101, 101 + 64, dtype=np.uint64)) | np.uint64(1)
_RUN, _CHILD = mix64(np.arange(201, 201 + 64, dtype=np.uint64)), mix64(np.arange(301, 301 + 64, dtype=np.uint64))


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD) -> int:
    """Runs after which a pair at the threshold has met with the wanted probability.

    The pair shares at least ``threshold`` times the larger size, each of which is picked by
    both with probability ``1 / (threshold * larger size)``: one meeting expected per run.
    """
    return math.ceil(math.log(1 - recall) / -1.0)


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingles of one document's word hashes."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    take = min(size, n)
    total = np.zeros(n - take + 1, np.uint64)
    for k in range(take):
        total += mix64(hashes[k : n - take + 1 + k] + _STEP[k]) * _STEP[k]
    return np.unique(mix64(total + np.uint64(take)))


def set_hash(tokens: np.ndarray) -> int:
    """One 64-bit name for a set, the same for any order."""
    total = mix64(tokens).sum(dtype=np.uint64, keepdims=True) + np.array([len(tokens)], np.uint64)
    return int(mix64(total).view(np.int64)[0])


def signature(tokens: np.ndarray) -> bytes:
    """A byte of the minimum of each of COORDINATES hash functions."""
    low = (tokens ^ (tokens >> np.uint64(32))).astype(np.uint32)
    least = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    a, b = (_SEEDS.astype(np.uint32) | np.uint32(1)), (_SEEDS >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(low), 4096):
        part = low[at : at + 4096, None] * a
        part ^= part >> np.uint32(15)
        part *= b | np.uint32(1)
        least = np.minimum(least, part.min(0))
    return ((least * np.uint32(2654435769)) >> np.uint32(24)).astype(np.uint8).tobytes()


def chosen(tokens: np.ndarray, runs: int, threshold: float = THRESHOLD) -> np.ndarray:
    """The first steps of all runs: a path for each picked shingle."""
    limit = min((1 << 64) - 1, int((1 << 64) / (threshold * len(tokens)))) if len(tokens) else 0
    found = []
    for r in range(runs):
        picked = tokens[mix64(tokens ^ _RUN[r]) <= np.uint64(limit)]
        found.append(mix64(picked + _CHILD[r]))
    return np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)


def _word_lists(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    lists = batch.column(column)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
    for i in range(batch.num_rows):
        yield flat[ends[i] - ends[0] : ends[i + 1] - ends[0]]


def _list_array(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).view(np.int64)))


def _hashed_words() -> Column:
    return F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("words")


def _documents_as_sets(docs: DataFrame, runs: int) -> DataFrame:
    """(doc_id, text_key, node, size, sketch, paths) for each document; null nodes where there are no words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = [shingles(x) for x in _word_lists(part, 2)]
                node = [set_hash(x) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(node, pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array([signature(x) for x in sets], pa.binary()), _list_array([chosen(x, runs) for x in sets])],
                    names=["doc_id", "text_key", "node", "size", "sketch", "paths"],
                )

    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), _hashed_words())
    return hashed.mapInArrow(giving_back(read), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, node long, size long, sketch binary, paths array<long>")


def _compare_sketches(a: pa.StructArray, b: pa.StructArray, same: bool) -> list[tuple[int, int]]:
    """Forest edges of the pairs that can reach the threshold by size and signature."""
    x, y = (np.frombuffer(b"".join(f.field(2).to_pylist()), np.uint8).reshape(-1, COORDINATES) for f in (a, b))
    agree = np.zeros((len(x), len(y)), np.uint8)
    for k in range(COORDINATES):
        agree += x[:, k, None] == y[None, :, k]
    s, t = a.field(1).to_numpy()[:, None], b.field(1).to_numpy()[None, :]
    near = (agree >= SKETCH * COORDINATES) & (np.minimum(s, t) >= THRESHOLD * np.maximum(s, t))
    if same:
        np.fill_diagonal(near, False)
    return forest(a.field(0).to_numpy(), b.field(0).to_numpy(), near, same)


def _pairs(tiles: DataFrame, key: str) -> DataFrame:
    """(left, right) of all pairs of a key's tiles; right is null where a tile meets itself."""
    alone = tiles.where("tiles = 1").select("left").withColumn("right", F.when(F.lit(False), F.col("left")))
    # pair (i, j), i <= j, is a key that both tiles name, so two tiles meet in an equi-join
    named = tiles.where("tiles > 1").select(key, "tile", "left", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    low = named.where("tile <= other").select(key, F.col("tile").alias("i"), F.col("other").alias("j"), "left")
    high = named.where("other < tile").select(key, F.col("other").alias("i"), F.col("tile").alias("j"), F.col("left").alias("right"))
    return alone.unionByName(low.join(high, [key, "i", "j"], "left").where("i = j or right is not null").select("left", "right"))


def _tiles(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidate edges (u, v) of buckets compared whole. members: (path, node, size, sketch); counts: (path, n)."""
    # each tile holds a bounded number of nodes, whatever the bucket holds
    dealt = join_counts(members, counts, "path").withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    tiles = dealt.groupBy("path", "tiles", "tile").agg(F.collect_list(F.struct("node", "size", "sketch")).alias("left"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges: list[tuple[int, int]] = []
            for k in range(batch.num_rows):
                left, right = (batch.column(c)[k] for c in (0, 1))
                edges += _compare_sketches(left.values, right.values if right.is_valid else left.values, not right.is_valid)
            u, v = zip(*edges, strict=True) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return _pairs(tiles, "path").mapInArrow(giving_back(compare), "u long, v long")


def _split(level: DataFrame, turn: int, runs: int, threshold: float = THRESHOLD) -> DataFrame:
    """Children (parent, path, node, size, sketch) of each member on its sampled coordinates."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.uint64(int((1 << 64) / (threshold * COORDINATES)))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                path, sketch = part.column(0).to_numpy().view(np.uint64), np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint8).reshape(-1, COORDINATES)
                for r in range(runs):
                    seed = mix64(path + _STEP[r] * np.uint64(turn + 1))
                    row, k = np.nonzero(mix64(seed[:, None] ^ _SEEDS[None, :]) <= limit)
                    child = mix64(seed[row] + _SEEDS[k] * np.uint64(3) + sketch[row, k])
                    out = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([out.column(0), pa.array(child.view(np.int64)), *out.columns[1:]], names=["parent", "path", "node", "size", "sketch"])

    return level.select("path", "node", "size", "sketch").mapInArrow(giving_back(walk), "parent long, path long, node long, size long, sketch binary")


def _candidates(nodes: DataFrame, runs: int, scratch: Scratch) -> DataFrame:
    """Forest edges between nodes that may be similar. nodes: (node, size, sketch, paths)."""
    steps = nodes.select("node", F.explode("paths").alias("path"))
    counts = scratch.save(steps.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "counts-1")
    met = join_counts(steps, counts, "path").drop("n")
    # (path, node) pairs first: signatures join only where a bucket has company
    members = scratch.save(met.join(nodes.select("node", "size", "sketch"), "node").select("path", "node", "size", "sketch"), "members-1")
    edges = scratch.save(_tiles(members, counts.where(F.col("n") <= TILE)), "edges-1")
    for turn in range(2, LEVELS + 1):
        large = counts.where(F.col("n") > TILE)
        if large.isEmpty():
            return edges
        level = scratch.save(join_counts(members, large, "path").drop("n"), f"level-{turn}")
        children = scratch.save(_split(level, turn, runs), f"members-{turn}")
        sizes = scratch.save(children.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"counts-{turn}")
        whole = large.join(sizes.groupBy("parent").agg(F.max("n").alias("most")), F.col("path") == F.col("parent"), "left")  # a row per bucket
        whole = scratch.save(whole.where(F.col("most") > F.col("n") / 2).select("path", "n"), f"whole-{turn}")  # most of it agrees
        rest = sizes.join(whole.select(F.col("path").alias("parent")), "parent", "left_anti").select("path", "n")
        now, last = children.select("path", "node", "size", "sketch"), turn == LEVELS
        fits = rest if last else rest.where(F.col("n") <= TILE)
        found = _tiles(level, whole).unionByName(_tiles(now, fits))
        edges = edges.unionByName(scratch.save(found, f"edges-{turn}"))
        members, counts = now, rest
    return edges


class _Side:
    """The sets of one tile over shared token numbers, as bit rows."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self.flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(sets)), self.sizes)


def _exact(left: _Side, right: _Side, threshold: float = THRESHOLD) -> Iterator[tuple[int, np.ndarray]]:
    """For each left set the mask of right sets with a Jaccard similarity of at least ``threshold``."""
    tokens, inverse = np.unique(np.concatenate([left.flat, right.flat]), return_inverse=True)
    a, b = inverse[: len(left.flat)], inverse[len(left.flat) :]
    both = np.zeros(len(tokens), bool)
    both[a] = True
    seen = np.zeros(len(tokens), bool)
    seen[b] = True
    both &= seen  # only tokens of both sides count
    number = np.cumsum(both) - 1
    wide = (int(both.sum()) + 63) // 64

    def bits(side: _Side, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(side.sizes), max(1, wide)), np.uint64)
        keep = both[at]
        n = number[at[keep]]
        np.bitwise_or.at(out, (side.row[keep], n >> 6), np.uint64(1) << (n & 63).astype(np.uint64))
        return out

    x, y = bits(left, a), bits(right, b)
    for i in range(len(x)):
        shared = np.bitwise_count(x[i] & y).sum(1, dtype=np.int64)
        yield i, shared >= threshold * (left.sizes[i] + right.sizes - shared) - 1e-9


def _verify(sets: DataFrame) -> DataFrame:
    """sets: (root, tiles, tile, node, copies, tokens). Rows (u, v, null) of a forest and (u, null, n) of link counts."""
    tiles = sets.groupBy("root", "tiles", "tile").agg(F.collect_list(F.struct("node", "copies", "tokens")).alias("left"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs, ns = [], [], []
            for k in range(batch.num_rows):
                sides = []
                for column in (0, 1):
                    cell = batch.column(column)[k]
                    if not cell.is_valid:
                        sides.append(sides[0])
                        continue
                    values = cell.values
                    node, first = np.unique(values.field(0).to_numpy(), return_index=True)  # a node may come by several equal rows
                    tokens = values.field(2)
                    sides.append((node, values.field(1).to_numpy()[first], _Side([tokens[int(i)].values.to_numpy() for i in first])))
                (a, wa, x), (b, wb, y) = sides
                same = sides[0] is sides[1]
                if same and len(a) < 2:
                    continue
                near = np.zeros((len(a), len(b)), bool)
                for i, mask in _exact(x, y):
                    near[i] = mask
                if same:
                    np.fill_diagonal(near, False)
                for u, n in [(a, near @ wb)] + ([] if same else [(b, wa @ near)]):
                    us += u[n > 0].tolist()
                    vs += [None] * int((n > 0).sum())
                    ns += n[n > 0].tolist()
                for u, v in forest(a, b, near, same):
                    us.append(u)
                    vs.append(v)
                    ns.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64()), pa.array(ns, pa.int64())], names=["u", "v", "n"])

    return _pairs(tiles, "root").mapInArrow(giving_back(compare), "u long, v long, n long")


def _tokens_of(docs: DataFrame) -> DataFrame:
    """(node, tokens) of each given document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                sets = [shingles(x) for x in _word_lists(batch.slice(at, SLICE), 0)]
                yield pa.RecordBatch.from_arrays([pa.array([set_hash(x) for x in sets], pa.int64()), _list_array(sets)], names=["node", "tokens"])

    return docs.select(_hashed_words()).mapInArrow(giving_back(read), "node long, tokens array<long>")


def _semi(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents that stand for the wanted nodes; equal rows all come."""
    # texts move once, by merge join at every size: the keys grow with the documents
    keys = wanted.select(F.col("one.text_key").alias("_k"), F.col("one.doc_id").alias("_d")).hint("merge")
    return docs.join(keys, (F.xxhash64("text") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi")


def jaccard_join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(doc_id, text_key, node, class_id, class_key, n_links) for each row of ``docs``.

    ``class_id`` is the least id of the component of links, ``class_key`` the text hash of that
    row, ``n_links`` the number of other rows with a similarity of at least the threshold.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    runs = runs_for(recall)
    docs = docs.select("doc_id", "text")
    rows = scratch.save(_documents_as_sets(docs, runs), "rows")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "text_key")).alias("one")
    nodes = rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), one, *(F.any_value(c).alias(c) for c in ("size", "sketch", "paths")))
    nodes = scratch.save(nodes, "nodes")
    maybe = components(_candidates(nodes, runs, scratch), scratch, "maybe")
    found = scratch.save(maybe.join(nodes.select("node", "copies", "one", "size"), "node"), "maybe")
    tiles = found.groupBy("root").agg(F.ceil(F.sum("size") / EXACT).cast("int").alias("tiles"))
    wanted = found.join(tiles, "root").withColumn("tile", F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles")).cast("int"))
    wanted = scratch.save(wanted.select("root", "tiles", "tile", "node", "copies", "one"), "wanted")
    sets = _tokens_of(_semi(docs, wanted)).join(wanted.drop("one").hint("merge"), "node")
    found = scratch.save(_verify(sets), "found")
    linked = found.where("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    joined = components(found.where("v is not null").select("u", "v"), scratch, "exact")
    classes = joined.join(nodes.select("node", "one"), "node").groupBy("root").agg(F.min("one").alias("class"))
    of_node = joined.join(classes, "root").select("node", "class")
    own = F.coalesce("class", "one")
    table = nodes.select("node", "copies", "one").join(of_node, "node", "left").join(linked, "node", "left")
    table = table.select("node", own["doc_id"].alias("class_id"), own["text_key"].alias("class_key"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    rows = rows.select("doc_id", "text_key", "node")
    bare = rows.where("node is null").select("*", F.col("doc_id").alias("class_id"), F.col("text_key").alias("class_key"), F.lit(0).cast("long").alias("n_links"))
    return rows.join(scratch.save(table, "table"), "node").select(bare.columns).unionByName(bare)


def drop_near_copies(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of each class, that of the least id. Rows without words all stay."""
    kept = Kept(docs, "doc_id", "text")
    docs = kept.frame
    found = jaccard_join(docs, recall).where(F.col("node").isNotNull() & (F.col("n_links") > 0))
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("class_key"))
    keys = found.groupBy(F.col("doc_id").alias("id"), "text_key").agg(F.bool_or(stays).alias("stays"), F.count(F.lit(1)).alias("n"))
    keys = Scratch(docs.sparkSession, "kept").save(keys, "keys")
    keyed = docs.withColumn("own_key", F.xxhash64("text"))
    match = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("text_key"))
    out = keyed.join(keys.where("not stays or n > 1").hint("merge"), match, "left_anti")
    again = keys.where("stays and n > 1")  # equal rows of one id: one of them stays
    if not again.isEmpty():
        out = out.unionByName(keyed.join(again.hint("merge"), match, "left_semi").dropDuplicates(["doc_id", "own_key"]))
    return kept.back(out)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")
