"""Connected components by alternating large and small stars, as joins and aggregations.

Every round sends each node's larger neighbours to its least one. Least neighbours are found
by a map-side combined minimum and joined back; the edges of a node with very many neighbours
stay where they are and get its minimum by broadcast, so such a node is neither collected nor
held by one task. Rounds are written to the shared folder.

Defined cases: self-loops and repeated edges change nothing; an empty edge table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from littoral.llm import common
from littoral.llm.common import Scratch, join_counts


def _toward_least(edges: DataFrame, small: bool, scratch: Scratch, spread: bool, name: str) -> DataFrame:
    """edges: (u, v). Large star: neighbours above u go to the least of u and all its neighbours;
    small star: u and its lesser neighbours go to the least of them. ``spread``: a node may be hot."""
    if small:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if spread:
        both = scratch.save(both, f"{name}-both")
        least = scratch.save(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n"), f"{name}-least")
        joined = join_counts(both, least, "u")
    else:
        joined = both.join(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "u")
    if small:
        out = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """edges: (u long, v long). (node, root): root is the least node reachable; only nodes with an edge."""
    now = scratch.save(edges.select("u", "v").where("u != v").distinct(), f"{name}-0")
    turn, seen = 0, now.agg(F.count(F.lit(1))).first()[0]
    mark = None
    while True:
        turn += 1
        spread = seen > common.HOT_ROWS  # no node has more neighbours than there are edges
        large = _toward_least(now, False, scratch, spread, f"{name}-{turn}-large")
        now = scratch.save(_toward_least(large, True, scratch, spread, f"{name}-{turn}-small"), f"{name}-{turn}")
        if spread:
            scratch.drop(*(f"{name}-{turn}-{star}-{part}" for star in ("large", "small") for part in ("both", "least")))
        if turn > 1:
            scratch.drop(f"{name}-{turn - 1}")
        seen, total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (seen, total) == mark:
            break
        mark = (seen, total)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def forest(a: np.ndarray, b: np.ndarray, near: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """A spanning forest of the pairs (a[i], b[j]) with near[i, j]; same: a and b are one side."""
    left = np.arange(len(a))
    right = left if same else np.arange(len(a), len(a) + len(b))
    label = np.arange(len(a) + (0 if same else len(b)))
    edges = []
    for i in np.flatnonzero(near.any(1)):
        j = np.flatnonzero(near[i])
        others, first = np.unique(label[right[j]], return_index=True)
        fresh = others != label[left[i]]
        if fresh.any():
            edges += [(int(a[i]), int(b[x])) for x in j[first[fresh]]]
            label[np.isin(label, others)] = label[left[i]]
    return edges
