"""Sharding by histogram sort [native].

The sort key of a row is (hash of its text, hash of its id): equal texts lie side by side and
ids split a group that is larger than a shard. The bytes below candidate boundaries are
counted exactly, one aggregation over all partitions per round; each round divides the
interval that holds a wanted splitter, until a boundary lies within the tolerance. The rows
then move in one exchange. The law is ``bytes``: shard sizes are near equal.

Defined cases: a null text has size 1 and forms a group with the other null texts; an empty
table gives no rows; repeated rows have equal keys and stay in one shard; ties of the key are
numbered in any order; a text of more bytes than a shard fills one, or lies across none; rows
with a null id are told apart by their text; columns named ``size``, ``shard`` or ``slot`` are
replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from littoral.llm.common import Kept, Scratch, documents

#: Candidate boundaries counted per wanted splitter and round.
PROBES = 512
#: A splitter is accepted within this share of one shard's bytes.
TOLERANCE = 0.002
LOW, HIGH = -(1 << 63), 1 << 63
#: Rows of a shard are numbered in parts (by id hash) of about PART_BYTES, PARTS to MOST_PARTS of them, so no task holds
#: a whole shard; the table of their starts, which is broadcast, has shards * MOST_PARTS rows at most.
PARTS, MOST_PARTS, PART_BYTES = 64, 1 << 15, 32 << 20


def text_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _histogram(keys: DataFrame, column: str, spans: list[tuple[int, int, Column | None]]) -> dict[tuple[int, int], int]:
    """Exact bytes in each of PROBES equal slices of each span of ``column``."""
    index = None
    for i, (lo, hi, where) in enumerate(spans):
        step = max(1, -(-(hi - lo) // PROBES))
        inside = (F.col(column) >= F.lit(lo)) & (F.col(column) <= F.lit(hi - 1))
        if where is not None:
            inside = inside & where
        # decimal arithmetic: the width of a span can pass 63 bits
        offset = F.col(column).cast("decimal(20,0)") - F.lit(str(lo)).cast("decimal(20,0)")
        piece = F.floor(offset / F.lit(str(step)).cast("decimal(20,0)")).cast("int") + F.lit(i * (PROBES + 1))
        index = F.when(inside, piece) if index is None else index.when(inside, piece)
    rows = keys.select(index.alias("piece"), "size").where("piece is not null").groupBy("piece").agg(F.sum("size").alias("b")).collect()
    return {divmod(r.piece, PROBES + 1): r.b for r in rows}


def _refine(keys: DataFrame, column: str, wants: list[dict], tolerance: float) -> None:
    """Narrow each want's [lo, hi) around its wanted byte count ``at``; ``below`` counts what lies under lo."""
    open_ = [w for w in wants if not w.get("done")]
    while open_:
        # open wants are equally deep in one grid, so their spans are equal or disjoint
        spans = {(w["lo"], w["hi"], w.get("key")): w.get("where") for w in open_}
        place = {span: i for i, span in enumerate(spans)}
        found = _histogram(keys, column, [(lo, hi, where) for (lo, hi, _), where in spans.items()])
        for w in open_:
            i = place[(w["lo"], w["hi"], w.get("key"))]
            step = max(1, -(-(w["hi"] - w["lo"]) // PROBES))
            cells = sorted((j, b) for (s, j), b in found.items() if s == i)
            run, best = w["below"], (w["below"], w["lo"])
            hit = None
            for j, b in cells:
                if run + b > w["at"]:
                    hit = (j, run, b)
                    break
                run += b
            edges = [(w["below"], w["lo"])]
            if hit:
                j, run, b = hit
                edges += [(run, w["lo"] + j * step), (run + b, min(w["hi"], w["lo"] + (j + 1) * step))]
            else:
                edges.append((run, w["hi"]))
            best = min(edges, key=lambda e: (abs(e[0] - w["at"]), e[1]))
            w["cut"], w["got"] = best[1], best[0]
            if abs(best[0] - w["at"]) <= tolerance or hit is None:
                w["done"] = True
            elif step == 1:
                w["done"], w["group"] = True, (w["lo"] + hit[0], hit[1], hit[2])
            else:
                w["lo"], w["hi"], w["below"] = w["lo"] + hit[0] * step, min(w["hi"], w["lo"] + (hit[0] + 1) * step), hit[1]
        open_ = [w for w in open_ if not w.get("done")]


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> tuple[list[tuple[int, int]], int]:
    """The ``shards - 1`` boundaries (k1, k2): a row lies below one if (k1, k2) < boundary."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    wants = [{"at": total * (i + 1) / shards, "lo": LOW, "hi": HIGH, "below": 0} for i in range(shards - 1)]
    if total == 0:
        return [(0, LOW)] * (shards - 1), 0
    _refine(keys, "k1", wants, slack)
    inner = []
    for w in wants:
        if "group" in w and abs(w["got"] - w["at"]) > slack:  # a group of equal texts lies across: split it by id
            key, below, _ = w["group"]
            inner.append({"at": w["at"], "lo": LOW, "hi": HIGH, "below": below, "where": F.col("k1") == F.lit(key), "of": w, "key": key})
    _refine(keys, "k2", inner, slack)
    for x in inner:
        x["of"]["pair"] = (x["key"], x["cut"])
    return [w.get("pair", (w["cut"], LOW)) for w in wants], total


def shard_by_bytes(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``size, shard, slot``; slots number the rows of a shard without gaps."""
    kept = Kept(docs, "doc_id", "text")
    docs, scratch = kept.frame, Scratch(kept.frame.sparkSession, "shard")
    k1 = F.xxhash64(F.col("text").isNull(), "text")
    # a null id leaves the seed of the hash as it is, so the text must tell such rows apart
    k2 = F.xxhash64(F.lit(5), "doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(6), "text")))
    slim = scratch.save(docs.select(k1.alias("k1"), k2.alias("k2"), text_bytes(F.col("text")).alias("size")), "keys")
    cuts, total = splitters(slim, shards, tolerance)
    parts = min(MOST_PARTS, max(PARTS, -(-total // (shards * PART_BYTES))))

    def place(a: Column, b: Column) -> Column:
        out = F.lit(0)
        for x, y in cuts:
            if x >= HIGH:
                continue
            above = (a >= F.lit(x)) if y <= LOW else (a > F.lit(x)) | ((a == F.lit(x)) & (b >= F.lit(y))) if y < HIGH else a > F.lit(x)
            out = out + above.cast("int")
        return out

    part = F.pmod(F.shiftright(F.col("k2"), 7), F.lit(parts)).cast("int")
    counts = slim.groupBy(place(F.col("k1"), F.col("k2")).alias("shard"), part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("start"))
    rows = docs.withColumns({"size": text_bytes(F.col("text")), "k1": k1, "k2": k2})
    rows = rows.withColumns({"shard": place(F.col("k1"), F.col("k2")), "part": part})
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("shard", "part").orderBy("k1", "k2", "size")))
    rows = rows.join(F.broadcast(starts), ["shard", "part"])  # shards * MOST_PARTS rows at most
    return kept.back(rows.withColumn("slot", (F.col("start") + F.col("n") - 1).cast("long")), "size", "shard", "slot")


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(documents(spark, sf_dir))
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
