import os
import sys
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import SCHEMA, odd_documents  # noqa: E402
from littoral.llm import common, components, embeddings, jaccard  # noqa: E402
from littoral.llm.common import Scratch  # noqa: E402

MORE, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def classes(ids, links):
    """id -> least id reachable."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for i in sorted(ids):
        todo = [i] if i not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo += near[x]
    return out


@pytest.mark.parametrize("hot", [100_000, 40])
def test_components_against_search(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(500)]
    edges = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.root for r in components.components(edges, Scratch(spark, "t")).collect()}
    want = classes({x for p in links if p[0] != p[1] for x in p}, links)
    assert got == want
    assert components.components(edges.limit(0), Scratch(spark, "t")).count() == 0


def brute_vectors(frame, threshold=0.95):
    good, links = [], []
    for i, v in zip(frame.vec_id, frame.embedding, strict=True):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            v = np.array(v, np.float64)
            good.append((i, v / np.linalg.norm(v)))
    m = np.array([v for _, v in good])
    cos = m @ m.T
    ids = [i for i, _ in good]
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(cos >= threshold, 1)), strict=True)]
    return links


def same_vectors(rows, frame):
    links = brute_vectors(frame)
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    want = classes(frame.vec_id, links)
    assert len(rows) == len(frame)
    for r in rows:
        assert (r.n_links, r.component_id, r.kept) == (count[r.vec_id], want[r.vec_id], r.vec_id == want[r.vec_id])


def test_embeddings_against_brute_force(spark):
    same_vectors(embeddings.op5_embeddings(spark, LARGER).collect(), pd.read_parquet(f"{LARGER}/embeddings.parquet"))


def test_embeddings_with_copies_added(spark):
    frame = pd.read_parquet(f"{LARGER}/embeddings.parquet")
    rng, old = np.random.default_rng(8), np.stack(frame.embedding)
    noise = rng.normal(size=(300, old.shape[1])) * np.linalg.norm(old[:300], axis=1, keepdims=True) * np.linspace(0.01, 0.06, 300)[:, None]
    rows = [(int(i), v.tolist()) for i, v in enumerate(np.concatenate([old, old[:300] + noise, old[:50], old[:50]]).astype(np.float32))]
    frame = pd.DataFrame(rows, columns=["vec_id", "embedding"])
    assert len(brute_vectors(frame)) > 150
    same_vectors(embeddings.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect(), frame)


def test_embeddings_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 40)
    monkeypatch.setattr(embeddings, "MOST", 40)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(60, 24))
    rows = [(i, [float(x) for x in centre[i % 60 if i % 3 else 0] + rng.normal(size=24) * 0.18]) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]
    frame = pd.DataFrame(rows, columns=["vec_id", "embedding"])
    same_vectors(embeddings.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), frame)


def test_embeddings_odd_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [3.0, 4.0]), (7, [3.0, 4.0]), (8, [1e200, 1e200]), (9, [6.0, 8.0]), (10, [1e-300, 1e-300]), (None, [3.0, 4.0]), (11, [1.0])]
    out = embeddings.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    by = {r.vec_id: r for r in out}
    assert len(out) == len(rows) and all(by[i].n_links == 0 and by[i].component_id == i and by[i].kept for i in (1, 2, 3, 4, 5, 6, 11))
    assert by[7].n_links == by[9].n_links + 0 and by[7].component_id == 7 and not by[9].kept and not by[None].kept and by[None].component_id == 7
    assert by[8].n_links == by[7].n_links and by[8].component_id == 7  # cosine of (1, 1) and (3, 4) is 0.99
    assert embeddings.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def shingle_set(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_texts(texts):
    sets, owners = {i: shingle_set(t) for i, t in texts.items()}, defaultdict(list)
    for i, s in sets.items():
        for x in s:
            owners[x].append(i)
    shared = defaultdict(int)
    for ids in owners.values():
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                shared[ids[a], ids[b]] += 1
    return [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9]


def same_texts(rows, texts):
    links = brute_texts(texts)
    count, want = defaultdict(int), classes(texts, links)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert len(rows) == len(texts) and links
    for r in rows:
        assert (r.n_links, r.class_id) == (count[r.doc_id], want[r.doc_id])


def test_jaccard_against_brute_force(spark):
    frame = pd.read_parquet(f"{MORE}/documents.parquet")
    same_texts(jaccard.op7_jaccard(spark, MORE).collect(), dict(zip(frame.doc_id, frame.text, strict=True)))


@pytest.mark.parametrize("tile", [4, 16])
def test_jaccard_splits_large_buckets(spark, monkeypatch, tile):
    """Groups of near copies and a passage that all share, with buckets far larger than a tile."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "EXACT", 500)
    monkeypatch.setattr(common, "HOT_ROWS", 60)
    rng = np.random.default_rng(6)
    passage = [f"p{i}" for i in range(12)]
    texts = {}
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(90)]
        for c in range(25):
            own = list(base)
            for i in rng.choice(90, 1 + c % 3, replace=False):
                own[i] = f"x{g}_{c}_{i}"
            texts[g * 25 + c] = " ".join(passage + own)
    for i in range(200):
        texts[500 + i] = " ".join(passage + [f"q{i}_{k}" for k in range(6)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    same_texts(jaccard.jaccard_join(docs).collect(), texts)


def test_jaccard_odd_rows(spark):
    docs = odd_documents(spark)
    out = jaccard.jaccard_join(docs).collect()
    assert len(out) == docs.count()
    by = {r.doc_id: r for r in out}
    assert (by[1].n_links, by[1].class_id) == (1, 1) and by[2].n_links == by[3].n_links == 0 and by[3].class_id == 3
    assert (by[8].class_id, by[8].n_links) == (7, 1)
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 6, 7]
    assert jaccard.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0
    assert jaccard.drop_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
