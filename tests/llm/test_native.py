import base64
import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import SCHEMA, odd_documents  # noqa: E402
from littoral.llm import media, mixing, secrets, sharding  # noqa: E402

SMALL = "/root/testdata/sf0.001"
DOCS = pd.read_parquet(f"{SMALL}/documents.parquet")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights, cap):
    """Water-filling by repeated resharing."""
    total, names = sum(sizes.values()), sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return fixed | {s: level * w[s] for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("weights", [(1.0, 2.0, 3.0), (1.0, 50.0, 1.0)])
def test_targets_match_repeated_resharing(spark, weights):
    sizes = {"a": 100, "b": 5000, "c": 30, "d": 0, "é": 700, None: 10}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(table, weights).collect()}
    wanted = filled(sizes, weights, 3.0)
    assert found.keys() == wanted.keys()
    for s in wanted:
        assert math.isclose(found[s], wanted[s], rel_tol=1e-9, abs_tol=1e-9)


def test_mix_against_brute_force(spark):
    rows = mixing.op1_mix(spark, SMALL).collect()
    assert len(rows) == len(DOCS)
    size = {d: len(WORDS.findall(t or "")) for d, t in zip(DOCS.doc_id, DOCS.text, strict=True)}
    per = Counter()
    for d, s in zip(DOCS.doc_id, DOCS.source, strict=True):
        per[s] += size[d]
    wanted, source = filled(per, (1.0, 2.0, 3.0), 3.0), dict(zip(DOCS.doc_id, DOCS.source, strict=True))
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == per[source[r.doc_id]]
        assert math.isclose(r.target, wanted[source[r.doc_id]], rel_tol=1e-9)
        rate = r.target / r.source_size
        assert r["size"] == 0 or r.taken / r["size"] in (math.floor(rate), math.ceil(rate))
    assert abs(sum(r.taken for r in rows) / sum(per.values()) - 1) < 0.25
    assert sorted(rows) == sorted(mixing.op1_mix(spark, SMALL).collect())


def test_many_sources_are_joined_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"s{i % 7}" if i % 3 else None, "word " * (i % 50)) for i in range(600)], "doc_id long, source string, text string")
    few = sorted(mixing.plan_mix(docs).collect(), key=str)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert sorted(mixing.plan_mix(docs).collect(), key=str) == few


def test_each_source_comes_near_its_target(spark):
    rows = mixing.op1_mix(spark, "/root/testdata/sf0.1").toPandas()
    for (target, _), own in rows.groupby(["target", "source_size"]):
        # coins of documents are independent: five standard deviations of their sum
        assert abs(own.taken.sum() - target) <= 5 * math.sqrt((own["size"].astype(float) ** 2).sum() / 4)


def test_hot_keys_are_judged_in_place(spark, monkeypatch):
    from littoral.llm import common

    docs = spark.createDataFrame([(i, f"password = hunter{i % 3}{i % 3}{i % 3}{i % 3}{i % 3} and token: {'own' + str(i) * 4 if i % 5 else 'samesame1'}", "en", f"s{i % 4}") for i in range(300)], "doc_id long, text string, lang string, source string")
    plain = sorted(secrets.find_secrets(docs).collect())
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    assert sorted(secrets.find_secrets(docs).collect()) == plain


def test_mix_odd_rows(spark):
    docs = odd_documents(spark)
    planned = mixing.plan_mix(docs)
    assert planned.count() == docs.count()
    by = {(r.doc_id, r.source): r for r in planned.collect()}
    assert by[(3, None)]["size"] == 0 and by[(None, "b")]["size"] == 2 and by[(4, "b")]["size"] == 30000
    assert set(mixing.mix(docs).columns) <= set(docs.columns)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shards_are_near_equal_and_keep_groups(spark):
    rows = sharding.op2_shard(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(DOCS.doc_id)
    text = dict(zip(DOCS.doc_id, DOCS.text, strict=True))
    load, slots, shards = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        assert r["size"] == len((text[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode())
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        shards[text[r.doc_id]].add(r.shard)
    assert set(load) == set(range(8)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(load.values()) - min(load.values()) <= 2 * max(len(t.encode()) for t in DOCS.text)
    assert all(len(v) == 1 for v in shards.values())


def test_a_group_larger_than_a_shard_is_split_by_id(spark):
    docs = spark.createDataFrame([(i, "same" if i % 2 else f"t{i}") for i in range(4000)], "doc_id long, text string")
    load = Counter()
    for r in sharding.shard_by_bytes(docs).collect():
        load[r.shard] += r["size"]
    assert max(load.values()) <= 1.02 * sum(load.values()) / 8


def test_shard_odd_rows(spark):
    docs = odd_documents(spark)
    rows = sharding.shard_by_bytes(docs, 3).collect()
    assert len(rows) == docs.count() and {r.shard for r in rows} <= {0, 1, 2}
    assert sharding.shard_by_bytes(spark.createDataFrame([], SCHEMA)).count() == 0


BASE = {
    "assign": (re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def base_spans(text):
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, (p, g, n)) in enumerate(BASE.items()) for m in p.finditer(text or "") if len(m[g]) >= n]
    return [x[2] for x in sorted(found)]


def test_spans_against_python(spark):
    seen = 0
    for r in secrets.op3_secrets(spark, "/root/testdata/sf0.01").collect():
        want = base_spans(BIG[r.doc_id])
        seen += len(want)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(",")) | {""}
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in want) for k in BASE)
    assert seen > 10


_big = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
BIG = dict(zip(_big.doc_id, _big.text, strict=True))


def test_secrets_odd_rows_ownership_and_redaction(spark):
    docs = odd_documents(spark)
    found = secrets.find_secrets(docs)
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for d, r in rows.items():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.secret_spans if s.kind in BASE] == base_spans(texts[d])
    shared = hashlib.sha256(b"0123456789abcdef01234567").hexdigest()
    assert shared in rows[7].live_hashes  # two owners only
    few = {r.doc_id: r for r in secrets.find_secrets(docs, copied_owners=2, copied_repositories=2).collect()}
    assert shared not in few[7].live_hashes and few[5].live_hashes
    forks = secrets.find_secrets(docs, copied_owners=2, copied_repositories=2, repository=F.lit("one")).collect()
    assert all(shared in r.live_hashes and (r.max_owners, r.max_repositories) == (2, 1) for r in forks if r.doc_id in (7, 8))
    clean = {r.doc_id: r.text for r in secrets.redact(found).collect()}
    assert "hunter2222" not in clean[5] and "AKIA" not in clean[5] and clean[1] == "one two three" and clean[3] is None
    assert secrets.find_secrets(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_survive_the_picture(spark):
    for r in media.op6_media(spark, SMALL).collect():
        raw = DOCS.set_index("doc_id").text[r.doc_id].encode()
        payload = raw + b" " * (-len(raw) % 192)
        stored = b"P6\n64 %d\n255\n" % (len(payload) // 192) + payload
        assert (r.n_bytes, r.payload_bytes, r.media_bytes) == (len(raw), len(payload), len(stored))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.media_sha256 == hashlib.sha256(stored).hexdigest()
        assert r.tail_crc32 == zlib.crc32(payload[-16:])


def plain_hash(picture):
    """The difference hash by the share of every pixel in every cell, pixel by pixel."""
    from fractions import Fraction

    height, width = len(picture), len(picture[0])
    grey = [[0.299 * r + 0.587 * g + 0.114 * b for r, g, b in row] for row in picture]

    def shares(n, cells):
        return [[max(Fraction(0), min(Fraction(i + 1), Fraction((c + 1) * n, cells)) - max(Fraction(i), Fraction(c * n, cells))) for i in range(n)] for c in range(cells)]

    down, across = shares(height, 8), shares(width, 9)
    cell = [[sum(float(y * x) * grey[i][j] for i, y in enumerate(down[a]) if y for j, x in enumerate(across[b]) if x) * 72 / (height * width) for b in range(9)] for a in range(8)]
    bits = "".join("1" if round(cell[a][b], 6) < round(cell[a][b + 1], 6) else "0" for a in range(8) for b in range(8))
    return f"{int(bits, 2):016x}"


def test_media_feature_against_plain_loops(spark):
    import io

    import numpy as np

    texts = ["", "a short text", "two words " * 30, "é and ü " * 900, "the longest text of all, over several tiles " * 320]
    rows = media.read_back(media.store_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    for r in rows:
        raw = texts[r.doc_id].encode()
        raw += b" " * (-len(raw) % 192 or (192 if not raw else 0))
        pixels = [[tuple(raw[(y * 64 + x) * 3 : (y * 64 + x) * 3 + 3]) for x in range(64)] for y in range(len(raw) // 192)]
        tiles = hashlib.sha256()
        for at in range(0, len(pixels), 64):
            part, out = pixels[at : at + 64], io.BytesIO()
            np.save(out, np.array(part, np.uint8))
            tiles.update(b"%d,0," % (at // 64) + out.getvalue() + plain_hash(part).encode())
        assert r.feature == f"64x{len(pixels)}:{plain_hash(pixels)}:{tiles.hexdigest()[:16]}", r.doc_id


def test_media_odd_rows_and_decoders(spark):
    import io

    import numpy as np

    docs = odd_documents(spark)
    rows = media.read_back(media.store_texts(docs)).collect()
    assert len(rows) == docs.count() and {r.payload_bytes for r in rows if r.n_bytes == 0} == {192}
    grey = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert (media.decode(b"P5 # note\n4 3\n255\n" + grey.tobytes())[:, :, 0] == grey).all()
    assert (media.decode(b"P2\n4 3 255\n" + b" ".join(b"%d" % x for x in grey.ravel()))[:, :, 0] == grey).all()
    assert media.decode(b"P1\n2 1\n1 0")[:, :, 0].tolist() == [[0, 255]] and media.decode(b"P4\n2 1\n\x80")[:, :, 0].tolist() == [[0, 255]]
    assert media.decode(b"P5\n2 1\n65535\n\xff\xff\x00\x00")[:, :, 0].tolist() == [[255, 0]]
    colour = np.arange(27, dtype=np.uint8).reshape(3, 3, 3)
    body = b"".join(row[:, ::-1].tobytes() + b"\0" * 3 for row in colour[::-1])
    bmp = b"BM" + (54 + len(body)).to_bytes(4, "little") + b"\0" * 4 + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (3).to_bytes(4, "little") * 2 + b"\1\0\x18\0" + b"\0" * 24 + body
    assert (media.decode(bmp) == colour).all()
    assert media.decode(b"GIF89a") is None and media.decode(b"P5\n9 9\n255\nxx") is None and media.decode(None) is None
    big = np.random.default_rng(1).integers(0, 255, (130, 70, 3), dtype=np.uint8)
    stored = spark.createDataFrame([(1, b"P6\n70 130\n255\n" + big.tobytes()), (2, None), (3, b"junk")], "id int, media binary")
    tiles = media.media_tiles(stored).collect()
    whole = np.zeros_like(big)
    for t in tiles:
        part = np.load(io.BytesIO(t.npy))
        whole[t.tile_row * 64 : t.tile_row * 64 + part.shape[0], t.tile_col * 64 : t.tile_col * 64 + part.shape[1]] = part
    assert (whole == big).all() and len(tiles) == 6
    exact = media.area_resize(np.arange(64.0).reshape(8, 8), 4, 2)
    assert np.allclose(exact, np.arange(64.0).reshape(4, 2, 2, 4).mean((1, 3)))


def test_key_blocks_are_told_apart_and_masked_whole(spark):
    def block(seed, end="\n-----END RSA PRIVATE KEY-----", gap="\n", head=""):
        body = base64.b64encode(hashlib.sha512(seed).digest() * 3).decode()
        return f"-----BEGIN RSA PRIVATE KEY-----{gap}{head}" + gap.join(body[i : i + 64] for i in range(0, len(body), 64)) + end

    enc = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC,0011\n\n"
    texts = [(block(b"shared"), f"s{i}") for i in range(3)] + [(block(b"shared", gap="\r\n"), "s3"), (block(b"own0"), "s0"), (block(b"own1", end=""), "s1"), (block(b"own2", gap="\\n"), "s2"), (block(b"own3", head=enc), "s3"), (block(b"own4", gap=" ", end=""), "s4")]
    rows = [(i, f"before {t}\nand after {block(b'own0') if i == 4 else ''}", "en", s) for i, (t, s) in enumerate(texts)]
    rows.append((99, "a line -----BEGIN RSA PRIVATE KEY----- starts a key " + "- x" * 50000, "en", "s5"))
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    live = {r.doc_id: r for r in found.collect()}
    clean = {r.doc_id: r.text for r in secrets.redact(found).collect()}
    for i, text, *_ in rows[:9]:
        assert [s.kind for s in live[i].secret_spans if s.kind == "pem"] == ["pem"] * text.count("BEGIN")
        assert clean[i] == (text if i < 4 else text.replace(texts[i][0], "[SECRET]")), i
    assert len({live[i].secret_spans[0].hash for i in range(4)}) == 1  # a copied example, however broken into lines
    assert len({live[i].secret_spans[0].hash for i in range(9)}) == 6
    assert [(s.kind, s.end - s.start) for s in live[99].secret_spans] == [("pem", 31)]
