"""Input columns may bear any name that an operator uses inside or gives back."""

import os
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from littoral.llm import bpe, html, jaccard, language, lm, media, mixing, secrets, sharding  # noqa: E402

HERE = Path(bpe.__file__).parent
#: Every word in quotes of the package's sources that could name a column, but for those that an operator reads.
NAMES = sorted({w for f in HERE.glob("*.py") for w in re.findall(r"[\"'](?:of\.)?([A-Za-z_][a-z0-9_]{0,24})[\"']", f.read_text())} - {"doc_id", "text", "lang", "source", "html", "media", "page_id", "url", "vec_id", "embedding"})
TEXTS = [(1, "password = hunter2222 and more words here", "en", "a"), (2, "password = hunter2222 and more words here", "en", "a"), (None, None, None, None), (4, "x" * 300 + " word", "de", "b"), (5, "alpha beta gamma", "en", "b")]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(*r, *[f"{n}-{r[0]}" for n in NAMES]) for r in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in NAMES))


CASES = {
    "plan_mix": (mixing.plan_mix, mixing.PLAN, ()), "shard": (sharding.shard_by_bytes, ("size", "shard", "slot"), ()), "secrets": (secrets.find_secrets, secrets.MADE, ()), "lm": (lm.score, ("n_words", "log_prob", "mean_log_prob", "least_count"), ("text",)),
    "near_copies": (jaccard.drop_near_copies, (), ()), "language": (language.identify, ("lang_pred", "score"), ()), "bpe": (lambda d: bpe.encode(d)[0], ("ids",), ()), "html": (lambda d: html.extract(d.withColumn("html", F.col("text"))), ("text", "n_chars"), ("html",)),
}


@pytest.mark.parametrize("name", CASES)
def test_columns_of_any_name_are_kept(clashing, name):
    operator, made, gone = CASES[name]
    assert len(NAMES) > 150 and len({n.lower() for n in NAMES}) == len(NAMES)
    out = operator(clashing)
    rows = {r["doc_id"]: r for r in out.collect()}
    for n in NAMES:
        if n not in made and n not in gone:
            assert all(r[n] == f"{n}-{i}" for i, r in rows.items()), n
    assert len(set(out.columns)) == len(out.columns) and set(made) <= set(out.columns)


def test_mix_gives_back_the_columns_of_the_input(clashing):
    out = mixing.mix(clashing)
    assert out.columns == clashing.columns
    for r in out.collect():
        assert all(r[n] == f"{n}-{r['doc_id']}" for n in NAMES)


def test_tiles_keep_columns(spark):
    names = [n for n in NAMES if n not in ("tile_row", "tile_col", "npy", "dhash")]
    stored = spark.createDataFrame([(bytearray(media.encode_ppm(b"abc" * 64)), *names)], "media binary, " + ", ".join(f"`{n}` string" for n in names))
    row = media.media_tiles(stored).first()
    assert all(row[n] == n for n in names) and "media" not in row.asDict()


def test_near_copies_of_string_ids(spark):
    docs = spark.createDataFrame([("b", "one two three four five six"), ("a", "one two three four five six"), ("c", "other words")], "doc_id string, text string")
    assert sorted(r.doc_id for r in jaccard.drop_near_copies(docs).collect()) == ["a", "c"]


BROKEN = [b"P5\n3 3\n255", b"P5\n3 3\n255\n", b"P2\n2 1 255\n7 x", b"P2\n2 1 255\n7 -1", b"P1\n2 1\n2 9", b"P1\n2 1\n1", b"P4\n9 1\n\x80", b"P6\n99999999999999999999 1\n255\n", b"P5\n2 1\n9\n\xff\xff", b"P3\n999999999 999999999 255\n1", b"BM", b"BM" + b"\0" * 60, b"P5\n0 3\n255\n", b"P5 # no end"]
_BMP8 = b"BM" + (58).to_bytes(4, "little") + b"\0" * 4 + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (1).to_bytes(4, "little") * 2 + b"\1\0\x08\0" + b"\0" * 24 + b"\0" * 4


@pytest.mark.parametrize("data", [*BROKEN, _BMP8, _BMP8[:-3]])
def test_broken_media_give_none(data):
    assert media.decode(data) is None


def test_broken_media_are_described_as_null(spark):
    stored = spark.createDataFrame([(1, 5, bytearray(b"P5\n3 3\n255")), (2, 0, None), (3, 3, bytearray(media.encode_ppm(b"abc" * 64)))], "doc_id long, n_bytes long, media binary")
    rows = {r.doc_id: r for r in media.read_back(stored).collect()}
    assert rows[1].feature is None and rows[1].media_bytes == 10 and rows[2].media_sha256 is None and rows[3].feature
    assert media.media_tiles(stored).count() == 1
