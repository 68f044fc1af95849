import hashlib
import math
import os
import re
import sys
from collections import Counter, defaultdict

import pandas as pd

sys.path.insert(0, os.path.dirname(__file__))
import corpus_pipeline  # noqa: E402
from fixtures import odd_documents  # noqa: E402
from littoral.llm import secrets  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from test_native import BASE, filled  # noqa: E402
from test_pairs import brute_texts, classes  # noqa: E402
from test_text import TIKTOKEN  # noqa: E402

MORE = "/root/testdata/sf0.01"


def test_pipeline_against_brute_force(spark):
    docs = pd.read_parquet(f"{MORE}/documents.parquet").set_index("doc_id")
    docs = docs[[any(c.isalpha() for c in t) for t in docs.text]]
    texts = docs.text.to_dict()
    least = classes(texts, brute_texts(texts))
    texts = {i: t for i, t in texts.items() if least[i] == i}
    kinds = BASE | {k: (re.compile(p), g, n) for k, (p, g, n) in secrets.ADDED.items()}
    found, owners = {}, defaultdict(set)
    for i, t in texts.items():
        found[i] = sorted((m.start(), k, m.end(), m[g]) for k, (p, g, n) in kinds.items() for m in p.finditer(t) if len(m[g]) >= n)
        for _, _, _, value in found[i]:
            owners[hashlib.sha256(value.encode()).hexdigest()].add(docs.source[i])
    for i, spans in found.items():
        out, at = "", 0
        for start, _, end, value in spans:
            if len(owners[hashlib.sha256(value.encode()).hexdigest()]) < secrets.COPIED_OWNERS:
                if start >= at:
                    out += texts[i][at:start] + "[SECRET]"
                at = max(at, end)
        texts[i] = out + texts[i][at:]
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}
    per = Counter()
    for i in texts:
        per[docs.source[i]] += size[i]
    target = filled(per, (1.0, 2.0, 3.0), 3.0)
    rows = corpus_pipeline.run(spark, MORE).collect()
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= set(texts)
    for i in texts:
        rate = min(3.0, target[docs.source[i]] / per[docs.source[i]])
        assert copies[i] in (math.floor(rate), math.ceil(rate))
    for r in rows:
        assert r.ids == TIKTOKEN.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


CLASHES = ("lang_pred", "score", "secret_spans", "live_hashes", "max_owners", "rate", "copies", "source_size", "node", "class_id", "stays", "found", "looked", "_d", "_k", "_sig", "_copy", "_source")


def test_stages_keep_columns_and_odd_rows(spark):
    docs = odd_documents(spark)
    docs = docs.select("*", *[F.concat_ws("-", F.lit(c), F.coalesce("doc_id", F.lit(0))).alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert all(r[c] == f"{c}-{r.doc_id or 0}" for c in CLASHES), name
        assert stage(spark, docs.limit(0), "").count() == 0
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs, "").collect()}
    assert kept == {1, None, 4, 5, 6, 7, 8}
    last = corpus_pipeline.encoded(spark, docs, "")
    assert last.count() == docs.count() and last.where("not round_trip").count() == 0
