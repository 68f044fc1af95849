"""Queries of the training-data operators, one for each.

SQL is given where it can express the result: secrets and both pair operators. It cannot
express the drawn copies of a mix, splitters, models, pictures, parsers and merges; there the
tests hold each query against a brute-force version, a round trip or held-out accuracy.
"""

from __future__ import annotations

from littoral.llm import secrets
from littoral.llm.bpe import op10_bpe
from littoral.llm.embeddings import op5_embeddings
from littoral.llm.html import op8_html
from littoral.llm.jaccard import op7_jaccard
from littoral.llm.language import op9_language
from littoral.llm.lm import op4_lm
from littoral.llm.media import op6_media
from littoral.llm.mixing import op1_mix
from littoral.llm.secrets import op3_secrets
from littoral.llm.sharding import op2_shard

QUERIES = {f.__name__: f for f in (op1_mix, op2_shard, op3_secrets, op4_lm, op5_embeddings, op6_media, op7_jaccard, op8_html, op9_language, op10_bpe)}

_KINDS = {**secrets.BASE, **secrets.ADDED}


def _spans(at: int, kind: str) -> str:
    pattern, group, least = _KINDS[kind]
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, source, lang, {at} AS k, '{kind}' AS kind, list_sum(list_transform(g[1:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n, v[i] AS v FROM
 (SELECT doc_id, source, lang, string_split_regex(text, '{quoted}') AS g, regexp_extract_all(text, '{quoted}', 0) AS m, regexp_extract_all(text, '{quoted}', {group}) AS v, unnest(range(1, len(regexp_extract_all(text, '{quoted}', 0)) + 1)) AS i FROM documents) WHERE length(v[i]) >= {least}"""


_REACH = "r(a, b) AS (SELECT DISTINCT id, id FROM ids UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), c AS (SELECT a, MIN(b) AS root FROM r GROUP BY 1), n AS (SELECT a, COUNT(*) AS n FROM l GROUP BY 1)"

ORACLE_SQL: dict[str, str] = {
    "op3_secrets": f"""WITH sp AS ({" UNION ALL ".join(_spans(i, k) for i, k in enumerate(_KINDS))}), own AS (SELECT v, COUNT(DISTINCT COALESCE(source, '')) AS o, COUNT(DISTINCT COALESCE(source, '') || '/' || COALESCE(lang, '')) AS r FROM sp GROUP BY 1),
 one AS (SELECT doc_id, k, kind, s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT) AS t, o, r FROM sp JOIN own USING (v))
 SELECT d.doc_id, COUNT(*) FILTER (k = 0) AS n_assign, COUNT(*) FILTER (k = 1) AS n_access, COUNT(*) FILTER (k = 2) AS n_hex, sha256(COALESCE(string_agg(t, ',' ORDER BY s, k) FILTER (k < {len(secrets.BASE)}), '')) AS base_sha256,
 COALESCE(string_agg(t, ',' ORDER BY s, k), '') AS spans, COUNT(*) FILTER (o < {secrets.COPIED_OWNERS} OR r < {secrets.COPIED_REPOSITORIES}) AS n_live, COALESCE(MAX(o), 0) AS max_owners, COALESCE(MAX(r), 0) AS max_repositories FROM documents d LEFT JOIN one USING (doc_id) GROUP BY 1""",
    "op5_embeddings": f"""WITH RECURSIVE ids AS (SELECT vec_id AS id FROM embeddings), v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
 l AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id WHERE list_cosine_similarity(x.e, y.e) >= 0.95), {_REACH} SELECT c.a AS vec_id, COALESCE(n.n, 0) AS n_links, c.root AS component_id, c.a = c.root AS kept FROM c LEFT JOIN n USING (a)""",
    "op7_jaccard": f"""WITH RECURSIVE ids AS (SELECT doc_id AS id FROM documents), w AS (SELECT doc_id AS id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents), sh AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
 z AS (SELECT id, COUNT(*) AS n FROM sh GROUP BY 1), p AS (SELECT x.id AS a, y.id AS b, COUNT(*) AS n FROM sh x JOIN sh y ON x.s = y.s AND x.id <> y.id GROUP BY 1, 2), l AS (SELECT p.a, p.b FROM p JOIN z x ON x.id = p.a JOIN z y ON y.id = p.b WHERE p.n >= 0.8 * (x.n + y.n - p.n) - 1e-9), {_REACH}
 SELECT c.a AS doc_id, c.root AS class_id, COALESCE(n.n, 0) AS n_links FROM c LEFT JOIN n USING (a)""",
}
