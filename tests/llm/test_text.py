import base64
import hashlib
import math
import os
import struct
import sys
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import tiktoken

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import SCHEMA, odd_documents  # noqa: E402
from littoral.llm import bpe, html, language, lm  # noqa: E402

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_bpe_equals_the_library_on_all_documents(spark):
    texts = pd.read_parquet(f"{SMALL}/documents.parquet").set_index("doc_id").text
    rows = bpe.op10_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = TIKTOKEN.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


ODD = [
    "", " ", "\n\n \t x", "I'll we've they're 'tis 's", "naïve café — “quotes”", "日本語テキスト 漢字", "🙂🙂 emoji​ zero", "a b c　　d\x85e\x1cf",
    "x" * 5000, "ab" * 700 + " " * 900 + "=" * 600, "12345678901234567890 ٣٤٥", "<|endoftext|> plain", "\r\n\r\n  end  ", "Ⅷ ² ½ ªº ǅ", "éclair", "é" * 450,
]


@pytest.mark.parametrize("cache", [0, 4, 1 << 19])
def test_bpe_odd_texts(spark, cache):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD * 2)] + [(99, None)], "doc_id long, text string")
    coded, codec = bpe.encode(docs, cache_words=cache)
    for r in coded.withColumn("back", bpe.decode(bpe.spell(codec, coded.ids))).collect():
        text = ODD[r.doc_id % len(ODD)] if r.doc_id < 99 else ""
        assert r.ids == TIKTOKEN.encode_ordinary(text), text[:20]
        assert bytes(r.back).decode() == text


def test_bpe_odd_rows(spark):
    docs = odd_documents(spark)
    assert bpe.encode(docs)[0].count() == docs.count()
    assert bpe.encode(spark.createDataFrame([], SCHEMA))[0].count() == 0


def test_language_on_held_out_documents(spark):
    docs = pd.read_parquet(f"{MORE}/documents.parquet").set_index("doc_id")
    rows = language.op9_language(spark, MORE).collect()
    assert len(rows) == len(docs)
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.held_out and docs.lang[r.doc_id] is not None:
            right.append(r.lang_pred == docs.lang[r.doc_id])
    assert len(right) > 100 and np.mean(right) > 0.97


VOCABULARY = {base64.b64decode(line.split()[0]) for line in open(PATH, "rb")} | {bytes([i]) for i in range(256)}


def plain_sums(word, p, number):
    """The logarithm of the sum over all segmentations, piece by piece, and the expected number of each piece."""
    n, languages = len(word), p.shape[1]
    longest = max(map(len, VOCABULARY))
    spans = [(i, j, number[word[i:j]]) for i in range(n) for j in range(i + 1, min(n, i + longest) + 1) if word[i:j] in number]
    left, right = [[-math.inf] * languages for _ in range(n + 1)], [[-math.inf] * languages for _ in range(n + 1)]
    left[0], right[n] = [0.0] * languages, [0.0] * languages
    for i, j, x in spans:
        left[j] = [float(np.logaddexp(left[j][k], left[i][k] + math.log(p[x, k]))) for k in range(languages)]
    for i, j, x in reversed(spans):
        right[i] = [float(np.logaddexp(right[i][k], right[j][k] + math.log(p[x, k]))) for k in range(languages)]
    expected = Counter()
    for i, j, x in spans:
        for k in range(languages):
            expected[x, k] += math.exp(left[i][k] + math.log(p[x, k]) + right[j][k] - left[n][k])
    return left[n], expected


def test_forward_sums_all_segmentations():
    pieces = language.Pieces.load(PATH)
    number = {piece: k for k, piece in enumerate(sorted(VOCABULARY))}
    p = np.random.default_rng(1).random((pieces.count, 2)) / 100
    some = [" the", " tion", "été", "a", " internationalization", "donaudampfschifffahrtselektrizitätenhauptbetriebswerk", " " + "日本語の漢字テキスト" * 4, " " + "x" * 500]
    some = [w.encode() for w in some] + [max(VOCABULARY, key=len)]
    weights = language.Weights(pieces, p)
    assert any(len(w) > 60 for w in some)
    assert np.allclose(weights.scores(some), [plain_sums(w, p, number)[0] for w in some])
    counts = np.arange(1.0, 2 * len(some) + 1).reshape(-1, 2)
    want = np.zeros_like(p)
    for w, n in zip(some, counts, strict=True):
        for (x, k), e in plain_sums(w, p, number)[1].items():
            want[x, k] += e * n[k]
    assert np.allclose(weights.expected(some, counts), want)


def test_language_query_against_plain_sums(spark, tmp_path):
    """All of op9: the same sample, rounds and sums in plain loops, over short texts and some odd ones."""
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")[["doc_id", "text", "lang"]]
    docs["text"] = [t[:90] for t in docs.text]
    odd = [(9001, "donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamter", None), (9002, "日本語の漢字テキスト" * 5, None), (9003, "12 34", "en"), (9004, "", None)]
    docs = pd.concat([docs, pd.DataFrame(odd, columns=docs.columns)], ignore_index=True)
    docs.to_parquet(tmp_path / "documents.parquet")
    pattern = regex.compile(r"\p{L}+")
    words = {i: [b" " + w.encode() for w in pattern.findall(t.lower())] for i, t in zip(docs.doc_id, docs.text, strict=True)}
    own = docs[docs.lang.notna() & np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i in docs.doc_id])]
    langs, sizes = sorted(set(own.lang)), Counter(own.lang)
    assert max(sizes.values()) <= language.SAMPLE_DOCS  # so all are taken
    counts = [Counter(w for i in own.doc_id[own.lang == x] for w in words[i]) for x in langs]
    number = {piece: k for k, piece in enumerate(sorted(VOCABULARY))}
    longest = max(map(len, VOCABULARY))
    first = np.zeros((len(number), len(langs)))
    for k, c in enumerate(counts):
        for w, n in c.items():
            for i in range(len(w)):
                for j in range(i + 1, min(len(w), i + longest) + 1):
                    if w[i:j] in number:
                        first[number[w[i:j]], k] += n
    p = language.normal(first)
    for _ in range(language.ROUNDS):
        found = np.zeros_like(p)
        for w in set().union(*counts):
            for (x, k), e in plain_sums(w, p, number)[1].items():
                found[x, k] += e * counts[k][w]
        p = language.normal(found)
    of_word = {w: np.array(plain_sums(w, p, number)[0]) for ws in words.values() for w in ws}
    for r in language.op9_language(spark, str(tmp_path)).collect():
        ws = words[r.doc_id]
        total = sum((of_word[w] for w in ws), np.zeros(len(langs)))
        odds = np.exp(total - total.max())
        assert r.lang_pred == (langs[int(total.argmax())] if ws else "und")
        assert np.isclose(r.score, odds.max() / odds.sum() if ws else 0, atol=1e-3)


def test_language_odd_rows(spark):
    docs = odd_documents(spark)
    rows = {r.doc_id: r for r in language.identify(docs).collect()}
    assert rows[2].lang_pred == rows[3].lang_pred == "und" and rows[2].score == 0 and rows[4].lang_pred in ("en", "fr", "de")
    unlabelled = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language.identify(unlabelled).first().lang_pred == "und"
    assert language.identify(spark.createDataFrame([], SCHEMA)).count() == 0


class Article(HTMLParser):
    """Everything inside the article element."""

    def __init__(self):
        super().__init__()
        self.inside, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "br"):
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1"):
            self.parts.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def test_html_against_the_article_element(spark):
    pages = pd.read_parquet(f"{MORE}/pages.parquet").set_index("page_id").html
    rows = html.op8_html(spark, MORE).collect()
    assert len(rows) == len(pages)
    for r in rows:
        parser = Article()
        parser.feed(pages[r.page_id])
        parser.close()
        assert r.text == " ".join("".join(parser.parts).split()) and r.n_chars == len(r.text)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header><div class="nav-bar"><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></div>
<div id="cookie-notice">We use cookies.</div>%s<div class="sidebar"><p>Related things</p></div><form>Name <input></form><footer>&copy; us</footer></body></html>"""
BODY = "<h1>A &amp; B</h1><p>First&nbsp;long paragraph with <b>in</b>line text that goes on for a while.<p>Second one,\n  also long enough to be told from menus.<script>x='<p>'</script><p>Short."
WANT = "A & B First long paragraph with inline text that goes on for a while. Second one, also long enough to be told from menus. Short."


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><article>%s</article></main>", "<div class=content>%s</div>", "<main>%s<div class='comments'><p>Nice post, I say, and a long one</p></div></main>", "<article>%s<section id='comments'><article class=comment>No.</article></section></article>"])
def test_html_regions(wrap):
    assert html.main_text(PAGE % (wrap % BODY)) == WANT


NOISY = [
    "<div class='layout has-sidebar'><article>%s</article></div>", "<div id='page-with-menu'>%s</div>", "<div class='widget'><article>%s</article></div>", "<div class='sidebar'><main>%s</main></div>",
    "<div class=menu><div class=share>%s</div></div>", "<article>%s<p class=ad>Buy this<p class=ad>and this</article>", "<article><p class=ad>Buy this%s</article>", "<div class=content><ul><li class=ad>Buy<li class=ad>now</ul>%s</div>",
]


@pytest.mark.parametrize("wrap", NOISY)
def test_html_names_are_evidence_only(wrap):
    assert html.main_text(PAGE % (wrap % BODY)) == WANT


def plain_content(chars, tags, weight, region):
    """The clusters in plain loops."""
    n = len(chars)
    ratio = [weight[i] * math.log1p(chars[i] / max(tags[i], 1)) for i in range(n)]
    smooth = []
    for i in range(n):
        own = [j for j in range(n) if region[j] == region[i]]
        at = own.index(i)
        near = [(math.exp(-0.5 * ((at - k) / html.SIGMA) ** 2), ratio[j]) for k, j in enumerate(own) if abs(at - k) <= math.ceil(3 * html.SIGMA)]
        smooth.append(sum(w * x for w, x in near) / sum(w for w, _ in near))
    low, high = min(smooth), max(smooth)
    for _ in range(20):
        below, above = [x for x in smooth if x < (low + high) / 2], [x for x in smooth if x >= (low + high) / 2]
        if not below:
            break
        low, high = sum(below) / len(below), sum(above) / len(above)
    return [x > 0 and x >= min((low + high) / 2, math.log1p(3)) - 1e-12 for x in smooth]


def test_html_clusters_against_plain_loops():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 60):
        chars, tags = rng.integers(0, 400, n), rng.integers(0, 9, n)
        weight, region = rng.choice([0.0, html.NAMED, 1.0], n), rng.integers(0, 4, n)
        assert html.content_lines(chars, tags, weight, region).tolist() == plain_content(chars, tags, weight, region)


@pytest.mark.parametrize("other", [lambda c, *_: np.ones(len(c), bool), lambda c, *_: np.arange(len(c)) % 2 == 0])
def test_html_text_depends_on_the_clusters(monkeypatch, other):
    pages = pd.read_parquet(f"{SMALL}/pages.parquet").html
    before = [html.main_text(x) for x in pages]
    monkeypatch.setattr(html, "content_lines", other)
    assert all(html.main_text(x) != y for x, y in zip(pages, before, strict=True))


def test_html_without_article_elements():
    """Regions told by ratio alone: no element or name speaks of menus."""
    links = "".join(f"<div><a href=/{i}>Entry {i}</a></div>" for i in range(12))
    list_ = "<ul>" + "".join(f"<li>step {i} of it</li>" for i in range(9)) + "</ul>"
    page = f"<body><div class=x1>{links}</div><div class=x2><div class=x3>{BODY}</div><div class=x4>{list_}</div></div><div class=x5>{links}</div></body>"
    assert html.main_text(page) == f"{WANT} " + " ".join(f"step {i} of it" for i in range(9))


@pytest.mark.parametrize("head", ["<header class='entry-header'><h1>Title</h1></header>", "<div class='post-header'><h1>Title</h1></div>", "<header><h1>Title</h1></header>", "<div class=header><h1>Title</h1></div>"])
def test_html_titles_stay(head):
    assert html.main_text(PAGE % f"<article>{head}{BODY}</article>") == f"Title {WANT}"


def test_html_names_inside_an_article():
    head, work = "<div class='entry-header'><h1>Title</h1></div>", "<section id='related-work'><p>Earlier work on this matter</p></section>"
    assert html.main_text(PAGE % f"<article>{head}{BODY}{work}</article>") == f"Title {WANT} Earlier work on this matter"
    assert html.main_text("<body><div class='notice'>The only text</div>") == "The only text"


def test_html_odd_rows(spark):
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "plain text", "x"), (4, "u", "<p>unclosed <b>bold", "x"), (5, "u", "<article>" + "<p>word &lt;" * 20000, "x"), (6, "u", "<script>only</script>", "x"), (6, "u", "<script>only</script>", "x")]
    out = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert out[1].text == out[2].text == out[6].text == "" and out[3].text == "plain text" and out[4].text == "unclosed bold"
    assert out[5].text == " ".join(["word <"] * 20000) and out[5].n_chars == len(out[5].text)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


SHAPE = lm.Shape()


def plain_word(net, context, target):
    """One word's log-probability by the formulas."""
    of, members = net.of, net.shape.members
    h = np.tanh(of["bias"] + sum(of["embed"][k][context[k]] for k in range(len(lm.REACH))))
    g, m = target // members, target % members
    a, b = h @ of["group"] + of["group_bias"], h @ of["member"][g] + of["member_bias"][g]
    return a[g] - np.log(np.exp(a).sum()) + b[m] - np.log(np.exp(b).sum())


def plain_context(own, i, outside):
    return [own[i + k] if 0 <= i + k < len(own) else outside for k in lm.REACH]


@pytest.mark.parametrize("shape", [SHAPE, lm.Shape(10, 7, 5, 3, 12)])
def test_lm_windows_and_scores_against_loops(shape):
    rng = np.random.default_rng(3)
    sizes = np.array([0, 1, 5, 0, 7])
    ids = rng.integers(0, shape.classes, sizes.sum()).astype(np.int32)
    context, at, want = lm.windows(ids, sizes, shape.classes), 0, []
    for n in sizes:
        own = ids[at : at + n]
        at += n
        want += [plain_context(own, i, shape.classes) for i in range(n)]
    assert context.tolist() == want
    net = lm.Net(shape)
    for c, t, x in zip(context, ids, net.run(context, ids), strict=True):
        assert np.isclose(x, plain_word(net, c, t), atol=1e-4)


def test_lm_gradient_by_differences():
    rng = np.random.default_rng(4)
    net = lm.Net(SHAPE)
    context, target = rng.integers(0, SHAPE.classes, (6, 4)), rng.integers(0, SHAPE.classes, 6)
    before, flat = net.flat.copy(), net.flat.astype(np.float64)
    net.run(context, target, 1.0)
    grad = (before - net.flat) * np.sqrt(net.sums)
    for i in np.argsort(-np.abs(grad))[:5]:
        step = np.zeros_like(flat)
        step[i] = 1e-2
        low, high = (-lm.Net(SHAPE, flat + s * step).run(context, target).mean() for s in (-1, 1))
        assert np.isclose((high - low) / 2e-2, grad[i], rtol=0.05)


@pytest.mark.parametrize("shape", [SHAPE, lm.Shape(40, 8, 6, 4, 64)])
def test_lm_query_against_plain_loops(spark, monkeypatch, shape):
    """Counts, classes, shares, windows and sums of every document, with the parameters that were fitted."""
    import xxhash

    nets, fit = [], lm.fit

    def kept(*a):
        nets.append(fit(*a))
        return nets[-1]

    monkeypatch.setattr(lm, "fit", kept)
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")[["doc_id", "text"]]
    rows = lm.score(spark.createDataFrame(docs), shape).collect()
    split = {i: [w for w in regex.split(r"[\x20\x09-\x0D]+", t.lower()) if w] for i, t in zip(docs.doc_id, docs.text, strict=True)}
    counts = Counter(w for ws in split.values() for w in ws)
    order = sorted(counts, key=lambda w: (-counts[w], w))
    own = {w: i for i, w in enumerate(order[: shape.known])}

    def hashed(w):
        seed = xxhash.xxh64_intdigest(w.encode(), 42)  # Spark hashes column by column
        number = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), seed)
        number -= (number >> 63) << 64
        return shape.known + number % shape.hashed

    of = {w: own.get(w, hashed(w)) for w in counts}
    totals = Counter()
    for w, n in counts.items():
        totals[of[w]] += n
    for r in rows:
        ws = split[r.doc_id]
        ids = [of[w] for w in ws]
        want = sum(plain_word(nets[0], plain_context(ids, i, shape.classes), ids[i]) + np.log(counts[w] / totals[of[w]]) for i, w in enumerate(ws))
        assert r.n_words == len(ws) and np.isclose(r.log_prob, want, rtol=1e-4, atol=0.02)
        assert r.least_count == (min(counts[w] for w in ws) if ws else None)


def test_lm_parameters_are_averaged_by_words(spark, monkeypatch):
    """The sum over a tree of tasks is the sum of all vectors."""
    rng = np.random.default_rng(1)
    vectors = rng.integers(-(1 << 40), 1 << 40, (23, 9))
    frame = spark.createDataFrame([(v.tolist(),) for v in vectors], "sums array<long>").repartition(7)
    monkeypatch.setattr(lm, "FAN", 3)
    assert lm._added(frame, 23).first().sums == vectors.sum(0).tolist()


def test_lm_tells_order_and_odd_rows(spark):
    rows = lm.op4_lm(spark, MORE).toPandas()
    docs = pd.read_parquet(f"{MORE}/documents.parquet")
    assert sorted(rows.doc_id) == sorted(docs.doc_id) and (rows.log_prob <= 0).all()
    counts = Counter(w for t in docs.text for w in t.lower().split())
    total, known = sum(counts.values()), sorted(counts.values(), reverse=True)[: SHAPE.known]
    rest = total - sum(known)
    unigram = sum(n * np.log(n / total) for n in known) + rest * np.log(rest / total / (len(counts) - len(known)))
    assert rows.log_prob.sum() > unigram  # better than word frequencies alone
    again = lm.op4_lm(spark, MORE).toPandas()
    assert rows.sort_values("doc_id").log_prob.tolist() == again.sort_values("doc_id").log_prob.tolist()
    odd = odd_documents(spark)
    scored = {r.doc_id: r for r in lm.score(odd).collect()}
    assert scored[3].n_words == 0 and scored[3].log_prob == 0 and scored[3].mean_log_prob is None and scored[4].n_words == 30000 and scored[1]["size"] == "x"
    assert lm.score(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lm_shared_words_score_by_their_counts(spark):
    """Of words outside the known ones, one that stands 50 times scores higher than one that stands once."""
    known, often, once = ([f"{k}{i}" for i in range(n)] for k, n in (("known", SHAPE.known), ("often", 300), ("once", 300)))
    rows = [" ".join(known)] * 100 + [" ".join(often)] * 49 + often + once
    scored = lm.score(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).toPandas().set_index("doc_id").log_prob.sort_index()
    gap = scored[149:449].mean() - scored[449:].mean()
    assert abs(gap - np.log(50)) < 1


def test_lm_scores_beat_a_unigram_with_true_counts(spark):
    docs = pd.read_parquet(f"{MORE}/documents.parquet")
    counts = Counter(w for t in docs.text for w in t.lower().split())
    total = sum(counts.values())
    assert lm.op4_lm(spark, MORE).toPandas().log_prob.sum() > sum(n * np.log(n / total) for n in counts.values())


def test_lm_joined_shares_equal_cached_ones(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    cached = lm.score(frame).toPandas().set_index("doc_id").sort_index()
    joined = lm.score(frame, SHAPE._replace(cached=1024)).toPandas().set_index("doc_id").sort_index()
    assert np.allclose(cached.log_prob, joined.log_prob, rtol=0.01) and cached.least_count.equals(joined.least_count)
