"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability in a language is the sum over all its segmentations into pieces, of whatever length,
by the forward algorithm; a text's is the product over its words (lower-cased runs of letters).
Probabilities are fitted by expectation maximisation on the words of about SAMPLE_DOCS labelled
documents per language, those whose id has a small hash. Every round counts expected pieces over
the sampled words in parallel and sums them in fixed point, so their order does not matter.
Prediction reads nothing but the text.

Defined cases: ``lang_pred`` is ``und`` with score 0 for a null text, a text without a letter,
or where no labelled document exists; a null id is never learned from and is not held out;
ties go to the language that sorts first; words and texts of any length are scored whole;
equal texts get equal results; an empty table gives no rows; input columns named ``lang_pred``
or ``score`` are replaced, all others are kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.llm.common import Kept, Scratch, documents, give_back, giving_back, some_texts

#: Labelled documents per language that the model is fitted on, about; all where a language has fewer.
SAMPLE_DOCS = 300
ROUNDS = 3
#: Parts that the sampled words are dealt into.
PARTS = 8
#: Words of more bytes are summed in logarithms, as their probability can be too small for a double.
LONG = 32
#: Numbers of one table of sums, about.
ROOM = 1 << 21
FIXED = 1 << 20
UNKNOWN = "und"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def letter_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))


class Pieces:
    """The vocabulary and all single bytes, as a tree of bytes: edges from node and byte to node, and the pieces of nodes."""

    def __init__(self, keys: np.ndarray, child: np.ndarray, piece: np.ndarray, count: int):
        self.keys, self.child, self.piece, self.count = keys, child, piece, count

    @property
    def parts(self) -> tuple:
        return self.keys, self.child, self.piece, self.count

    @classmethod
    def load(cls, path: str) -> Pieces:
        with open(path, "rb") as lines:
            found = {base64.b64decode(line.split()[0]) for line in lines}
        found |= {bytes([i]) for i in range(256)}
        nodes: dict[bytes, int] = {bytes([i]): i for i in range(256)}
        edges: dict[int, int] = {}
        number = {}
        for k, piece in enumerate(sorted(found)):
            for size in range(2, len(piece) + 1):
                head = piece[:size]
                if head not in nodes:
                    nodes[head] = len(nodes)
                    edges[nodes[piece[: size - 1]] << 8 | piece[size - 1]] = nodes[head]
            number[nodes[piece]] = k
        keys = np.array(sorted(edges), np.int64)
        child = np.array([edges[k] for k in keys.tolist()], np.int32)
        return cls(keys, child, np.array([number.get(n, -1) for n in range(len(nodes))], np.int32), len(found))

    def walk(self, words: np.ndarray, sizes: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(end, rows, pieces) for all pieces that begin at ``start`` in the rows of ``words``, (n, length) bytes."""
        rows = np.flatnonzero(sizes > start)
        node, end = words[rows, start].astype(np.int64), start + 1
        while len(rows):
            piece = self.piece[node]
            has = piece >= 0
            if has.any():
                yield end, rows[has], piece[has]
            more = sizes[rows] > end
            rows, key = rows[more], node[more] << 8 | words[rows[more], min(end, words.shape[1] - 1)]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[at] == key
            rows, node, end = rows[on], self.child[at[on]].astype(np.int64), end + 1


def chunks(words: list[bytes], languages: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, matrix of bytes, sizes) of words of like length, padded with zeros."""
    sizes = np.array([len(w) for w in words], np.int64)
    order, at = np.argsort(sizes, kind="stable"), 0
    while at < len(order):
        least = int(sizes[order[at]])
        most = LONG if least <= LONG and least > LONG // 2 else least + least // 4 + 1
        if least <= LONG:
            most = min(most, LONG)
        to = int(np.searchsorted(sizes[order], most, "right"))
        to = min(to, at + max(1, ROOM // ((most + 1) * max(1, languages))))
        some = order[at:to]
        length = int(sizes[some[-1]])
        yield some, np.frombuffer(b"".join(words[i].ljust(length, b"\0") for i in some), np.uint8).reshape(len(some), length), sizes[some]
        at = to


class Weights:
    """Piece probabilities and the sums over segmentations: plain for short words, logarithms for long ones."""

    def __init__(self, pieces: Pieces, p: np.ndarray):
        """p: (pieces, languages), all positive."""
        self.pieces, self.p, self.log = pieces, p, np.log(p)

    def forward(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, bool]:
        """[end, row, language]: the sum over all segmentations of a word's first ``end`` bytes; whether they are logarithms."""
        n, length = words.shape
        long = length > LONG
        sums = np.full((length + 1, n, self.p.shape[1]), -np.inf if long else 0.0)
        sums[0] = 0.0 if long else 1.0
        for start in range(length):
            for end, rows, piece in self.pieces.walk(words, sizes, start):
                if long:
                    sums[end, rows] = np.logaddexp(sums[end, rows], sums[start, rows] + self.log[piece])
                else:
                    sums[end, rows] += sums[start, rows] * self.p[piece]
        return sums, long

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Log-probability of each word in each language."""
        out = np.zeros((len(words), self.p.shape[1]))
        for places, matrix, sizes in chunks(words, self.p.shape[1]):
            sums, long = self.forward(matrix, sizes)
            last = sums[sizes, np.arange(len(sizes))]
            out[places] = last if long else np.log(last)
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, which occur ``counts`` (words, languages) times."""
        out, languages = np.zeros(self.p.shape), self.p.shape[1]
        for places, matrix, sizes in chunks(words, languages):
            left, long = self.forward(matrix, sizes)
            n, length = matrix.shape
            right = np.full_like(left, -np.inf if long else 0.0)
            right[sizes, np.arange(n)] = 0.0 if long else 1.0
            total, weight = left[sizes, np.arange(n)], counts[places]
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for start in range(length - 1, -1, -1):
                for end, rows, piece in self.pieces.walk(matrix, sizes, start):
                    if long:
                        on = self.log[piece] + right[end, rows]
                        share = np.exp(left[start, rows] + on - total[rows])
                        right[start, rows] = np.logaddexp(right[start, rows], on)
                    else:
                        on = self.p[piece] * right[end, rows]
                        share = left[start, rows] * on / total[rows]
                        right[start, rows] += on
                    found.append((piece, share * weight[rows]))
            _gather(out, found)
        return out


def _gather(into: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
    piece, share = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    for k in range(into.shape[1]):
        into[:, k] += np.bincount(piece, share[:, k], minlength=len(into))


def occurrences(words: list[bytes], counts: np.ndarray, pieces: Pieces) -> np.ndarray:
    """How often each piece stands in the words, wherever; what the first probabilities come from."""
    out = np.zeros((pieces.count, counts.shape[1]))
    for places, matrix, sizes in chunks(words, counts.shape[1]):
        _gather(out, [(piece, counts[places[rows]]) for start in range(matrix.shape[1]) for _, rows, piece in pieces.walk(matrix, sizes, start)])
    return out


def normal(c: np.ndarray) -> np.ndarray:
    """Counts as probabilities; no piece is impossible in any language."""
    c = c + 1e-9
    pooled = c.sum(1, keepdims=True) / c.sum()
    return 0.97 * c / c.sum(0) + 0.03 * (0.9 * pooled + 0.1 / len(c))


def sample_words(docs: DataFrame, languages: dict[str, int], per_language: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, word, n) over the labelled documents with a small hash; languages: documents that could be taken."""
    share = F.create_map(*[x for lang, n in languages.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    # 53 bits of the hash as a number from 0 to 1
    part = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id"), 11) / F.lit(float(1 << 53))
    chosen = docs.where(_learnable() & (part < F.element_at(share, F.col("lang"))))
    return chosen.select("lang", F.explode(letter_words(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def _learnable() -> Column:
    return F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))


class Model:
    """Fitted languages: their names, the vocabulary and the piece probabilities."""

    def __init__(self, langs: list[str], pieces: Pieces, p: np.ndarray):
        self.langs, self.weights = langs, Weights(pieces, p)

    @classmethod
    def learn(cls, docs: DataFrame, vocabulary: str | None = None, per_language: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> Model | None:
        """None where no document can be learned from."""
        spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "language")
        # one row per language
        sizes = {r.lang: r.n for r in docs.where(_learnable()).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes:
            return None
        langs = sorted(sizes)
        words = scratch.save(sample_words(docs, sizes, per_language).repartition(PARTS, "word"), "words")
        pieces = Pieces.load(vocabulary or default_vocabulary())
        sent = spark.sparkContext.broadcast(pieces.parts)  # as large as the vocabulary

        def count(p: np.ndarray | None) -> np.ndarray:
            def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                rows = sorted((w, langs.index(lang), n) for b in batches for lang, w, n in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True))
                own = sorted({w for w, _, _ in rows})
                if not own:
                    return
                place = {w: i for i, w in enumerate(own)}
                counts = np.zeros((len(own), len(langs)))
                for w, k, n in rows:
                    counts[place[w], k] += n
                raw = [b" " + w.encode() for w in own]
                found = occurrences(raw, counts, Pieces(*sent.value)) if p is None else Weights(Pieces(*sent.value), p).expected(raw, counts)
                piece, lang = np.nonzero(found)
                value = np.round(found[piece, lang] * FIXED).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(piece * len(langs) + lang, pa.int64()), pa.array(value)], names=["at", "x"])

            parts = words.select("lang", "word", "n").mapInArrow(giving_back(some), "at long, x long")
            sums = parts.groupBy("at").agg(F.sum("x").alias("x")).toArrow()  # a row per piece and language at most
            out = np.zeros(pieces.count * len(langs))
            out[sums.column("at").to_numpy()] = sums.column("x").to_numpy() / FIXED
            return normal(out.reshape(pieces.count, len(langs)))

        p = count(None)
        for _ in range(rounds):
            p = count(p)
        scratch.drop("words")
        return cls(langs, pieces, p)

    def predict(self, texts: pa.ListArray) -> tuple[list[str], np.ndarray]:
        """texts: the words of each text."""
        total = [np.zeros((0, len(self.langs)))]
        for part in some_texts(texts):
            flat = part.flatten().dictionary_encode()
            index, bounds = flat.indices.to_numpy(zero_copy_only=False), part.offsets.to_numpy()
            scores = self.weights.scores([b" " + w.encode() for w in flat.dictionary.to_pylist()])
            total += [scores[index[a - bounds[0] : b - bounds[0]]].sum(0, keepdims=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        total = np.concatenate(total)
        sizes = np.diff(texts.offsets.to_numpy())
        if not len(total):
            return [], np.zeros(0)
        best = total.argmax(1)
        odds = np.exp(total - total.max(1, keepdims=True))
        score = odds.max(1) / odds.sum(1)
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, sizes, strict=True)], np.where(sizes > 0, score, 0.0)


def identify(docs: DataFrame, vocabulary: str | None = None, per_language: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    kept = Kept(docs, "doc_id", "text", "lang")
    model = Model.learn(kept.frame, vocabulary, per_language)
    if model is None:
        return kept.back(kept.frame.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0)), "lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.weights.pieces.parts, model.weights.p))  # bounded by vocabulary and languages

    @F.arrow_udf("lang_pred string, score double")
    def predict(words: pa.Array) -> pa.Array:
        langs, parts, p = sent.value
        langs, score = Model(langs, Pieces(*parts), p).predict(words)
        give_back()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    found = kept.frame.withColumn("found", predict(letter_words(F.col("text"))))
    return kept.back(found.withColumn("lang_pred", F.col("found.lang_pred")).withColumn("score", F.col("found.score")), "lang_pred", "score")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
