"""Byte-level BPE encoding and decoding by Spark's higher-order functions.

A word (one match of the splitting pattern) is an array of bytes. A fold over it merges the
leftmost pair of lowest rank, step by step; ranks come from a literal map in hash buckets, so
a look-up costs the same at any size. Distinct words are counted over the whole corpus; those
above a count, at most ``cache_words``, are folded once, and their ids travel to the tasks as
arrays of a bounded size. A text's other words are folded once for each text that holds them, so
texts never move between tasks and nothing that grows with the vocabulary is sent. An Arrow
function only strings the ids of the known words together and leaves a gap for each other one.
Decoding joins the byte pieces of the ids.

A long word has many places where the same pair can be merged; there a step of the fold merges
all of them from the left, as long as none of them makes a pair of lower rank. That is the order
in which single merges would come, so the ids are the same.

Defined cases: a null text is encoded as an empty one, which gives no ids; equal texts give
equal ids; an empty table gives no rows; very long texts are one row, and very long words cost
time with their length and the number of their distinct merges; an input column named ``ids`` is
replaced, all others are kept; ids outside the vocabulary decode to nothing.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.llm.common import Kept, Scratch, bucket, documents, give_back, let, literal, some_texts

CACHE_WORDS = 1 << 19
#: Words of more characters take the steps that merge a pair everywhere; the result is the same.
EVERYWHERE = 64
#: A token of the fold in one long: the rank of its pair with the next token, its place, its id.
ID_BITS, PLACE_BITS = 20, 23
#: No such pair; above all ranks.
NONE = (1 << ID_BITS) - 1
RANK_AT = ID_BITS + PLACE_BITS
#: White space as the tokenizer's own regular expressions define it (Unicode's property).
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def java_pattern(pattern: str) -> str:
    r"""The splitting pattern for Java: ``\s`` and ``\S`` spelled out, as Java's cover ASCII only.

    Where it opens in the usual way, words and numbers are tried before the contractions, which
    begin with an apostrophe that neither can match, and runs are possessive, as nothing follows
    them in their alternatives. Matches stay the same.
    """
    usual = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"
    if pattern.startswith(usual):
        pattern = r" ?\p{L}++| ?\p{N}++|'(?:[stmd]|re|ve|ll)| ?[^\s\p{L}\p{N}]++|" + pattern[len(usual) :]
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


class Vocabulary:
    """Ranks of a file, the pairs of ids that merge, and the pieces that merging does not reach."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        if max(self.ranks.values()) >= NONE:
            raise ValueError(f"ids must lie below {NONE}: a pair of ids is packed into one number")
        self.pairs: dict[int, int] = {}
        for piece, rank in self.ranks.items():
            for at in range(1, len(piece)):
                left, right = self.ranks.get(piece[:at]), self.ranks.get(piece[at:])
                if left is not None and right is not None:
                    self.pairs[left << ID_BITS | right] = rank
        self.apart = {piece: rank for piece, rank in self.ranks.items() if len(_merged(piece, self.ranks)) > 1}

    @staticmethod
    @lru_cache(1)
    def of(path: str) -> Vocabulary:
        return Vocabulary(path)


def _merged(raw: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The pieces that merging leaves of one piece of the vocabulary."""
    start, after, before = list(range(len(raw))), list(range(1, len(raw) + 1)), list(range(-1, len(raw) - 1))
    end, alive = [i + 1 for i in start], [True] * len(raw)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(raw) and (rank := ranks.get(raw[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(len(raw) - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= len(raw) or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, end[j], after[j]
        if after[i] < len(raw):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [raw[i : end[i]] for i in range(len(raw)) if alive[i]]


class Cache:
    """Ids of the most frequent words as flat arrays."""

    def __init__(self, words: pa.Array, ids: np.ndarray, ends: np.ndarray):
        self.words, self.ids, self.ends = words, ids, ends

    def look_up(self, texts: pa.ListArray) -> pa.StructArray:
        """texts: the words of each text. ``runs``: ids of known words between the other ones; ``rare``: the
        distinct other words of a text; ``at``: for each gap between runs the place of its word in ``rare``."""
        parts = [self._part(part) for part in some_texts(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], LOOKED)

    def _part(self, texts: pa.ListArray) -> pa.StructArray:
        flat = texts.flatten().dictionary_encode()
        words, index, bounds = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False), texts.offsets.to_numpy()
        bounds = bounds - bounds[0]
        found = pc.index_in(words, self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        size = np.where(found < 0, 0, self.ends[found + 1] - self.ends[found])[index]  # of each word, whether known or not
        ends = np.append(0, np.cumsum(size))
        ids = np.arange(ends[-1])
        ids += np.repeat(self.ends[found][index] - ends[:-1], size)
        ids = self.ids[ids]
        known = found[index]
        gap = np.flatnonzero(known < 0)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[gap]
        # runs end at gaps and at the ends of texts
        order = np.argsort(np.append(2 * gap + 1, 2 * bounds[1:]), kind="stable")
        stops = np.append(ends[gap], ends[bounds[1:]])[order]
        runs = pa.ListArray.from_arrays(pa.array(np.append(0, stops), pa.int32()), pa.array(ids, pa.int32()))
        gaps = np.bincount(text, minlength=len(bounds) - 1)
        runs = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(gaps + 1)), pa.int32()), runs)
        own, place = np.unique(text * np.int64(len(words) + 1) + index[gap], return_inverse=True)
        first = np.searchsorted(own, np.arange(len(bounds)) * np.int64(len(words) + 1))
        rare = pa.ListArray.from_arrays(pa.array(first, pa.int32()), words.take(pa.array(own % (len(words) + 1))))
        at = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(gaps)), pa.int32()), pa.array(place - first[text], pa.int32()))
        return pa.StructArray.from_arrays([runs, at, rare], fields=list(LOOKED))


LOOKED = pa.struct([("runs", pa.list_(pa.list_(pa.int32()))), ("at", pa.list_(pa.int32())), ("rare", pa.list_(pa.string()))])


class Codec:
    """Column expressions over the literals of one vocabulary."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.spark, self.pattern, self.vocabulary = spark, java_pattern(pattern), Vocabulary.of(path)
        ranks, pairs = self.vocabulary.ranks, self.vocabulary.pairs
        self.buckets = 1 << max(8, len(pairs).bit_length() - 1)
        maps: list[dict[int, int]] = [{} for _ in range(self.buckets)]
        for key, rank in pairs.items():
            maps[xxhash.xxh64_intdigest(key.to_bytes(8, "little"), 42) % self.buckets][key] = rank
        self.merges = literal(spark.createDataFrame([(maps,)], "v array<map<bigint,bigint>>"))
        del maps
        single = [ranks.get(bytes([i]), 0) for i in range(256)]
        self.bytes = literal(spark.createDataFrame([(single,)], "v array<bigint>"))
        #: ranks of all pairs of bytes, by 256 times the first plus the second
        first = [ranks.get(bytes([i, j]), NONE) for i in range(256) for j in range(256)]
        self.first = literal(spark.createDataFrame([(first,)], "v array<bigint>"))
        self.size = max(ranks.values()) + 1
        pieces = [""] * self.size
        for piece, rank in ranks.items():
            pieces[rank] = piece.hex()
        spelling = [(i.to_bytes(4, "little").hex(), piece) for i, piece in enumerate(pieces)]
        self.spelling = literal(spark.createDataFrame([(spelling,)], "v array<struct<id:string,piece:string>>"))

    def rank(self, left: Column, right: Column) -> Column:
        """The rank (and id) of the piece that two ids merge to, or NONE; null ids merge with nothing."""
        key = F.shiftleft(left, ID_BITS).bitwiseOR(right)
        return F.coalesce(F.element_at(F.get(self.merges, bucket(key, self.buckets)), key), F.lit(NONE).cast("long"))

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def fold(self, word: Column) -> Column:
        """The ids of one word.

        The state holds a token in one long, its pair's rank in the high bits and its place in the
        word below, so the least number is the leftmost pair of lowest rank.
        """
        id_mask, place_mask, below = F.lit(NONE).cast("long"), F.lit(((1 << PLACE_BITS) - 1) << ID_BITS).cast("long"), F.lit((1 << RANK_AT) - 1).cast("long")
        none, gone = F.lit(NONE << RANK_AT).cast("long"), F.lit(-1).cast("long")

        def id_of(x: Column) -> Column:
            return x.bitwiseAND(id_mask)

        def ranked(left: Column, right: Column) -> Column:
            return F.shiftleft(self.rank(left, right), RANK_AT)

        def once(state: Column, best: Column) -> Column:
            """The leftmost pair of lowest rank merged."""
            rank = F.shiftright(best, RANK_AT)

            def changed(x: Column, i: Column) -> Column:
                merged = ranked(rank, id_of(F.get(state, i + 2))).bitwiseOR(best.bitwiseAND(place_mask)).bitwiseOR(rank)
                before = ranked(id_of(x), rank).bitwiseOR(x.bitwiseAND(below))
                return F.when(x == best, merged).when(F.get(state, i + 1) == best, before).when(F.get(state, i - 1) == best, gone).otherwise(x)

            return F.array_remove(F.transform(state, changed), gone)

        def everywhere(state: Column, best: Column) -> Column:
            """All pairs of lowest rank merged, from the left; only the first where one of them makes a pair of lower rank."""
            rank = F.shiftright(best, RANK_AT)
            flags = F.array_join(F.transform(state, lambda x: F.when(F.shiftright(x, RANK_AT) == rank, "1").otherwise("0")), "")

            def merge(taken: Column) -> Column:
                def changed(x: Column, i: Column) -> Column:
                    after = F.when(F.get(taken, i + 2) == "1", rank).otherwise(id_of(F.get(state, i + 2)))
                    merged = ranked(rank, after).bitwiseOR(x.bitwiseAND(place_mask)).bitwiseOR(rank)
                    before = ranked(id_of(x), rank).bitwiseOR(x.bitwiseAND(below))
                    return F.when(F.get(taken, i) == "1", merged).when(F.get(taken, i + 1) == "1", before).otherwise(x)

                return F.filter(F.transform(state, changed), lambda _, i: (i == 0) | (F.get(taken, i - 1) != "1"))

            def checked(new: Column) -> Column:
                return F.when(F.shiftright(F.array_min(new), RANK_AT) < rank, once(state, best)).otherwise(new)

            # of neighbouring pairs the left one goes first, which takes a token of the next
            return let(let(F.split(F.replace(flags, F.lit("11"), F.lit("10")), ""), merge), checked)

        def start(raw: Column) -> Column:
            """raw: the word's bytes."""

            def token(b: Column, i: Column) -> Column:
                pair = F.coalesce(F.get(self.first, b * 256 + F.get(raw, i + 1)), F.lit(NONE).cast("long"))
                return F.shiftleft(pair, RANK_AT).bitwiseOR(F.shiftleft(i.cast("long"), ID_BITS)).bitwiseOR(F.get(self.bytes, b))

            return F.transform(raw, token)

        def fold_once(raw: Column) -> Column:
            def turn(state: Column, _: Column) -> Column:
                return let(F.array_min(state), lambda best: F.when(best >= none, state).otherwise(once(state, best)))

            return F.aggregate(turns(raw), start(raw), turn, ids_of)

        def fold_everywhere(raw: Column) -> Column:
            def with_best(state: Column) -> Column:  # the turns after the last merge need not look for it
                return F.struct(state.alias("tokens"), F.array_min(state).alias("best"))

            def turn(state: Column, _: Column) -> Column:
                return F.when(state["best"] >= none, state).otherwise(let(everywhere(state["tokens"], state["best"]), with_best))

            # turns in blocks, so that those after the last merge, each of which copies the state, are few
            block = F.sequence(F.lit(1), F.ceil(F.sqrt(F.size(raw))).cast("int"))

            def some(state: Column, _: Column) -> Column:
                return F.when(state["best"] >= none, state).otherwise(F.aggregate(block, state, turn))

            return F.aggregate(block, let(start(raw), with_best), some, lambda state: ids_of(state["tokens"]))

        def turns(raw: Column) -> Column:
            return F.sequence(F.lit(2), F.greatest(F.size(raw), F.lit(2)))

        def ids_of(state: Column) -> Column:
            return F.transform(state, lambda x: id_of(x).cast("int"))

        raw = F.transform(F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ""), lambda c: F.ascii(c))
        out = F.when(F.length(word) <= EVERYWHERE, let(raw, fold_once)).otherwise(let(raw, fold_everywhere))
        for piece, rank in self.vocabulary.apart.items():
            out = F.when(word.cast("binary") == F.lit(bytearray(piece)), F.array(F.lit(rank))).otherwise(out)
        return out

    def cache(self, counts: DataFrame, words: int) -> Cache:
        """The ids of the most frequent words: all above one count, ``words`` at most."""
        grade = F.floor(F.log2("n") * 16).cast("int")
        left, least = words, None
        for r in counts.groupBy(grade.alias("g")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("g")).collect():
            if r.k > left:
                break
            left, least = left - r.k, r.g
        own = counts.where(grade >= least if least is not None else F.lit(False)).select("w", self.fold(F.col("w")).alias("ids")).toArrow()
        found, ids = own.column("w").combine_chunks(), own.column("ids").combine_chunks()
        return Cache(found, ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32), ids.offsets.to_numpy().astype(np.int64) - (ids.offsets[0].as_py() if len(ids) else 0))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, cache_words: int = CACHE_WORDS, text: str = "text") -> tuple[DataFrame, Codec]:
    """``docs`` with ``ids`` (array<int>), and the codec that decodes them."""
    spark = docs.sparkSession
    own = default_tokenizer()
    codec = Codec(spark, path or own[0], pattern or own[1])
    kept = Kept(docs, text)
    scratch, split = Scratch(spark, "bpe"), codec.words(F.col(text))
    counts = kept.frame.select(F.explode(split).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cache = codec.cache(scratch.save(counts, "counts"), cache_words)
    scratch.drop("counts")
    sent = spark.sparkContext.broadcast((cache.words, cache.ids, cache.ends))  # cache_words at most

    @F.arrow_udf("runs array<array<int>>, at array<int>, rare array<string>")
    def look_up(words: pa.Array) -> pa.Array:
        try:
            return Cache(*sent.value).look_up(words)
        finally:
            give_back()

    none = F.array().cast("array<int>")

    def filled(x: Column) -> Column:
        """The runs with the ids of the other words between them."""
        fill = lambda rare: F.flatten(F.zip_with(x["runs"], x["at"], lambda run, k: F.concat(run, F.coalesce(F.get(rare, k), none))))
        return F.when(F.size(x["rare"]) > 0, let(F.transform(x["rare"], codec.fold), fill)).otherwise(F.flatten(x["runs"]))

    looked = kept.frame.withColumn("looked", look_up(split))
    return kept.back(looked.withColumn("ids", filled(F.col("looked"))), "ids"), codec


def spell(codec: Codec, ids: Column) -> Column:
    """Each id's little-endian bytes and its piece, in hex; null for an id outside the vocabulary."""
    return F.transform(ids, lambda i: F.get(codec.spelling, i))


def ids_bytes(spelled: Column) -> Column:
    """Ids as little-endian unsigned 32-bit integers."""
    return F.unhex(F.array_join(spelled["id"], ""))


def decode(spelled: Column) -> Column:
    """The bytes of the ids' pieces, joined; joining leaves nulls out."""
    return F.unhex(F.array_join(spelled["piece"], ""))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codec = encode(documents(spark, sf_dir).select("doc_id", "text"))
    spelled = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), spell(codec, F.col("ids")).alias("s"))
    return spelled.select("doc_id", "n_tokens", F.sha2(ids_bytes(F.col("s")), 256).alias("ids_sha256"), F.sha2(decode(F.col("s")), 256).alias("decoded_sha256"))
