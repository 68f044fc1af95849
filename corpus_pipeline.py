"""Corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads what it
wrote. All but the last keep the columns of ``documents``, and any others of whatever name.

Defined cases, the same for all stages: an empty table gives no rows; very long texts are taken
whole; rows are judged by their text (and source, for owners and mixing), so equal rows are judged
alike; a null text counts as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.llm import bpe, jaccard, language, mixing, secrets
from littoral.llm.common import Kept, Scratch, documents


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter have no language and go; so do null and empty texts. All others stay, and ``lang``
    as it is, null included. Where no document has a language to learn from, none is kept."""
    kept = Kept(docs, "doc_id", "text", "lang")
    return kept.back(language.identify(kept.frame).where(F.col("lang_pred") != language.UNKNOWN))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the least id stays; of equal rows of one id one does, of rows with a
    null id only where no other is in the group. Texts without words are in no group and all stay."""
    return jaccard.drop_near_copies(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked, and ``n_chars`` follows the new text; documents all stay. Spans that overlap are
    masked once. A null source or language counts as an empty one."""
    kept = Kept(docs, "text", "source", "lang", "n_chars")
    clean = secrets.redact(secrets.find_secrets(kept.frame))
    if "n_chars" in kept.inside:
        clean = clean.withColumn("n_chars", F.when(F.size("live_hashes") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.back(clean)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of its source say; a null source is one of its own, repeated rows
    share one coin, and a text without words is emitted at the rate of its source."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text; an empty text has none and does."""
    coded, codec = bpe.encode(docs)
    same = bpe.decode(bpe.spell(codec, F.col("ids"))) == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [("language", known_language), ("near_copies", one_of_each_group), ("secrets", without_secrets), ("mixing", mixed), ("bpe", encoded)]

#: The language model and the byte-pair merges have no SQL form; a test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
