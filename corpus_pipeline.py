"""A training-data pipeline over documents: drop toxic, keep one of near copies, pseudonymise, mix sources, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import minhash, mixing, packing, pii, toxicity
from leafmill.llm.common import cut, fresh, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5.

    Null text scores as an empty one; an empty table stays empty; repeated rows and null ids are scored each by their
    text; very long texts are read whole; without usable labels every score is the prior's; columns pass through.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = fresh("_lm_score", docs.columns)
    return toxicity.score(docs, model, keep=tuple(docs.columns), score_col=score).where(F.col(score) < 0.5).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingle sets with a Jaccard of 0.80 or more are linked.

    The smallest id of a group stays. Null ids and documents without words are never linked and all stay; of rows of one
    id one stays; very long texts are compared whole; an empty table stays empty; columns pass through.
    """
    return minhash.near_dedup(docs, percent=80)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values replaced within their formats; n_chars follows the text. The key: see pii.key_of.

    Null and empty texts stay so; repeated rows are treated each, alike; very long texts are read whole; an empty table
    stays empty; other columns pass through; without a column n_chars none is made.
    """
    found = fresh("_lm_found", docs.columns)
    out = pii.pseudonymise(docs, pii.key_of(spark), found_col=found)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(found) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.drop(found)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources more often, towards flatter source weights.

    Null sources are a source of their own; null and empty texts weigh one token; repeated rows and null ids are mixed
    each; very long texts are one document; an empty table stays empty; columns pass through.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024.

    Null and empty texts are one closing id; repeated rows are packed each; a null id stays null; very long texts are
    encoded whole and cut; an empty table gives no piece; other columns are left behind.
    """
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("pii", pseudonymise), ("mixing", mix_sources), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs


ORACLE_SQL = None
