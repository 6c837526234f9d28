"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing and packing, each stage on all that the one before kept."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, language, mixing, near, packing
from tessera.llm.common import save, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return language.accepted(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 5-word shingles with a Jaccard likeness of 0.8 or more."""
    return near.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", identify_language), ("exact dedup", drop_copies), ("near-dedup", drop_near_copies), ("mixing", mix), ("packing", pack)]
#: Neither the classifier, nor fingerprints, nor tokens can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep, as `packing.pack` returns them.

    Nulls, empty and long texts and repeated rows are treated as each stage's operator says. Columns of documents, whatever
    their names, come along until packing. No rows give no rows."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save(docs, f"stage{k}")
    return docs
