"""The operators' queries: each applies one operator, with production parameters, to its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat, exact_dedup, language, lz, mixing, packing, pii, simhash, substrings, token_files
from .common import table


def op1_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz.neighbour_likeness(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.pii(table(spark, sf_dir, "documents")))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_trees(chat.chains(rows)))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_lz_fingerprint, op2_token_files, op3_language_id, op4_substring_dedup, op5_pii, op6_mix_sources, op7_pack, op8_exact_dedup, op9_chat, op10_simhash)}
ORACLES = {"op4_substring_dedup": substrings.ORACLE, "op6_mix_sources": mixing.ORACLE, "op8_exact_dedup": exact_dedup.ORACLE, "op9_chat": chat.ORACLE}
