"""The queries of this package: one per dealt operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import chunked_bpe, direct_codes, fm_index, language_profiles, periodic_runs, phrase_mining, pii_bootstrap, preferences, prefix_hash, risk_rules, shingle_rtree, token_counts, warc_dictionary
from .oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.format_preferences(preferences.pairs_from_conversations(_table(spark, sf_dir, "conversations")))


@query
def op2_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = language_profiles.held_out(F.col("doc_id"))
    profiles = language_profiles.learn_profiles(docs.filter(~held))
    return language_profiles.predict_languages(docs, profiles).withColumn("held_out", held)


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_bootstrapped_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.personal_data_digest(pii_bootstrap.find_personal_data(_table(spark, sf_dir, "documents")))


@query
def op5_warc_dictionary_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_dictionary.archive_round_trip(_table(spark, sf_dir, "pages"))


@query
def op6_count_vector_rtree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_rtree.link_documents(_table(spark, sf_dir, "documents"))


@query
def op6_count_vector_rtree_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_rtree.count_links(_table(spark, sf_dir, "documents"))


@query
def op7_prefix_hash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.compare_with_next(_table(spark, sf_dir, "documents"))


@query
def op8_direct_code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = direct_codes.write_codes(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return direct_codes.read_codes(manifest)


@query
def op9_content_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chunked_bpe.encoding_digest(chunked_bpe.encode_documents(_table(spark, sf_dir, "documents"), path), path)


@query
def op10_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return fm_index.contamination_digest(found)


@query
def op11_block_convolution_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(periodic_runs.collapse_runs(_table(spark, sf_dir, "documents"), word_order=periodic_runs.planted_order))


@query
def op12_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_rules.judge_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op13_misra_gries_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.mine_collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
