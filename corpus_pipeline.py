"""The corpus pipeline: documents to token ids, five stages, each written as Parquet and read again by the next.

Language identification drops texts without a letter and texts far from every learned language;
the shingle join keeps one document of each group of copies; benchmark passages are cut out; personal
data is masked; what is left is encoded. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import chunked_bpe, fm_index, language_profiles, pii_bootstrap, shingle_rtree
from textloom.session import materialize, ship_package

#: Clean texts of the learned languages score 0.4 and more, also very short ones; other scripts and encoded junk about 0.
LEAST_SCORE = 0.2


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return language_profiles.keep_known_languages(docs, language_profiles.learn_profiles(docs), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return shingle_rtree.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _with_length(fm_index.remove_contamination(docs, benchmark))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _with_length(pii_bootstrap.mask_personal_data(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chunked_bpe.encode_documents(docs, path).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language identification", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("BPE encoding", encoding),
]

#: Rank-order profiles and bootstrapped patterns are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + "".join(c if c.isalnum() else "-" for c in name))
    return docs
