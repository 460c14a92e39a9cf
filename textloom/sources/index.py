"""S8 length index and S9 load-or-build cache."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from .. import __version__
from ..functions import text as T


def length_index(df: DataFrame, segs_col: str, sep: str = "", idx_col: str = "idx") -> DataFrame:
    """Characters of the joined raw segments, without the end token.

    The join string is an argument: ``""`` for documents, ``" "`` for conversations.
    """
    return df.select(idx_col, T.char_length(T.join_segments(segs_col, sep)).alias("n_chars"))


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None if there is none (an uncommitted
    write leaves no readable table behind)."""
    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018 - forces the footer read
        return df
    except AnalysisException:
        return None


def content_key(df: DataFrame, *more) -> str:
    """A key that changes with the files under ``df`` (paths, sizes, modification times), the package version and ``more``."""
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    seen = sorted(tuple(map(str, r)) for r in files.collect())  # one row a file
    return hashlib.sha1(repr((seen, __version__, more)).encode()).hexdigest()[:16]


def cached(spark: SparkSession, path: str, build, *, recache: bool = False) -> DataFrame:
    """Read the table at ``path`` if present and ``recache`` is false, else build and write it.

    Like the original there is no freshness check; the write goes through a
    committed parquet output, so a lost executor never leaves a half table.
    """
    if not recache:
        got = read_if_present(spark, path)
        if got is not None:
            return got
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
