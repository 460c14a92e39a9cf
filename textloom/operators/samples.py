"""Sample builders from text (Q1-Q4, Q9): join segments, append the end token, encode, shape.

``encoder`` is a learned :class:`~textloom.operators.bpe.BpeModel` (encoded as a
table job: distinct pieces, salted join back) or a Column -> Column function
(e.g. :func:`textloom.functions.text.codepoints`). The end token is appended as
*text*, and the BPE special-token split maps it to id 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import END_OF_TEXT_TOKEN as E
from ..functions import text as T
from . import sequence as Q
from .bpe import BpeModel, encode_documents


def encode_text(df: DataFrame, key_col: str, text_col: str, encoder) -> DataFrame:
    """``(key, ids array<bigint>)`` with any encoder."""
    if isinstance(encoder, BpeModel):
        return encode_documents(df.select(key_col, text_col), encoder, key_col, text_col)
    return df.select(key_col, encoder(F.col(text_col)).cast("array<bigint>").alias("ids"))


def map_style_samples(df: DataFrame, key_col: str, segs_col: str, encoder, max_len: int | None, sep: str = "") -> DataFrame:
    """Q1: ``sep.join(segments) + E`` -> encode -> F5 truncation (mask tail 0) -> labels."""
    t = df.select(key_col, T.append_end_token(T.join_segments(segs_col, sep)).alias("_t"))
    return Q.map_style_sample(encode_text(t, key_col, "_t", encoder), "ids", max_len).drop("ids")


def iterable_samples(df: DataFrame, key_col: str, segs_col: str, encoder, max_len: int | None) -> DataFrame:
    """Q2: segments of 2+ chars joined by E plus a trailing E -> encode -> F6 -> position ids -> labels."""
    kept = T.keep_long_segments(segs_col)
    t = df.select(key_col, T.append_end_token(T.join_segments(kept, E)).alias("_t"))
    return Q.iterable_sample(encode_text(t, key_col, "_t", encoder), "ids", max_len).drop("ids")


def conversation_samples(
    df: DataFrame, key_col: str, turns_col: str, encoder, max_len: int | None, *, trailing_end: bool
) -> DataFrame:
    """Q3 (iterable, ``trailing_end=False``, F6) / Q4 (map-style intent, ``trailing_end=True``, F5):
    the turns joined by E."""
    joined = T.join_segments(turns_col, E)
    t = df.select(key_col, (T.append_end_token(joined) if trailing_end else joined).alias("_t"))
    enc = encode_text(t, key_col, "_t", encoder)
    if trailing_end:
        return Q.map_style_sample(enc, "ids", max_len).drop("ids")
    return Q.iterable_sample(enc, "ids", max_len).drop("ids")


def raw_text_samples(df: DataFrame, key_col: str, segs_col: str, encoder=None) -> DataFrame:
    """Q9: segments joined by E with no trailing token; without an encoder the text itself is the sample."""
    t = df.select(key_col, T.join_segments(segs_col, E).alias("text"))
    if encoder is None:
        return t
    return encode_text(t, key_col, "text", encoder)
