"""Pre-tokenisation (T1, T2) and the pre-token histogram."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PRETOKEN_PATTERN, SPECIAL_TOKENS

SPECIAL_ALT = "|".join(re.escape(t) for t in SPECIAL_TOKENS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pretokens(text) -> Column:
    """GPT-2 style split of a text into pieces (array<string>)."""
    return F.regexp_extract_all(_col(text), F.lit(PRETOKEN_PATTERN), 0)


def special_parts(text) -> Column:
    """Split a text into special tokens and the ordinary runs between them.

    The special strings are found first and the text is cut at them, so no pattern looks ahead from every
    character (such a pattern recurses in the JVM and ends it on long texts).
    """
    t = _col(text)
    between, found = F.split(t, SPECIAL_ALT, -1), F.regexp_extract_all(t, F.lit(SPECIAL_ALT), 0)
    return F.filter(F.flatten(F.zip_with(between, found, lambda run, token: F.array(run, token))), lambda p: p != "")


def has_visible_char(piece) -> Column:
    """True for a piece holding at least one non-whitespace character."""
    return _col(piece).rlike("(?U)\\S")


def pretoken_histogram(df: DataFrame, text_col: str = "text", piece_col: str = "piece") -> DataFrame:
    """Count of every distinct pre-token over the corpus (partial + final hash aggregate)."""
    return (
        df.select(F.explode(pretokens(text_col)).alias(piece_col))
        .groupBy(piece_col)
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    )


def piece_list(text) -> Column:
    """T2 then T1: the pieces of a text in order, special tokens whole (array<string>).

    No piece of an ordinary run equals a special token, as those runs hold none.
    """
    t = _col(text)
    parts = F.transform(special_parts(t), lambda p: F.when(p.isin(SPECIAL_TOKENS), F.array(p)).otherwise(pretokens(p)))
    # every special token starts with '<': texts without one are not cut
    return F.when(F.instr(t, "<") > 0, F.flatten(parts)).otherwise(pretokens(t))
