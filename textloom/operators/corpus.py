"""Corpus shaping: folding row-per-turn conversations, joining segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import END_OF_TEXT_TOKEN, EOD_ID
from ..functions import text as T


def fold_conversations(
    turns: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    text: str = "text",
    *,
    sep: str = END_OF_TEXT_TOKEN,
    trailing: str = "",
    out: str = "text",
) -> DataFrame:
    """Row-per-turn table -> one row per conversation: ``sep.join(turns in order) + trailing``.

    Also returns the list form (``turns``) and ``n_turns``. One conversation is
    one output row by definition, so its turns are gathered on one task.
    """
    g = turns.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, text))).alias("_p"))
    segs = F.transform(F.col("_p"), lambda z: z[text])
    return g.select(
        key,
        segs.alias("turns"),
        F.concat(F.array_join(segs, sep), F.lit(trailing)).alias(out),
        F.size("_p").cast("bigint").alias("n_turns"),
    )


def split_lines(text_col: str = "text") -> "F.Column":
    """A document as a list of segments (the crawl ``cont`` shape): split on line breaks."""
    return F.split(F.col(text_col), "\n")


def join_long_segments(segs, sep: str = END_OF_TEXT_TOKEN, trailing: str = END_OF_TEXT_TOKEN):
    """Q2 text: segments of 2+ chars joined by the end token, plus a trailing end token."""
    return F.concat(T.join_segments(T.keep_long_segments(segs), sep), F.lit(trailing))


def ids_join_long_segments(segs, encode, min_len: int = 2, sep_id: int = EOD_ID, trailing: bool = True):
    """Q2 in id space: encode each kept segment, put ``sep_id`` between, and at the end if ``trailing``.

    Appending the end token as an *id* (not as text) lets a tokenizer-free
    encoding stand in for the vocabulary.
    """
    kept = F.filter(segs if not isinstance(segs, str) else F.col(segs), lambda s: F.length(s) >= min_len)
    sep = F.array(F.lit(sep_id).cast("bigint"))
    parts = F.transform(kept, lambda s: F.concat(encode(s), sep))
    flat = F.flatten(parts)
    if trailing:
        return F.when(F.size(kept) == 0, sep).otherwise(flat)
    return F.when(F.size(kept) == 0, F.array().cast("array<bigint>")).otherwise(F.slice(flat, 1, F.size(flat) - 1))


def tokenizer_corpus(frames, text_col: str = "text", mode: str = "union") -> DataFrame:
    """The corpus a vocabulary is learned from.

    ``union`` (the intent): all corpora together. ``last``: only the last one,
    which is what three successive from-scratch training calls amount to.
    """
    if mode not in ("union", "last"):
        raise ValueError("mode must be 'union' or 'last'")
    frames = list(frames)
    if mode == "last":
        return frames[-1].select(text_col)
    out = frames[0].select(text_col)
    for f in frames[1:]:
        out = out.unionByName(f.select(text_col))
    return out


def strict_segments(df: DataFrame, segs_col: str) -> DataFrame:
    """Z9 strict mode: fail the job on a null segment instead of skipping it like ``array_join``."""
    return df.withColumn(
        segs_col,
        F.when(T.has_null_segment(segs_col), F.raise_error(F.lit("null segment"))).otherwise(F.col(segs_col)),
    )
