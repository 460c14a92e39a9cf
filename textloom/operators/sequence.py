"""Sequence shaping (Q1-Q9, A7, A10): sample builders, collation, block packing.

Token ids are any ``array<bigint>`` column. Builders take an ``encode`` callable
(Column -> Column of ids); the BPE encoder lives in :mod:`textloom.operators.bpe`
and works on whole tables, so callers usually encode first and pass ``ids``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DEFAULT_SEQUENCE_LENGTH, EOD_ID, LABEL_PAD_ID, PACK_GROUP_ROWS, PAD_ID
from ..functions import arrays as A


def map_style_sample(df: DataFrame, ids_col: str, max_len: int | None) -> DataFrame:
    """Q1 / Q4 tail: F5 truncation (mask tail 0), labels = ids (F9), all ``bigint``."""
    ids = F.col(ids_col)
    return (
        df.withColumn("attention_mask", A.truncated_mask(ids, max_len, mask_tail=0))
        .withColumn("input_ids", A.as_long_array(A.truncate_ids(ids, max_len)))
        .withColumn("labels", F.col("input_ids"))
    )


def iterable_sample(df: DataFrame, ids_col: str, max_len: int | None) -> DataFrame:
    """Q2 / Q3 tail: F6 truncation (mask tail 1, type tail 0), position ids (F8), labels."""
    ids = F.col(ids_col)
    return (
        df.withColumn("attention_mask", A.truncated_mask(ids, max_len, mask_tail=1))
        .withColumn("input_ids", A.as_long_array(A.truncate_ids(ids, max_len)))
        .withColumn("token_type_ids", A.zeros_like("input_ids"))
        .withColumn("position_ids", A.position_ids("input_ids"))
        .withColumn("labels", F.col("input_ids"))
    )


def equal_lengths(df: DataFrame, *cols: str) -> DataFrame:
    """A10 as a data-quality table: rows whose arrays differ in length (expected empty)."""
    return df.where(~A.arrays_equal_length(*cols))


def collate(
    df: DataFrame,
    group_cols=("rank", "batch"),
    *,
    pad_cols: dict | None = None,
) -> DataFrame:
    """Q5 / Q6: right-pad every array of a batch to the batch maximum.

    ``pad_cols`` maps column -> pad value; default ids 0, mask 0, labels -100.
    A batch holds at most ``batch_size`` rows, so the window per batch is bounded.
    """
    pads = pad_cols or {"input_ids": PAD_ID, "attention_mask": PAD_ID, "labels": LABEL_PAD_ID}
    first = next(iter(pads))
    w = Window.partitionBy(*group_cols)
    out = df.withColumn("batch_width", F.max(F.size(first)).over(w))
    for c, v in pads.items():
        out = out.withColumn(c, A.pad_to(c, F.col("batch_width"), v))
    return out


def collate_five(df: DataFrame, group_cols=("rank", "batch")) -> DataFrame:
    """Q6: the iterable loader's five arrays are padded together, three of them are returned."""
    five = {"input_ids": PAD_ID, "position_ids": PAD_ID, "token_type_ids": PAD_ID, "attention_mask": PAD_ID, "labels": LABEL_PAD_ID}
    return collate(df, group_cols, pad_cols=five).drop("position_ids", "token_type_ids")


def block_size(requested: int | None, model_max: int) -> int:
    """Q7: tokens in a packed block - the request, not beyond the model; 1,024 at most where none is made."""
    return min(model_max, DEFAULT_SEQUENCE_LENGTH if requested is None else requested)


def pack_blocks(
    df: DataFrame,
    ids_col: str,
    idx_col: str,
    block_size: int,
    *,
    group_rows: int = PACK_GROUP_ROWS,
    extra_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Q7: per group of ``group_rows`` consecutive rows, concatenate and cut into blocks.

    If the group's total is at least ``block_size`` the remainder is dropped,
    otherwise one short block is kept; an empty group yields nothing.
    A document may span many blocks: block numbers are exploded, never tokens,
    and every output block collects at most ``block_size`` ids.
    ``extra_cols`` are other aligned arrays packed the same way (e.g. a mask).
    Output: ``grp, blk, <ids_col>, <extra_cols...>, labels``.
    """
    S = block_size
    cols = [ids_col, *extra_cols]
    g = F.floor(F.col(idx_col) / group_rows).cast("bigint")
    base = df.select(F.col(idx_col), g.alias("grp"), *[F.col(c) for c in cols]).withColumn(
        "_len", F.size(ids_col).cast("bigint")
    )
    w_before = Window.partitionBy("grp").orderBy(idx_col).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy("grp")
    base = base.withColumn("_start", F.coalesce(F.sum("_len").over(w_before), F.lit(0)).cast("bigint"))
    base = base.withColumn("_total", F.sum("_len").over(w_all).cast("bigint"))
    kept = F.when(F.col("_total") >= S, F.floor(F.col("_total") / S) * S).otherwise(F.col("_total"))
    base = base.withColumn("_kept", kept.cast("bigint")).where(
        (F.col("_len") > 0) & (F.col("_start") < F.col("_kept"))
    )
    first_blk = F.floor(F.col("_start") / S)
    last_blk = F.floor((F.least(F.col("_start") + F.col("_len"), F.col("_kept")) - 1) / S)
    pieces = base.withColumn("blk", F.explode(F.sequence(first_blk.cast("bigint"), last_blk.cast("bigint"))))
    lo = F.greatest(F.col("blk") * S, F.col("_start"))
    hi = F.least((F.col("blk") + 1) * S, F.col("_start") + F.col("_len"), F.col("_kept"))
    sel = [F.slice(F.col(c), (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int")).alias(c) for c in cols]
    pieces = pieces.select("grp", "blk", F.col(idx_col).alias("_i"), *sel)
    agg = pieces.groupBy("grp", "blk").agg(
        *[
            F.flatten(
                F.transform(F.sort_array(F.collect_list(F.struct("_i", c))), _field(c))
            ).alias(c)
            for c in cols
        ]
    )
    return agg.withColumn("labels", F.col(ids_col))


def _field(name: str):
    return lambda z: z[name]


def block_lengths(blocks: DataFrame, ids_col: str = "input_ids") -> DataFrame:
    """Q8: the length of every packed block."""
    return blocks.select("grp", "blk", F.size(ids_col).cast("bigint").alias("block_len"))


def packed_lengths(df: DataFrame, len_col: str, idx_col: str, block_size: int, *, group_rows: int = PACK_GROUP_ROWS) -> DataFrame:
    """Q8 without packing: ``(grp, blk, block_len)`` of the blocks that :func:`pack_blocks` makes, from the rows' lengths alone."""
    S = block_size
    total = df.groupBy(F.floor(F.col(idx_col) / group_rows).cast("bigint").alias("grp")).agg(F.sum(F.coalesce(len_col, F.lit(0))).cast("bigint").alias("_total"))
    full = F.floor(F.col("_total") / S).cast("bigint")
    blocks = total.where(F.col("_total") > 0).withColumn("blk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(full, F.lit(1)) - 1)))
    return blocks.select("grp", "blk", F.least(F.col("_total"), F.lit(S)).cast("bigint").alias("block_len"))


def raw_text_batches(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Q9 batch form: one row per (rank, batch) with its texts in slot order."""
    return df.groupBy("rank", "batch").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", text_col))), lambda z: z[text_col]).alias("texts")
    )


def eod_array():
    return F.array(F.lit(EOD_ID).cast("bigint"))
