"""Ordering, sharding, batching, epochs and splits.

All operators take a DataFrame that already carries a dense position column
(see :func:`textloom.operators.position.global_position`) where the reference
walks a Python list of indices. The rank/batch assignment of every slot is a
closed form of the position, so no operator needs the whole order in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .position import global_position, scan_union_positions


def length_order(
    df: DataFrame,
    length_col: str = "n_chars",
    idx_col: str = "idx",
    *,
    descending: bool = False,
    pos_col: str = "pos",
    total_col: str | None = None,
) -> DataFrame:
    """O1 / O1d: position by length, ties by ``idx`` (O1d is the exact reverse)."""
    if descending:
        keys = [F.col(length_col).desc(), F.col(idx_col).desc()]
    else:
        keys = [F.col(length_col).asc(), F.col(idx_col).asc()]
    return global_position(df, keys, pos_col=pos_col, total_col=total_col)


def natural_order(df: DataFrame, idx_col: str = "idx", *, pos_col: str = "pos", total_col: str | None = None) -> DataFrame:
    """Position = rank of ``idx`` (the no-sampler path ignores the length order)."""
    return global_position(df, [F.col(idx_col)], pos_col=pos_col, total_col=total_col)


def seeded_shuffle(
    df: DataFrame, seed: int, epoch: int = 0, idx_col: str = "idx", *, pos_col: str = "pos", total_col: str | None = None
) -> DataFrame:
    """A repeatable permutation keyed by ``seed + epoch`` (order of an MD5 text, ties by idx).

    Hash-based, so a retried task reproduces the same order (``rand()`` would not).
    """
    key = F.md5(F.concat_ws(":", F.lit(seed + epoch), F.col(idx_col)))
    return global_position(
        df.withColumn("_shuffle_key", key), [F.col("_shuffle_key"), F.col(idx_col)],
        pos_col=pos_col, total_col=total_col,
    ).drop("_shuffle_key")


def _network(x: str, inverse: bool, rounds: int) -> str:
    """One pass of the Feistel network over the cells of an ``_a`` by ``_b`` rectangle, or back: alternately one side is moved round by a hash of the other."""
    value = "cast(conv(substring(md5(concat_ws(':', _key, {0}, {1})), 1, 12), 16, 10) AS bigint)"
    sign = "-" if inverse else "+"
    left = f"named_struct('l', pmod(s.l {sign} {value.format('i', 's.r')}, _a), 'r', s.r)"
    right = f"named_struct('l', s.l, 'r', pmod(s.r {sign} {value.format('i', 's.l')}, _b))"
    order = f"sequence({rounds - 1}, 0)" if inverse else f"sequence(0, {rounds - 1})"
    return f"aggregate({order}, named_struct('l', {x} % _a, 'r', {x} div _a), (s, i) -> if(i % 2 = 0, {left}, {right}), s -> s.l + _a * s.r)"


def _walk(df: DataFrame, in_col: str, out_col: str, total_col: str, seed: int, epoch, inverse: bool, rounds: int) -> DataFrame:
    e = F.lit(epoch) if isinstance(epoch, int) else F.col(epoch)
    n = F.col(total_col)
    side = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("bigint"), F.lit(1))
    sized = df.withColumns({"_x": F.col(in_col).cast("bigint"), "_n": n.cast("bigint"), "_a": side, "_key": F.concat_ws(":", F.lit(seed), e)})
    sized = sized.withColumn("_b", F.ceil(F.col("_n") / F.col("_a")).cast("bigint")).withColumn("_y", F.expr(_network("_x", inverse, rounds)))
    # the few cells beyond the last position are walked on from until a position is reached: at most as many steps as there are such cells
    on = f"if(_y < _n, _y, aggregate(sequence(1, _a * _b - _n), _y, (y, k) -> if(y < _n, y, {_network('y', inverse, rounds)})))"
    return sized.withColumn(out_col, F.expr(on)).drop("_x", "_n", "_a", "_b", "_key", "_y")


def shuffled_place(df: DataFrame, seed: int, epoch: int | str = 0, *, pos_col: str = "pos", total_col: str = "n_total", out_col: str = "place", rounds: int = 6) -> DataFrame:
    """O9 by random access: the place of a dense position in the shuffle of an epoch, computed from the position alone.

    A Feistel network over the least rectangle of about ``sqrt(n)`` by ``sqrt(n)`` cells, with cycle walking: a
    permutation of ``0 .. n - 1`` for every key ``seed:epoch`` and every ``n``. Nothing is sorted or exchanged, so any
    row's place in any epoch (``epoch`` may name a column) costs the same, and :func:`unshuffled_position` gives the row at a place.
    """
    return _walk(df, pos_col, out_col, total_col, seed, epoch, False, rounds)


def unshuffled_position(df: DataFrame, seed: int, epoch: int | str = 0, *, place_col: str = "place", total_col: str = "n_total", out_col: str = "pos", rounds: int = 6) -> DataFrame:
    """The inverse of :func:`shuffled_place`: which position stands at a place of the shuffle."""
    return _walk(df, place_col, out_col, total_col, seed, epoch, True, rounds)


def rank_shard(
    df: DataFrame,
    world_size: int,
    *,
    drop_last: bool = False,
    pos_col: str = "pos",
    total_col: str = "n_total",
) -> DataFrame:
    """Assign every position to ``(rank, step)``.

    Padding (``drop_last=False``): ``num_samples = ceil(N/R)``; slot ``(r, s)`` holds the
    row at position ``(s*R + r) mod N`` - positions beyond N wrap to the start.
    Dropping (``drop_last=True``): ``num_samples = floor(N/R)``; the tail is cut.
    Needs ``total_col`` (N) on every row. Adds ``rank``, ``step``, ``num_samples``.
    """
    R = world_size
    pos, n = F.col(pos_col), F.col(total_col)
    if drop_last:
        num = F.floor(n / R).cast("bigint")
        return (
            df.where(pos < num * R)
            .withColumn("rank", (pos % R).cast("bigint"))
            .withColumn("step", F.floor(pos / R).cast("bigint"))
            .withColumn("num_samples", num)
        )
    num = F.ceil(n / R).cast("bigint")
    pad = num * R - n  # < R extra slots, filled from the start of the order
    # a row at position p also fills the padding slots N + p, N + p + N, ... below num * R (N < R wraps again)
    copies = F.when(pos < pad, F.sequence(pos, pad - 1, F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
    slots = F.concat(F.array(pos.cast("bigint")), F.transform(copies, lambda k: (n + k).cast("bigint")))
    return (
        df.withColumn("num_samples", num)
        .withColumn("_slot", F.explode(slots))
        .withColumn("rank", (F.col("_slot") % R).cast("bigint"))
        .withColumn("step", F.floor(F.col("_slot") / R).cast("bigint"))
        .drop("_slot")
    )


def cut_batches(df: DataFrame, batch_size: int, *, drop_last: bool, step_col: str = "step", num_col: str = "num_samples") -> DataFrame:
    """Consecutive ``batch_size`` samples of a rank form a batch; optionally drop the short last one."""
    step = F.col(step_col)
    out = df.withColumn("batch", F.floor(step / batch_size).cast("bigint")).withColumn(
        "slot", (step % batch_size).cast("bigint")
    )
    if drop_last:
        out = out.where(F.col("batch") < F.floor(F.col(num_col) / batch_size))
    return out


def training_order(
    df: DataFrame,
    world_size: int,
    batch_size: int,
    *,
    length_col: str = "n_chars",
    idx_col: str = "idx",
    drop_last: bool = True,
) -> DataFrame:
    """The composition used for training.

    ``world_size > 1``: length order -> positions -> padded rank shard -> batches
    (only the short last batch dropped). ``world_size == 1``: no sampler, natural
    order, batches of the single rank.
    """
    if world_size > 1:
        positioned = length_order(df, length_col, idx_col, total_col="n_total")
        sharded = rank_shard(positioned, world_size, drop_last=False)
    else:
        positioned = natural_order(df, idx_col, total_col="n_total")
        sharded = (
            positioned.withColumn("rank", F.lit(0).cast("bigint"))
            .withColumn("step", F.col("pos"))
            .withColumn("num_samples", F.col("n_total"))
        )
    return cut_batches(sharded, batch_size, drop_last=drop_last)


def line_shard(df: DataFrame, world_size: int, line_col: str = "line_no") -> DataFrame:
    """Strided shard - line ``i`` of each file goes to rank ``i % R``."""
    line = F.col(line_col)
    return df.withColumn("rank", (line % world_size).cast("bigint")).withColumn(
        "step", F.floor(line / world_size).cast("bigint")
    )


def line_window(df: DataFrame, world_size: int, num_workers: int, line_col: str = "line_no") -> DataFrame:
    """With W loader workers rank ``r`` reads lines ``[W*r, W*(r+1))`` of each file,
    and every worker yields the same lines (one output row per worker).
    """
    line = F.col(line_col)
    W = num_workers
    return (
        df.where(line < W * world_size)
        .withColumn("rank", F.floor(line / W).cast("bigint"))
        .withColumn("worker", F.explode(F.sequence(F.lit(0), F.lit(W - 1)).cast("array<bigint>")))
    )


def repeat_epochs(df: DataFrame, num_epochs: int, start_epoch: int = 0) -> DataFrame:
    """The same batches every epoch (no join: each row is replicated in place)."""
    return df.withColumn(
        "epoch", F.explode(F.sequence(F.lit(start_epoch), F.lit(num_epochs - 1)).cast("array<bigint>"))
    )


def resume_step(checkpoint_path: Column | str) -> Column:
    """The integer after the last ``_`` of a checkpoint path."""
    c = F.lit(checkpoint_path) if isinstance(checkpoint_path, str) else checkpoint_path
    return F.regexp_extract(c, "([^_]*)$", 1).cast("bigint")


def skip_resumed(df: DataFrame, checkpoint_path: str | None, batch_col: str = "batch", epoch_col: str = "epoch") -> DataFrame:
    """In epoch 0 only, skip batches numbered below the resume step."""
    if checkpoint_path is None:
        return df
    return df.where((F.col(epoch_col) > 0) | (F.col(batch_col) >= resume_step(checkpoint_path)))


def head_limit(df: DataFrame, n: int | None, pos_col: str = "pos") -> DataFrame:
    """P10: the first ``n`` rows by position (not ``limit``, which has no order).

    For rows that have no position yet, :func:`textloom.operators.position.head_rows` finds them without ordering all.
    """
    return df if n is None else df.where(F.col(pos_col) < n)


def percent_split(
    df: DataFrame, percent: float = 5, pos_col: str = "pos", total_col: str = "n_total", split_col: str = "split"
) -> DataFrame:
    """The first ``percent`` % by position is validation, the rest train.

    The cut rounds half to even, like Python's ``round``.
    """
    cut = F.bround(F.col(total_col) * F.lit(percent) / F.lit(100.0), 0)
    return df.withColumn(
        split_col, F.when(F.col(pos_col) < cut, F.lit("validation")).otherwise(F.lit("train"))
    )


def concat_sets(frames: Sequence[DataFrame], ord_col: str = "dataset_ord") -> DataFrame:
    """Bag union in the given order, tagged with the set's ordinal."""
    out = None
    for i, f in enumerate(frames):
        tagged = f.withColumn(ord_col, F.lit(i).cast("bigint"))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def scanned_index(frames: Sequence[DataFrame], *, ord_col: str = "dataset_ord", idx_col: str = "idx", file_col: str = "file", block_col: str = "block") -> DataFrame:
    """U1 / U2 + O2 over scans of files (columns ``file_col``, ``block_col``): one index in set, file and row order, without a sort of the rows."""
    return scan_union_positions(concat_sets(frames, ord_col), ord_col, file_col, block_col, idx_col)


def concat_index(frames: Sequence[DataFrame], local_cols: Sequence[str], *, ord_col: str = "dataset_ord", idx_col: str = "idx") -> DataFrame:
    """U1 + O2: one global index - earlier sets' sizes plus the local position."""
    u = concat_sets(frames, ord_col)
    return global_position(u, [F.col(ord_col), *[F.col(c) for c in local_cols]], pos_col=idx_col)
