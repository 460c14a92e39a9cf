"""O2: dense global positions without a single-partition window.

``row_number()`` over an un-partitioned window moves every row into one task.
Instead the rows are range-partitioned on the order keys, numbered inside each
partition, and shifted by the number of rows in all earlier partitions. The
per-partition count table has one row per partition (its size is bounded by
the partition count, not by the data), so broadcasting it is safe.
The numbered rows are written once as a table in the shared checkpoint folder
and both the count branch and the numbering branch read that table: a range
exchange evaluated twice could sample different boundaries, and Catalyst's
column pruning keeps the two branches from sharing one exchange.

With ``group_cols`` positions restart in every group (line numbers per file).
A hot group is still split across many range partitions, so one group holding
a third of the rows does not land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_RN_BITS = 33  # monotonically_increasing_id = partition index << 33 | row in partition
_RN_MASK = (1 << _RN_BITS) - 1


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _default_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_position(
    df: DataFrame,
    order_cols: Sequence,
    *,
    group_cols: Sequence[str] = (),
    pos_col: str = "pos",
    total_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``pos_col``: the 0-based position of each row in ``order_cols`` order.

    ``order_cols`` must define a total order (add a unique id as last key), or
    tied rows get an arbitrary - but still dense and unique - position.
    ``total_col`` (optional, only without groups) carries the row count N.
    """
    n = num_partitions or _default_partitions(df)
    keys = _as_cols(list(group_cols)) + _as_cols(order_cols)
    tagged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    tagged = (
        materialize(tagged, "positions")
        .withColumn("_pid", F.shiftrightunsigned(F.col("_mid"), _RN_BITS))
        .withColumn("_rn", F.col("_mid").bitwiseAND(F.lit(_RN_MASK)))
        .drop("_mid")
    )
    if not group_cols:
        counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(
            "_pid",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
            F.sum("_n").over(Window.partitionBy()).alias("_total"),
        )
        # one row per range partition: a size bound independent of the data
        out = tagged.join(F.broadcast(offsets), "_pid").withColumn(
            pos_col, (F.col("_off") + F.col("_rn")).cast("bigint")
        )
        if total_col:
            out = out.withColumn(total_col, F.col("_total").cast("bigint"))
        return out.drop("_pid", "_rn", "_off", "_total")

    g = list(group_cols)
    stats = tagged.groupBy("_pid", *g).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rn").alias("_first")
    )
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(
        "_pid", *g, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    # one row per (partition, group) pair; AQE turns this into a broadcast join
    # when the measured size is small and keeps a shuffle join otherwise.
    s = stats.select(*[F.col(c).alias("_s" + c) for c in ["_pid", *g]], "_first", "_off")
    cond = F.col("_pid") == F.col("_s_pid")
    for c in g:
        cond = cond & F.col(c).eqNullSafe(F.col("_s" + c))
    out = tagged.join(s, cond).withColumn(
        pos_col, (F.col("_off") + F.col("_rn") - F.col("_first")).cast("bigint")
    )
    return out.drop("_pid", "_rn", "_off", "_first", *["_s" + c for c in ["_pid", *g]])


def scan_line_numbers(df: DataFrame, file_col: str, block_col: str, pos_col: str = "line_no", over_col: str | None = None) -> DataFrame:
    """Position of each row of a file scan inside its file, without moving the rows; with ``over_col`` inside all files that share its value, in the order of their paths.

    A split (``file_col``, ``block_col``: path and start of the block) is read by one task in file
    order, so its rows have consecutive ``monotonically_increasing_id`` values. A first
    narrow pass counts the rows of every split; the rows then only add their
    split's offset. The offsets have one row per split, that is one per
    ``spark.sql.files.maxPartitionBytes`` of input; they are written once, so their size is known when the join is planned.
    """
    numbered = df.withColumn("_mid", F.monotonically_increasing_id())
    before = Window.partitionBy("_over").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _split_counts(numbered, [F.col(over_col or file_col).alias("_over"), F.col(file_col).alias("_file"), F.col(block_col).alias("_block")]).select(
        "_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    out = numbered.join(materialize(offsets, "split-offsets"), (F.col(file_col) == F.col("_file")) & (F.col(block_col) == F.col("_block")))
    return out.withColumn(pos_col, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint")).drop("_mid", "_file", "_block", "_first", "_off")


def _split_counts(numbered: DataFrame, names: list[Column]) -> DataFrame:
    """Rows and first number of every split."""
    return numbered.groupBy(*names).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))


def scan_union_positions(df: DataFrame, set_col: str, file_col: str, block_col: str, pos_col: str = "idx") -> DataFrame:
    """U1 / U2 + O2: position of each row over several scanned sets, one after the other, without sorting or moving the rows.

    Sets come in the order of ``set_col``, their files in the order of their paths, and rows as they stand in their files. The
    offset of a split is the sum of the counts of all splits before it, over sets and files: a prefix sum
    over one row a split, made in two levels (the splits of a file, the files of all sets).
    """
    numbered = df.withColumn("_mid", F.monotonically_increasing_id())
    splits = materialize(_split_counts(numbered, [F.col(set_col).alias("_set"), F.col(file_col).alias("_file"), F.col(block_col).alias("_block")]), "split-counts")
    inside = Window.partitionBy("_set", "_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    files = global_prefix_sum(splits.groupBy("_set", "_file").agg(F.sum("_n").alias("_m")), ["_set", "_file"], "_m", "_base")
    offsets = splits.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(files.select("_set", "_file", "_base"), ["_set", "_file"])
    offsets = materialize(offsets.select("_set", "_file", "_block", "_first", (F.col("_base") + F.col("_in")).alias("_off")), "split-offsets")
    out = numbered.join(offsets, (F.col(set_col) == F.col("_set")) & (F.col(file_col) == F.col("_file")) & (F.col(block_col) == F.col("_block")))
    return out.withColumn(pos_col, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint")).drop("_mid", "_set", "_file", "_block", "_first", "_off")


def global_prefix_sum(df: DataFrame, order_cols: Sequence, value_col: str, out_col: str) -> DataFrame:
    """The sum of ``value_col`` over all rows before, in ``order_cols`` order: range partitions add up their own rows, then the partitions' sums are added up.

    ``order_cols`` must define a total order. No window holds all rows.
    """
    keys = _as_cols(order_cols)
    tagged = df.repartitionByRange(_default_partitions(df), *keys).withColumn("_pid", F.spark_partition_id())
    tagged = materialize(tagged, "prefix-sums")
    own = Window.partitionBy("_pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sums = tagged.groupBy("_pid").agg(F.sum(value_col).alias("_t")).select("_pid", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_e"))
    out = tagged.withColumn(out_col, F.coalesce(F.sum(value_col).over(own), F.lit(0))).join(sums, "_pid")
    return out.withColumn(out_col, F.col(out_col) + F.col("_e")).drop("_pid", "_e")


def head_rows(df: DataFrame, order_cols: Sequence, n: int, *, pos_col: str = "pos") -> DataFrame:
    """P10: the first ``n`` rows in ``order_cols`` order with their position; every task keeps its own first ``n`` only."""
    keys = _as_cols(order_cols)
    return df.orderBy(*keys).limit(n).withColumn(pos_col, (F.row_number().over(Window.orderBy(*keys)) - 1).cast("bigint"))
