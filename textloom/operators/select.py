"""Selecting from score tables.

Input is a long table ``(group, item, score)`` - one row per candidate item of a
group; the model that produced the scores is out of scope. Softmax and the nucleus cut hold for groups of any
size: the rows of a group are spread over tasks in score order, every task adds up its own part, and
the parts are put together by their log-sum-exp. Where the caller knows that groups are small
(the candidates of one decision), ``small_groups`` takes a window per group instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


def temperature(df: DataFrame, t: float, score: str = "score") -> DataFrame:
    """G1: divide scores by the temperature."""
    return df.withColumn(score, F.col(score) / F.lit(float(t)))


def repetition_penalty(
    scores: DataFrame, history: DataFrame, penalty: float, group: str = "group_id", item: str = "item_id", score: str = "score"
) -> DataFrame:
    """Every *distinct* item of the group's history is divided by ``penalty`` once.

    Negative scores move up for penalty > 1 (kept literal). The history is
    reduced to distinct (group, item) keys before the join.
    """
    seen = history.select(group, item).distinct().withColumn("_seen", F.lit(True))
    out = scores.join(seen, [group, item], "left")
    return out.withColumn(
        score, F.when(F.col("_seen"), F.col(score) / F.lit(float(penalty))).otherwise(F.col(score))
    ).drop("_seen")


def ban_items(df: DataFrame, items, item: str = "item_id") -> DataFrame:
    """Remove items from selection (the -inf score becomes a missing row)."""
    return df.where(~F.col(item).isin(list(items)))


def top_k(df: DataFrame, k: int, group: str = "group_id", item: str = "item_id", score: str = "score") -> DataFrame:
    """Keep scores not below the k-th largest - ties at the k-th value stay.

    ``rank() <= k``; k = 0 disables. Spark plans a partial per-group limit
    before the shuffle, so a hot group is cut down map-side.
    """
    if k <= 0:
        return df
    w = Window.partitionBy(group).orderBy(F.col(score).desc())
    return df.withColumn("_r", F.rank().over(w)).where(F.col("_r") <= k).drop("_r")


def _task_sums(df: DataFrame, group: str, score: str, keys: list, partitions: int | None) -> DataFrame:
    """Rows in ``(group, keys)`` order over range partitions, with their partition and two numbers inside their part of the group:
    ``_e``, the exponential of the score less the part's first (largest) one, and ``_before``, the sum of those of the rows before. Written once."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.withColumn("_x", F.col(score).cast("double")).repartitionByRange(n, F.col(group), *keys).sortWithinPartitions(F.col(group), *keys)
    schema = T.StructType([*ordered.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_e", T.DoubleType()), T.StructField("_before", T.DoubleType())])

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        last, top, total = None, 0.0, 0.0  # the group that goes on from the batch before
        for b in batches:
            if not b.num_rows:
                continue
            code = b.column(group).dictionary_encode(null_encoding="encode")
            number = np.asarray(code.indices)
            starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            ends = np.append(starts[1:], b.num_rows)
            x = np.asarray(pc.fill_null(b.column("_x"), float("nan")))
            e, before = np.empty(b.num_rows), np.empty(b.num_rows)
            for s, z in zip(starts.tolist(), ends.tolist()):
                name = (code.dictionary[number[s]].as_py(),)
                if name != last:
                    last, top, total = name, x[s], 0.0
                e[s:z] = np.exp(x[s:z] - top)
                sums = total + np.cumsum(e[s:z])
                before[s], before[s + 1 : z] = total, sums[:-1]
                total = sums[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, pid, np.int32)), pa.array(e), pa.array(before)], names=[*b.schema.names, "_pid", "_e", "_before"])

    return materialize(ordered.mapInArrow(run, schema), "softmax")


def _in_order(df: DataFrame, group: str, score: str, item: str | None, partitions: int | None) -> DataFrame:
    """Rows with ``_p``, their probability in the group, and ``_mass``, that of the rows before them by score (then item)."""
    keys = [F.col(score).desc(), *([F.col(item).asc()] if item else [])]
    rows = _task_sums(df, group, score, keys, partitions)
    # one row for each part of a group: as many as there are groups, and one more for every partition border inside one
    parts = rows.groupBy("_pid", F.col(group).alias("_g")).agg(F.max("_x").alias("_m"), F.sum("_e").alias("_s"))
    whole, earlier = Window.partitionBy("_g"), Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    scaled = parts.withColumn("_w", F.exp(F.col("_m") - F.max("_m").over(whole)))
    mass = F.col("_s") * F.col("_w")
    offsets = scaled.select(F.col("_pid").alias("_q"), "_g", (F.col("_w") / F.sum(mass).over(whole)).alias("_scale"), (F.coalesce(F.sum(mass).over(earlier), F.lit(0.0)) / F.sum(mass).over(whole)).alias("_offset"))
    joined = rows.join(offsets, (F.col("_pid") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    out = joined.withColumn("_p", F.col("_e") * F.col("_scale")).withColumn("_mass", F.col("_offset") + F.col("_before") * F.col("_scale"))
    return out.drop("_x", "_pid", "_e", "_before", "_q", "_g", "_scale", "_offset")


def softmax(df: DataFrame, group: str = "group_id", score: str = "score", prob: str = "prob", *, small_groups: bool = False, partitions: int | None = None) -> DataFrame:
    """``exp(s - max) / sum(exp(s - max))`` per group, in two levels (tasks, then groups) unless the groups are known to be small."""
    if not small_groups:
        return _in_order(df, group, score, None, partitions).withColumnRenamed("_p", prob).drop("_mass")
    w = Window.partitionBy(group)
    e = F.exp(F.col(score) - F.max(score).over(w))
    return df.withColumn("_e", e).withColumn(prob, F.col("_e") / F.sum("_e").over(w)).drop("_e")


def nucleus(
    df: DataFrame, p: float, group: str = "group_id", item: str = "item_id", score: str = "score", prob: str = "prob", *, small_groups: bool = False, partitions: int | None = None
) -> DataFrame:
    """After softmax, keep an item if the probability mass *before* it is <= p.

    Sorted by score descending, ties by item; the first item always stays; p = 0 disables. A group of any size is spread
    over range partitions, so the border may fall anywhere, also among equal scores.
    """
    if p <= 0:
        return softmax(df, group, score, prob, small_groups=small_groups, partitions=partitions)
    if not small_groups:
        return _in_order(df, group, score, item, partitions).filter(F.col("_mass") <= F.lit(float(p))).withColumnRenamed("_p", prob).drop("_mass")
    sm = softmax(df, group, score, prob, small_groups=True)
    w = (
        Window.partitionBy(group)
        .orderBy(F.col(score).desc(), F.col(item).asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum(prob).over(w), F.lit(0.0))
    return sm.withColumn("_before", before).where(F.col("_before") <= F.lit(float(p))).drop("_before")


def weighted_draw(
    df: DataFrame, seed: int, group: str = "group_id", item: str = "item_id", prob: str = "prob", exclude=None
) -> DataFrame:
    """G7 (+ G8): draw one item per group with probability ``prob``.

    Exponential races: the item minimising ``-ln(u) / p`` wins with probability
    p / sum(p), so renormalisation is implicit and excluding an item (G8) is a
    filter before the draw. ``u`` is the first 52 bits of an MD5 of (seed, group, item): a
    retried task draws the same item, and any engine can repeat the draw. An emptied group yields no row.
    """
    d = df if exclude is None else df.where(~F.col(item).isin(list(exclude)))
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(group), F.col(item)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    key = -F.log(u) / F.col(prob)
    return d.where(F.col(prob) > 0).groupBy(group).agg(F.min_by(item, key).alias(item))


def argmax(df: DataFrame, group: str = "group_id", item: str = "item_id", score: str = "score") -> DataFrame:
    """A5: the item with the largest score per group; ties go to the smallest item."""
    return df.groupBy(group).agg(
        F.min_by(item, F.struct((-F.col(score)).alias("s"), F.col(item).alias("i"))).alias(item)
    )
