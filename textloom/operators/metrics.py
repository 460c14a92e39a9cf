"""Corpus profiles and evaluation metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hooks import TwoPhaseMetric


def describe_lengths(df: DataFrame, group_cols: Sequence[str], value_col: str, digits: int = 2) -> DataFrame:
    """A1: pandas ``describe()`` per group - count, mean, sample std, min, quartiles, max.

    Rows are first counted by (group, value), partially in every task, so a group that
    holds most rows only brings its distinct values to one place. Quartiles
    interpolate linearly (exact ``percentile`` with the counts as frequencies); the moments
    are sums of exact integers.
    """
    seen = df.groupBy(*group_cols, F.col(value_col).cast("bigint").alias("_v")).agg(F.count(F.lit(1)).cast("bigint").alias("_n"))
    v, n = F.col("_v"), F.col("_n")
    q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n)
    wide = lambda c: c.cast("decimal(38,0)")
    out = seen.groupBy(*group_cols).agg(
        F.coalesce(F.sum(F.when(v.isNotNull(), n)), F.lit(0)).cast("bigint").alias("count"),
        F.sum(wide(v * n)).alias("_s"),
        F.sum(wide(v * v * n)).alias("_ss"),
        F.min(v).cast("double").alias("min"),
        q.alias("_q"),
        F.max(v).cast("double").alias("max"),
    )
    c, s, ss = F.col("count").cast("double"), F.col("_s").cast("double"), F.col("_ss").cast("double")
    mean = F.when(c > 0, s / c)
    # N * sum(v^2) - sum(v)^2 stays exact in decimals as long as it fits them
    spread = F.expr("try_subtract(CAST(count AS DECIMAL(19,0)) * try_cast(_ss AS DECIMAL(19,0)), try_cast(_s AS DECIMAL(19,0)) * try_cast(_s AS DECIMAL(19,0)))").cast("double")
    out = out.withColumn("mean", mean).withColumn("std", F.when(c > 1, F.sqrt(F.coalesce(spread, c * ss - s * s) / (c * (c - 1)))))
    return out.select(
        *group_cols,
        "count",
        F.round("mean", digits).alias("mean"),
        F.round("std", digits).alias("std"),
        F.round("min", digits).alias("min"),
        F.round(F.col("_q")[0], digits).alias("p25"),
        F.round(F.col("_q")[1], digits).alias("p50"),
        F.round(F.col("_q")[2], digits).alias("p75"),
        F.round("max", digits).alias("max"),
    )


def row_counts(df: DataFrame, group_col: str) -> DataFrame:
    """A2 / A3: rows per group plus a grand-total row (group value null)."""
    return df.rollup(group_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def shifted_accuracy(df: DataFrame, preds_col: str, labels_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """A4: compare ``preds[:-1]`` with ``labels[1:]`` over all rows; -100 labels count too.

    Each row contributes ``(hits, n-1)``; the mean is taken over the sums, so it
    is a partial/final aggregate with no per-token rows.
    """
    p, l = F.col(preds_col), F.col(labels_col)
    m = F.greatest(F.size(l) - 1, F.lit(0))
    hits = F.aggregate(
        F.zip_with(F.slice(p, 1, m), F.slice(l, 2, m), lambda a, b: F.when(a == b, 1).otherwise(0)),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x,
    )
    per_row = df.select(*group_cols, hits.alias("_hits"), m.cast("bigint").alias("_n"))
    agg = per_row.groupBy(*group_cols).agg(
        F.sum("_hits").cast("bigint").alias("hits"), F.sum("_n").cast("bigint").alias("n_pred")
    )
    return agg.withColumn("accuracy", F.round(F.col("hits") / F.col("n_pred"), 6))


def perplexity(df: DataFrame, nll_sum_col: str, n_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``exp(mean loss)``; an overflow is +infinity (Spark's ``exp`` already gives it)."""
    agg = df.groupBy(*group_cols).agg((F.sum(nll_sum_col) / F.sum(n_col)).alias("mean_nll"))
    return agg.withColumn("perplexity", F.exp("mean_nll"))


def _lists(batch: pa.RecordBatch, col: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values and lengths of a list column, and which rows have a list."""
    c = batch.column(col)
    lengths = np.asarray(c.value_lengths().fill_null(0), dtype=np.int64)
    return np.asarray(c.flatten()), lengths, np.asarray(c.is_valid())


def accuracy_metric(preds_col: str, labels_col: str) -> TwoPhaseMetric:
    """A4 as a metric in two phases: hits and predictions are counted per batch."""

    def partial(batch):
        (p, pn, _), (l, ln, _) = _lists(batch, preds_col), _lists(batch, labels_col)
        # row starts in the flat arrays; place i of a row is predicted by place i - 1
        ps, ls = np.cumsum(pn) - pn, np.cumsum(ln) - ln
        n = np.maximum(ln - 1, 0)
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        there = at < pn[row]
        hits = p[(ps[row] + at)[there]] == l[(ls[row] + at + 1)[there]]
        return {"hits": int(hits.sum()), "n": int(n.sum())}

    return TwoPhaseMetric(partial, lambda a, b: {k: a[k] + b[k] for k in a}, lambda s: {"hits": s["hits"], "n_pred": s["n"], "accuracy": round(s["hits"] / s["n"], 6) if s["n"] else None}, "hits bigint, n_pred bigint, accuracy double")


def perplexity_metric(nll_sum_col: str, n_col: str) -> TwoPhaseMetric:
    """A6 as a metric in two phases: losses and counts are added up per batch; an overflow is infinity."""

    def partial(batch):
        return {"nll": math.fsum(x for x in batch.column(nll_sum_col).to_pylist() if x is not None), "n": sum(x for x in batch.column(n_col).to_pylist() if x is not None)}

    def finish(s):
        mean = s["nll"] / s["n"] if s["n"] else None
        try:
            return {"mean_nll": mean, "perplexity": None if mean is None else math.exp(mean)}
        except OverflowError:
            return {"mean_nll": mean, "perplexity": math.inf}

    return TwoPhaseMetric(partial, lambda a, b: {k: a[k] + b[k] for k in a}, finish, "mean_nll double, perplexity double")
