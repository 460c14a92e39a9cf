"""Profiles and metrics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import hooks as H
from ..operators import metrics as M
from ..session import materialize
from .duck import codepoints as d_cp
from .registry import register
from .tables import table


def _describe_sql(key: str) -> str:
    return f"""SELECT {key}, CAST(count(n) AS BIGINT) AS count, round(avg(n), 2) AS mean, round(stddev_samp(n), 2) AS std,
  round(CAST(min(n) AS DOUBLE), 2) AS min, round(quantile_cont(n, 0.25), 2) AS p25, round(quantile_cont(n, 0.5), 2) AS p50,
  round(quantile_cont(n, 0.75), 2) AS p75, round(CAST(max(n) AS DOUBLE), 2) AS max
FROM (SELECT {key}, length(text) AS n FROM documents) GROUP BY {key}"""


@register("length_describe", ids="A1", sql=_describe_sql("lang"))
def length_describe(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("lang", T.char_length("text").alias("n"))
    return M.describe_lengths(d, ["lang"], "n")


@register("length_describe_source", ids="A1 S6", sql=_describe_sql("source"))
def length_describe_source(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", T.char_length("text").alias("n"))
    return M.describe_lengths(d, ["source"], "n")


@register(
    "corpus_counts",
    ids="A2 A3",
    sql="SELECT lang, CAST(count(*) AS BIGINT) AS n_rows FROM documents GROUP BY ROLLUP (lang)",
)
def corpus_counts(spark, sf_dir):
    return M.row_counts(table(spark, sf_dir, "documents"), "lang")


_D_TOKENS = f"""(SELECT lang, doc_id, u.c, u.k FROM documents,
  LATERAL (SELECT unnest({d_cp('text')}) AS c, generate_subscripts({d_cp('text')}, 1) AS k) u)"""


_D_ACCURACY = f"""SELECT lang, CAST(sum(CASE WHEN nxt = c THEN 1 ELSE 0 END) AS BIGINT) AS hits, CAST(count(nxt) AS BIGINT) AS n_pred,
  round(sum(CASE WHEN nxt = c THEN 1 ELSE 0 END) / count(nxt), 6) AS accuracy
FROM (SELECT lang, c, lead(c) OVER (PARTITION BY doc_id ORDER BY k) AS nxt FROM {_D_TOKENS}) GROUP BY lang"""


@register("next_token_accuracy", ids="A4", sql=_D_ACCURACY)
def next_token_accuracy(spark, sf_dir):
    """Predictions = the labels themselves (a 'repeat the current token' model), scored with the one-step shift."""
    d = table(spark, sf_dir, "documents").select("lang", T.codepoints("text").alias("labels"))
    return M.shifted_accuracy(d.withColumn("preds", F.col("labels")), "preds", "labels", ["lang"])


@register("accuracy_by_hook", ids="X5 A4", sql=_D_ACCURACY)
def accuracy_by_hook(spark, sf_dir):
    """The same through the hook of a caller's own metric, reduced per batch."""
    d = table(spark, sf_dir, "documents").select("lang", T.codepoints("text").alias("labels"))
    return H.two_phase(d.withColumn("preds", F.col("labels")), M.accuracy_metric("preds", "labels"), ["lang"])


_D_PERPLEXITY = f"""WITH cl AS (SELECT lang, c, count(*) AS n FROM {_D_TOKENS} GROUP BY 1, 2),
g AS (SELECT c, sum(n) AS nc FROM cl GROUP BY c),
tot AS (SELECT sum(n) AS total FROM cl)
SELECT lang, round(sum(cl.n * -ln(g.nc / tot.total)) / sum(cl.n), 6) AS mean_nll,
  round(exp(sum(cl.n * -ln(g.nc / tot.total)) / sum(cl.n)), 6) AS perplexity
FROM cl JOIN g ON cl.c = g.c, tot GROUP BY lang"""


def _losses(spark, sf_dir):
    """Unigram code-point model of the whole corpus: loss = -ln(frequency); per-language perplexity.

    Tokens are pre-aggregated to (lang, code point) counts before any join.
    """
    # one pass over the characters, counted as one-character strings; the code point is taken
    # on the small (lang, character) table, which is written once and read three times
    d = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", "")).alias("ch"))
    counts = d.where(F.col("ch") != "").groupBy("lang", "ch").agg(F.count(F.lit(1)).alias("n"))
    cl = materialize(counts.select("lang", F.ascii("ch").cast("bigint").alias("c"), "n"), "perplexity-counts")
    g = cl.groupBy("c").agg(F.sum("n").alias("nc"))
    total = cl.agg(F.sum("n")).scalar()
    return cl.join(g, "c").withColumn("nll", F.col("n") * -F.log(F.col("nc") / total))


def _rounded(p):
    return p.select("lang", F.round("mean_nll", 6).alias("mean_nll"), F.round("perplexity", 6).alias("perplexity"))


@register("perplexity", ids="A6", sql=_D_PERPLEXITY)
def perplexity(spark, sf_dir):
    return _rounded(M.perplexity(_losses(spark, sf_dir), "nll", "n", ["lang"]))


@register("perplexity_by_hook", ids="X5 A6", sql=_D_PERPLEXITY)
def perplexity_by_hook(spark, sf_dir):
    return _rounded(H.two_phase(_losses(spark, sf_dir), M.perplexity_metric("nll", "n"), ["lang"]))
