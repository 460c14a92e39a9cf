"""Score-table selection queries (G1-G8, A5) over events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import select as G
from .registry import register
from .tables import table

TEMP, BANNED, TOP_K, TOP_P, PENALTY, SEED, REDRAW = 0.7, "error", 3, 0.8, 1.5, 20240101, "view"


def _scores(spark, sf_dir):
    """One candidate row per (user, event type); score = number of events."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("group_id"), F.col("event_type").alias("item_id")).agg(
        F.count(F.lit(1)).cast("double").alias("score")
    )


_D_SCORES = f"""(SELECT user_id AS group_id, event_type AS item_id, count(*) / {TEMP} AS score
  FROM events WHERE event_type <> '{BANNED}' GROUP BY 1, 2)"""
_D_SOFTMAX = f"""sm AS (SELECT group_id, item_id, score, e / sum(e) OVER (PARTITION BY group_id) AS prob
  FROM (SELECT *, exp(score - max(score) OVER (PARTITION BY group_id)) AS e FROM {{src}}))"""


@register(
    "softmax_scores",
    ids="G1 G3 G6 F10",
    sql=f"""WITH {_D_SOFTMAX.format(src=_D_SCORES)}
SELECT group_id AS user_id, item_id AS event_type, round(prob, 9) AS prob FROM sm""",
)
def softmax_scores(spark, sf_dir):
    s = G.ban_items(G.temperature(_scores(spark, sf_dir), TEMP), [BANNED])
    p = G.softmax(s, small_groups=True)  # a group holds one row an event type
    return p.select(F.col("group_id").alias("user_id"), F.col("item_id").alias("event_type"), F.round("prob", 9).alias("prob"))


def _filtered(spark, sf_dir):
    s = G.ban_items(G.temperature(_scores(spark, sf_dir), TEMP), [BANNED])
    return G.nucleus(G.top_k(s, TOP_K), TOP_P, small_groups=True)


_D_TOPK = f"""(SELECT * FROM (SELECT *, rank() OVER (PARTITION BY group_id ORDER BY score DESC) AS r FROM {_D_SCORES}) WHERE r <= {TOP_K})"""
_D_NUCLEUS = f"""WITH {_D_SOFTMAX.format(src=_D_TOPK)},
cum AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY group_id ORDER BY score DESC, item_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sm)"""


@register(
    "nucleus_cut",
    ids="G4 G5 G1 G3 G6",
    sql=_D_NUCLEUS + f"""
SELECT group_id AS user_id, item_id AS event_type, round(prob, 9) AS prob FROM cum WHERE before <= {TOP_P}""",
)
def nucleus_cut(spark, sf_dir):
    f = _filtered(spark, sf_dir)
    return f.select(F.col("group_id").alias("user_id"), F.col("item_id").alias("event_type"), F.round("prob", 9).alias("prob"))


@register(
    "weighted_draw",
    ids="G7 G8",
    sql=_D_NUCLEUS + f""",
race AS (SELECT group_id, item_id, -ln((CAST(CAST('0x' || substr(md5('{SEED}:' || CAST(group_id AS VARCHAR) || ':' || item_id), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
    / {float(1 << 52)!r}) / prob AS k FROM cum WHERE before <= {TOP_P} AND item_id <> '{REDRAW}' AND prob > 0)
SELECT group_id AS user_id, arg_min(item_id, k) AS event_type FROM race GROUP BY group_id""",
)
def weighted_draw(spark, sf_dir):
    """One draw per user from the nucleus-filtered distribution, never the re-drawn item."""
    f = _filtered(spark, sf_dir)
    d = G.weighted_draw(f, SEED, exclude=[REDRAW])
    return d.select(F.col("group_id").alias("user_id"), F.col("item_id").alias("event_type"))


def _kinds(spark, sf_dir):
    """Few groups of very many items: every event is an item of its type's group."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("group_id"), F.col("event_id").alias("item_id"), (F.floor(F.col("value") / 4) / 40).alias("score"))


_D_KINDS = """WITH s AS (SELECT event_type AS group_id, event_id AS item_id, floor(value / 4) / 40 AS score FROM events),
sm AS (SELECT *, e / sum(e) OVER (PARTITION BY group_id) AS prob FROM (SELECT *, exp(score - max(score) OVER (PARTITION BY group_id)) AS e FROM s))"""


@register(
    "softmax_large_groups",
    ids="G6",
    sql=_D_KINDS + "\nSELECT group_id AS event_type, item_id AS event_id, round(prob, 9) AS prob FROM sm",
)
def softmax_large_groups(spark, sf_dir):
    p = G.softmax(_kinds(spark, sf_dir))
    return p.select(F.col("group_id").alias("event_type"), F.col("item_id").alias("event_id"), F.round("prob", 9).alias("prob"))


@register(
    "nucleus_large_groups",
    ids="G5 G6",
    sql=_D_KINDS + f""",
cum AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY group_id ORDER BY score DESC, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sm)
SELECT group_id AS event_type, item_id AS event_id, round(prob, 9) AS prob FROM cum WHERE before <= {TOP_P}""",
)
def nucleus_large_groups(spark, sf_dir):
    p = G.nucleus(_kinds(spark, sf_dir), TOP_P)
    return p.select(F.col("group_id").alias("event_type"), F.col("item_id").alias("event_id"), F.round("prob", 9).alias("prob"))


TOPK_ORDERS = 2


@register(
    "topk_ties",
    ids="G4",
    sql=f"""SELECT o_custkey, o_orderkey, score FROM (
  SELECT o_custkey, o_orderkey, floor(o_totalprice / 50000) AS score,
         rank() OVER (PARTITION BY o_custkey ORDER BY floor(o_totalprice / 50000) DESC) AS r FROM orders)
WHERE r <= {TOPK_ORDERS}""",
)
def topk_ties(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("group_id"), F.col("o_orderkey").alias("item_id"),
        F.floor(F.col("o_totalprice") / 50000).cast("double").alias("score"),
    )
    k = G.top_k(o, TOPK_ORDERS)
    return k.select(F.col("group_id").alias("o_custkey"), F.col("item_id").alias("o_orderkey"), "score")


_D_MID = "(SELECT (max(event_id) + min(event_id)) / 2.0 FROM events)"


@register(
    "repetition_penalty",
    ids="G2 Z14",
    sql=f"""WITH s AS (SELECT user_id, event_type, avg(value) - 10.0 AS score FROM events
  WHERE event_id >= {_D_MID} GROUP BY 1, 2),
h AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_id < {_D_MID})
SELECT s.user_id, s.event_type, round(CASE WHEN h.user_id IS NOT NULL THEN score / {PENALTY} ELSE score END, 6) AS score
FROM s LEFT JOIN h ON s.user_id = h.user_id AND s.event_type = h.event_type""",
)
def repetition_penalty(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    mid = e.agg(((F.max("event_id") + F.min("event_id")) / 2.0).alias("m")).scalar()
    later = e.where(F.col("event_id") >= mid)
    history = e.where(F.col("event_id") < mid).select(F.col("user_id").alias("group_id"), F.col("event_type").alias("item_id"))
    scores = later.groupBy(F.col("user_id").alias("group_id"), F.col("event_type").alias("item_id")).agg(
        (F.avg("value") - 10.0).alias("score")
    )
    p = G.repetition_penalty(scores, history, PENALTY)
    return p.select(F.col("group_id").alias("user_id"), F.col("item_id").alias("event_type"), F.round("score", 6).alias("score"))


@register(
    "argmax_item",
    ids="A5",
    sql="""SELECT user_id, first(event_type ORDER BY n DESC, event_type) AS event_type
FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY user_id""",
)
def argmax_item(spark, sf_dir):
    a = G.argmax(_scores(spark, sf_dir))
    return a.select(F.col("group_id").alias("user_id"), F.col("item_id").alias("event_type"))
