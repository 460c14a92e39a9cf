import math

from pyspark.sql import functions as F

from textloom.operators import metrics as M
from textloom.operators import select as G


def scores(spark, rows):
    return spark.createDataFrame(rows, "group_id bigint, item_id string, score double")


def test_repetition_penalty(spark):
    s = scores(spark, [(0, "a", 4.0), (0, "b", -4.0), (0, "c", 1.0)])
    hist = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b")], "group_id bigint, item_id string")
    got = {r.item_id: r.score for r in G.repetition_penalty(s, hist, 2.0).collect()}
    assert got == {"a": 2.0, "b": -2.0, "c": 1.0}


def test_top_k_keeps_ties(spark):
    s = scores(spark, [(0, "a", 5.0), (0, "b", 4.0), (0, "c", 4.0), (0, "d", 3.0)])
    assert sorted(r.item_id for r in G.top_k(s, 2).collect()) == ["a", "b", "c"]
    assert G.top_k(s, 0).count() == 4


def test_nucleus(spark):
    logs = [math.log(p) for p in (0.6, 0.3, 0.1)]
    s = scores(spark, [(0, n, v) for n, v in zip("abc", logs)])
    for p, k in ((0.5, 1), (0.8, 2), (0.95, 3), (0.0, 3)):
        assert G.nucleus(s, p).count() == k


def test_softmax_sums_to_one(spark):
    s = scores(spark, [(0, "a", 1.0), (0, "b", 2.0), (1, "a", 1000.0)])
    got = {(r.group_id, r.item_id): r.prob for r in G.softmax(s).collect()}
    assert abs(got[(0, "a")] + got[(0, "b")] - 1) < 1e-12 and got[(1, "a")] == 1.0


def test_argmax_ties_lowest_item(spark):
    s = scores(spark, [(0, "b", 2.0), (0, "a", 2.0), (0, "c", 1.0)])
    assert G.argmax(s).first().item_id == "a"


def test_weighted_draw_frequencies(spark):
    s = scores(spark, [(g, i, math.log(p)) for g in range(3000) for i, p in (("a", 0.7), ("b", 0.2), ("c", 0.1))])
    p = G.softmax(s)
    counts = {r.item_id: r["count"] for r in G.weighted_draw(p, seed=7).groupBy("item_id").count().collect()}
    assert abs(counts["a"] / 3000 - 0.7) < 0.04 and abs(counts["b"] / 3000 - 0.2) < 0.04
    again = {r.group_id: r.item_id for r in G.weighted_draw(p, seed=7).collect()}
    assert again == {r.group_id: r.item_id for r in G.weighted_draw(p, seed=7).collect()}
    ex = G.weighted_draw(p, seed=7, exclude=["a"]).groupBy("item_id").count().collect()
    assert {r.item_id for r in ex} == {"b", "c"}


def test_shifted_accuracy(spark):
    df = spark.createDataFrame([([1, 2, 3, 9], [0, 1, 2, 4])], "preds array<bigint>, labels array<bigint>")
    r = M.shifted_accuracy(df, "preds", "labels").first()
    assert (r.hits, r.n_pred) == (2, 3)


def test_perplexity_overflow(spark):
    df = spark.createDataFrame([(1000.0, 1)], "nll double, n bigint")
    assert M.perplexity(df, "nll", "n").first().perplexity == float("inf")


def test_describe_matches_pandas(spark):
    import pandas as pd

    vals = [3, 1, 4, 1, 5, 9, 2, 6]
    df = spark.createDataFrame([("x", v) for v in vals], "g string, n bigint")
    r = M.describe_lengths(df, ["g"], "n").first()
    d = pd.Series(vals).describe()
    assert r["count"] == 8 and r.p25 == round(d["25%"], 2) and r.p75 == round(d["75%"], 2) and r.std == round(d["std"], 2)
