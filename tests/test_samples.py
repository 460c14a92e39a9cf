import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.constants import END_OF_TEXT_TOKEN as E
from textloom.functions import text as T
from textloom.operators import bpe as B
from textloom.operators import corpus as C
from textloom.operators import hooks as H
from textloom.operators import samples as S


def segs(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "k bigint, segs array<string>")


def test_map_style_samples_codepoints(spark):
    got = S.map_style_samples(segs(spark, [["ab", "c"]]), "k", "segs", T.codepoints, None).first()
    # "".join + end token as text -> code points spell out the token
    assert got.input_ids == [ord(c) for c in "abc" + E] and got.labels == got.input_ids


def test_iterable_and_raw_samples(spark):
    df = segs(spark, [["ab", "c", "", "de"]])
    it = S.iterable_samples(df, "k", "segs", T.codepoints, None).first()
    assert it.input_ids == [ord(c) for c in f"ab{E}de{E}"]
    assert it.position_ids == list(range(len(it.input_ids)))
    assert S.raw_text_samples(df, "k", "segs").first().text == f"ab{E}c{E}{E}de"


def test_conversation_samples_with_bpe(spark):
    model = B.learn_bpe(spark.createDataFrame([("hi yo hi yo",)], "text string"), 40)
    df = segs(spark, [["hi", "yo"]])
    q3 = S.conversation_samples(df, "k", "segs", model, None, trailing_end=False).first()
    q4 = S.conversation_samples(df, "k", "segs", model, None, trailing_end=True).first()
    assert 1 in q3.input_ids and q3.input_ids[-1] != 1
    assert q4.input_ids[-1] == 1 and q4.input_ids[:-1] == q3.input_ids


def test_encode_gated_keep_rejected(spark):
    model = B.learn_bpe(spark.createDataFrame([("abc abc abc",)], "text string"), 30)
    df = spark.createDataFrame([(0, "  abc abc  "), (1, "short")], "k bigint, text string")
    got = {r.k: (r.ids, r.n_tokens) for r in B.encode_gated(df, model, "k", keep_rejected=True).collect()}
    assert got[1] == (None, 0) and got[0][0][-1] == 1 and got[0][1] == len(got[0][0])
    assert B.encode_gated(df, model, "k").count() == 1


def test_tokenizer_corpus_modes(spark):
    a = spark.createDataFrame([("x",)], "text string")
    b = spark.createDataFrame([("y",)], "text string")
    assert sorted(r.text for r in C.tokenizer_corpus([a, b]).collect()) == ["x", "y"]
    assert [r.text for r in C.tokenizer_corpus([a, b], mode="last").collect()] == ["y"]


def test_strict_segments(spark):
    df = spark.createDataFrame([(["a", None],)], "segs array<string>")
    with pytest.raises(Exception):
        C.strict_segments(df, "segs").collect()


def test_hooks(spark):
    df = spark.range(5).withColumn("g", F.col("id") % 2)
    out = H.map_batches(df, lambda p: p[p.id > 2], "id long, g long")
    assert sorted(r.id for r in out.collect()) == [3, 4]
    per = H.apply_per_group(df, ["g"], lambda p: pd.DataFrame({"g": [p.g.iloc[0]], "n": [len(p)]}), "g long, n long")
    assert sorted((r.g, r.n) for r in per.collect()) == [(0, 3), (1, 2)]
    raw = H.with_encoder(spark.createDataFrame([("ab",)], "t string"), "t", None).first()
    assert raw.ids == "ab"
