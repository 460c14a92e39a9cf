from pyspark.sql import functions as F

from textloom.constants import END_OF_TEXT_TOKEN as E
from textloom.functions import text as T
from textloom.operators import corpus as C
from textloom.sources.index import length_index


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first().r


def test_length_gate_bounds(spark):
    df = spark.createDataFrame([("x" * n,) for n in (9, 10, 20000, 20001)], "t string")
    kept = [len(r.t) for r in df.where(T.length_gate("t")).collect()]
    assert sorted(kept) == [10, 20000]


def test_strip_python_semantics(spark):
    assert one(spark, T.strip, "　\x1ca b\n") == "a b"
    s = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    assert one(spark, T.strip, s + "x y" + s) == "x y"
    assert one(spark, T.strip, "   ") == ""


def test_drop_short_then_join(spark):
    assert one(spark, lambda c: C.join_long_segments(c), ["ab", "c", "", "de"], "array<string>") == f"ab{E}de{E}"
    assert one(spark, lambda c: C.join_long_segments(c), ["a", ""], "array<string>") == E


def test_conversation_join_no_trailing(spark):
    assert one(spark, lambda c: T.join_segments(c, E), ["hi", "yo"], "array<string>") == f"hi{E}yo"


def test_length_index_separators(spark):
    df = spark.createDataFrame([(0, ["ab", "c"])], "idx bigint, segs array<string>")
    assert length_index(df, "segs", "").first().n_chars == 3
    assert length_index(df, "segs", " ").first().n_chars == 4


def test_cjk_predicates(spark):
    assert [one(spark, T.contains_cjk_basic, s) for s in ("abc", "a你", "")] == [False, True, False]
    assert [one(spark, T.is_cjk_char, s) for s in ("一", "\U00020000", "あ", "a")] == [True, True, False, False]
    assert one(spark, T.count_cjk_chars, "a你\U00020000bあ") == 2


def test_is_word(spark):
    assert [one(spark, T.is_word, s) for s in ("abc", "", "aB", "a\n")] == [True, True, False, False]


def test_clean_generated(spark):
    df = spark.createDataFrame([("我", "a b，c，d"), ("x", " yz"), ("", "")], "p string, t string")
    got = [r.r for r in df.select(T.clean_generated("t", F.col("p")).alias("r")).collect()]
    assert got == ["我ab，c", "xy", ""]


def test_codepoints_empty_and_supplementary(spark):
    assert one(spark, T.codepoints, "") == []
    assert one(spark, T.codepoints, "aé你\U00020000") == [97, 233, 20320, 131072]


def test_fold_conversations_orders_turns(spark):
    df = spark.createDataFrame([(1, 1, "yo"), (1, 0, "hi"), (2, 0, "x")], "conv_id bigint, turn bigint, text string")
    got = {r.conv_id: r.text for r in C.fold_conversations(df, sep=E, trailing=E).collect()}
    assert got == {1: f"hi{E}yo{E}", 2: f"x{E}"}
