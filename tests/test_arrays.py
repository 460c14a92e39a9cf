from pyspark.sql import functions as F

from textloom.functions import arrays as A
from textloom.operators import sequence as Q


def ids_df(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i bigint, ids array<bigint>")


def test_truncate_map_style(spark):
    df = Q.map_style_sample(ids_df(spark, [[9, 8, 7, 6, 1], [9, 8, 7, 1]]), "ids", 4).orderBy("i").collect()
    assert df[0].input_ids == [9, 8, 7, 1] and df[0].attention_mask == [1, 1, 1, 0]
    assert df[1].input_ids == [9, 8, 7, 1] and df[1].attention_mask == [1, 1, 1, 1]
    assert df[0].labels == df[0].input_ids


def test_truncate_iterable(spark):
    r = Q.iterable_sample(ids_df(spark, [[9, 8, 7, 6, 1]]), "ids", 4).first()
    assert r.input_ids == [9, 8, 7, 1]
    assert r.attention_mask == [1, 1, 1, 1]
    assert r.token_type_ids == [0, 0, 0, 0]
    assert r.position_ids == [0, 1, 2, 3]


def test_no_cap(spark):
    r = Q.iterable_sample(ids_df(spark, [[1, 2, 3]]), "ids", None).first()
    assert r.input_ids == [1, 2, 3]


def test_context_tail_and_drop_prefix(spark):
    df = ids_df(spark, [list(range(10)), [1]])
    got = df.select(A.context_tail("ids", 4).alias("t"), A.drop_prefix("ids", 3).alias("g")).orderBy(F.size("g").desc()).collect()
    assert got[0].t == [7, 8, 9] and got[0].g == [3, 4, 5, 6, 7, 8, 9]
    assert got[1].t == [1] and got[1].g == []


def test_collate_pads(spark):
    df = spark.createDataFrame(
        [(0, 0, [5, 6, 7]), (0, 0, [8])], "rank bigint, batch bigint, ids array<bigint>"
    ).withColumn("input_ids", F.col("ids")).withColumn("attention_mask", A.ones_like("ids")).withColumn("labels", F.col("ids"))
    rows = sorted(Q.collate(df).collect(), key=lambda r: -len(r.ids))
    assert rows[0].input_ids == [5, 6, 7] and rows[1].input_ids == [8, 0, 0]
    assert rows[1].labels == [8, -100, -100] and rows[1].attention_mask == [1, 0, 0]


def test_equal_lengths_check(spark):
    df = spark.createDataFrame([([1, 2], [1, 1]), ([1], [1, 1])], "a array<bigint>, b array<bigint>")
    assert Q.equal_lengths(df, "a", "b").count() == 1
