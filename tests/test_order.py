import itertools
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.operators import order as O
from textloom.operators.position import global_position
from tests.conftest import SF


# --- plain-Python restatements of the sampler, written from its documented behaviour


def shard_reference(order, R, drop_last):
    n = len(order)
    per_rank = n // R if drop_last else -(-n // R)
    total = per_rank * R
    seq = list(itertools.islice(itertools.cycle(order), total)) if n else []
    return {r: seq[r::R][:per_rank] for r in range(R)}


def shard_closed_form(order, R, drop_last):
    n = len(order)
    per_rank = n // R if drop_last else -(-n // R)
    return {r: [order[(s * R + r) % n] for s in range(per_rank)] for r in range(R)}


def test_closed_form_equals_loop():
    for n in range(1, 60):
        for R in range(1, 17):
            order = list(range(n))
            for drop in (False, True):
                assert shard_closed_form(order, R, drop) == shard_reference(order, R, drop)


def frame(spark, n):
    return spark.createDataFrame([(i, (i * 7919) % 13) for i in range(n)], "idx bigint, n_chars bigint")


def spark_shards(spark, n, R, drop_last):
    pos = O.length_order(frame(spark, n), total_col="n_total")
    got = O.rank_shard(pos, R, drop_last=drop_last).collect()
    out = {r: [] for r in range(R)}
    for row in sorted(got, key=lambda x: (x.rank, x.step)):
        out[row.rank].append(row.idx)
    order = [r.idx for r in sorted(frame(spark, n).collect(), key=lambda x: (x.n_chars, x.idx))]
    return out, order


def test_shard_fixtures(spark):
    df = spark.createDataFrame([(i, 0, c) for i, c in enumerate("abcde")], "idx bigint, n_chars bigint, name string")
    pos = O.length_order(df, total_col="n_total")

    def names(d):
        out = {}
        for r in sorted(d.collect(), key=lambda x: (x.rank, x.step)):
            out.setdefault(r.rank, []).append(r.name)
        return out

    assert names(O.rank_shard(pos, 2)) == {0: ["a", "c", "e"], 1: ["b", "d", "a"]}
    assert names(O.rank_shard(pos, 2, drop_last=True)) == {0: ["a", "c"], 1: ["b", "d"]}
    one = O.length_order(df.where("name = 'a'"), total_col="n_total")
    assert names(O.rank_shard(one, 4)) == {r: ["a"] for r in range(4)}
    assert O.rank_shard(one, 4, drop_last=True).count() == 0


@settings(max_examples=12, deadline=None)
@given(n=st.integers(1, 40), R=st.integers(1, 9), drop=st.booleans())
def test_shard_property(spark, n, R, drop):
    got, order = spark_shards(spark, n, R, drop)
    assert got == shard_reference(order, R, drop)


def test_positions_match_row_number_and_partition_invariance(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("idx"), F.length("text").alias("n_chars"))
    w = Window.orderBy("n_chars", "idx")
    want = {r.idx: r.p for r in d.select("idx", (F.row_number().over(w) - 1).alias("p")).collect()}
    for parts in (1, 4, 32):
        got = {r.idx: r.pos for r in global_position(d, ["n_chars", "idx"], num_partitions=parts).collect()}
        assert got == want


def test_grouped_positions(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source")
    w = Window.partitionBy("source").orderBy("doc_id")
    want = {r.doc_id: r.p for r in d.select("doc_id", (F.row_number().over(w) - 1).alias("p")).collect()}
    got = {r.doc_id: r.line_no for r in global_position(d, ["doc_id"], group_cols=["source"], pos_col="line_no", num_partitions=5).collect()}
    assert got == want


def test_no_single_partition_exchange_of_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("idx"), F.length("text").alias("n_chars"))
    plan = O.rank_shard(O.length_order(d, total_col="n_total"), 4)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    singles = [i for i, l in enumerate(lines) if "Exchange SinglePartition" in l]
    assert singles
    for i in singles:
        # only the per-partition count table (one row per range partition) is gathered
        assert "HashAggregate(keys=[_pid" in lines[i + 1]


def test_batches_drop_last(spark):
    df = spark.createDataFrame([(0, i, 3) for i in range(3)], "rank bigint, step bigint, num_samples bigint")
    got = O.cut_batches(df, 2, drop_last=True).collect()
    assert sorted(r.step for r in got) == [0, 1]


def test_line_shard_and_window(spark):
    df = spark.createDataFrame([(i,) for i in range(7)], "line_no bigint")
    assert sorted(r.line_no for r in O.line_shard(df, 3).where("rank = 1").collect()) == [1, 4]
    w = O.line_window(df, 3, 2).where("rank = 1")
    assert sorted(r.line_no for r in w.collect()) == [2, 2, 3, 3]  # each of the 2 workers yields both lines


def test_resume_and_epochs(spark):
    df = spark.createDataFrame([(b,) for b in range(6)], "batch bigint")
    rep = O.skip_resumed(O.repeat_epochs(df, 2), "checkpoints/weights_3").collect()
    assert sorted(r.batch for r in rep if r.epoch == 0) == [3, 4, 5]
    assert sorted(r.batch for r in rep if r.epoch == 1) == list(range(6))


def test_percent_split_rounding(spark):
    for n, want in ((10, 0), (30, 2), (50, 2), (1000, 50)):
        df = spark.range(n).select(F.col("id").alias("idx"))
        pos = O.natural_order(df, total_col="n_total")
        got = O.percent_split(pos, 5).where("split = 'validation'").count()
        assert got == want == round(n * 5 / 100)


def test_seeded_shuffle(spark):
    d = spark.range(50).select(F.col("id").alias("idx"))
    a = {r.idx: r.pos for r in O.seeded_shuffle(d, 1024, 0).collect()}
    b = {r.idx: r.pos for r in O.seeded_shuffle(d, 1024, 0).collect()}
    c = {r.idx: r.pos for r in O.seeded_shuffle(d, 1024, 1).collect()}
    assert sorted(a.values()) == list(range(50)) and a == b and a != c


def test_concat_index(spark):
    a = spark.createDataFrame([(5,), (3,)], "k bigint")
    b = spark.createDataFrame([(1,)], "k bigint")
    got = sorted((r.dataset_ord, r.k, r.idx) for r in O.concat_index([a, b], ["k"]).collect())
    assert got == [(0, 3, 0), (0, 5, 1), (1, 1, 2)]
