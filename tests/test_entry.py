import __spark_entry__ as E


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 45


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"rank", "batch", "n_samples", "max_len", "real_tokens", "padded_tokens"}


def test_stream_equals_batch(spark):
    from pyspark.sql import functions as F

    from textloom.functions import arrays as A
    from textloom.operators import corpus as C
    from textloom.operators import sequence as Q
    from textloom.plans import stream_plans as SP

    q = E.queries()
    sf = "/root/testdata/sf0.001"
    s = {r.conv_id: (r.input_ids, r.n_tokens) for r in q["stream_encode"](spark, sf).collect()}
    conv = C.fold_conversations(spark.read.parquet(f"{sf}/conversations.parquet"))
    b = Q.iterable_sample(conv.select("conv_id", SP._ids(F.col("turns")).alias("ids")), "ids", SP.STREAM_L)
    batch = {r.conv_id: (r.s, r.n) for r in b.select("conv_id", A.ids_to_string("input_ids").alias("s"), F.size("input_ids").alias("n")).collect()}
    assert s == batch and len(s) > 0
