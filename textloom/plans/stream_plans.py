"""Streaming queries: conversations arrive as JSONL files and are encoded on the fly (ST1, ST2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import text as T
from ..operators import corpus as C
from ..session import scratch_path
from ..sources import readers as R
from ..streaming import encode as S
from .duck import codepoints as d_cp, ids_str as d_ids
from .registry import register
from .tables import table

STREAM_L = 128


def _write_source(spark, sf_dir):
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"))
    src = scratch_path(spark, "stream-src")
    # several files of known order, so the stream sees more than one arrival
    rows = conv.select("conv_id", F.col("turns").alias("texts"))
    R.write_jsonl(rows.repartitionById(4, (F.col("conv_id") % 4).cast("int")).sortWithinPartitions("conv_id"), src)
    return src


def _ids(turns):
    # Q3 in id space: turns joined by the end id, no trailing end id
    return C.ids_join_long_segments(turns, T.codepoints, min_len=0, trailing=False)


_D_Q3 = f"""(SELECT conv_id, flatten(list_transform(turns, lambda t, i: CASE WHEN i = 1 THEN {d_cp('t')}
   ELSE list_concat([CAST(1 AS BIGINT)], {d_cp('t')}) END)) AS ids
 FROM (SELECT conv_id, list(text ORDER BY turn) AS turns FROM conversations GROUP BY conv_id))"""


@register(
    "stream_encode",
    ids="ST1 Q3 F6 F8",
    sql=f"""SELECT conv_id,
  {d_ids(f"CASE WHEN len(ids) > {STREAM_L} THEN list_concat(ids[1:{STREAM_L - 1}], [CAST(1 AS BIGINT)]) ELSE ids END")} AS input_ids,
  CAST(least(len(ids), {STREAM_L}) AS BIGINT) AS n_tokens
FROM {_D_Q3}""",
)
def stream_encode(spark, sf_dir):
    src = _write_source(spark, sf_dir)
    stream = S.conversation_stream(spark, src, max_files_per_trigger=2)
    enc = S.encode_stream(stream, _ids(F.col("texts")), STREAM_L)
    sink = scratch_path(spark, "stream-sink")
    S.run_to_parquet(enc, sink, scratch_path(spark, "stream-ckpt"))
    out = spark.read.parquet(sink)
    return out.select("conv_id", A.ids_to_string("input_ids").alias("input_ids"), F.size("input_ids").cast("bigint").alias("n_tokens"))


STREAM_R, STREAM_B = 2, 4


@register(
    "stream_batches",
    ids="ST2 O7 O5 Q6",
    sql=f"""WITH s AS (SELECT conv_id, least(len(ids), {STREAM_L}) AS n FROM {_D_Q3}),
l AS (SELECT conv_id, n, conv_id % 4 AS file, row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id) - 1 AS line FROM s),
b AS (SELECT *, line % {STREAM_R} AS rank, line // {STREAM_R} // {STREAM_B} AS batch, line // {STREAM_R} % {STREAM_B} AS slot FROM l)
SELECT CAST(rank AS BIGINT) AS rank, CAST(batch AS BIGINT) AS batch, CAST(slot AS BIGINT) AS slot, conv_id,
  CAST(max(n) OVER (PARTITION BY file, rank, batch) AS BIGINT) AS width FROM b""",
)
def stream_batches(spark, sf_dir):
    src = _write_source(spark, sf_dir)
    stream = S.conversation_stream(spark, src, max_files_per_trigger=1)
    enc = S.encode_stream(stream, _ids(F.col("texts")), STREAM_L, key_cols=("conv_id", "file", "block"))
    sink = scratch_path(spark, "stream-batches")
    S.run_foreach_batch(enc, S.shard_and_batch_per_microbatch(STREAM_R, STREAM_B, sink), scratch_path(spark, "stream-ckpt"))
    out = spark.read.parquet(sink)
    return out.select("rank", "batch", "slot", "conv_id", F.size("input_ids").cast("bigint").alias("width"))


@register(
    "stream_continuous_batches",
    ids="ST2 O7 O5 Q6",
    sql=f"""WITH s AS (SELECT conv_id, least(len(ids), {STREAM_L}) AS n FROM {_D_Q3}),
f AS (SELECT conv_id, n, 4 * (conv_id % 3) + conv_id // 3 % 4 AS file FROM s),
l AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY conv_id) - 1 AS line FROM f),
r AS (SELECT *, line % {STREAM_R} AS rank, row_number() OVER (PARTITION BY line % {STREAM_R} ORDER BY file, line) - 1 AS step FROM l),
b AS (SELECT *, step // {STREAM_B} AS batch, step % {STREAM_B} AS slot FROM r)
SELECT CAST(rank AS BIGINT) AS rank, CAST(batch AS BIGINT) AS batch, CAST(slot AS BIGINT) AS slot, conv_id,
  CAST(max(n) OVER (PARTITION BY rank, batch) AS BIGINT) AS width FROM b""",
)
def stream_continuous_batches(spark, sf_dir):
    """Three arrivals of four files each; the stream is started anew for each from its checkpoint, and no batch ends with a file or an arrival."""
    conv = C.fold_conversations(table(spark, sf_dir, "conversations")).select("conv_id", F.col("turns").alias("texts"))
    src, sink, state, ckpt = (scratch_path(spark, f"stream-{n}") for n in ("arrivals", "continuous", "open", "ckpt"))
    for arrival in range(3):
        mine = conv.filter(F.col("conv_id") % 3 == arrival)
        R.write_jsonl(mine.repartitionById(4, F.expr("int(conv_id div 3 % 4)")).sortWithinPartitions("conv_id"), f"{src}/{arrival}")
        stream = S.conversation_stream(spark, f"{src}/*")
        enc = S.encode_stream(stream, _ids(F.col("texts")), STREAM_L, key_cols=("conv_id", "file", "block"))
        batches = S.ContinuousBatches(spark, STREAM_R, STREAM_B, sink, state)
        S.run_foreach_batch(enc, batches, ckpt)
    return batches.finish().select("rank", "batch", "slot", "conv_id", F.size("input_ids").cast("bigint").alias("width"))
