"""Order, shard, batch, epoch and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import END_OF_TEXT_TOKEN as E
from ..operators import corpus as C
from ..operators import order as O
from ..operators.position import global_position, head_rows
from ..session import scratch_path
from ..sources import batch_store as BS
from ..sources import readers as R
from .registry import register
from .tables import table


def _docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("idx"), F.length("text").cast("bigint").alias("n_chars"))


_D_DOCS = "(SELECT doc_id AS idx, CAST(length(text) AS BIGINT) AS n_chars FROM documents)"


@register(
    "union_index",
    ids="U1 U2 O2",
    sql=f"""WITH u AS (
  SELECT 0 AS dataset_ord, doc_id AS local_id, length(text) AS n_chars FROM documents
  UNION ALL SELECT 1, item_id, length(text) FROM benchmark
  UNION ALL SELECT 2, conv_id, length(string_agg(text, '{E}' ORDER BY turn)) FROM conversations GROUP BY conv_id)
SELECT CAST(dataset_ord AS BIGINT) AS dataset_ord, local_id, CAST(n_chars AS BIGINT) AS n_chars,
       CAST(row_number() OVER (ORDER BY dataset_ord, local_id) - 1 AS BIGINT) AS idx
FROM u""",
)
def union_index(spark, sf_dir):
    n_chars = F.length("text").cast("bigint").alias("n_chars")  # only lengths are ordered, never texts
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("local_id"), n_chars)
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("local_id"), n_chars)
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"), sep=E).select(F.col("conv_id").alias("local_id"), n_chars)
    return O.concat_index([docs, bench, conv], ["local_id"]).select("dataset_ord", "local_id", "n_chars", "idx")


@register(
    "length_order",
    ids="O1 O2",
    sql=f"SELECT idx, n_chars, CAST(row_number() OVER (ORDER BY n_chars, idx) - 1 AS BIGINT) AS pos FROM {_D_DOCS}",
)
def length_order(spark, sf_dir):
    return O.length_order(_docs(spark, sf_dir)).select("idx", "n_chars", "pos")


@register(
    "length_order_desc",
    ids="O1d O2",
    sql=f"SELECT idx, n_chars, CAST(row_number() OVER (ORDER BY n_chars DESC, idx DESC) - 1 AS BIGINT) AS pos FROM {_D_DOCS}",
)
def length_order_desc(spark, sf_dir):
    return O.length_order(_docs(spark, sf_dir), descending=True).select("idx", "n_chars", "pos")


SHARD_R = 7


def _shard_sql(drop_last: bool) -> str:
    num = f"n // {SHARD_R}" if drop_last else f"CAST(ceil(n / {SHARD_R}.0) AS BIGINT)"
    return f"""WITH o AS (SELECT idx, row_number() OVER (ORDER BY n_chars, idx) - 1 AS pos FROM {_D_DOCS}),
params AS (SELECT count(*) AS n, {num} AS num FROM o),
slots AS (SELECT unnest(range(0, num * {SHARD_R})) AS p, n, num FROM params)
SELECT CAST(p % {SHARD_R} AS BIGINT) AS rank, CAST(p // {SHARD_R} AS BIGINT) AS step, o.idx,
       CAST(num AS BIGINT) AS num_samples
FROM slots JOIN o ON o.pos = slots.p % slots.n"""


@register("rank_shard_pad", ids="O3 A3", sql=_shard_sql(False))
def rank_shard_pad(spark, sf_dir):
    pos = O.length_order(_docs(spark, sf_dir), total_col="n_total")
    return O.rank_shard(pos, SHARD_R, drop_last=False).select("rank", "step", "idx", "num_samples")


@register("rank_shard_drop", ids="O4 A3", sql=_shard_sql(True))
def rank_shard_drop(spark, sf_dir):
    pos = O.length_order(_docs(spark, sf_dir), total_col="n_total")
    return O.rank_shard(pos, SHARD_R, drop_last=True).select("rank", "step", "idx", "num_samples")


LINE_R, LINE_W = 3, 2
_D_LINES = "(SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS line_no FROM documents)"


def _lines(spark, sf_dir):
    # one "file" per source; line number = position inside the file
    d = table(spark, sf_dir, "documents").select("source", "doc_id")
    return global_position(d, [F.col("doc_id")], group_cols=["source"], pos_col="line_no")


@register(
    "line_shard",
    ids="O7",
    sql=f"""SELECT source, doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(line_no % {LINE_R} AS BIGINT) AS rank,
       CAST(line_no // {LINE_R} AS BIGINT) AS step FROM {_D_LINES}""",
)
def line_shard(spark, sf_dir):
    return O.line_shard(_lines(spark, sf_dir), LINE_R).select("source", "doc_id", "line_no", "rank", "step")


@register(
    "line_window",
    ids="O8 Z7",
    sql=f"""SELECT source, doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(line_no // {LINE_W} AS BIGINT) AS rank,
       CAST(w.range AS BIGINT) AS worker
FROM {_D_LINES} l, range({LINE_W}) w WHERE line_no < {LINE_W * LINE_R}""",
)
def line_window(spark, sf_dir):
    return O.line_window(_lines(spark, sf_dir), LINE_R, LINE_W).select("source", "doc_id", "line_no", "rank", "worker")


@register(
    "seeded_shuffle",
    ids="O9",
    sql=f"SELECT idx, CAST(row_number() OVER (ORDER BY md5('1025:' || CAST(idx AS VARCHAR)), idx) - 1 AS BIGINT) AS pos FROM {_D_DOCS}",
)
def seeded_shuffle(spark, sf_dir):
    return O.seeded_shuffle(_docs(spark, sf_dir), seed=1024, epoch=1).select("idx", "pos")


EPOCH_B, EPOCHS, RESUME = 16, 3, "checkpoints/weights_3"


@register(
    "epochs_resume",
    ids="O10 P12 O5 O6",
    sql=f"""WITH o AS (SELECT idx, row_number() OVER (ORDER BY idx) - 1 AS pos, count(*) OVER () AS n FROM {_D_DOCS}),
b AS (SELECT idx, pos // {EPOCH_B} AS batch, pos % {EPOCH_B} AS slot FROM o WHERE pos // {EPOCH_B} < n // {EPOCH_B})
SELECT CAST(e.range AS BIGINT) AS epoch, CAST(batch AS BIGINT) AS batch, CAST(slot AS BIGINT) AS slot, idx
FROM b, range({EPOCHS}) e
WHERE e.range > 0 OR batch >= CAST(regexp_extract('{RESUME}', '([^_]*)$', 1) AS BIGINT)""",
)
def epochs_resume(spark, sf_dir):
    batches = O.training_order(_docs(spark, sf_dir), 1, EPOCH_B)
    rep = O.repeat_epochs(batches, EPOCHS)
    return O.skip_resumed(rep, RESUME).select("epoch", "batch", "slot", "idx")


HEAD_N, SPLIT_PCT = 100, 5


@register(
    "head_limit",
    ids="P10",
    sql=f"""SELECT idx, n_chars, CAST(pos AS BIGINT) AS pos FROM
  (SELECT idx, n_chars, row_number() OVER (ORDER BY idx) - 1 AS pos FROM {_D_DOCS}) WHERE pos < {HEAD_N}""",
)
def head_limit(spark, sf_dir):
    return head_rows(_docs(spark, sf_dir), ["idx"], HEAD_N).select("idx", "n_chars", "pos")


@register(
    "percent_split",
    ids="P11",
    sql=f"""SELECT idx, CAST(pos AS BIGINT) AS pos,
  CASE WHEN pos < round_even(n * {SPLIT_PCT} / 100.0, 0) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT idx, row_number() OVER (ORDER BY idx) - 1 AS pos, count(*) OVER () AS n FROM {_D_DOCS})""",
)
def percent_split(spark, sf_dir):
    pos = O.natural_order(_docs(spark, sf_dir), total_col="n_total")
    return O.percent_split(pos, SPLIT_PCT).select("idx", "pos", "split")


@register(
    "resume_from_store",
    ids="O10 P12 O5 O6",
    sql=f"""WITH o AS (SELECT idx, row_number() OVER (ORDER BY n_chars, idx) - 1 AS pos, count(*) OVER () AS n FROM {_D_DOCS}),
p AS (SELECT count(*) AS n, CAST(ceil(count(*) / 2.0) AS BIGINT) AS num FROM o),
s AS (SELECT unnest(range(0, num * 2)) AS slot, n, num FROM p),
b AS (SELECT slot % 2 AS rank, slot // 2 // {EPOCH_B} AS batch, slot // 2 % {EPOCH_B} AS slot, idx FROM s JOIN o ON o.pos = s.slot % s.n WHERE slot // 2 // {EPOCH_B} < num // {EPOCH_B})
SELECT CAST(e.range AS BIGINT) AS epoch, CAST(rank AS BIGINT) AS rank, CAST(batch AS BIGINT) AS batch, CAST(slot AS BIGINT) AS slot, idx
FROM b, range({EPOCHS}) e WHERE e.range > 0 OR batch >= 3""",
)
def resume_from_store(spark, sf_dir):
    """Batches of two ranks are stored once; a resumed epoch opens the files from its step on."""
    batches = O.training_order(_docs(spark, sf_dir), 2, EPOCH_B).select("rank", "batch", "slot", "idx")
    path = scratch_path(spark, "batch-store")
    BS.write_batches(batches, path, batches_per_range=4)
    return BS.resume_epochs(spark, path, EPOCHS, RESUME).select("epoch", F.col("rank").cast("bigint").alias("rank"), "batch", "slot", "idx")


SHUFFLE_SEED, SHUFFLE_ROUNDS = 1024, 6


def _duck_network(src: str) -> str:
    """The rounds of the network over (l, r), one nested select each; key ``seed:epoch``."""
    for i in range(SHUFFLE_ROUNDS):
        side, other, size = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        value = f"CAST('0x' || substr(md5('{SHUFFLE_SEED}:' || epoch || ':{i}:' || {other}), 1, 12) AS BIGINT)"
        moved = f"({side} + {value}) % {size} AS {side}"
        src = f"(SELECT idx, epoch, n, a, b, {', '.join(moved if c == side else c for c in 'lr')} FROM {src})"
    return src


@register(
    "shuffle_places",
    ids="O9",
    sql=f"""WITH RECURSIVE d AS (SELECT idx, row_number() OVER (ORDER BY idx) - 1 AS pos, count(*) OVER () AS n FROM {_D_DOCS}),
z AS (SELECT idx, pos, n, e.range AS epoch, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM d, range(2) e),
w AS (SELECT *, CAST(ceil(n / a) AS BIGINT) AS b FROM z),
walk AS (
  SELECT idx, epoch, n, a, b, l + a * r AS y FROM {_duck_network("(SELECT idx, epoch, n, a, b, pos % a AS l, pos // a AS r FROM w)")}
  UNION ALL SELECT idx, epoch, n, a, b, l + a * r AS y FROM {_duck_network("(SELECT idx, epoch, n, a, b, y % a AS l, y // a AS r FROM walk WHERE y >= n)")})
SELECT w.idx, CAST(w.epoch AS BIGINT) AS epoch, CAST(w.pos AS BIGINT) AS pos, CAST(y AS BIGINT) AS place, CAST(w.pos AS BIGINT) AS back
FROM w JOIN walk ON walk.idx = w.idx AND walk.epoch = w.epoch AND y < walk.n""",
)
def shuffle_places(spark, sf_dir):
    """Every document's place in two epochs, and back, computed from its position alone."""
    d = O.natural_order(_docs(spark, sf_dir), total_col="n_total").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(1)).cast("array<bigint>")))
    placed = O.shuffled_place(d, SHUFFLE_SEED, "epoch", rounds=SHUFFLE_ROUNDS)
    return O.unshuffled_position(placed, SHUFFLE_SEED, "epoch", out_col="back", rounds=SHUFFLE_ROUNDS).select("idx", "epoch", "pos", "place", "back")


@register(
    "scanned_union_index",
    ids="U1 U2 O2 S6 S1",
    sql=f"""WITH u AS (
  SELECT 0 AS dataset_ord, doc_id AS local_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
  UNION ALL SELECT 2, conv_id, string_agg(text, '{E}' ORDER BY turn) FROM conversations GROUP BY conv_id)
SELECT CAST(dataset_ord AS BIGINT) AS dataset_ord, local_id, CAST(length(text) AS BIGINT) AS n_chars,
       CAST(row_number() OVER (ORDER BY dataset_ord, local_id) - 1 AS BIGINT) AS idx FROM u""",
)
def scanned_union_index(spark, sf_dir):
    """Three sets of JSON-line files, several files each: one index from the counts of their splits; the lines are neither sorted nor moved."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("local_id"), "text")
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("local_id"), "text")
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"), sep=E).select(F.col("conv_id").alias("local_id"), "text")
    scans = []
    for name, rows in (("documents", docs), ("benchmark", bench), ("conversations", conv)):
        path = scratch_path(spark, f"set-{name}")
        R.write_ordered_jsonl(rows, path, ["local_id"], "text")
        scans.append(R.scan_jsonl(spark, path, "text", extra="local_id bigint"))
    out = O.scanned_index(scans)
    return out.select("dataset_ord", "local_id", F.length("text").cast("bigint").alias("n_chars"), "idx")
