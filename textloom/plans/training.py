"""Training-read plans: documents -> ids -> order -> ranks -> batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_SEQUENCE_LENGTH
from ..functions import text as T
from ..operators import order as O
from ..operators import sequence as Q
from .duck import strip as d_strip
from .registry import register
from .tables import table


def documents_to_order(docs: DataFrame, *, gate: bool = False) -> DataFrame:
    """Keys for ordering (raw length, id) and the text; ``gate`` applies P2 (the training read has no gate)."""
    d = docs.where(T.length_gate("text")) if gate else docs
    return d.select(F.col("doc_id").alias("idx"), T.char_length("text").alias("n_chars"), "text")


def placed_texts(docs: DataFrame, world_size: int, batch_size: int) -> DataFrame:
    """O6 on the keys alone; the texts move once, when ranks and batches are joined to them by ``idx``."""
    placed = O.training_order(docs.select("idx", "n_chars"), world_size, batch_size)
    return placed.join(docs.select("idx", "text"), "idx")


def codepoint_samples(docs: DataFrame, max_len: int | None = DEFAULT_SEQUENCE_LENGTH) -> DataFrame:
    """P3 strip -> ids = code points + end id -> F5 truncation (tokenizer-free samples).

    Applied after ordering and sharding, on texts that have their place.
    """
    d = docs.withColumn("ids", F.concat(T.codepoints(T.strip("text")), Q.eod_array())).drop("text")
    return Q.map_style_sample(d, "ids", max_len).drop("ids")


def batch_summary(batched: DataFrame) -> DataFrame:
    return batched.groupBy("rank", "batch").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_samples"),
        F.max(F.size("input_ids")).cast("bigint").alias("max_len"),
        F.sum(F.size("input_ids")).cast("bigint").alias("real_tokens"),
        (F.count(F.lit(1)) * F.max(F.size("input_ids"))).cast("bigint").alias("padded_tokens"),
    )


TRAIN_R, TRAIN_B, TRAIN_L = 4, 16, 1024


@register(
    "train_batches",
    ids="O6 O5 O3 O2 O1 P3 F2 F5",
    sql=f"""
WITH docs AS (
  SELECT doc_id AS idx, length(text) AS n_chars,
         least(length({d_strip('text')}) + 1, {TRAIN_L}) AS n_tok
  FROM documents),
ordered AS (SELECT idx, n_tok, row_number() OVER (ORDER BY n_chars, idx) - 1 AS pos FROM docs),
params AS (SELECT count(*) AS n, CAST(ceil(count(*) / {TRAIN_R}.0) AS BIGINT) AS num FROM docs),
slots AS (SELECT unnest(range(0, num * {TRAIN_R})) AS p, n, num FROM params),
placed AS (
  SELECT p % {TRAIN_R} AS rank, p // {TRAIN_R} AS step, num, o.n_tok
  FROM slots JOIN ordered o ON o.pos = slots.p % slots.n)
SELECT CAST(rank AS BIGINT) AS rank, CAST(step // {TRAIN_B} AS BIGINT) AS batch,
       CAST(count(*) AS BIGINT) AS n_samples, CAST(max(n_tok) AS BIGINT) AS max_len,
       CAST(sum(n_tok) AS BIGINT) AS real_tokens, CAST(count(*) * max(n_tok) AS BIGINT) AS padded_tokens
FROM placed WHERE step // {TRAIN_B} < num // {TRAIN_B}
GROUP BY 1, 2
""",
)
def train_batches(spark, sf_dir):
    """Flagship: documents -> code-point samples -> length order -> 4 ranks -> batches of 16."""
    docs = documents_to_order(table(spark, sf_dir, "documents"))
    return batch_summary(codepoint_samples(placed_texts(docs, TRAIN_R, TRAIN_B), TRAIN_L))
