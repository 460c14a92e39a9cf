"""Sequence-shaping queries over code-point ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import END_OF_TEXT_TOKEN as E
from ..functions import arrays as A
from ..functions import text as T
from ..operators import corpus as C
from ..operators import hooks as H
from ..operators import samples as SB
from ..operators import sequence as Q
from ..operators.order import natural_order
from ..session import scratch_path
from ..sources import readers as R
from .duck import codepoints as d_cp, ids_str as d_ids
from .registry import register
from .tables import table
from .training import placed_texts

TRUNC_L = 64


def _doc_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id"), F.concat(T.codepoints("text"), Q.eod_array()).alias("ids"))


_D_IDS = f"(SELECT doc_id, list_concat({d_cp('text')}, [CAST(1 AS BIGINT)]) AS ids FROM documents)"


def _d_trunc(ids: str, L: int) -> str:
    return f"(CASE WHEN len({ids}) > {L} THEN list_concat({ids}[1:{L - 1}], [CAST(1 AS BIGINT)]) ELSE {ids} END)"


def _d_mask(ids: str, L: int, tail: int) -> str:
    return (
        f"(CASE WHEN len({ids}) > {L} THEN list_concat(list_transform(range({L - 1}), lambda x: CAST(1 AS BIGINT)), [CAST({tail} AS BIGINT)]) "
        f"ELSE list_transform({ids}, lambda x: CAST(1 AS BIGINT)) END)"
    )


@register(
    "truncate_eod",
    ids="F5 F7 F9 Q1 P13",
    sql=f"""SELECT doc_id, {d_ids(_d_trunc('ids', TRUNC_L))} AS input_ids, {d_ids(_d_mask('ids', TRUNC_L, 0))} AS attention_mask,
  {d_ids(_d_trunc('ids', TRUNC_L))} AS labels FROM {_D_IDS}""",
)
def truncate_eod(spark, sf_dir):
    s = Q.map_style_sample(_doc_ids(spark, sf_dir), "ids", TRUNC_L)
    return s.select(
        "doc_id", *[A.ids_to_string(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


@register(
    "truncate_eot",
    ids="F6 F7 F8",
    sql=f"""SELECT doc_id, {d_ids(_d_trunc('ids', TRUNC_L))} AS input_ids, {d_ids(_d_mask('ids', TRUNC_L, 1))} AS attention_mask,
  {d_ids(f"list_transform({_d_trunc('ids', TRUNC_L)}, lambda x: CAST(0 AS BIGINT))")} AS token_type_ids FROM {_D_IDS}""",
)
def truncate_eot(spark, sf_dir):
    s = Q.iterable_sample(_doc_ids(spark, sf_dir), "ids", TRUNC_L)
    return s.select(
        "doc_id", *[A.ids_to_string(c).alias(c) for c in ("input_ids", "attention_mask", "token_type_ids")]
    )


SAMPLE_L = 128
# Q2 in id space: kept segments (2+ chars) each followed by the end id
_D_SEG_IDS = f"""(SELECT doc_id, CASE WHEN len(kept) = 0 THEN [CAST(1 AS BIGINT)] ELSE
  flatten(list_transform(kept, lambda s: list_concat({d_cp('s')}, [CAST(1 AS BIGINT)]))) END AS ids
FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda s: length(s) > 1) AS kept FROM documents))"""


@register(
    "sample_columns",
    ids="Q2 F6 F8 F9 A10 P4",
    sql=f"""SELECT doc_id, {d_ids(_d_trunc('ids', SAMPLE_L))} AS input_ids,
  {d_ids(f"list_transform({_d_trunc('ids', SAMPLE_L)}, lambda x, i: CAST(i - 1 AS BIGINT))")} AS position_ids,
  CAST(least(len(ids), {SAMPLE_L}) AS BIGINT) AS n_tokens, true AS lengths_equal
FROM {_D_SEG_IDS}""",
)
def sample_columns(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    ids = C.ids_join_long_segments(C.split_lines("text"), T.codepoints)
    s = Q.iterable_sample(d.select("doc_id", ids.alias("ids")), "ids", SAMPLE_L)
    return s.select(
        "doc_id",
        A.ids_to_string("input_ids").alias("input_ids"),
        A.ids_to_string("position_ids").alias("position_ids"),
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        A.arrays_equal_length("input_ids", "attention_mask", "token_type_ids", "position_ids", "labels").alias("lengths_equal"),
    )


@register(
    "raw_text_samples",
    ids="Q9",
    sql=f"""SELECT doc_id AS idx, array_to_string(string_split(text, chr(10)), '{E}') AS text FROM documents""",
)
def raw_text_samples(spark, sf_dir):
    """Q9: segments joined by the end token, no trailing token, tokenizer = None -> raw text."""
    d = table(spark, sf_dir, "documents")
    return SB.raw_text_samples(d.select(F.col("doc_id").alias("idx"), C.split_lines("text").alias("segs")), "idx", "segs")


COLL_R, COLL_B, COLL_L = 4, 16, 64


_D_COLLATED = f"""WITH docs AS (SELECT doc_id AS idx, CAST(length(text) AS BIGINT) AS n_chars,
    {_d_trunc('r', COLL_L)} AS ids, {_d_mask('r', COLL_L, 0)} AS mask
  FROM (SELECT *, list_concat({d_cp('text')}, [CAST(1 AS BIGINT)]) AS r FROM documents)),
ordered AS (SELECT idx, ids, mask, row_number() OVER (ORDER BY n_chars, idx) - 1 AS pos FROM docs),
params AS (SELECT count(*) AS n, CAST(ceil(count(*) / {COLL_R}.0) AS BIGINT) AS num FROM docs),
slots AS (SELECT unnest(range(0, num * {COLL_R})) AS p, n, num FROM params),
placed AS (SELECT p % {COLL_R} AS rank, (p // {COLL_R}) // {COLL_B} AS batch, (p // {COLL_R}) % {COLL_B} AS slot, num, o.idx, o.ids, o.mask
  FROM slots JOIN ordered o ON o.pos = slots.p % slots.n),
kept AS (SELECT *, max(len(ids)) OVER (PARTITION BY rank, batch) AS w FROM placed WHERE batch < num // {COLL_B})
SELECT CAST(rank AS BIGINT) AS rank, CAST(batch AS BIGINT) AS batch, CAST(slot AS BIGINT) AS slot, idx,
  {d_ids('list_resize(ids, w, 0)')} AS input_ids,
  {d_ids('list_resize(mask, w, 0)')} AS attention_mask,
  {d_ids('list_resize(ids, w, -100)')} AS labels
FROM kept"""


def _map_samples(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("idx"), T.char_length("text").alias("n_chars"), "text"
    )
    batched = placed_texts(d, COLL_R, COLL_B)  # order and shard on the keys; build the arrays afterwards
    ids = batched.withColumn("ids", F.concat(T.codepoints("text"), Q.eod_array())).drop("text")
    # untruncated rows keep an all-ones mask; truncated rows end in 0
    return Q.map_style_sample(ids, "ids", COLL_L)


def _batch_rows(out):
    return out.select(
        "rank", "batch", "slot", "idx",
        *[A.ids_to_string(c).alias(c) for c in ("input_ids", "attention_mask", "labels")],
    )


@register("collate_batches", ids="Q5 Q6 A7 O6", sql=_D_COLLATED)
def collate_batches(spark, sf_dir):
    return _batch_rows(Q.collate(_map_samples(spark, sf_dir)))


@register("collate_by_hook", ids="X4 Q5", sql=_D_COLLATED)
def collate_by_hook(spark, sf_dir):
    """The same through a table function over the rows of each batch."""
    rows = _map_samples(spark, sf_dir).select("rank", "batch", "slot", "idx", "input_ids", "attention_mask", "labels")
    return _batch_rows(H.run_over_groups(rows, H.PadRows, ["rank", "batch"], ["slot"]))


# the five columns of an iterable sample, padded together
_D_FIVE = f"""WITH docs AS (SELECT doc_id AS idx, CAST(length(text) AS BIGINT) AS n_chars, {_d_trunc('r', COLL_L)} AS ids, {_d_mask('r', COLL_L, 1)} AS mask
  FROM (SELECT *, list_concat({d_cp('text')}, [CAST(1 AS BIGINT)]) AS r FROM documents)),
ordered AS (SELECT *, row_number() OVER (ORDER BY n_chars, idx) - 1 AS pos FROM docs),
params AS (SELECT count(*) AS n, CAST(ceil(count(*) / {COLL_R}.0) AS BIGINT) AS num FROM docs),
slots AS (SELECT unnest(range(0, num * {COLL_R})) AS p, n, num FROM params),
placed AS (SELECT p % {COLL_R} AS rank, (p // {COLL_R}) // {COLL_B} AS batch, (p // {COLL_R}) % {COLL_B} AS slot, num, o.* FROM slots JOIN ordered o ON o.pos = slots.p % slots.n),
kept AS (SELECT *, max(len(ids)) OVER (PARTITION BY rank, batch) AS w FROM placed WHERE batch < num // {COLL_B})"""


@register(
    "collate_five_columns",
    ids="Q6 Q5 A7 F6 F8",
    sql=_D_FIVE + f"""
SELECT CAST(rank AS BIGINT) AS rank, CAST(batch AS BIGINT) AS batch, CAST(slot AS BIGINT) AS slot, idx,
  {d_ids('list_resize(ids, w, 0)')} AS input_ids, {d_ids('list_resize(mask, w, 0)')} AS attention_mask, {d_ids('list_resize(ids, w, -100)')} AS labels
FROM kept""",
)
def collate_five_columns(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), T.char_length("text").alias("n_chars"), "text")
    ids = placed_texts(d, COLL_R, COLL_B).withColumn("ids", F.concat(T.codepoints("text"), Q.eod_array())).drop("text")
    out = Q.collate_five(Q.iterable_sample(ids, "ids", COLL_L))
    return out.select("rank", "batch", "slot", "idx", *[A.ids_to_string(c).alias(c) for c in ("input_ids", "attention_mask", "labels")])


@register(
    "raw_text_batches",
    ids="Q9 O6 O5",
    sql=_D_FIVE + """
SELECT CAST(rank AS BIGINT) AS rank, CAST(batch AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n_texts, md5(string_agg(text, chr(0) ORDER BY slot)) AS texts_md5
FROM kept JOIN documents ON doc_id = idx GROUP BY rank, batch""",
)
def raw_text_batches(spark, sf_dir):
    """Batches of the texts themselves, in slot order (their digest stands for them here)."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), T.char_length("text").alias("n_chars"), "text")
    b = Q.raw_text_batches(placed_texts(d, COLL_R, COLL_B))
    return b.select("rank", "batch", F.size("texts").cast("bigint").alias("n_texts"), F.md5(F.array_join("texts", "\0")).alias("texts_md5"))


BUILD_L = 96
_D_CONV = "(SELECT conv_id, list(text ORDER BY turn) AS segs FROM conversations GROUP BY conv_id)"
_D_SEGS = "(SELECT doc_id, string_split(text, chr(10)) AS segs FROM documents)"


def _d_sample(key: str, text: str, source: str, tail: int) -> str:
    return f"""SELECT {key}, {d_ids(_d_trunc('ids', BUILD_L))} AS input_ids, {d_ids(_d_mask('ids', BUILD_L, tail))} AS attention_mask
FROM (SELECT {key}, {d_cp('t')} AS ids FROM (SELECT {key}, {text} AS t FROM {source}))"""


def _sample_out(s, key: str):
    return s.select(key, *[A.ids_to_string(c).alias(c) for c in ("input_ids", "attention_mask")])


@register("map_style_builder", ids="Q1 F5", sql=_d_sample("doc_id", f"array_to_string(segs, '') || '{E}'", _D_SEGS, 0))
def map_style_builder(spark, sf_dir):
    """Q1 by its builder: segments joined, the end token as text, code points for a vocabulary."""
    d = table(spark, sf_dir, "documents").select("doc_id", C.split_lines("text").alias("segs"))
    return _sample_out(SB.map_style_samples(d, "doc_id", "segs", T.codepoints, BUILD_L), "doc_id")


@register(
    "iterable_builder", ids="Q2 P4 F6",
    sql=_d_sample("doc_id", f"array_to_string(list_filter(segs, lambda s: length(s) > 1), '{E}') || '{E}'", _D_SEGS, 1),
)
def iterable_builder(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", C.split_lines("text").alias("segs"))
    return _sample_out(SB.iterable_samples(d, "doc_id", "segs", T.codepoints, BUILD_L), "doc_id")


@register("conversation_builder", ids="Q3 S3 F6", sql=_d_sample("conv_id", f"array_to_string(segs, '{E}')", _D_CONV, 1))
def conversation_builder(spark, sf_dir):
    """Q3 from conversations written as JSON lines and read back."""
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"))
    path = scratch_path(spark, "jsonl-conv")
    R.write_jsonl(conv.select("conv_id", F.col("turns").alias("texts")), path)
    read = R.read_jsonl(spark, path, "texts", "array<string>", numbered=False, extra="conv_id bigint")
    return _sample_out(SB.conversation_samples(read, "conv_id", "texts", T.codepoints, BUILD_L, trailing_end=False), "conv_id")


@register("conversation_map_builder", ids="Q4 F5", sql=_d_sample("conv_id", f"array_to_string(segs, '{E}') || '{E}'", _D_CONV, 0))
def conversation_map_builder(spark, sf_dir):
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"))
    return _sample_out(SB.conversation_samples(conv, "conv_id", "turns", T.codepoints, BUILD_L, trailing_end=True), "conv_id")


PACK_S, PACK_G = Q.block_size(256, 2048), 100
_D_PACK = f"""WITH toks AS (
  SELECT pos // {PACK_G} AS grp, doc_id, u.v AS tok, u.k AS k FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents),
    LATERAL (SELECT unnest({d_cp('text')}) AS v, generate_subscripts({d_cp('text')}, 1) AS k) u),
num AS (SELECT grp, doc_id, k, tok, row_number() OVER (PARTITION BY grp ORDER BY doc_id, k) - 1 AS t,
  count(*) OVER (PARTITION BY grp) AS total FROM toks),
kept AS (SELECT grp, t // {PACK_S} AS blk, t, tok FROM num
  WHERE t < CASE WHEN total >= {PACK_S} THEN total // {PACK_S} * {PACK_S} ELSE total END)"""


def _numbered(spark, sf_dir, *cols):
    docs = table(spark, sf_dir, "documents")
    # groups are consecutive rows: the ids are numbered densely first (they need not be after a filter)
    pos = natural_order(docs.select(F.col("doc_id").alias("idx"))).select("idx", "pos")
    return docs.select(F.col("doc_id").alias("idx"), *cols).join(pos, "idx").drop("idx")


def _pack(spark, sf_dir):
    return Q.pack_blocks(_numbered(spark, sf_dir, T.codepoints("text").alias("input_ids")), "input_ids", "pos", PACK_S, group_rows=PACK_G)


_D_BLOCKS = _D_PACK + """
SELECT CAST(grp AS BIGINT) AS grp, CAST(blk AS BIGINT) AS blk,
  string_agg(CAST(tok AS VARCHAR), ',' ORDER BY t) AS input_ids, CAST(count(*) AS BIGINT) AS n_tokens
FROM kept GROUP BY grp, blk"""


def _block_rows(b):
    return b.select("grp", "blk", A.ids_to_string("input_ids").alias("input_ids"), F.size("input_ids").cast("bigint").alias("n_tokens"))


@register("pack_blocks", ids="Q7", sql=_D_BLOCKS)
def pack_blocks(spark, sf_dir):
    return _block_rows(_pack(spark, sf_dir))


@register("pack_by_hook", ids="X3 Q7", sql=_D_BLOCKS)
def pack_by_hook(spark, sf_dir):
    """The same through a table function that carries less than a block from row to row."""
    d = _numbered(spark, sf_dir, T.codepoints("text").alias("input_ids")).withColumn("grp", F.floor(F.col("pos") / PACK_G).cast("bigint"))
    return _block_rows(H.run_over_groups(d, H.PackRows, ["grp"], ["pos"], PACK_S))


@register(
    "block_lengths",
    ids="Q8",
    sql=_D_PACK + """
SELECT CAST(block_len AS BIGINT) AS block_len, CAST(count(*) AS BIGINT) AS n_blocks
FROM (SELECT grp, blk, count(*) AS block_len FROM kept GROUP BY grp, blk) GROUP BY block_len""",
)
def block_lengths(spark, sf_dir):
    lens = Q.packed_lengths(_numbered(spark, sf_dir, T.char_length("text").alias("n")), "n", "pos", PACK_S, group_rows=PACK_G)
    return lens.groupBy("block_len").agg(F.count(F.lit(1)).cast("bigint").alias("n_blocks"))


N_CTX, CONTEXT_LEN = 64, 5


@register(
    "context_tail",
    ids="O11 O12",
    sql=f"""SELECT doc_id, {d_ids(f"ids[greatest(len(ids) - {N_CTX - 1}, 0) + 1:]")} AS tail,
  {d_ids(f"ids[{CONTEXT_LEN + 1}:]")} AS generated, CAST(greatest(len(ids) - {CONTEXT_LEN}, 0) AS BIGINT) AS n_generated
FROM (SELECT doc_id, {d_cp('text')} AS ids FROM documents)""",
)
def context_tail(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", T.codepoints("text").alias("ids"))
    gen = A.drop_prefix("ids", CONTEXT_LEN)
    return d.select(
        "doc_id",
        A.ids_to_string(A.context_tail("ids", N_CTX)).alias("tail"),
        A.ids_to_string(gen).alias("generated"),
        F.size(gen).cast("bigint").alias("n_generated"),
    )
