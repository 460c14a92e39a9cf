"""Text-level queries: lengths, gate, strip, CJK/word flags, folds, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import END_OF_TEXT_TOKEN as E
from ..functions import text as T
from ..operators import corpus as C
from ..sources import index as S
from .duck import RE2_CJK_CLASS, strip as d_strip
from .registry import register
from .tables import table


@register(
    "length_index",
    ids="S8 F3",
    sql="SELECT doc_id AS idx, CAST(length(text) AS BIGINT) AS n_chars FROM documents",
)
def length_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), F.array("text").alias("segs"))
    return S.length_index(docs, "segs", sep="")


@register(
    "conversation_length_index",
    ids="S8 F1 Z10",
    sql="""SELECT conv_id AS idx, CAST(length(string_agg(text, ' ' ORDER BY turn)) AS BIGINT) AS n_chars
FROM conversations GROUP BY conv_id""",
)
def conversation_length_index(spark, sf_dir):
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"), sep=" ")
    return S.length_index(conv.select(F.col("conv_id").alias("idx"), "turns"), "turns", sep=" ")


@register(
    "length_gate",
    ids="P2",
    sql="""SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents
WHERE length(text) BETWEEN 10 AND 20000""",
)
def length_gate(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.where(T.length_gate("text")).select("doc_id", T.char_length("text").alias("n_chars"))


_PAD_L, _PAD_R = "\t　", "　\n\x1c"


@register(
    "strip_text",
    ids="P3",
    sql=f"SELECT doc_id, {d_strip('(chr(9) || chr(12288) || text || chr(12288) || chr(10) || chr(28))')} AS text FROM documents",
)
def strip_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    padded = F.concat(F.lit(_PAD_L), F.col("text"), F.lit(_PAD_R))
    return d.select("doc_id", T.strip(padded).alias("text"))


def _cjk_text(col):
    # the driver text holds no CJK: substitute some letter pairs to create it
    return F.replace(F.replace(F.replace(col, F.lit("th"), F.lit("中")), F.lit("er"), F.lit("\U00020000")), F.lit("an"), F.lit("あ"))


_D_CJK_TEXT = "replace(replace(replace(text, 'th', '中'), 'er', '\U00020000'), 'an', 'あ')"


@register(
    "cjk_flags",
    ids="P5 P6",
    sql=f"""SELECT doc_id,
  regexp_matches(t2, '[\\x{{4E00}}-\\x{{9FFF}}]') AS has_cjk,
  CAST(length(t2) - length(regexp_replace(t2, '{RE2_CJK_CLASS}', '', 'g')) AS BIGINT) AS n_cjk,
  regexp_full_match(substring(t2, 1, 1), '{RE2_CJK_CLASS}') AS first_is_cjk,
  regexp_full_match(substring(t2, length(t2), 1), '{RE2_CJK_CLASS}') AS last_is_cjk
FROM (SELECT doc_id, {_D_CJK_TEXT} AS t2 FROM documents)""",
)
def cjk_flags(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", _cjk_text(F.col("text")).alias("t2"))
    return d.select(
        "doc_id",
        T.contains_cjk_basic("t2").alias("has_cjk"),
        T.count_cjk_chars("t2").alias("n_cjk"),
        T.is_cjk_char(F.substring("t2", 1, 1)).alias("first_is_cjk"),
        T.is_cjk_char(F.expr("substring(t2, length(t2), 1)")).alias("last_is_cjk"),
    )


@register(
    "ascii_words",
    ids="P7",
    sql="""SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_tokens,
  CAST(len(list_filter(string_split(text, ' '), lambda w: regexp_full_match(w, '[a-z]*'))) AS BIGINT) AS n_words
FROM documents""",
)
def ascii_words(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    toks = F.split("text", " ")
    return d.select(
        "doc_id",
        F.size(toks).cast("bigint").alias("n_tokens"),
        F.size(F.filter(toks, T.is_word)).cast("bigint").alias("n_words"),
    )


@register(
    "conversation_fold",
    ids="F1 F2",
    sql=f"""SELECT conv_id, string_agg(text, '{E}' ORDER BY turn) || '{E}' AS text, CAST(count(*) AS BIGINT) AS n_turns
FROM conversations GROUP BY conv_id""",
)
def conversation_fold(spark, sf_dir):
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"), sep=E, trailing=E)
    return conv.select("conv_id", "text", "n_turns")


@register(
    "conversation_fold_newline",
    ids="F1 S4 S5",
    sql="""SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text, CAST(count(*) AS BIGINT) AS n_turns
FROM conversations GROUP BY conv_id""",
)
def conversation_fold_newline(spark, sf_dir):
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"), sep="\n")
    return conv.select("conv_id", "text", "n_turns")


@register(
    "drop_short_segments",
    ids="P4 F1 F2",
    sql=f"""SELECT doc_id,
  array_to_string(list_filter(string_split(text, chr(10)), lambda s: length(s) > 1), '{E}') || '{E}' AS text
FROM documents""",
)
def drop_short_segments(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", C.join_long_segments(C.split_lines("text")).alias("text"))


@register(
    "clean_generated",
    ids="F4",
    sql="""SELECT doc_id,
  CASE WHEN strpos(r, '，') > 0 THEN left(r, length(r) - strpos(reverse(r), '，'))
       ELSE left(r, length(r) - 1) END AS text
FROM (SELECT doc_id, replace(lang || replace(text, ',', '，'), ' ', '') AS r FROM documents)""",
)
def clean_generated(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    t = F.replace(F.col("text"), F.lit(","), F.lit("，"))
    return d.select("doc_id", T.clean_generated(t, prefix=F.col("lang")).alias("text"))
