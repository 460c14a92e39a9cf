"""Pre-token histogram and BPE queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import DEFAULT_VOCAB_SIZE, STRIP_CHARS
from ..functions import arrays as A
from ..functions import text as T
from ..operators import bpe as B
from ..operators import corpus as C
from ..operators import pretoken as P
from ..operators import sequence as Q
from ..session import checkpoint_dir, scratch_path
from ..sources.index import content_key, read_if_present
from .duck import strip as d_strip
from .registry import register
from .tables import table

_RE2_WS = "".join(f"\\x{{{ord(c):X}}}" for c in STRIP_CHARS if c not in "\x1c\x1d\x1e\x1f")
_RE2_PRETOKEN = f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_RE2_WS}\\p{{L}}\\p{{N}}]+"


_D_PIECES = f"""(SELECT unnest(regexp_extract_all(text, '{_RE2_PRETOKEN.replace("'", "''")}')) AS piece FROM documents)"""


@register(
    "pretoken_histogram",
    ids="T1 A8",
    # RE2 has no look-ahead: a run of white space before something visible gives all but its last character, and the
    # last one too unless it is a blank (which then belongs to the next piece); a run at the end is one piece
    sql=f"""WITH runs AS (SELECT unnest(regexp_extract_all(text, '[{_RE2_WS}]+([^{_RE2_WS}]|$)')) AS m FROM documents),
r AS (SELECT regexp_full_match(m, '[{_RE2_WS}]+') AS fin, CASE WHEN regexp_full_match(m, '[{_RE2_WS}]+') THEN m ELSE left(m, length(m) - 1) END AS w FROM runs),
p AS (SELECT piece FROM {_D_PIECES} UNION ALL SELECT w FROM r WHERE fin
  UNION ALL SELECT left(w, length(w) - 1) FROM r WHERE NOT fin AND length(w) > 1
  UNION ALL SELECT right(w, 1) FROM r WHERE NOT fin AND right(w, 1) <> ' ')
SELECT piece, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY piece""",
)
def pretoken_histogram(spark, sf_dir):
    return P.pretoken_histogram(table(spark, sf_dir, "documents"))


def trained_model(spark, sf_dir, vocab_size: int = DEFAULT_VOCAB_SIZE, *, recache: bool = False) -> B.BpeModel:
    """S9 + S11: load the model for this corpus (U3: documents and folded conversations) from the shared folder, or learn and save it."""
    path = f"{checkpoint_dir(spark)}/bpe-model-{content_key(table(spark, sf_dir, 'documents'), vocab_size, content_key(table(spark, sf_dir, 'conversations')))}"
    if not recache and read_if_present(spark, f"{path}/merges") is not None:
        return B.BpeModel.load(spark, path)
    conversations = C.fold_conversations(table(spark, sf_dir, "conversations"), sep="\n")
    model = B.learn_bpe(C.tokenizer_corpus([table(spark, sf_dir, "documents"), conversations]), vocab_size)
    model.save(spark, path)
    return model


@register("bpe_vocab", ids="T3 A9 S11 U3")
def bpe_vocab(spark, sf_dir):
    """Always learns afresh (and refreshes the saved model the other BPE queries load)."""
    m = trained_model(spark, sf_dir, recache=True)
    return m.vocab_frame(spark).select("id", "token", "special")


@register("bpe_merges", ids="T3 A9")
def bpe_merges(spark, sf_dir):
    m = trained_model(spark, sf_dir)
    return m.merges_frame(spark)


@register("bpe_encode", ids="T4 T6 T7 T2 P2 P3")
def bpe_encode(spark, sf_dir):
    """Gate -> strip -> encode -> append the end id; ids and token count per document."""
    m = trained_model(spark, sf_dir)
    enc = B.encode_gated(table(spark, sf_dir, "documents").select("doc_id", "text"), m, "doc_id")
    return enc.select("doc_id", A.ids_to_string("ids").alias("input_ids"), "n_tokens")


@register("bpe_decode", ids="T5 T4 T6", sql="SELECT doc_id, text FROM documents")
def bpe_decode(spark, sf_dir):
    """decode(encode(text)) over the whole corpus the vocabulary was learned on: the identity."""
    m = trained_model(spark, sf_dir)
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return B.decode_documents(B.encode_documents(d, m, "doc_id"), m, "doc_id")


# ---------------------------------------------------------------- the tokenizer against SQL: a small vocabulary learned from `benchmark`

CHECK_SIZE, CHECK_BASE = 260, 4  # tokens in all, special ones
_CLASS = f"{_RE2_WS}\\p{{L}}\\p{{N}}"
# a mark before the last white space of a run that something visible follows gives RE2 the pieces in order without look-ahead
_MARK = "\uE000"
_RE2_ORDERED = f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_CLASS}{_MARK}]+|[{_RE2_WS}]+".replace("'", "''")


def _ordered(expr: str) -> str:
    marked = f"regexp_replace({expr}, '([{_RE2_WS}])([^{_RE2_WS}])', '{_MARK}\\1\\2', 'g')"
    return f"regexp_extract_all({marked}, '{_RE2_ORDERED}')"


# words as strings of ids: one byte is its place among the printable characters that stand for bytes
_D_LEARN = f"""WITH RECURSIVE piece AS (SELECT p, count(*) AS n FROM (SELECT unnest({_ordered('text')}) AS p FROM benchmark) GROUP BY p),
byte AS (SELECT DISTINCT unnest(regexp_extract_all(hex(encode(p)), '..')) AS h FROM piece),
num AS (SELECT h, CAST('0x' || h AS INT) AS b FROM byte),
-- printable Latin-1 bytes stand for themselves, the others follow in byte order
ids AS (SELECT h, {CHECK_BASE} + row_number() OVER (ORDER BY CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174 THEN b ELSE 256 + b END) - 1 AS id FROM num),
chars AS (SELECT max(id) + 1 AS a FROM ids),
m AS (SELECT map_from_entries(list(struct_pack(k := h, v := '<' || id || '>'))) AS of FROM ids),
w0 AS (SELECT p, n, array_to_string(list_transform(regexp_extract_all(hex(encode(p)), '..'), lambda h: of[h]), '') AS w FROM piece, m),
step AS (
  SELECT 0 AS k, p, n, w, 0 AS l, 0 AS r FROM w0
  UNION ALL
  SELECT s.k + 1, s.p, s.n, replace(s.w, '<' || t.l || '><' || t.r || '>', '<' || (chars.a + s.k) || '>'), t.l, t.r
  FROM step s, chars, (
    SELECT x[i] AS l, x[i + 1] AS r FROM (SELECT x, n, unnest(range(1, len(x))) AS i FROM (SELECT list_transform(regexp_extract_all(w, '<(\\d+)>', 1), lambda z: CAST(z AS INT)) AS x, n FROM step))
    GROUP BY 1, 2 ORDER BY sum(n) DESC, 1, 2 LIMIT 1) t
  WHERE s.k < {CHECK_SIZE} - chars.a)"""


def check_model(spark, sf_dir) -> B.BpeModel:
    """Learned from `benchmark`, written as the one JSON file that libraries load, and read back."""
    model = B.learn_bpe(table(spark, sf_dir, "benchmark"), CHECK_SIZE)
    path = f"{scratch_path(spark, 'bpe-file')}/tokenizer.json"
    model.save_file(path)
    return B.BpeModel.load_file(path)


@register(
    "bpe_check_merges",
    ids="T3 A9 S11",
    sql=_D_LEARN + """
SELECT DISTINCT CAST(k - 1 AS INT) AS rank, l AS "left", r AS "right", CAST(a + k - 1 AS INT) AS "out" FROM step, chars WHERE k > 0""",
)
def bpe_check_merges(spark, sf_dir):
    return check_model(spark, sf_dir).merges_frame(spark)


@register(
    "bpe_check_encode",
    ids="T2 T4 T6 T7 S11",
    sql=_D_LEARN + f""",
last AS (SELECT p, replace(replace(w, '><', ','), '<', '') AS w FROM step WHERE k = (SELECT max(k) FROM step)),
doc AS (SELECT item_id, {_ordered(d_strip('text'))} AS pieces FROM benchmark WHERE length(text) BETWEEN 10 AND 20000),
flat AS (SELECT item_id, unnest(pieces) AS p, generate_subscripts(pieces, 1) AS i FROM doc),
one AS (SELECT item_id, string_agg(rtrim(w, '>'), ',' ORDER BY i) || ',1' AS input_ids FROM flat JOIN last USING (p) GROUP BY item_id)
SELECT item_id, input_ids, CAST(len(string_split(input_ids, ',')) AS BIGINT) AS n_tokens FROM one""",
)
def bpe_check_encode(spark, sf_dir):
    enc = B.encode_gated(table(spark, sf_dir, "benchmark").select("item_id", "text"), check_model(spark, sf_dir), "item_id")
    return enc.select("item_id", A.ids_to_string("ids").alias("input_ids"), "n_tokens")


@register(
    "bpe_pair_histogram",
    ids="A9 U3",
    sql=f"""WITH corpus AS (SELECT text FROM documents UNION ALL SELECT string_agg(text, chr(10) ORDER BY turn) FROM conversations GROUP BY conv_id),
piece AS (SELECT p, count(*) AS n FROM (SELECT unnest({_ordered('text')}) AS p FROM corpus) GROUP BY p),
x AS (SELECT list_transform(regexp_extract_all(hex(encode(p)), '..'), lambda h: CAST('0x' || h AS INT)) AS x, n FROM piece)
SELECT x[i] AS "left", x[i + 1] AS "right", CAST(sum(n) AS BIGINT) AS n FROM (SELECT x, n, unnest(range(1, len(x))) AS i FROM x) GROUP BY ALL""",
)
def bpe_pair_histogram(spark, sf_dir):
    """Adjacent byte pairs inside pre-tokens over the whole corpus a vocabulary is learned from."""
    conversations = C.fold_conversations(table(spark, sf_dir, "conversations"), sep="\n")
    return B.pair_histogram(C.tokenizer_corpus([table(spark, sf_dir, "documents"), conversations]))
