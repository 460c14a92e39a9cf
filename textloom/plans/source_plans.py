"""Source round trips: driver tables are written in each input format to the
shared checkpoint folder, then read back through the scan under test (S1-S9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import END_OF_TEXT_TOKEN as E
from ..functions import text as T
from ..operators import corpus as C
from ..session import checkpoint_dir, remove_table, scratch_path
from ..sources import incremental as INC
from ..sources import index as IX
from ..sources import readers as R
from .registry import register
from .tables import table


@register(
    "jsonl_scan",
    ids="S1 P1 F11 S6",
    sql="""SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n_chars,
  CAST(row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1 AS BIGINT) AS line_no FROM documents""",
)
def jsonl_scan(spark, sf_dir):
    """Four sets of known order, each in as many part files as its size asks for, so the line numbers are known too."""
    d = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "jsonl-docs")
    of = F.coalesce(F.pmod(F.col("doc_id"), F.lit(4)).cast("int"), F.lit(0))
    rows = d.select("doc_id", "text", F.struct(F.col("source").alias("pile_set_name"), F.col("lang").alias("other")).alias("meta"), of.alias("of"))
    R.write_ordered_jsonl(rows, path, ["doc_id"], "text", set_col="of")
    got = R.read_jsonl(spark, f"{path}/*/*.json", "text", extra="doc_id bigint", over_folders=True)
    return got.select("doc_id", "text", T.char_length("text").alias("n_chars"), "line_no")


@register(
    "jsonl_mixed_scan",
    ids="S1 P1",
    sql="SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text ELSE replace(text, chr(10), '') END AS text FROM documents",
)
def jsonl_mixed_scan(spark, sf_dir):
    """One field holds a string in some lines and a list of strings in others; lists are joined."""
    d = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "jsonl-mixed")
    as_text = F.to_json(F.struct("doc_id", "text"))
    as_list = F.to_json(F.struct("doc_id", C.split_lines("text").alias("text")))
    R.write_text(d.select(F.when(F.col("doc_id") % 2 == 0, as_text).otherwise(as_list).alias("text")), path)
    return R.read_jsonl(spark, path, "text", numbered=False, extra="doc_id bigint").select("doc_id", "text")


@register("json_text_column", ids="S7 P9", sql="SELECT text FROM documents")
def json_text_column(spark, sf_dir):
    """A JSON table whose first column, by the order in the file, isn't the first by name."""
    path = scratch_path(spark, "json-table")
    R.write_jsonl(table(spark, sf_dir, "documents").select(F.col("text").alias("zeta"), F.col("lang").alias("alpha"), "doc_id"), path)
    return R.read_text_table(spark, path, "json")


@register("jsonl_list_scan", ids="S2 P4", sql="SELECT doc_id, text FROM documents")
def jsonl_list_scan(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "jsonl-cont")
    R.write_jsonl(d.select("doc_id", C.split_lines("text").alias("cont")), path)
    got = R.read_jsonl(spark, path, "cont", "array<string>", numbered=False, extra="doc_id bigint")
    return got.select("doc_id", F.array_join("cont", "\n").alias("text"))


def _conv_files(spark, sf_dir, wrapped: bool):
    conv = C.fold_conversations(table(spark, sf_dir, "conversations"), sep=E)
    path = scratch_path(spark, "conv-wrapped" if wrapped else "conv-lists")
    files = conv.withColumn("file_no", F.floor(F.col("conv_id") / 25))
    R.write_wholefile_json(files, path, "file_no", "conv_id", "turns", wrapped=wrapped)
    return R.read_wholefile_json(spark, path, wrapped=wrapped)


@register(
    "wholefile_json_scan",
    ids="S4 F1",
    sql=f"SELECT string_agg(text, '{E}' ORDER BY turn) AS text, CAST(count(*) AS BIGINT) AS n_turns FROM conversations GROUP BY conv_id",
)
def wholefile_json_scan(spark, sf_dir):
    got = _conv_files(spark, sf_dir, wrapped=False)
    return got.select(F.array_join("turns", E).alias("text"), F.size("turns").cast("bigint").alias("n_turns"))


@register(
    "wrapped_json_scan",
    ids="S5 F1",
    sql="SELECT string_agg(text, chr(10) ORDER BY turn) AS text, CAST(count(*) AS BIGINT) AS n_turns FROM conversations GROUP BY conv_id",
)
def wrapped_json_scan(spark, sf_dir):
    got = _conv_files(spark, sf_dir, wrapped=True)
    return got.select(F.array_join("turns", "\n").alias("text"), F.size("turns").cast("bigint").alias("n_turns"))


@register("text_column_scan", ids="S7 P9", sql="SELECT text FROM documents")
def text_column_scan(spark, sf_dir):
    """CSV without a ``text`` column: the first column is taken, the others dropped."""
    d = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "csv-docs")
    d.select(F.col("text").alias("body"), "doc_id", "lang").write.mode("overwrite").options(
        header="true", escape='"'
    ).csv(path)
    return R.read_text_table(spark, path, "csv", multi_line=True)


@register(
    "text_lines_scan",
    ids="S7 S12",
    sql="SELECT unnest(string_split(text, chr(10))) || chr(10) AS text FROM documents",
)
def text_lines_scan(spark, sf_dir):
    """TXT with ``keep_linebreaks``: every line of every document, with its line break."""
    d = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "txt-docs")
    R.write_text(d, path)
    return R.read_text_table(spark, path, "txt", keep_linebreaks=True)


@register(
    "cached_index",
    ids="S9 S8",
    sql="SELECT doc_id AS idx, CAST(length(text) AS BIGINT) AS n_chars FROM documents",
)
def cached_index(spark, sf_dir):
    path = f"{checkpoint_dir(spark)}/length-index-{IX.content_key(table(spark, sf_dir, 'documents'))}"

    def build():
        docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), F.array("text").alias("segs"))
        return IX.length_index(docs, "segs")

    IX.cached(spark, path, build)  # first call builds and writes
    return IX.cached(spark, path, build)  # second call reads the cached table


@register("compressed_jsonl_scan", ids="S10 S1 P8", sql="SELECT doc_id, [text] AS segs, true AS refused FROM documents")
def compressed_jsonl_scan(spark, sf_dir):
    """Compressed lines are read as they are unless the caller wants them refused, as the original does; each text is its own only segment."""
    path = scratch_path(spark, "jsonl-gz")
    table(spark, sf_dir, "documents").select("doc_id", "text").write.option("compression", "gzip").json(path)
    try:
        R.check_compressed(spark, path, True)
        refused = False
    except NotImplementedError:
        refused = True
    got = R.read_jsonl(spark, path, "text", numbered=False, extra="doc_id bigint")
    return got.select("doc_id", T.identity_split("text").alias("segs"), F.lit(refused).alias("refused"))


@register(
    "encoder_hook",
    ids="X1 X2",
    sql="""SELECT doc_id, text AS raw, CASE WHEN length(text) = 0 THEN 0 ELSE list_sum(list_transform(string_split(text, ''), lambda c: unicode(c))) END AS total FROM documents""",
)
def encoder_hook(spark, sf_dir):
    """The caller's encoder as a column function, and none at all (the raw-text path), for a field of the caller's choice."""
    from ..operators import hooks as H

    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("cont"))
    both = H.with_encoder(H.with_encoder(d, "cont", None, "raw"), "cont", T.codepoints, "ids")
    return both.select("doc_id", "raw", F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@register("incremental_index", ids="S8 S9", sql="SELECT doc_id AS idx, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE doc_id % 4 <> 1")
def incremental_index(spark, sf_dir):
    """An index over files that come and go: three of four sets are indexed, one goes and the last one comes, and only its files are read."""
    src = scratch_path(spark, "index-src")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")

    def build(session, files):
        lines = R.read_jsonl(session, files, "text", numbered=False, extra="doc_id bigint")
        return lines.select("file", F.col("doc_id").alias("idx"), T.char_length("text").alias("n_chars"))

    index = INC.IncrementalIndex(spark, scratch_path(spark, "index"), build)
    for k in range(3):
        R.write_jsonl(d.filter(F.col("doc_id") % 4 == k), f"{src}/{k}")
    index.update(f"{src}/*/*.json")
    R.write_jsonl(d.filter(F.col("doc_id") % 4 == 3), f"{src}/3")
    remove_table(f"{src}/1")
    index.update(f"{src}/*/*.json")
    return index.read().select("idx", "n_chars")
