"""Scans (S1-S7, S10) and the text sink.

Line order is part of the data model (indices, strided shards), so line
readers return ``(file, line_no, ...)`` with ``line_no`` the 0-based line
position inside its file, computed without a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.position import scan_line_numbers
from ..session import materialize

COMPRESSED_SUFFIXES = (".gz", ".bz", ".bz2")
#: Bytes of text in a file of an ordered set; a task writes one.
FILE_BYTES = 64 << 20


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def check_compressed(spark: SparkSession, paths, reject_compressed: bool) -> None:
    """Spark reads gz/bz2 natively; ``reject_compressed=True`` restores the refusal, also for members of folders and globs."""
    if reject_compressed:
        bad = [p for p in spark.read.text(_paths(paths)).inputFiles() if p.endswith(COMPRESSED_SUFFIXES)]
        if bad:
            raise NotImplementedError(f"compressed input refused: {bad[:10]}")


def _scan(spark: SparkSession, paths) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(_paths(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata.file_size").alias("_size"), "value"
    )


def read_lines(spark: SparkSession, paths, *, over_folders: bool = False, reject_compressed: bool = False) -> DataFrame:
    """S6 + line numbers: ``(file, line_no, value)`` for every line of every file (globs allowed).

    Lines are numbered where they are read (one narrow count of rows per split comes
    first); no line is shuffled. With ``over_folders`` a folder's files, in the order of their names, are one file in several
    parts (as :func:`write_ordered_jsonl` writes them) and line numbers go on from part to part.
    """
    check_compressed(spark, paths, reject_compressed)
    scan = _scan(spark, paths)
    if not over_folders:
        return scan_line_numbers(scan, "file", "_start").select("file", "line_no", "value")
    folders = scan.withColumn("_folder", F.regexp_extract("file", "^(.*)/", 1))
    return scan_line_numbers(folders, "file", "_start", over_col="_folder").select("file", "line_no", "value")


def _strict(kind: str, field: str, want_list: bool) -> Column:
    """The field of a parsed variant object, failing like the original on anything but a string or a list of strings."""
    v, name = F.col(kind), field.replace("'", "''")
    t = F.schema_of_variant(v)
    wrong = F.raise_error(F.concat(F.lit(f"field {name}: unexpected "), F.coalesce(t, F.lit("absence"))))
    is_list = t.isin("ARRAY<STRING>", "ARRAY<VOID>")
    items = F.try_variant_get(v, "$", "array<string>")
    if want_list:
        return F.when(is_list, items).otherwise(wrong.cast("array<string>"))
    return F.when(t == "STRING", F.try_variant_get(v, "$", "string")).when(is_list, F.array_join(items, "")).otherwise(wrong.cast("string"))


def parse_jsonl(lines: DataFrame, field: str, field_type: str = "string", *, mode: str = "FAILFAST", extra: str = "") -> DataFrame:
    """Parse each line as a JSON object and keep ``field``.

    ``field_type`` is ``string`` (S1; a list of strings is joined without a separator) or ``array<string>``
    (S2, S3). With ``mode="FAILFAST"`` a malformed or blank line, an absent field and a value of
    another type fail the job like the original; with ``mode="PERMISSIVE"`` they become nulls. A duplicate key
    keeps the last value. ``extra`` adds more fields to the schema, e.g. ``"doc_id bigint"``.
    """
    if field_type not in ("string", "array<string>"):
        raise ValueError("field_type must be string or array<string>")
    want_list, strict = field_type != "string", mode.upper() == "FAILFAST"
    schema = f"`{field}` variant" + (f", {extra}" if extra else "")
    extras = [f.strip().split()[0] for f in extra.split(",") if f.strip()] if extra else []
    parsed = lines.withColumn("_j", F.from_json("value", schema, {"mode": mode})).withColumn("_v", F.col(f"_j.`{field}`"))
    if strict:
        value = F.when(F.trim("value") == "", F.raise_error(F.lit("blank line")).cast(field_type)).otherwise(_strict("_v", field, want_list))
    elif want_list:
        value = F.try_variant_get("_v", "$", "array<string>")
    else:
        t = F.schema_of_variant("_v")
        value = F.when(t == "STRING", F.try_variant_get("_v", "$", "string")).when(t.isin("ARRAY<STRING>", "ARRAY<VOID>"), F.array_join(F.try_variant_get("_v", "$", "array<string>"), ""))
    return parsed.select(
        *[c for c in lines.columns if c != "value"],
        value.alias(field),
        *[F.col(f"_j.`{e}`").alias(e) for e in extras],
    )


def read_jsonl(spark: SparkSession, paths, field: str, field_type: str = "string", *, numbered: bool = True, **kw) -> DataFrame:
    """JSONL scan keeping one field, with file and line number (``numbered=False`` leaves the number out)."""
    extra = kw.pop("extra", "")
    mode = kw.pop("mode", "FAILFAST")
    if numbered:
        lines = read_lines(spark, paths, **kw)
    else:
        check_compressed(spark, paths, kw.get("reject_compressed", False))
        lines = _scan(spark, paths).select("file", "value")
    return parse_jsonl(lines, field, field_type, mode=mode, extra=extra)


def scan_jsonl(spark: SparkSession, paths, field: str, field_type: str = "string", *, mode: str = "FAILFAST", extra: str = "", reject_compressed: bool = False) -> DataFrame:
    """S1-S3 for several sets at once: ``(file, block, field)`` with the start of each line's split, for :func:`textloom.operators.order.scanned_index`."""
    check_compressed(spark, paths, reject_compressed)
    return parse_jsonl(_scan(spark, paths).select("file", F.col("_start").alias("block"), "value"), field, field_type, mode=mode, extra=extra)


def read_wholefile_json(spark: SparkSession, paths, *, wrapped: bool = False, field: str = "texts", reject_compressed: bool = False) -> DataFrame:
    """Whole-file JSON of conversations -> ``(file, conv_no, turns array<string>)``.

    S4: the file is a list of lists of strings. S5 (``wrapped``): a list whose
    element 0 is a list of ``{field: [...]}`` objects; other elements are ignored.
    One file is one JSON value, so a file is parsed by one task (as the format requires).
    """
    check_compressed(spark, paths, reject_compressed)
    raw = spark.read.text(_paths(paths), wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )
    if wrapped:
        j = F.from_json("value", f"array<array<struct<`{field}`: array<string>>>>", {"mode": "FAILFAST"})
        items = F.transform(F.element_at(j, 1), lambda z: z[field])
    else:
        items = F.from_json("value", "array<array<string>>", {"mode": "FAILFAST"})
    return raw.select("file", F.posexplode(items).alias("conv_no", "turns"))


def _with_breaks(scan: DataFrame) -> DataFrame:
    """Lines with the line breaks they have in their files: a file's last line may have none.

    A narrow pass adds up the bytes of every split; a file one byte shorter than its lines with
    breaks lacks the last one. One row per such file is written, so its size is known when the join is planned.
    """
    numbered = scan.withColumn("_mid", F.monotonically_increasing_id())
    splits = numbered.groupBy("file", "_start").agg(F.sum(F.octet_length("value") + 1).alias("_bytes"), F.max("_mid").alias("_last"), F.max("_size").alias("_size"))
    open_files = splits.groupBy("file").agg(F.sum("_bytes").alias("_bytes"), F.max("_size").alias("_size"), F.max(F.struct("_start", "_last")).alias("_end"))
    ends = open_files.where(F.col("_bytes") == F.col("_size") + 1).select(F.col("file").alias("_file"), F.col("_end._start").alias("_s"), F.col("_end._last").alias("_l"))
    j = numbered.join(materialize(ends, "open-files"), (F.col("file") == F.col("_file")) & (F.col("_start") == F.col("_s")) & (F.col("_mid") == F.col("_l")), "left")
    return j.select(F.when(F.col("_file").isNull(), F.concat("value", F.lit("\n"))).otherwise(F.col("value")).alias("text"))


def read_text_table(spark: SparkSession, paths, extension: str, *, keep_linebreaks: bool = True, multi_line: bool = False, csv_options: dict | None = None) -> DataFrame:
    """S7 + P9: CSV / JSON / TXT table reduced to its text column, named ``text``.

    The text column is ``text`` if present, else the first column in the file's own order; the other
    columns are dropped. JSON tables are lines of objects; a narrow pass looks for the key ``text`` in any of
    them, and where none has it the first key of the first object is taken. Lines without the key give null. TXT keeps one row per line; with ``keep_linebreaks`` each line keeps
    its line break, as far as it has one. CSV files are split unless ``multi_line`` allows
    line breaks inside quoted values.
    """
    if extension not in ("csv", "json", "txt"):
        raise ValueError("extension must be csv, json or txt")
    p = _paths(paths)
    if extension == "txt":
        scan = _scan(spark, p)
        return _with_breaks(scan) if keep_linebreaks else scan.select(F.col("value").alias("text"))
    if extension == "csv":
        opts = {"header": "true", "multiLine": str(multi_line).lower(), "escape": '"'}
        opts.update(csv_options or {})
        df = spark.read.options(**opts).csv(p)
        col = "text" if "text" in df.columns else df.columns[0]
        return df.select(F.col(f"`{col}`").alias("text"))
    lines = spark.read.option("lineSep", "\n").text(p).where(F.trim("value") != "")
    keys = F.json_object_keys("value")
    named = lines.agg(F.bool_or(F.array_contains(keys, "text"))).first()[0]
    first = None if named else lines.select(keys.alias("k")).first()
    if not named and not (first and first["k"]):
        return lines.select(F.lit(None).cast("string").alias("text")).where(F.lit(False))
    col = "text" if named else first["k"][0]
    return lines.select(F.from_json("value", f"`{col}` string", {"mode": "FAILFAST"})[col].alias("text"))


def write_text(df: DataFrame, path: str, col: str = "text") -> None:
    """One line per row."""
    df.select(col).write.mode("overwrite").text(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines sink (one object per row)."""
    df.write.mode("overwrite").json(path)


def write_ordered_jsonl(df: DataFrame, path: str, order_cols: Sequence[str], text_col: str, *, set_col: str | None = None, least_files: int = 4) -> None:
    """JSON lines in the order of ``order_cols``, in part files of about ``FILE_BYTES`` of text (``least_files`` ranges of keys at least), however many that takes.

    The parts' names follow the order. ``set_col`` makes sets: each has a folder of its own with its rows in order, and the column is left out of the objects.
    """
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    keys = [set_col, *order_cols] if set_col else list(order_cols)
    ordered = df.repartitionByRange(max(least_files, size // FILE_BYTES + 1), *keys).sortWithinPartitions(*keys)
    out = ordered.write.mode("overwrite")
    (out.partitionBy(set_col) if set_col else out).json(path)


def write_wholefile_json(df: DataFrame, path: str, file_col: str, order_col: str, turns_col: str, *, wrapped: bool = False, field: str = "texts") -> None:
    """Write conversations as whole-file JSON (S4 shape, or S5 when ``wrapped``), one file per ``file_col`` value."""
    item = F.struct(F.col(turns_col).alias(field)) if wrapped else F.col(turns_col)
    g = df.groupBy(file_col).agg(F.sort_array(F.collect_list(F.struct(order_col, item.alias("_it")))).alias("_l"))
    arr = F.transform("_l", lambda z: z["_it"])
    body = F.to_json(F.array(arr)) if wrapped else F.to_json(arr)
    g.select(file_col, body.alias("value")).write.mode("overwrite").partitionBy(file_col).text(path)
