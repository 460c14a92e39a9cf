"""String predicates and transforms on text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    CJK_RANGES,
    END_OF_TEXT_TOKEN,
    MAX_DOC_CHARS,
    MIN_DOC_CHARS,
    STRIP_CHARS,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


CJK_CLASS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in CJK_RANGES) + "]"


def char_length(c) -> Column:
    """length in code points."""
    return F.length(_col(c)).cast("bigint")


def length_gate(c, lo: int = MIN_DOC_CHARS, hi: int = MAX_DOC_CHARS) -> Column:
    """Keep documents with ``lo <= length <= hi`` (measured before stripping)."""
    n = F.length(_col(c))
    return (n >= lo) & (n <= hi)


def strip(c) -> Column:
    """Python ``str.strip()`` - the 29 whitespace code points removed from both ends.

    ``trim(str, chars)`` compares whole code points and touches only the ends
    (a regex would scan the whole text).
    """
    return F.trim(_col(c), F.lit(STRIP_CHARS))


def keep_long_segments(segs, min_len: int = 2) -> Column:
    """Drop segments shorter than ``min_len`` characters."""
    return F.filter(_col(segs), lambda s: F.length(s) >= min_len)


def contains_cjk_basic(c) -> Column:
    """P5: any character in U+4E00..U+9FFF."""
    return _col(c).rlike("[\\x{4E00}-\\x{9FFF}]")


def is_cjk_char(c) -> Column:
    """A single character inside one of the CJK ideograph ranges."""
    return _col(c).rlike("^" + CJK_CLASS + "\\z")


def count_cjk_chars(c) -> Column:
    """P6, document form: number of CJK ideographs in the text."""
    return F.size(F.regexp_extract_all(_col(c), F.lit(CJK_CLASS), 0)).cast("bigint")


def is_word(c) -> Column:
    """Every character in a..z; the empty string counts as a word."""
    return _col(c).rlike("^[a-z]*\\z")


def identity_split(c) -> Column:
    """The identity splitter - one text becomes a one-element list."""
    return F.array(_col(c))


def join_segments(segs, sep: str = "") -> Column:
    """``sep.join(segs)``. Null elements are skipped (see ``has_null_segment``)."""
    return F.array_join(_col(segs), sep)


def has_null_segment(segs) -> Column:
    """Strict-mode check for F1: a null segment is an error in the original."""
    return F.exists(_col(segs), lambda s: s.isNull())


def append_end_token(c, token: str = END_OF_TEXT_TOKEN) -> Column:
    """text followed by the end-of-text token."""
    return F.concat(_col(c), F.lit(token))


def fold_ordered(parts, order_field: str, value_field: str, sep: str) -> Column:
    """F1 over a row-per-part table: ``collect_list(struct(order, value))`` sorted, joined."""
    return F.array_join(
        F.transform(F.sort_array(_col(parts)), lambda z: z[value_field]), sep
    )


def clean_generated(text, prefix=None, *, keep_if_absent: bool = False) -> Column:
    """prefix + text, drop U+0020, cut before the last full-width comma.

    With no full-width comma the last character is dropped (a ``[:-1]`` slice), or the text is kept
    whole with ``keep_if_absent``.
    """
    t = _col(text) if prefix is None else F.concat(_col(prefix), _col(text))
    r = F.replace(t, F.lit(" "), F.lit(""))
    comma = "\uff0c"
    return F.when(
        F.instr(r, comma) > 0, F.regexp_extract(r, "(?s)^(.*)" + comma, 1)
    ).otherwise(r if keep_if_absent else F.regexp_replace(r, "(?s).\\z", ""))


def codepoints(c) -> Column:
    """Code points of a string as ``array<bigint>`` (empty string -> empty array).

    Used as a tokenizer-free id encoding so order/shape operators can be
    checked against an SQL oracle. The input appears twice (empty guard and
    split): pass a column or a cheap expression.
    """
    t = _col(c)
    return F.when(t == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(t, ""), lambda ch: F.ascii(ch).cast("bigint"))
    )
