"""SQL fragments for the DuckDB oracles (same fixed values as the Spark side)."""

from __future__ import annotations

from ..constants import CJK_RANGES, STRIP_CHARS

_RE2_STRIP_CLASS = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in STRIP_CHARS) + "]"
RE2_CJK_CLASS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in CJK_RANGES) + "]"


def strip(expr: str) -> str:
    pat = f"^{_RE2_STRIP_CLASS}+|{_RE2_STRIP_CLASS}+$"
    return f"regexp_replace({expr}, '{pat}', '', 'g')"


def codepoints(expr: str) -> str:
    return (
        f"(CASE WHEN length({expr}) = 0 THEN CAST([] AS BIGINT[]) ELSE "
        f"list_transform(string_split({expr}, ''), lambda c: CAST(unicode(c) AS BIGINT)) END)"
    )


def ids_str(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: CAST(x AS VARCHAR)), ',')"
