"""Array-valued column functions for token sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EOD_ID


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate_ids(ids, max_len: int | None, end_id: int = EOD_ID) -> Column:
    """F5/F6 ids: if ``size > max_len`` keep the first ``max_len - 1`` ids and append ``end_id``.

    ``max_len=None`` means no cap.
    """
    a = _col(ids)
    if max_len is None:
        return a
    return F.when(
        F.size(a) > max_len,
        F.concat(F.slice(a, 1, max_len - 1), F.array(F.lit(end_id).cast("bigint"))),
    ).otherwise(a)


def truncated_mask(ids, max_len: int | None, mask_tail: int) -> Column:
    """F5 (``mask_tail=0``, map-style) / F6 (``mask_tail=1``, iterable) attention mask.

    All ones, except the last position becomes ``mask_tail`` when the sequence
    was truncated. Computed from the *untruncated* ids.
    """
    a = _col(ids)
    ones = ones_like(a)
    if max_len is None:
        return ones
    return F.when(
        F.size(a) > max_len,
        F.concat(
            F.array_repeat(F.lit(1).cast("bigint"), max_len - 1),
            F.array(F.lit(mask_tail).cast("bigint")),
        ),
    ).otherwise(ones)


def ones_like(ids) -> Column:
    """F7 attention mask: all ones."""
    return F.transform(_col(ids), lambda x: F.lit(1).cast("bigint"))


def zeros_like(ids) -> Column:
    """F7 token type ids: all zeros."""
    return F.transform(_col(ids), lambda x: F.lit(0).cast("bigint"))


def position_ids(ids) -> Column:
    """F8: 0 .. n-1 (safe on empty arrays)."""
    return F.transform(_col(ids), lambda x, i: i.cast("bigint"))


def as_long_array(c) -> Column:
    """Cast to the caller's integer dtype (always 64-bit here)."""
    return _col(c).cast("array<bigint>")


def pad_to(ids, width, pad_value: int) -> Column:
    """Q5: right-pad ``ids`` to ``width`` with ``pad_value``."""
    a = _col(ids)
    w = _col(width) if not isinstance(width, int) else F.lit(width)
    return F.concat(
        a, F.array_repeat(F.lit(pad_value).cast("bigint"), F.greatest(w - F.size(a), F.lit(0)))
    )


def context_tail(ids, n_ctx: int) -> Column:
    """The last ``n_ctx - 1`` ids."""
    a = _col(ids)
    keep = n_ctx - 1
    return F.slice(a, F.greatest(F.size(a) - keep, F.lit(0)) + 1, F.lit(keep))


def drop_prefix(ids, context_len: int) -> Column:
    """The ids after the first ``context_len``."""
    a = _col(ids)
    return F.slice(a, F.lit(context_len + 1), F.greatest(F.size(a) - context_len, F.lit(0)))


def ids_to_string(ids, sep: str = ",") -> Column:
    """Render an id array as a string (for value hashing across engines)."""
    return F.array_join(_col(ids).cast("array<string>"), sep)


def arrays_equal_length(*cols) -> Column:
    """A10: all arrays of a sample have the same length."""
    sizes = [F.size(_col(c)) for c in cols]
    cond = F.lit(True)
    for s in sizes[1:]:
        cond = cond & (s == sizes[0])
    return cond
