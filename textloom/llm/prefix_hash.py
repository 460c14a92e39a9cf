"""Document fingerprints from prefix polynomial hashes (dealt operator 7).

The prefix array of a text holds the polynomial hash of each of its prefixes (code points, modulo two
primes). The hash of any span is a difference of two entries, so two spans are compared in
constant time, and the longest common extension of two positions is found by binary search
(``PrefixHashes``). A fingerprint keeps the array at up to 31 evenly spaced prefixes, the hashes of as many
suffixes on the same power-of-two grid, the length and the whole text's hash. The likeness of two
fingerprints is the share of the longer text that their longest common prefix and suffix cover, both found by
binary search on the coarser of the two grids; equal fingerprints are alike by 1.

The query pairs each document with the next one in descending id. Rows go through one shuffle into
ranges of the id (bounds from a narrow scan); the largest id of a range is also sent to the range that needs it
as neighbour, one row a range, so the pairing is a sorted pass without a global window.

Defined results: null text counts as empty; two empty texts are alike by 1; rows with one id are ordered
by their texts; null ids come last; a document that is alone is its own next. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, small_batches, with_order_bucket

#: Two primes below 2**31 and the bases of the polynomials.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
GRID = 32
_POWERS: dict[int, np.ndarray] = {}


def _powers(k: int, n: int) -> np.ndarray:
    """``BASES[k] ** i`` for ``i < n``."""
    have = _POWERS.get(k)
    if have is None or len(have) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        out, m = np.ones(size, np.int64), 1
        while m < size:
            out[m : 2 * m] = out[:m] * pow(BASES[k], m, PRIMES[k]) % PRIMES[k]
            m *= 2
        _POWERS[k] = have = out
    return have


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class PrefixHashes:
    """Prefix arrays of a text: equality of any spans, longest common extensions."""

    def __init__(self, text: str | np.ndarray):
        codes = code_points(text) if isinstance(text, str) else text
        self.n = len(codes)
        self.sums = []
        for k in (0, 1):
            s = np.zeros(self.n + 1, np.int64)
            np.cumsum((codes + 1) * _powers(k, self.n + 1)[: self.n] % PRIMES[k], out=s[1:])
            self.sums.append(s % PRIMES[k])

    def spans_equal(self, i: int, other: PrefixHashes, j: int, size: int) -> bool:
        """Whether the spans of ``size`` from ``i`` here and from ``j`` there are equal."""
        if i + size > self.n or j + size > other.n:
            return False
        for k, p in enumerate(PRIMES):
            a, b = int(self.sums[k][i + size] - self.sums[k][i]), int(other.sums[k][j + size] - other.sums[k][j])
            if a * pow(BASES[k], j, p) % p != b * pow(BASES[k], i, p) % p:
                return False
        return True

    def common_extension(self, i: int, other: PrefixHashes, j: int) -> int:
        """Length of the longest span that starts at ``i`` here and at ``j`` there."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.spans_equal(i, other, j, mid) else (low, mid - 1)
        return low

    def fingerprint(self) -> str:
        """``length.grid.whole.prefixes.suffixes``: grid is the spacing's exponent, hashes are hexadecimal."""
        k = max(0, (self.n // GRID).bit_length())
        at = np.arange(1, (self.n >> k) + 1) << k
        s, p = self.sums[0], PRIMES[0]
        heads = "".join(f"{x:08x}" for x in s[at].tolist())
        # spans that end the text, moved to exponent 0 by the inverse power
        tails = "".join(f"{(int(s[self.n]) - int(s[self.n - x])) * pow(BASES[0], -(self.n - x), p) % p:08x}" for x in at.tolist())
        return f"{self.n}.{k}.{int(s[self.n]):08x}{int(self.sums[1][self.n]):08x}.{heads}.{tails}"


def _common(a: str, ka: int, b: str, kb: int) -> int:
    """Length of the longest common prefix (or suffix) that the grid hashes show."""
    k = max(ka, kb)
    sa, sb = 1 << (k - ka), 1 << (k - kb)
    low, high = 0, min(len(a) // 8 // sa, len(b) // 8 // sb)
    while low < high:
        mid = (low + high + 1) // 2
        x, y = 8 * (mid * sa - 1), 8 * (mid * sb - 1)
        low, high = (mid, high) if a[x : x + 8] == b[y : y + 8] else (low, mid - 1)
    return low << k


def likeness(a: str, b: str) -> float:
    """Share of the longer text covered by the common prefix and suffix of two fingerprints."""
    if a == b:
        return 1.0
    (na, ka, _, ha, ta), (nb, kb, _, hb, tb) = a.split("."), b.split(".")
    both = _common(ha, int(ka), hb, int(kb)) + _common(ta, int(ka), tb, int(kb))
    return min(both, int(na), int(nb)) / max(int(na), int(nb), 1)


def fingerprint(text: str) -> str:
    return PrefixHashes(text).fingerprint()


def _compare(doc: str, after: str, after_print: str | None) -> tuple[int, str, str, str, float, float]:
    half = len(doc) // 2
    edited = doc[: len(doc) - half] + after[:half]
    own, changed = fingerprint(doc), fingerprint(edited)
    return len(doc), hashlib.sha256(edited.encode()).hexdigest(), own, changed, likeness(own, changed), likeness(own, fingerprint(after) if after_print is None else after_print)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its text edited with the next one in descending id, and their likeness."""
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    least = -(1 << 63)
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = with_order_bucket(d, "doc_id", buckets).withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(least)))
    # ascending pass: the next document in descending order is the row before; the first row of a range needs the last one of the range before
    tops = sorted((r["_bucket"], r["top"]) for r in d.groupBy("_bucket").agg(F.max("_key").alias("top")).collect())
    guests = spark.createDataFrame([(b, top, tops[(i + 1) % len(tops)][0]) for i, (b, top) in enumerate(tops)], "_bucket int, _key long, _to int")
    sent = d.join(F.broadcast(guests), ["_bucket", "_key"], "left")
    here = F.struct(F.col("_bucket").alias("bucket"), F.lit(1).alias("own"))
    there = F.struct(F.col("_to").alias("bucket"), F.lit(0).alias("own"))
    spread = sent.withColumn("_at", F.explode(F.when(F.col("_to").isNull(), F.array(here)).otherwise(F.array(here, there))))
    spread = spread.select(F.col("_at.bucket").alias("bucket"), F.col("_at.own").alias("own"), F.col("_key").alias("key"), "doc_id", "text")
    ordered = spread.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "own", "key", "text")

    def run(batches):
        before, known, bucket = "", None, None
        for b in small_batches(batches, "text"):
            ids, rows = [], []
            for k, own, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "own", "doc_id", "text"))):
                if own:
                    rows.append(_compare(text, before, known if k == bucket else None))
                    ids.append(doc_id)
                    known = rows[-1][2]
                else:
                    known = None
                before, bucket = text, k
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.schema.field("doc_id").type), *(pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, kinds))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return ordered.mapInArrow(run, f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
