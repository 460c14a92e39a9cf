"""Helpers shared by the operators of this package: Arrow buffers, word spans, span hashes, ordered buckets, files."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import file_store


def utf8_column(arr) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string array; nulls count as empty texts."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    arr = arr.cast(pa.large_string())
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def byte_slices(offsets: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch holding about ``step`` bytes each (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + step, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def small_batches(batches: Iterator[pa.RecordBatch], text: str, step: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``step`` bytes of text, so that numpy work arrays stay small; at the end of the rows freed memory goes back."""
    for b in batches:
        if b.num_rows == 0:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(b.column(text)), 0), dtype=np.int64)
        for i, j in byte_slices(np.concatenate([[0], np.cumsum(lengths)]), step):
            yield b.slice(i, j - i)
    give_back()


_KEPT: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """What an operator keeps in this worker from task to task; what others kept is dropped, as workers live on from operator to operator."""
    others = [k for k in _KEPT if k != operator]
    for k in others:
        del _KEPT[k]
    if others:
        give_back()
    return _KEPT.setdefault(operator, {})


def give_back() -> None:
    """Return what a task has freed to the system: workers live on from task to task, and several share an executor's memory."""
    _POW.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, row)`` of maximal runs of word bytes; runs never cross rows. ``is_word``: 256 flags."""
    w = is_word[data]
    if not len(w):
        z = np.zeros(0, np.int64)
        return z, z, z
    begin = w.copy()
    begin[1:] &= ~w[:-1]
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(w))]
    begin[cuts] = w[cuts]
    end = w.copy()
    end[:-1] &= ~w[1:]
    end[cuts - 1] = w[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads all 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fold_ascii() -> np.ndarray:
    """Byte map that lower-cases A-Z only."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


#: A Mersenne prime, and the number at which texts are read as polynomials modulo it.
_PRIME = (1 << 61) - 1
_POINT = 0x1B873593CC9E2D51 % _PRIME
_POW: dict[str, np.ndarray] = {}
_M30, _M31, _M61 = np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1), np.uint64(_PRIME)
_S30, _S31, _S61 = np.uint64(30), np.uint64(31), np.uint64(61)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _M61) + (x >> _S61)
    return np.where(x >= _M61, x - _M61, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, from products of halves."""
    a1, a0, b1, b0 = a >> _S31, a & _M31, b >> _S31, b & _M31
    mid = a1 * b0 + a0 * b1
    return _reduced(np.uint64(2) * a1 * b1 + (mid >> _S30) + ((mid & _M30) << _S31) + a0 * b0)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the point, split into their low 30 and high 31 bits, and of its inverse."""
    if len(_POW.get("inv", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("pow", _POINT), ("inv", pow(_POINT, -1, _PRIME))):
            t = np.ones(size, np.uint64)
            k = 1
            while k < size:  # double the filled part
                t[k : 2 * k] = _times(t[: min(k, size - k)], np.uint64(pow(base, k, _PRIME)))
                k *= 2
            _POW[name] = t
        _POW["low"], _POW["high"] = _POW["pow"] & _M30, _POW.pop("pow") >> _S30
    return _POW["low"], _POW["high"], _POW["inv"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """64-bit hashes of byte spans (sorted by start); equal folded bytes give equal hashes.

    A span is read as a polynomial with its bytes plus one as coefficients, modulo the prime 2**61 - 1 at a fixed point, from prefix
    sums over ``step`` bytes at a time, which stay in a core's cache. Two different spans of up to ``n`` bytes share a value at less than ``n`` of the 2**61 points there are; so a collision takes a pair that was made for
    the point, or a chance of ``n`` in 2**61. Values are spread over 64 bits by a bijection.
    """
    table = fold.astype(np.uint64) + np.uint64(1)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + step)))
        lo, hi = int(starts[i]), int(ends[j - 1])
        low, high, inverse = _powers(hi - lo + 1)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        total = np.zeros(j - i, np.uint64)
        for at in range(0, hi - lo, 1 << 22):  # sums of so many terms fit 64 bits
            to = min(hi - lo, at + (1 << 22))
            coefficients = table[data[lo + at : lo + to]]
            a, z = np.clip(s, at, to) - at, np.clip(e, at, to) - at
            sums = np.zeros(to - at + 1, np.uint64)
            np.cumsum(coefficients * high[at:to], out=sums[1:])
            top = _reduced(sums[z] - sums[a])
            np.cumsum(coefficients * low[at:to], out=sums[1:])
            # the high half counts 2**30 times
            total = _reduced(total + _reduced(((top & _M31) << _S30) + (top >> _S31)) + _reduced(sums[z] - sums[a]))
        out[i:j] = mix64(_times(total, inverse[s]))
        i = j
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i]`` of all rows, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def span_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """``(number, values)``: byte spans numbered by their exact bytes, equal spans alike, and the distinct values."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    joined = np.ascontiguousarray(data[ragged(starts, lengths)])
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)])
    coded = spans.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary


def digest64(values) -> np.ndarray:
    """64 bits of a cryptographic hash of every bytes value: no texts are known that collide by construction."""
    blake = hashlib.blake2b
    return np.frombuffer(b"".join([blake(v, digest_size=8).digest() for v in values]), "<u8").astype(np.uint64)


def with_order_bucket(df: DataFrame, key: str, buckets: int, name: str = "_bucket") -> DataFrame:
    """Adds the number of the ascending key range a row belongs to.

    The bounds are approximate quantiles of the key column alone (one narrow
    scan; at most ``buckets`` values reach the driver), so the wide rows are not
    read a second time to sample a range exchange. Null keys are in bucket 0.
    """
    steps = [i / buckets for i in range(1, buckets)]
    bounds = []
    if steps:
        row = df.agg(F.percentile_approx(key, steps, 10000).alias("b")).first()
        bounds = sorted(set(row["b"] or []))
    if not bounds:
        return df.withColumn(name, F.lit(0))
    wide = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    return df.withColumn(name, F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.size(F.filter(wide, lambda b: b < F.col(key)))))


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """A written table marked for broadcast if it has at most ``rows`` rows; a larger one is left to the optimizer, which shuffles both sides."""
    return F.broadcast(df) if df.count() <= rows else df


def whole_ids(docs: DataFrame, id_col: str) -> None:
    """Refuse an id column that isn't a whole number where ids are ordered or stored as numbers."""
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise ValueError(f"{id_col} is {kind.simpleString()}; whole numbers are needed")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def put_file(path: str, chunks) -> int:
    """Write byte chunks to a file of the shared store named by a URI or a path; returns its size."""
    store, name = file_store(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    size = 0
    with store.open_output_stream(name, compression=None) as out:
        for c in chunks:
            size += len(c)
            out.write(c)
    return size


def open_file(path: str):
    """A random-access file of the shared store."""
    store, name = file_store(path)
    return store.open_input_file(name)


SENT_IDS = 1 << 18


def id_bitmap(ids: DataFrame, id_col: str, bits: int) -> np.ndarray:
    """A fixed-size bitmap (2**bits bits) of hashed ids."""
    hashed = ids.select(F.pmod(F.xxhash64(id_col), F.lit(1 << bits)).alias("h"))
    found = hashed.groupBy(F.expr("int(h div 32)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, int(h % 32)))").alias("m")).toPandas()
    out = np.zeros((1 << bits) // 32, np.uint32)
    out[found["w"].to_numpy()] = found["m"].to_numpy().astype(np.uint32)
    return out


def split_by_ids(docs: DataFrame, id_col: str, ids: DataFrame, ids_col: str, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(outside, inside)``: rows whose id certainly isn't among ``ids``, and the others (with a few that aren't either).

    Only the second part needs a join, so the texts of the first are not shuffled. Up to ``SENT_IDS`` ids are sent to all executors; beyond that a
    bitmap of them is. It has about 16 bits an id, ``2**16`` at least
    and ``2**28`` (32 MB) at most unless ``bits`` says otherwise; beyond that more rows go into the second part, which its join sorts out.
    """
    if bits is None:
        n = ids.count()
        if n <= SENT_IDS:
            sent = F.broadcast(ids.select(F.col(ids_col).alias("_sent_id")).distinct())
            same = docs[id_col].eqNullSafe(F.col("_sent_id"))
            return docs.join(sent, same, "left_anti"), docs.join(sent, same, "left_semi")
        bits = min(28, max(16, (16 * n).bit_length()))
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids, ids_col, bits))
    hashed = docs.withColumn("_id_hash", F.pmod(F.xxhash64(id_col), F.lit(1 << bits)))
    names = docs.columns

    def part(wanted: bool) -> DataFrame:
        def run(batches):
            bit = bitmap.value
            for b in batches:
                at = np.asarray(b.column("_id_hash"))
                has = ((bit[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)
                yield b.select(names).filter(pa.array(has if wanted else ~has))

        return hashed.mapInArrow(run, docs.schema)

    return part(False), part(True)
