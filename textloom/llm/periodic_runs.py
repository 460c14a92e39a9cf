"""Periodic runs of words (dealt operator 11): block convolution at dyadic scales, exact NTT, seeds extended to runs.

A run is a maximal stretch of words with smallest period ``q`` and length ``max(LEAST, TIMES * q)`` or more.

* Scales. At scale ``B = 2, 4, 8, ...`` a text is cut into blocks of ``B`` words; the scale is responsible for the
  periods with ``2B - 1 <= 3q < 4B - 1``. The words of a run but its last ``q`` are at least ``3q``, so they hold a whole block,
  which comes again ``q`` words later in the run.
* Convolution. A block ``P`` occurs at distance ``d`` of its window ``T`` where ``sum (P[j] - T[d + j])**2`` is zero. The sums of squares are
  running sums, the products are a cyclic convolution by number-theoretic transforms over as many primes as the largest
  possible sum needs, so the test for zero is exact. Blocks of a scale are transformed together.
* Passed over without a transform are blocks with a word that doesn't come again within the scale's largest distance, and blocks that lie with
  their window inside a run of a smaller scale: a block longer than that run's period matches there only at its multiples.
* Extension. A zero at distance ``d`` seeds the stretch on which words ``d`` apart are equal. Stretches that are long
  enough are runs, unless a run of smaller period holds them (then ``d`` is not the smallest period).

One scan, no shuffle; the work arrays are those of a few megabytes of text (or of one longer text).
Words are compared by their exact bytes.

Defined results: null text counts as empty and has no words and no runs; repeated rows are treated each;
ties are ordered by start, then period; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged, small_batches, span_ids, utf8_column, word_spans

LEAST = 6
TIMES = 4
CHUNK = 1 << 18  # numbers transformed at a time
#: Primes ``c * 2**k + 1`` below 2**31 with a primitive root.
PRIMES = [(2013265921, 31), (1811939329, 13), (2113929217, 5)]

_IS_WORD = np.ones(256, bool)
_IS_WORD[9:14] = _IS_WORD[32] = False
_TWIDDLES: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _twiddles(prime: int, root: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``size // 2`` powers of a root of unity of this order, and of its inverse."""
    got = _TWIDDLES.get((prime, size))
    if got is None:
        base = pow(root, (prime - 1) // size, prime)
        pair = []
        for b in (base, pow(base, -1, prime)):
            t, k = np.ones(max(1, size // 2), np.uint64), 1
            while k < len(t):
                t[k : 2 * k] = t[: min(k, len(t) - k)] * np.uint64(pow(b, k, prime)) % np.uint64(prime)
                k *= 2
            pair.append(t)
        got = tuple(pair)
        if size <= 1 << 14:
            _TWIDDLES[prime, size] = got
    return got


def forward(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Transforms of the rows, in bit-reversed order."""
    rows, n = x.shape
    p, size = np.uint64(prime), n
    while size > 1:
        w = _twiddles(prime, root, size)[0]
        v = x.reshape(rows, n // size, 2, size // 2)
        a, b = v[:, :, 0, :], v[:, :, 1, :]
        out = np.empty_like(v)
        np.remainder(a + b, p, out=out[:, :, 0, :])
        np.remainder((a + (p - b)) * w, p, out=out[:, :, 1, :]) if size > 2 else np.remainder(a + (p - b), p, out=out[:, :, 1, :])
        x, size = out.reshape(rows, n), size // 2
    return x


def backward(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The rows whose transforms, in bit-reversed order, these are."""
    rows, n = x.shape
    p, size = np.uint64(prime), 2
    while size <= n:
        w = _twiddles(prime, root, size)[1]
        v = x.reshape(rows, n // size, 2, size // 2)
        a = v[:, :, 0, :]
        b = v[:, :, 1, :] * w % p if size > 2 else v[:, :, 1, :]
        out = np.empty_like(v)
        np.remainder(a + b, p, out=out[:, :, 0, :])
        np.remainder(a + (p - b), p, out=out[:, :, 1, :])
        x, size = out.reshape(rows, n), size * 2
    return x * np.uint64(pow(n, -1, prime)) % p


def zero_mismatch(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Flags ``[k, t]``: whether ``blocks[k]`` equals ``windows[k, t : t + B]``; numbers are non-negative.

    ``sum (P - T)**2`` is compared with zero modulo primes whose product is beyond the largest sum there can be.
    """
    rows, size = blocks.shape
    places = windows.shape[1] - size + 1
    n = 1 << max(1, (windows.shape[1] - 1).bit_length())
    most = size * max(int(blocks.max()), int(windows.max()), 1) ** 2
    out, product = np.ones((rows, places), bool), 1
    for prime, root in PRIMES:
        p = np.uint64(prime)
        b, t = blocks.astype(np.uint64) % p, windows.astype(np.uint64) % p
        reverse, whole = np.zeros((rows, n), np.uint64), np.zeros((rows, n), np.uint64)
        reverse[:, 0] = b[:, 0]
        reverse[:, n - size + 1 :] = b[:, :0:-1]
        whole[:, : t.shape[1]] = t
        mixed = backward(forward(reverse, prime, root) * forward(whole, prime, root) % p, prime, root)[:, :places]
        squares = np.zeros((rows, t.shape[1] + 1), np.uint64)
        np.cumsum(t * t % p, axis=1, out=squares[:, 1:])
        sums = (squares[:, size:] - squares[:, :places] + (b * b % p).sum(axis=1, dtype=np.uint64)[:, None]) % p
        out &= sums == (mixed + mixed) % p
        product *= prime
        if product > most:
            break
    return out  # sums beyond all three primes: what is no zero fails the extension


def _agree(c: np.ndarray, i: int, d: int, step: int) -> int:
    """How many words on from ``i`` (back before ``i`` for step -1) equal those ``d`` later."""
    total, size = 0, 64
    while True:
        if step > 0:
            y = c[i + total + d : i + total + d + size]
            x = c[i + total : i + total + len(y)]
        else:
            low = max(0, i - total - size)
            x, y = c[low : i - total][::-1], c[low + d : i - total + d][::-1]
        if not len(x):
            return total
        bad = x != y
        at = int(bad.argmax())
        if bad[at]:
            return total + at
        total += len(x)
        size *= 2


def find_runs(row: np.ndarray, ids: np.ndarray) -> list[tuple[int, int, int]]:
    """``(begin, end, period)`` of all runs in the words ``ids`` of the texts ``row`` (ascending), by begin, then period."""
    n = len(ids)
    if n < LEAST:
        return []
    # a number for every word of a text: texts share none
    key = row.astype(np.int64) << 32 | ids
    order = np.argsort(key, kind="stable")
    ascending = key[order]
    new = np.append(True, ascending[1:] != ascending[:-1])
    code = np.empty(n, np.int64)
    code[order] = np.cumsum(new) - 1
    next_at = np.full(n, n, np.int64)
    next_at[order[:-1][~new[1:]]] = (order[1:] - order[:-1])[~new[1:]]
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    bounds = np.append(first, n)
    text = np.repeat(np.arange(len(first)), np.diff(bounds))
    small = code[order][np.searchsorted(ascending, row[first].astype(np.int64) << 32)]
    value = code - small[text]  # numbered from 0 in each text
    longest = int(np.diff(bounds).max())

    found: list[tuple[int, int, int]] = []
    noted = 0
    reach = np.zeros(n, np.int64)  # the furthest end of a known run that begins here or before
    size, most = 2, np.maximum(next_at[0 : n - n % 2 : 2], next_at[1 : n - n % 2 : 2])
    while TIMES * -(-(2 * size - 1) // 3) <= longest:
        low, high = -(-(2 * size - 1) // 3), -(-(4 * size - 1) // 3) - 1
        begin = np.flatnonzero(most <= high) * size
        begin = begin[(text[begin] == text[begin + size - 1]) & (reach[begin] < begin + size + high)]
        seeds = _seeds(value, begin, bounds[text[begin] + 1], size, low, high)
        if len(seeds):
            known = reach.copy()
            last = (0, 0, 0)
            for d, s in seeds.tolist():
                # inside a run of a smaller scale, or of the stretch extended just before
                if known[s] >= s + size + d or (last[0] == d and last[1] <= s and s + size + d <= last[2]):
                    continue
                a = s - _agree(code, s, d, -1)
                z = s + size + _agree(code, s + size, d, 1) + d
                if last[0] != d:
                    reach, noted = _with_runs(reach, found[noted:]), len(found)
                last = (d, a, z)
                if z - a >= max(LEAST, TIMES * d) and reach[a] < z:
                    found.append((a, z, d))
            reach, noted = _with_runs(reach, found[noted:]), len(found)
        even = len(most) - len(most) % 2
        most = np.maximum(most[0:even:2], most[1:even:2])
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def _with_runs(reach: np.ndarray, found: list[tuple[int, int, int]]) -> np.ndarray:
    """``reach`` with more runs."""
    if found:
        a, z, _ = np.array(found, np.int64).T
        reach = reach.copy()
        np.maximum.at(reach, a, z)
        reach = np.maximum.accumulate(reach)
    return reach


def _seeds(value: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int, low: int, high: int) -> np.ndarray:
    """``(distance, block)`` rows, ascending, of the blocks that come again at a distance of the scale inside their text."""
    reach = size + high - low
    step = max(1, CHUNK // (2 * size))
    out = []
    for i in range(0, len(begin), step):
        b, e = begin[i : i + step], end[i : i + step]
        blocks = value[b[:, None] + np.arange(size)]
        at = b[:, None] + low + np.arange(reach)
        # places beyond the text match nothing
        windows = np.where(at < e[:, None], value[np.minimum(at, len(value) - 1)], blocks.max() + 1)
        k, t = np.nonzero(zero_mismatch(blocks, windows))
        out.append(np.stack([t + low, b[k]], axis=1))
    seeds = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    return seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))]


def _joined(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """Each text's words joined by one blank."""
    ends = np.cumsum(lengths + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    out[ragged(ends - lengths - 1, lengths)] = data[ragged(starts, lengths)]
    cut = np.searchsorted(row, np.arange(rows + 1))
    edge = np.concatenate([[0], ends])[cut]
    if len(out):
        # the blank after a text's last word goes
        keep = np.ones(len(out), bool)
        keep[edge[1:][cut[1:] > cut[:-1]] - 1] = False
        out = out[keep]
    edge = edge - np.concatenate([[0], np.cumsum(cut[1:] > cut[:-1])])
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(out))


def planted_order(doc_id, n: int) -> np.ndarray | None:
    """The words that a text with this id takes where one text in ten is made periodic from some word on; None leaves it."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", word_order: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every row: the runs by start, then period, and the words without each run's repeats.

    ``word_order(doc_id, n)`` may give the word numbers that the text is to be read as.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for b in small_batches(batches, "text"):
            rows = b.num_rows
            data, off = utf8_column(b.column("text"))
            starts, ends, row = word_spans(data, off, _IS_WORD)
            ids, _ = span_ids(data, starts, ends)
            first = np.searchsorted(row, np.arange(rows + 1))
            if word_order is not None:
                take = np.arange(len(ids))
                for k, doc_id in enumerate(b.column("doc_id").to_pylist()):
                    order = word_order(doc_id, int(first[k + 1] - first[k]))
                    if order is not None:
                        take[first[k] : first[k + 1]] = first[k] + order
                ids, starts, ends = ids[take], starts[take], ends[take]
            found = find_runs(row, ids)
            s, e, q = np.array(found, np.int64).reshape(-1, 3).T
            change = np.zeros(len(ids) + 1, np.int64)
            np.add.at(change, s + q, 1)
            np.add.at(change, e, -1)
            keep = np.cumsum(change)[:-1] == 0
            text = row[s] if len(s) else np.zeros(0, np.int64)
            runs = pa.StructArray.from_arrays([pa.array(s - first[text]), pa.array(e - s), pa.array(q)], fields=list(parts))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(rows + 1)), pa.int32()), runs)
            collapsed = _joined(data, starts[keep], (ends - starts)[keep], row[keep], rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(first), pa.int64()), lists, collapsed.cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digest(collapsed: DataFrame) -> DataFrame:
    """One row a document: its number of runs, its longest run, and hashes of all runs and of the collapsed text."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    d = collapsed.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return d.selectExpr("doc_id", "n_runs", "-top.start AS start", "top.length AS length", "-top.period AS period", "1000 * top.length div -top.period AS exponent_milli", "runs_sha256", "collapsed_sha256")
