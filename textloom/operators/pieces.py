"""Encoding of pre-tokens inside tasks: one distinct piece at a time, merges by rank."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa

STORE_PIECES = 1 << 18


class PieceEncoder:
    """Applies learned merges to pieces; keeps the ids of pieces it has met (started anew when full)."""

    def __init__(self, byte_ids: dict[int, int], merges: list[tuple[int, int, int]], special_ids: dict[str, int]):
        self.byte_ids, self.special_ids = byte_ids, special_ids
        self.ranks = {(a, b): (r, o) for r, (a, b, o) in enumerate(merges)}
        self.store: dict[str, list[int]] = {}

    def encode(self, piece: str) -> list[int]:
        got = self.store.get(piece)
        if got is None:
            special = self.special_ids.get(piece)
            got = [special] if special is not None else self.merge([self.byte_ids[b] for b in piece.encode() if b in self.byte_ids])
            if len(self.store) >= STORE_PIECES:
                self.store = {}
            self.store[piece] = got
        return got

    def merge(self, syms: list[int]) -> list[int]:
        """Lowest rank first, leftmost first within a rank: a heap over a linked list, n log n for any length."""
        n, ranks = len(syms), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*ranks[p][:1], i, p) for i, p in enumerate(zip(syms, syms[1:])) if p in ranks]
        heapq.heapify(heap)
        syms = list(syms)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or (syms[i], syms[j]) != pair:
                continue  # one of the two was merged since
            syms[i], syms[j] = ranks[pair][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    p = (syms[a], syms[after[a]])
                    if p in ranks:
                        heapq.heappush(heap, (ranks[p][0], a, p))
        return [s for s in syms if s >= 0]


def encode_batch(batch: pa.RecordBatch, key: str, pieces: str, encoder: PieceEncoder) -> pa.RecordBatch:
    """``(key, ids)`` of a batch whose ``pieces`` column lists each row's pieces."""
    lists = batch.column(pieces)
    values = lists.flatten().dictionary_encode()
    ids = [encoder.encode(p) for p in values.dictionary.to_pylist()]
    sizes = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate([np.array(x, np.int64) for x in ids]) if ids else np.zeros(0, np.int64)
    at = np.asarray(values.indices, dtype=np.int64)
    first, n = (np.cumsum(sizes) - sizes)[at], sizes[at]
    ends = np.concatenate([[0], np.cumsum(n)])
    out = flat[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])] if len(at) else flat[:0]
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    rows = ends[offsets - offsets[0]]
    return pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(out, pa.int64()))], names=[key, "ids"])
