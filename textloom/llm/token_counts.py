"""Token counts (dealt operator 3): batch encoding in an Arrow function that returns lengths only.

The texts of an Arrow batch are split at safe boundaries, before a blank that follows a
character which isn't one; a ``sentencepiece`` model without such a blank inside a piece can't
merge across it, and the blank comes back as the prefix the library puts before every text. So
the count of a text is the sum over its parts, whatever its length, and parts that occur
again in a batch, or that a worker has met lately, are encoded once. Parts that are new go to the library in
batches of about ``BATCH_BYTES``, so a call never holds more than that (or one part).

What the model must guarantee is read from it: pieces without an inner blank, blanks kept, a prefix
added, no user-defined pieces that hold a blank. A model without these is run on whole texts.

The column function returns one long for each text: nothing else leaves the tasks and nothing is
shuffled. Defined results: null counts as empty; empty text has 0 tokens; repeated rows are counted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, kept, span_hashes, utf8_column

BATCH_BYTES = 1 << 20
SLICE_BYTES = 4 << 20
STORE_PARTS = 1 << 20
LIMIT = 4096
_BLANK = "▁"  # how sentencepiece writes a blank
_SAME = np.arange(256, dtype=np.uint8)


class PieceCounter:
    """Counts of one sentencepiece model; parts are known by a 64-bit hash and their length."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        inner = any(_BLANK in p.lstrip(_BLANK) for p in pieces)
        # a blank at the start, in the middle and at the end must all be kept, and a prefix added
        kept = [self.model.decode(self.model.encode(t)) for t in ("a  b ", " a")] == ["a  b ", " a"]
        prefix = self.model.encode("a") != self.model.encode(" a") and len(self.model.encode("a b")) == 2 * len(self.model.encode("a"))
        self.splits = kept and prefix and not inner
        self.known = np.zeros((0, 2), np.uint64)  # hash and count, by hash

    def lengths(self, texts: list[str]) -> np.ndarray:
        out, at = np.zeros(len(texts), np.int64), 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_BYTES):
                size += len(texts[end])
                end += 1
            out[at:end] = [len(x) for x in self.model.encode(texts[at:end], num_threads=1)]
            at = end
        return out

    def _part_counts(self, keys: np.ndarray, first: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Counts of distinct parts; ``first`` says where each stands."""
        at = np.searchsorted(self.known[:, 0], keys)
        here = np.minimum(at, max(len(self.known) - 1, 0))
        old = self.known[here, 0] == keys if len(self.known) else np.zeros(len(keys), bool)
        out = np.zeros(len(keys), np.int64)
        out[old] = self.known[here[old], 1].astype(np.int64)
        new = np.flatnonzero(~old)
        if len(new):
            out[new] = self.lengths([raw[starts[i] : ends[i]].decode() for i in first[new].tolist()])
            fresh = np.stack([keys[new], out[new].astype(np.uint64)], axis=1)
            both = fresh if len(self.known) + len(new) > STORE_PARTS else np.concatenate([self.known, fresh])
            self.known = both[np.argsort(both[:, 0])]
        return out

    def counts(self, texts: pa.Array) -> np.ndarray:
        data, off = utf8_column(texts)
        out = [self._slice(data[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in byte_slices(off, SLICE_BYTES)]
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def _slice(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        raw = data.tobytes()
        n = len(off) - 1
        if not self.splits:
            return self.lengths([raw[off[i] : off[i + 1]].decode() for i in range(n)])
        cut = np.zeros(len(data), bool)
        cut[1:] = (data[1:] == 32) & (data[:-1] != 32)
        written = np.flatnonzero((data[2:] == 0x81) & (data[1:-1] == 0x96) & (data[:-2] == 0xE2)) + 3  # after a blank written out as U+2581
        cut[written[written < len(data)]] = False
        begins = off[:-1][off[1:] > off[:-1]]
        first = np.zeros(len(data), bool)
        first[begins] = True
        cut |= first
        starts = np.flatnonzero(cut)
        if not len(starts):
            return np.zeros(n, np.int64)
        ends = np.append(starts[1:], len(data))
        row = np.searchsorted(off, starts, "right") - 1
        # the blank at a cut is the prefix; a text's last part may be that blank alone, so it stays with the part before
        inner = ~first[starts]
        lone = inner & (ends - starts == 1)
        if lone.any():
            gone = np.flatnonzero(lone)
            ends[gone - 1] = ends[gone]
            keep = ~lone
            starts, ends, row, inner = starts[keep], ends[keep], row[keep], inner[keep]
        starts = starts + inner
        keys, where, back = np.unique(span_hashes(data, starts, ends, _SAME), return_index=True, return_inverse=True)
        return np.bincount(row, self._part_counts(keys, where, raw, starts, ends)[back], n).astype(np.int64)


class LibraryCounter:
    """Counts of a ``tokenizers`` file, text by text in byte-balanced batches."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def counts(self, texts: pa.Array) -> np.ndarray:
        _, off = utf8_column(texts)
        values, out = texts.to_pylist(), []
        for i, j in byte_slices(off, BATCH_BYTES):
            out += [len(e.ids) for e in self.model.encode_batch([t or "" for t in values[i:j]], add_special_tokens=False)]
        return np.array(out, np.int64)


def counter(path: str) -> PieceCounter | LibraryCounter:
    loaded = kept("token_counts")
    if path not in loaded:
        loaded[path] = (LibraryCounter if path.endswith(".json") else PieceCounter)(path)
    return loaded[path]


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of a text column under the vocabulary file at ``path`` (known to every worker)."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(counter(path).counts(texts), pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row."""
    counted = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), token_count(F.col(text_col), path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
