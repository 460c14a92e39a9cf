"""Token ids in directly addressable codes (dealt operator 8).

An id is split into chunks of eight bits, the low one first. Level ``k`` of a file holds chunk ``k`` of all
ids that reach it, a continuation bitmap that says which of them go on, and a rank directory (ones before
every 512 bits). The chunk of token ``i`` on the next level stands at the number of continuing
tokens before it, so any token is read from a few places without decoding a block, and a
document is one slice a level.

File: magic ``DACT``, levels, tokens, documents; then per level the count, chunks, bitmap words, directory; then
the documents' ids, null flags and token offsets. All numbers are little-endian.

Documents are encoded where they are read, then their packed ids go through one shuffle into ascending ranges of
the document id (bounds from a narrow scan, rows with one id ordered by their ids). Every range is
written as files of about ``FILE_TOKENS`` tokens, under names no other attempt uses; the manifest lists
those that count, and its running sum gives every file's first token.

Defined results: null text counts as empty and gives the end id alone; repeated rows are
stored each, next to each other; null document ids come first; empty tables give no files and no rows. Ids are
stored as 64-bit numbers: an id column that isn't a whole number is refused.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from . import word_bpe
from .common import give_back, open_file, put_file, shuffle_partitions, small_batches, whole_ids, with_order_bucket

MAGIC = b"DACT"
FILE_TOKENS = 2 << 20
_SUPER = 8  # bitmap words in a directory block
_HEAD = struct.Struct("<4sIQQ")


def pack(ids: np.ndarray, doc_ids: list[int | None], sizes: np.ndarray) -> bytes:
    """A file of the ids of consecutive documents."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest > 0xFF
        bits = np.packbits(np.append(more, np.zeros(-len(more) % (64 * _SUPER), bool)), bitorder="little")
        ones = np.bitwise_count(bits.view("<u8")).reshape(-1, _SUPER).sum(axis=1, dtype=np.uint64)
        levels.append((rest.astype(np.uint8), bits, np.cumsum(ones, dtype=np.uint64) - ones))
        rest = rest[more] >> np.uint32(8)
    out = io.BytesIO()
    out.write(_HEAD.pack(MAGIC, len(levels), len(ids), len(doc_ids)))
    for chunks, bits, directory in levels:
        out.write(struct.pack("<Q", len(chunks)))
        out.write(chunks.tobytes())
        out.write(bits.tobytes())
        out.write(directory.astype("<u8").tobytes())
    out.write(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    out.write(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    out.write(np.concatenate([[0], np.cumsum(sizes)]).astype("<u8").tobytes())
    return out.getvalue()


class DirectCodes:
    """Reader of one file; nothing is decoded before it is asked for."""

    def __init__(self, raw: bytes):
        magic, levels, self.tokens, docs = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        at, self.levels = _HEAD.size, []

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(raw, kind, n, at)
            at += got.nbytes
            return got

        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            blocks = -(-n // (64 * _SUPER))
            self.levels.append((take("u1", n), take("<u8", blocks * _SUPER), take("<u8", blocks)))
        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if z else d for d, z in zip(ids.tolist(), null.tolist())]
        self.offsets = take("<u8", docs + 1).astype(np.int64)

    def _rank(self, level: int, i: np.ndarray) -> np.ndarray:
        """Continuing tokens among the first ``i`` of a level."""
        _, words, directory = self.levels[level]
        if not len(words):
            return np.zeros_like(i)
        word = np.minimum(i >> 6, len(words) - 1)
        block = word // _SUPER
        out = directory[block].astype(np.int64)
        for k in range(_SUPER):  # whole words of the block before this one
            w = block * _SUPER + k
            out += np.where(w < word, np.bitwise_count(words[np.minimum(w, len(words) - 1)]), 0).astype(np.int64)
        inside = i - (word << 6)
        mask = np.where(inside >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(inside, 63).astype(np.uint64)) - np.uint64(1))
        return out + np.bitwise_count(words[word] & mask).astype(np.int64)

    def at(self, i) -> np.ndarray:
        """The tokens at any positions."""
        i = np.asarray(i, np.int64)
        out, live = np.zeros(len(i), np.uint32), np.arange(len(i))
        for k, (chunks, words, _) in enumerate(self.levels):
            out[live] |= chunks[i].astype(np.uint32) << np.uint32(8 * k)
            goes = ((words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            live, i = live[goes], self._rank(k, i[goes])
            if not len(live):
                break
        return out

    def span(self, begin: int, end: int) -> np.ndarray:
        """The tokens of a range: one slice a level."""
        out, live = np.zeros(end - begin, np.uint32), np.arange(end - begin)
        for k, (chunks, words, _) in enumerate(self.levels):
            if begin >= end:
                break
            out[live] |= chunks[begin:end].astype(np.uint32) << np.uint32(8 * k)
            first = begin >> 6
            bits = np.unpackbits(words[first : -(-end // 64)].view(np.uint8), bitorder="little")[begin - 64 * first : end - 64 * first].astype(bool)
            live = live[bits]
            begin = int(self._rank(k, np.array([begin]))[0])
            end = begin + len(live)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.span(int(self.offsets[k]), int(self.offsets[k + 1]))


def write_codes(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_tokens: int = FILE_TOKENS, folder: str | None = None) -> DataFrame:
    """Encode all texts and write their ids, each text ended by ``end_id``, to ``folder`` (scratch where none is given); returns the manifest ``(bucket, part, path, tokens, documents)``."""
    spark = docs.sparkSession
    whole_ids(docs, id_col)
    buckets = shuffle_partitions(spark)
    d = with_order_bucket(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", buckets)

    def encode(batches):
        enc = word_bpe.encoder(path)
        end, width = np.array([end_id], enc.kind).tobytes(), int(enc.kind[2])
        for b in small_batches(batches, "text"):
            packed = [ids + end for ids in enc.packed([t or "" for t in b.column("text").to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column("_bucket"), b.column("doc_id"), pa.array(packed, pa.binary()), pa.array([width] * len(packed), pa.int32())], names=["bucket", "doc_id", "ids", "width"])

    encoded = d.select("_bucket", "doc_id", "text").mapInArrow(encode, "bucket int, doc_id long, ids binary, width int")
    ordered = encoded.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "doc_id", "ids")
    folder = folder or scratch_path(spark, "codes")

    def write(batches):
        attempt, bucket, part, held, names, parts = uuid.uuid4().hex, None, 0, 0, [], []

        def flush():
            sizes = np.array([len(p) for p in parts], np.int64)
            name = f"{folder}/{bucket:06d}-{part:05d}-{attempt}.dact"
            put_file(name, [pack(np.concatenate(parts), names, sizes)])
            return pa.RecordBatch.from_pydict({"bucket": [bucket], "part": [part], "path": [name], "tokens": [int(sizes.sum())], "documents": [len(names)]}, schema=schema)

        for b in batches:
            for k, doc_id, ids, width in zip(*(b.column(c).to_pylist() for c in ("bucket", "doc_id", "ids", "width"))):
                if names and (k != bucket or held >= file_tokens):
                    yield flush()
                    part = part + 1 if k == bucket else 0
                    held, names, parts = 0, [], []
                bucket = k
                names.append(doc_id)
                parts.append(np.frombuffer(ids, f"<u{width}"))
                held += len(parts[-1])
        if names:
            yield flush()
        names, parts = [], []
        give_back()

    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("tokens", pa.int64()), ("documents", pa.int64())])
    return materialize(ordered.mapInArrow(write, "bucket int, part int, path string, tokens long, documents long"), "codes-manifest")


def read_codes(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every stored document; ``start`` counts the ids of all documents before it."""
    # one row a file: the running sum over the manifest is small whatever the corpus
    before = Window.orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first"))

    def run(batches):
        for b in batches:
            for path, first in zip(b.column("path").to_pylist(), b.column("first").to_pylist()):
                with open_file(path) as f:
                    codes = DirectCodes(f.read())
                sums = [zlib.crc32(codes.document(k).astype("<u4").tobytes()) for k in range(len(codes.doc_ids))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes.doc_ids, pa.int64()), pa.array(first + codes.offsets[:-1], pa.int64()), pa.array(np.diff(codes.offsets), pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                del codes
        give_back()

    return files.repartition(shuffle_partitions(manifest.sparkSession)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
