"""Byte-level BPE with content-defined chunk reuse (dealt operator 9).

A rolling hash over the last ``ROLL`` bytes cuts texts where its top bits are zero, so equal
passages get equal chunks wherever they stand. Every chunk is encoded from cut to cut as if it were a text, and one that
was seen before isn't encoded again. Tokens near a cut differ from those of the whole text, so every join is
repaired: the text around the cut is encoded anew, from one agreement position to another,
and its first and last tokens are compared with those stored for the two chunks. Where they differ, the repair
is widened by more positions on both sides, over neighbouring chunks and to the whole text if need be.

Agreement positions are ends of pre-tokenisation pieces that two neighbouring characters prove: the first is a letter, number or
other visible character but no apostrophe, and the second is of another of the four classes (white space is the fourth). No alternative of
the pattern reaches over such a place, no look-ahead begins before it and ends after it, and scanning goes on from
it whatever came before. Only characters count whose class has been the same since early Unicode versions, and
no place inside a special string does. So texts in any script are reused, with or without blanks.

The vocabulary file is one of the ``tokenizers`` library (a path known to every worker). Its ids
are checked to be merge ranks, and pieces are encoded by the rank-merging encoder of
``tiktoken``, which gives the same ids; other byte-level files go through the library itself.
Special strings in texts are special tokens, as is the library's default. That encoder's pattern can't go through very long runs of white
space; those are cut off as the pieces they are.

One scan, nothing shuffled: chunks are shared among all documents that a worker process meets
(the store of encoded chunks is bounded by ``STORE_BYTES`` and started anew when full).

Defined results: null counts as empty, empty text gives no ids; repeated rows are encoded each;
other columns are not read. Decoding drops ids outside the vocabulary and replaces bytes that
aren't UTF-8, as the library does; a null list decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, ragged, small_batches, utf8_column

ROLL = 16
CUT_BITS = 9
STORE_BYTES = 24 << 20
LONG_RUN = 1 << 12
#: Unicode's white space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: The pre-tokenisation pattern of byte-level BPE files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            raw = f.read()
        spec = json.loads(raw)
        alphabet = byte_alphabet()
        specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        token = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in specials}
        token |= {i: t.encode() for t, i in specials.items()}
        top = max(token, default=-1) + 1
        sizes = np.array([len(token.get(i, b"")) for i in range(top)], np.int64)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(token.get(i, b"") for i in range(top)), np.uint8)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        ids = spec["model"]["vocab"]
        pre = spec.get("pre_tokenizer") or {}
        plain = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
            and not any(spec["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(t.get(k) for t in spec.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized"))
            and all(" " not in s for s in specials)
        )
        ranks = [ids.get(a + b, -1) for a, b in merges]
        self.library = None
        self.specials = specials
        self._special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self._run = re.compile("[" + "".join(map(chr, WHITE)) + "]{%d,}" % LONG_RUN)
        if plain and ranks == sorted(ranks) and len(set(ranks)) == len(ranks) and all(c in ids for c in alphabet) and (not ranks or ranks[0] > max(ids[c] for c in alphabet)):
            import tiktoken

            mergeable = {bytes(alphabet[c] for c in t): i for t, i in ids.items() if t not in specials}
            self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=mergeable, special_tokens=specials)
        else:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(raw)
            self.library.no_truncation()
            self.library.no_padding()
        self.store: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.held = 0
        self.repaired = self.widened = 0

    def encode_text(self, text: str) -> np.ndarray:
        if self.library is not None:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)
        if self._run.search(text):
            return self._with_long_runs(text)
        return np.array(self.fast.encode(text, allowed_special="all"), np.int32)

    def _with_long_runs(self, text: str) -> np.ndarray:
        """Ids of a text with long runs of white space: all of a run but its last character is a piece, or all of it where an ordinary stretch ends."""
        out, at = [], 0
        for m in [*(self._special.finditer(text) if self._special else ()), None]:
            end = len(text) if m is None else m.start()
            while at < end:
                run = self._run.search(text, at, end)
                stop = end if run is None else run.start()
                if stop > at:
                    out += self.fast.encode_ordinary(text[at:stop])
                if run is None:
                    break
                at = end if run.end() == end else run.end() - 1
                out += self.fast._encode_single_piece(text[run.start() : at])
            if m is not None:
                out.append(self.specials[m.group()])
                at = m.end()
        return np.array(out, np.int32)

    def encode_part(self, part: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk or of a repaired join and the bytes up to the end of each, from the store where it is known."""
        got = self.store.get(part)
        if got is None:
            ids = self.encode_text(part.decode())
            got = ids, np.cumsum(self.sizes[ids])
            self.held += len(part) + 12 * len(ids) + 300
            if self.held > STORE_BYTES:
                self.store, self.held = {}, 0
            self.store[part] = got
        return got

    def encode_column(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of a batch of texts."""
        data, off = utf8_column(texts)
        if self.library is not None:
            lists = [self.encode_text(t or "") for t in texts.to_pylist()]
        else:
            raw, lists = data.tobytes(), []
            cuts = rolling_cuts(data, off)
            safe = agreement_positions(raw, self.specials)
            first_cut, last_cut = np.searchsorted(cuts, off[:-1], "right").tolist(), np.searchsorted(cuts, off[1:], "left").tolist()
            first, last = np.searchsorted(safe, off[:-1], "right").tolist(), np.searchsorted(safe, off[1:], "left").tolist()
            for k, (a, z) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                if a == z:
                    lists.append(np.zeros(0, np.int32))
                elif first_cut[k] == last_cut[k]:
                    lists.append(self.encode_part(raw[a:z])[0])
                else:
                    lists.append(self._joined(raw, [a, *cuts[first_cut[k] : last_cut[k]].tolist(), z], [a, *safe[first[k] : last[k]].tolist(), z]))
        sizes = np.array([len(x) for x in lists], np.int64)
        return (np.concatenate(lists) if lists else np.zeros(0, np.int32)), np.concatenate([[0], np.cumsum(sizes)])

    def _joined(self, raw: bytes, edges: list[int], safe: list[int]) -> np.ndarray:
        """Ids of a text from those of its chunks between ``edges``, every join repaired; ``safe``: its agreement positions, with its begin and end."""
        chunks = [self.encode_part(raw[a:z]) for a, z in zip(edges, edges[1:])]
        places = np.array(safe)
        right = np.searchsorted(places, edges[1:-1], "left")  # the first one at or after each cut
        margin = 1
        while True:
            repairs = []  # (from, inner from, inner to, to): encoded from the outer positions, compared as far as the inner ones
            for c, r in zip(edges[1:-1], right.tolist()):
                if safe[r] == c:
                    continue  # chunks that meet at an agreement position need no repair
                left, low, high = r - 1, max(0, r - 1 - margin), min(len(safe) - 1, r + margin)
                if repairs and safe[low] < repairs[-1][3]:
                    repairs[-1] = (*repairs[-1][:2], safe[r], safe[high])
                else:
                    repairs.append((safe[low], safe[left], safe[r], safe[high]))
            out, at, agreed = [], edges[0], True
            for low, inner_low, inner_high, high in [*repairs, (edges[-1],) * 4]:
                agreed &= self._stored(chunks, edges, at, low, out)
                if low == high:
                    break
                ids, ends = self.encode_part(raw[low:high])
                before, after = [], []
                agreed &= self._stored(chunks, edges, low, inner_low, before) and self._stored(chunks, edges, inner_high, high, after)
                head, tail = sum(map(len, before)), sum(map(len, after))
                agreed &= head + tail <= len(ids) and all((x == y).all() for x, y in ((np.concatenate([*before, ids[:0]]), ids[:head]), (np.concatenate([*after, ids[:0]]), ids[len(ids) - tail :])))
                out.append(ids)
                at = high
                self.repaired += 1
                if not agreed:
                    break
            if agreed:
                return np.concatenate(out)
            self.widened += 1
            if margin > len(safe):
                return self.encode_text(raw[edges[0] : edges[-1]].decode())
            margin *= 2

    def _stored(self, chunks, edges: list[int], begin: int, end: int, out: list[np.ndarray]) -> bool:
        """Add the stored ids of ``begin .. end`` to ``out``; False where tokens don't end there. Chunks meet inside it at agreement positions only."""
        k = bisect_right(edges, begin) - 1
        while begin < end:
            stop = min(end, edges[k + 1])
            ids, ends = chunks[k]
            i, j = np.searchsorted(ends, (begin - edges[k], stop - edges[k]), "right").tolist()
            if (i and ends[i - 1] != begin - edges[k]) or (not i and begin != edges[k]) or (not j or ends[j - 1] != stop - edges[k]):
                return False
            out.append(ids[i:j])
            begin, k = stop, k + 1
        return True

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.sizes))]
        return self.bytes[ragged(self.starts[ids], self.sizes[ids])].tobytes().decode("utf-8", "replace")


def rolling_cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Content-defined cuts: after the character in which the hash of the last ``ROLL`` bytes is zero in its top bits."""
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    step, base = 1, 0x85EBCA6B
    while step < ROLL:  # doubling the window
        longer = h * np.uint32(base)
        if step < len(h):
            longer[step:] += h[:-step]
        h, base, step = longer, base * base % (1 << 32), step * 2
    cut = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    row = np.searchsorted(off, cut, "left") - 1
    cut = cut[cut - off[row] >= ROLL]
    for _ in range(3):  # to the next character
        inside = cut < len(data)
        inside[inside] = (data[cut[inside]] & 0xC0) == 0x80
        cut = cut + inside
    return np.unique(cut[~np.isin(cut, off)])


_LETTER, _NUMBER, _OTHER, _BLANK, _UNSURE = range(5)
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """The class of every code point of the basic plane; unsure where early Unicode versions had another, and for what is not assigned."""
    if not _KINDS:
        old = unicodedata.ucd_3_2_0

        def kind(category: str) -> int:
            return _UNSURE if category in ("Cn", "Cs", "Co") else _LETTER if category[0] == "L" else _NUMBER if category[0] == "N" else _OTHER

        table = np.full((1 << 16) + 1, _UNSURE, np.uint8)  # the last one stands for the other planes
        for c in range(1 << 16):
            now, then = kind(unicodedata.category(chr(c))), kind(old.category(chr(c)))
            table[c] = now if now == then else _UNSURE
        table[WHITE] = _BLANK
        _KINDS.append(table)
    return _KINDS[0]


def agreement_positions(raw: bytes, specials=()) -> np.ndarray:
    """Byte positions where a piece of the pattern ends whatever stands around the two characters that meet there; none inside special strings."""
    if not raw:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
    data = np.frombuffer(raw, np.uint8)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    kind = _kinds()[np.minimum(codes, 1 << 16)]
    left, right = kind[:-1], kind[1:]
    ends = (left < _BLANK) & (codes[:-1] != 39) & (right < _UNSURE) & (left != right)
    safe = starts[1:][ends]
    for s in specials:
        text, at = s.encode(), raw.find(s.encode())
        while at >= 0:
            i, j = np.searchsorted(safe, (at + 1, at + len(text)))
            safe = np.delete(safe, np.s_[i:j])
            at = raw.find(text, at + 1)
    return safe


def encoder(path: str) -> ByteBPE:
    """The worker's encoder of a file, loaded once."""
    loaded = kept("chunked_bpe")
    if path not in loaded:
        loaded[path] = ByteBPE(path)
    return loaded[path]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` of every row."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in small_batches(batches, "text"):
            ids, off = encoder(path).encode_column(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))], names=["doc_id", "ids"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``."""
    e = encoded.select("doc_id", "ids")

    def run(batches):
        for b in batches:
            texts = [encoder(path).decode(np.asarray(x.values) if x.is_valid else np.zeros(0, np.int32)) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return e.mapInArrow(run, f"doc_id {e.schema['doc_id'].dataType.simpleString()}, text string")


def encoding_digest(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of ``(doc_id, ids)``; the ids are decoded for it."""
    e = encoded.select("doc_id", "ids")

    def run(batches):
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for x in b.column("ids"):
                ids = np.asarray(x.values) if x.is_valid else np.zeros(0, np.int32)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest())
                text_sha.append(hashlib.sha256(encoder(path).decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return e.mapInArrow(run, f"doc_id {e.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
