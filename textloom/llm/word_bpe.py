"""Encoding with word-end BPE files (lower-cased words that end in ``</w>``) for operators that write token ids.

The file is one of the ``tokenizers`` library. Where its settings are the known ones and a text has
only characters whose handling is context-free (no combining marks, no special strings), words are cut with
numpy and merged by ``tiktoken`` in rank order, a line feed standing for the word end; all other texts, and
files with other settings, go through the library itself. Both give the same ids (tests compare them on every character).
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

from .chunked_bpe import WHITE, byte_alphabet
from .common import kept, ragged, span_ids

#: The pre-tokenisation pattern this module reproduces.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
STORE_BYTES = 40 << 20
_TOP = 0x10000
_BLANK, _LETTER, _NUMBER, _OTHER = range(4)
_TABLES: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point of the basic plane: simple or not, class, lower case."""
    if not _TABLES:
        simple, kind, lower = np.zeros(_TOP, bool), np.full(_TOP, _OTHER, np.uint8), np.arange(_TOP, dtype=np.uint32)
        for c in range(_TOP):
            ch = chr(c)
            cat = unicodedata.category(ch)
            kind[c] = _LETTER if cat[0] == "L" else _NUMBER if cat[0] == "N" else _OTHER
            low = ch.lower()
            # composing jamo, marks and unassigned or private characters are left to the library
            simple[c] = cat[0] != "M" and cat not in ("Cn", "Cs", "Co") and not 0x1100 <= c < 0x1200 and len(low) == 1 and unicodedata.normalize("NFC", ch) == ch
            if len(low) == 1:
                lower[c] = ord(low)
        kind[WHITE] = _BLANK
        _TABLES.append((simple, kind, lower))
    return _TABLES[0]


class WordBPE:
    """Encoder of one file; ``encode`` takes a batch."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        # ids above the vocabulary's are those of added tokens
        self.size = max([*spec["model"]["vocab"].values(), *(t["id"] for t in added)], default=-1) + 1
        self.specials = [t["content"] for t in added]
        self.fast = self._fast(spec)
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self.path, self._library = path, None
        self.store: dict[str, bytes] = {}
        self.held = 0

    @property
    def library(self):
        """The library's tokenizer, loaded when a text needs it."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def _fast(self, spec: dict):
        model, norm, pre = spec["model"], spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = [(n.get("type"), n.get("pattern"), n.get("content")) for n in norm.get("normalizers", [])]
        cuts = pre.get("pretokenizers", [])
        known = (
            steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] and len(cuts) == 2
            and (cuts[0].get("type"), cuts[0].get("pattern"), cuts[0].get("behavior"), cuts[0].get("invert")) == ("Split", {"Regex": SPLIT}, "Removed", True)
            and (cuts[1].get("type"), cuts[1].get("add_prefix_space"), cuts[1].get("use_regex")) == ("ByteLevel", False, False)
            and model.get("end_of_word_suffix") == END and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        )
        if not known:
            return None
        import tiktoken

        alphabet, ranks = byte_alphabet(), {}
        for t, i in model["vocab"].items():
            if t not in self.specials:
                word = t.endswith(END) and t != END
                ranks[bytes(alphabet[c] for c in (t[: -len(END)] if word else t)) + (b"\n" if word else b"")] = i
        merges = [model["vocab"].get((a + b), -1) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        if merges != sorted(merges) or len(ranks) != len(model["vocab"]) - sum(s in model["vocab"] for s in self.specials):
            return None
        return tiktoken.Encoding("words", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})

    def _piece(self, piece: bytes) -> bytes:
        """Packed ids of a piece; a worker keeps those of short pieces it has met, up to ``STORE_BYTES`` (then started anew)."""
        got = self.store.get(piece)
        if got is None:
            got = np.array(self.fast.encode_ordinary(piece.decode() + "\n"), self.kind).tobytes()
            if len(piece) <= 256:
                if self.held >= STORE_BYTES:
                    self.store, self.held = {}, 0
                self.store[piece] = got
                self.held += 170 + len(piece) + len(got)  # with what Python needs for the entry
        return got

    def _lines(self, codes: list[np.ndarray]) -> list[bytes]:
        """Packed ids of texts given as code points: the distinct pieces of all of them are looked up once."""
        letters, ends = _word_lines(codes)
        data = np.frombuffer(letters.tobytes().decode("utf-32-le").encode(), np.uint8)
        stops = np.flatnonzero(data == 10)
        numbers, values = span_ids(data, np.concatenate([[0], stops[:-1] + 1])[: len(stops)], stops)
        packs = [self._piece(v) for v in values.to_pylist()]
        sizes = np.array([len(p) for p in packs], np.int64)
        flat = np.frombuffer(b"".join(packs), np.uint8)
        each = sizes[numbers]
        out = flat[ragged((np.cumsum(sizes) - sizes)[numbers], each)].tobytes()
        words = np.concatenate([[0], np.cumsum(letters == 10)])[ends]
        edges = np.concatenate([[0], np.cumsum(each)])[words].tolist()
        return [out[a:z] for a, z in zip([0, *edges], edges)]

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian numbers of ``kind``."""
        out: list[bytes | None] = [None] * len(texts)
        if self.fast is not None:
            codes = [np.frombuffer(t.encode("utf-32-le"), "<u4") for t in texts]
            simple = _tables()[0]
            easy = [i for i, (t, c) in enumerate(zip(texts, codes)) if (not len(c) or c.max() < _TOP and simple[c].all()) and not any(s in t for s in self.specials)]
            if easy:
                for i, ids in zip(easy, self._lines([codes[i] for i in easy])):
                    out[i] = ids
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.library.encode_batch([texts[i] for i in rest], add_special_tokens=False) if rest else []):
            out[i] = np.array(e.ids, self.kind).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(p, self.kind).tolist() for p in self.packed(texts)]


def _word_lines(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' pieces, lower-cased, a line feed after each, as code points; and where each text's end."""
    _, kinds, lower = _tables()
    gap = np.array([32], np.uint32)
    c = np.concatenate([x for t in codes for x in (t, gap)] + [gap, gap, gap])
    kind, c = kinds[c], lower[c]
    before = np.concatenate([np.array([_BLANK], np.uint8), kind[:-1]])
    start = (kind != _BLANK) & ((kind != before) | (kind == _NUMBER))
    q = np.flatnonzero((c == 39) & start)
    if len(q):
        one, two = c[q + 1], c[q + 2]
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for at, size in ((q[short], 2), (q[long], 3)):
            start[at + 1] = False
            start[at + size] = kind[at + size] != _BLANK
    keep = kind != _BLANK
    last = keep & (~np.append(keep[1:], False) | np.append(start[1:], False))
    place = np.cumsum(keep.astype(np.int64) + last)
    out = np.full(int(place[-1]), 10, "<u4")
    out[(place - 1 - last)[keep]] = c[keep]
    return out, place[np.cumsum([len(t) + 1 for t in codes]) - 1]


def encoder(path: str) -> WordBPE:
    """The worker's encoder of a file, loaded once."""
    loaded = kept("word_bpe")
    if path not in loaded:
        loaded[path] = WordBPE(path)
    return loaded[path]
