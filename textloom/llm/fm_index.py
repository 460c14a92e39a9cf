"""Benchmark decontamination (dealt operator 10): an FM-index per shard of training words.

Words are maximal runs of ASCII letters and digits (A-Z lower-cased) and non-ASCII
characters. A benchmark item's windows are its runs of ``window`` consecutive words; an
item with fewer words, but not none, is one window. Test phrases become sequences of
benchmark vocabulary numbers. Every task turns its documents into the same numbers
(words outside the vocabulary become the separator 0; stretches of vocabulary words that
are shorter than the shortest phrase can't hold one and are left out), indexes shards of
them (suffix order, Burrows-Wheeler transform in a wavelet matrix with rank directories,
sampled suffix positions), searches all phrases backwards at once, locates every
occurrence through the samples, and merges what they cover into removal spans.

Nothing is shuffled: one scan of the documents. The phrases are prepared in blocks of at
most ``block_bytes`` of benchmark text, written to the shared checkpoint folder; tasks
load one block at a time, so neither the driver nor a task holds a larger benchmark.

Defined results: null or word-free text has no words, hits or items; empty tables give
empty results; repeated rows are searched one by one; items repeated under one item_id
count once; an item with a null id marks words but isn't listed. Only the id and text
columns are read by ``find_contamination``; ``remove_contamination`` passes every other
column through untouched.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path
from .common import fold_ascii, kept, open_file, put_file, ragged, small_batches, span_hashes, utf8_column, word_spans

WINDOW = 10
SHARD_WORDS = 1 << 20
SAMPLE_EVERY = 8


def _word_bytes() -> np.ndarray:
    t = np.zeros(256, bool)
    t[48:58] = t[65:91] = t[97:123] = True
    t[128:] = True
    return t


_IS_WORD, _FOLD = _word_bytes(), fold_ascii()


class BitRank:
    """Bits in 64-bit words with a directory of the ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    """Ranks of symbols and the symbol at a row, one bit level after the other."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels, self.rows, self.zeros = levels, [], []
        for k in range(levels - 1, -1, -1):
            bits = (values >> k) & 1
            self.rows.append(BitRank(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first ``i`` rows' copies of ``symbol`` end after all levels."""
        for k, (row, zeros) in enumerate(zip(self.rows, self.zeros)):
            ones = row.rank(i)
            i = np.where((symbol >> (self.levels - 1 - k)) & 1, zeros + ones, i - ones)
        return i

    def follow(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each row and the row's place after all levels."""
        symbol = np.zeros(len(i), np.int64)
        for row, zeros in zip(self.rows, self.zeros):
            bit, ones = row.get(i).astype(np.int64), row.rank(i)
            symbol = symbol * 2 + bit
            i = np.where(bit, zeros + ones, i - ones)
        return symbol, i


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only groups that are still tied are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    new = np.concatenate([[True], text[order][1:] != text[order][:-1]]) if n else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = first
    h = 1
    tied = np.flatnonzero(~new | ~np.concatenate([new[1:], [True]]))
    while len(tied):
        pos = order[tied]
        key = (rank[pos] << 32) + rank[np.minimum(pos + h, n)] + 1
        by = np.argsort(key, kind="stable")
        pos, key = pos[by], key[by]
        order[tied] = pos
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[pos] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        tied = tied[~new | ~np.concatenate([new[1:], [True]])]
        h *= 2
    return order


class FMIndex:
    """Backward search and locating over one sequence of numbers 0..top (0 separates)."""

    def __init__(self, text: np.ndarray, top: int, every: int = SAMPLE_EVERY):
        self.n, self.every = len(text), every
        order = suffix_order(text)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.wavelet = WaveletMatrix(text[order - 1], max(1, int(top).bit_length()))
        sampled = (order % every == 0) | (text[order - 1] == 0)  # a walk back never crosses a separator
        self.marked, self.samples = BitRank(sampled), order[sampled]
        symbols = np.arange(top + 1)
        self.base = self.wavelet.place(symbols, np.zeros(top + 1, np.int64))

    def _back(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.below[symbol] + self.wavelet.place(symbol, i) - self.base[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases (right-aligned, 0 pads on the left); empty ranges where there is none."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((phrases[:, k] > 0) & (low < high))
            if len(live):
                c = phrases[live, k]
                low[live], high[live] = self._back(c, low[live]), self._back(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in these rows, walking back to the next sampled one."""
        out = np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            hit = self.marked.get(rows).astype(bool)
            out[left[hit]] = self.samples[self.marked.rank(rows[hit])] + steps
            left, rows = left[~hit], rows[~hit]
            if len(left):
                symbol, place = self.wavelet.follow(rows)
                rows = self.below[symbol] + place - self.base[symbol]
            steps += 1
        return out


def _prepare_block(ids: list[str | None], texts: list[str | None], window: int) -> bytes:
    """Vocabulary, phrases and the items each phrase belongs to, as one file."""
    data, off = utf8_column(pa.array(texts, pa.string()))
    starts, ends, row = word_spans(data, off, _IS_WORD)
    vocab, word = np.unique(span_hashes(data, starts, ends, _FOLD), return_inverse=True)
    word = word + 1
    first, last = np.searchsorted(row, np.arange(len(texts))), np.searchsorted(row, np.arange(len(texts)), "right")
    phrases, owner = [], []
    for i, (a, b) in enumerate(zip(first, last)):
        for s in range(a, max(b - window, a) + 1 if b > a else a):
            p = word[s : min(s + window, b)]
            phrases.append(np.concatenate([np.zeros(window - len(p), np.int64), p]))
            owner.append(i)
    if phrases:
        unique, where = np.unique(np.array(phrases), axis=0, return_inverse=True)
    else:
        unique, where = np.zeros((0, window), np.int64), np.zeros(0, np.int64)
    by = np.argsort(where.ravel(), kind="stable")
    out = io.BytesIO()
    names = np.array(["" if x is None else str(x) for x in ids], dtype=str)
    known = np.array([x is not None for x in ids], bool)
    np.savez(out, vocab=vocab, phrases=unique, owner=np.array(owner, np.int64)[by], counts=np.bincount(where.ravel(), minlength=len(unique)), names=names, known=known)
    return out.getvalue()


def prepare_phrases(benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text", block_bytes: int = 16 << 20) -> list[str]:
    """Write the benchmark's phrases in blocks of about ``block_bytes`` of text (an item at least); returns the files.

    Tasks cut the windows and write the blocks, under names no other attempt uses; the driver only gets the names of those that count.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).filter("t IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    folder = scratch_path(spark, "benchmark-phrases")

    def write(batches):
        attempt, number = uuid.uuid4().hex, 0
        ids, texts, held = [], [], 0

        def block():
            path = f"{folder}/block-{attempt}-{number:05d}.npz"
            put_file(path, [_prepare_block(ids, texts, window)])
            return pa.RecordBatch.from_pydict({"path": [path]})

        for b in batches:
            for i, t in zip(b.column("i").to_pylist(), b.column("t").to_pylist()):
                if ids and held + len(t) > block_bytes:
                    yield block()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t)
        if ids:
            yield block()

    blocks = items.repartition(max(1, -(-size // block_bytes))).mapInArrow(write, "path string")
    return sorted(r.path for r in materialize(blocks, "benchmark-blocks").collect())


#: Blocks a worker keeps, and small batches it searches together where there are more.
KEPT_BLOCKS, GROUP_BATCHES = 2, 4


def _block(path: str) -> dict:
    loaded = kept("fm_index")
    if path not in loaded:
        if len(loaded) >= KEPT_BLOCKS:
            loaded.clear()
        with open_file(path) as f, np.load(io.BytesIO(f.read())) as z:
            b = {k: z[k] for k in z.files}
        small = np.zeros(1 << 16, bool)  # most words are told apart by 16 bits of their hash
        small[(b["vocab"] >> np.uint64(48)).astype(np.int64)] = True
        b["small"] = small
        b["shortest"] = int((b["phrases"] > 0).sum(axis=1).min()) if len(b["phrases"]) else 0
        b["first"] = np.cumsum(b["counts"]) - b["counts"]
        loaded[path] = b
    return loaded[path]


def _numbers(hashes: np.ndarray, b: dict) -> np.ndarray:
    """Vocabulary number of each word, 0 outside the vocabulary."""
    out = np.zeros(len(hashes), np.int64)
    maybe = np.flatnonzero(b["small"][(hashes >> np.uint64(48)).astype(np.int64)])
    at = np.searchsorted(b["vocab"], hashes[maybe])
    found = b["vocab"][np.minimum(at, len(b["vocab"]) - 1)] == hashes[maybe]
    out[maybe[found]] = at[found] + 1
    return out


def _shards(number: np.ndarray, row: np.ndarray, shortest: int, longest: int, shard_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(sequence, word position)`` of stretches of vocabulary words that can hold a phrase, up to ``shard_words`` a shard.

    Longer stretches are cut with an overlap of ``longest - 1`` words, so no phrase is cut.
    """
    inside = number > 0
    if not inside.any():
        return
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | (row[1:] != row[:-1])
    end = inside.copy()
    end[:-1] &= ~inside[1:] | (row[1:] != row[:-1])
    a, z = np.flatnonzero(begin), np.flatnonzero(end) + 1
    keep = z - a >= shortest
    a, z = a[keep], z[keep]
    if len(a) and (z - a).max() > shard_words:
        parts = [(s, min(e, t + shard_words)) for s0, e in zip(a, z) for t in range(s0, max(e - longest + 1, s0 + 1), shard_words - longest + 1) for s in (t,)]
        a, z = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    total = np.concatenate([[0], np.cumsum(z - a + 1)])
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(total, total[i] + shard_words, "right")) - 1)
        sizes = z[i:j] - a[i:j] + 1
        at = ragged(a[i:j], sizes)
        last = np.cumsum(sizes) - 1
        sequence = number[np.minimum(at, len(number) - 1)]
        sequence[last] = 0
        yield sequence, at
        i = j


class _Search:
    """The words of a batch of texts, and what the blocks searched so far have found in them."""

    def __init__(self, texts):
        data, self.off = utf8_column(texts)
        self.starts, self.ends, self.row = word_spans(data, self.off, _IS_WORD)
        self.hashes = span_hashes(data, self.starts, self.ends, _FOLD)
        self.hit = np.zeros(len(self.starts), bool)
        self.items: list[set[str]] = [set() for _ in range(len(self.off) - 1)]

    def block(self, b: dict, shard_words: int) -> None:
        if not len(b["phrases"]):
            return
        longest = b["phrases"].shape[1]
        lengths = (b["phrases"] > 0).sum(axis=1)
        number = _numbers(self.hashes, b)
        for sequence, at in _shards(number, self.row, b["shortest"], longest, shard_words):
            index = FMIndex(sequence, len(b["vocab"]))
            low, high = index.search(b["phrases"])
            found = np.flatnonzero(high > low)
            if not len(found):
                continue
            each = (high - low)[found]
            place = at[index.locate(ragged(low[found], each))]
            phrase = np.repeat(found, each)
            self.hit[ragged(place, lengths[phrase])] = True
            pairs = np.unique(np.stack([self.row[place], phrase], axis=1), axis=0)
            for r, p in pairs.tolist():
                for o in b["owner"][b["first"][p] : b["first"][p] + b["counts"][p]]:
                    if b["known"][o]:
                        self.items[r].add(str(b["names"][o]))

    def result(self) -> dict:
        n = len(self.items)
        words, hits = np.bincount(self.row, minlength=n), np.bincount(self.row[self.hit], minlength=n)
        return {"n_words": words, "n_hit": hits, "items": self.items, "spans": _merged(self.starts, self.ends, self.row, self.hit, self.off, n)}


def search_many(columns, files: list[str], shard_words: int = SHARD_WORDS) -> list[dict]:
    """:func:`search_texts` of several batches, block by block: a block is loaded once for all of them."""
    searches = [_Search(texts) for texts in columns]
    for path in files:
        b = _block(path)
        for s in searches:
            s.block(b, shard_words)
    return [s.result() for s in searches]


def search_texts(texts, files: list[str], shard_words: int = SHARD_WORDS) -> dict:
    """Words, hit words, items and spans of a batch of texts, against every block of phrases."""
    return search_many([texts], files, shard_words)[0]


def _groups(batches, text: str, files: list[str]):
    """Small batches, several at a time where there are more blocks than a worker keeps."""
    group = []
    for b in small_batches(batches, text):
        group.append(b)
        if len(files) <= KEPT_BLOCKS or len(group) == GROUP_BATCHES:
            yield group
            group = []
    if group:
        yield group


def _merged(starts, ends, row, hit, off, n) -> list[list[tuple[int, int]]]:
    """Byte spans from the first to the last word of every stretch of hit words, by text."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    at = np.flatnonzero(hit)
    if len(at):
        new = np.concatenate([[True], (np.diff(at) > 1) | (row[at][1:] != row[at][:-1])])
        a = at[new]
        z = at[np.concatenate([new[1:], [True]])]
        for s, e, r in zip(starts[a], ends[z], row[a]):
            out[r].append((int(s - off[r]), int(e - off[r])))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document row: the id, n_words, n_hit, items (sorted strings), spans (merged removal spans in bytes)."""
    files = prepare_phrases(benchmark, window)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([d.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(span))])
    arrow_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for group in _groups(batches, "text", files):
            for b, r in zip(group, search_many([b.column("text") for b in group], files, shard_words)):
                spans = [[{"start": s, "end": e} for s, e in x] for x in r["spans"]]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(r["n_words"], pa.int64()), pa.array(r["n_hit"], pa.int64()), pa.array([sorted(x) for x in r["items"]], pa.list_(pa.string())), pa.array(spans, arrow_span)],
                    names=["doc_id", "n_words", "n_hit", "items", "spans"],
                )

    return d.mapInArrow(run, schema)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without these byte spans; a line break stands where words were taken out between others."""
    raw, out, at = text.encode(), [], 0
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    out.append(raw[at:])
    return b"\n".join(out).decode()


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` with the removal spans cut from the texts; documents left without a word go.

    A cut can bring words together that form a phrase anew, so a cut text is searched again until none is found.
    Texts without a hit stay as they are, also those without words.
    """
    files = prepare_phrases(benchmark, window)

    def run(batches):
        for b, r in ((b, r) for group in _groups(batches, text_col, files) for b, r in zip(group, search_many([b.column(text_col) for b in group], files))):
            changed = [i for i, x in enumerate(r["spans"]) if x]
            if changed:
                texts, keep = b.column(text_col).to_pylist(), np.ones(b.num_rows, bool)
                todo, spans = changed, {i: r["spans"][i] for i in changed}
                while todo:
                    for i in todo:
                        texts[i] = cut_spans(texts[i], spans[i])
                    again = search_texts(pa.array([texts[i] for i in todo], pa.string()), files)
                    for i, words in zip(todo, again["n_words"]):
                        keep[i] = words > 0
                    spans = {i: s for i, s in zip(todo, again["spans"]) if s}
                    todo = list(spans)
                k = b.schema.get_field_index(text_col)
                b = b.set_column(k, b.schema.field(k), pa.array(texts, b.schema.field(k).type)).filter(pa.array(keep))
            yield b

    return docs.mapInArrow(run, docs.schema)


def contamination_digest(found: DataFrame) -> DataFrame:
    """The columns of the query: counts, the digest of the item list, the flag."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
