"""Phrase collocation mining (dealt operator 13): Misra-Gries summaries per hash partition, then exact counts.

Words are lower-cased (A-Z), texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs into
words. A phrase is one to four consecutive words of a piece in one language; phrases of two words and more with at
least ``threshold`` occurrences are candidates.

* First pass. A task counts the hashed phrases of a slice of text and deals the counts into hash partitions by the
  top bits, one packed summary (sorted key remainders and counts) a partition. Such a summary is exact, so it is a
  Misra-Gries summary without error, and summaries merge: counts are added, and beyond the capacity the count
  after the last that fits is taken off all, the ones that reach zero go. A partition of mass ``M`` (all its occurrences;
  the masses come before the summaries in its stream) has capacity ``M // threshold + 1``. Each unit taken off removes more than capacity units
  of mass, so at most ``M / (capacity + 1) < threshold`` is ever taken off: every phrase with ``threshold`` occurrences survives.
  Keys that share a hash only add up, which cannot lose one.
* Second pass. The survivors set bits in a bitmap (about 16 bits a survivor, ``2 ** filter_bits`` at most, each hash partition its own part); the texts are read again,
  phrases outside it are passed over, and the others are counted by their words. What the bitmap lets through by chance is dropped by the exact
  count. Beyond a survivor for four bits the bitmap alone would let too much through, and the phrases also join the survivors' keys.
* Scores are exact decimals. Cuts and contained phrases are looked up by joins of the frequent phrases alone.

Nothing but the bitmap (bounded) reaches the driver, and a task holds one slice's counts or one partition's summary.

Defined results: null text counts as empty; null language is ``und``; repeated rows count each; empty tables, and
tables without a frequent phrase, give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import digest64, fold_ascii, mix64, shuffle_partitions, small_batches, span_ids, utf8_column, word_spans

LONGEST = 4
THRESHOLD = 30
COVERED = 80
KEEP = 2000
SLICE_BYTES = 6 << 20
FILTER_BITS = 27
UNKNOWN = "und"

_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?"]] = True
_BREAKS[10:14] = True
_IS_WORD = ~_BREAKS
_IS_WORD[[9, 32]] = False
_FOLD = fold_ascii()
_STEP = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(LONGEST)]
_LOW = np.uint64(32)


class Words:
    """The words of a batch of texts: numbers, values, hashes, and how many words of the same piece follow each."""

    def __init__(self, texts, langs):
        data, off = utf8_column(texts)
        data = _FOLD[data]
        starts, ends, self.row = word_spans(data, off, _IS_WORD)
        self.ids, values = span_ids(data, starts, ends)
        self.values = values
        piece = np.cumsum(_BREAKS[data], dtype=np.int64)[starts] if len(starts) else np.zeros(0, np.int64)
        n = len(starts)
        # a word is the last of its run where the next stands in another piece or text
        last = np.ones(n, bool)
        last[:-1] = (piece[1:] != piece[:-1]) | (self.row[1:] != self.row[:-1])
        ends_at = np.flatnonzero(last)
        self.follow = (ends_at[np.searchsorted(ends_at, np.arange(n))] - np.arange(n)) if n else np.zeros(0, np.int64)
        coded = pc.fill_null(langs, UNKNOWN).cast(pa.string()).dictionary_encode() if len(langs) else pa.array([], pa.string()).dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        self.langs = coded.dictionary.to_pylist()
        self.lang = np.asarray(coded.indices).astype(np.int64)[self.row]
        self._hash = digest64(values.to_pylist())[self.ids] if n else np.zeros(0, np.uint64)
        self._seed = digest64([b"language:" + x.encode() for x in self.langs])[self.lang] if n else np.zeros(0, np.uint64)

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """``(starts, hashes)`` of all phrases of ``size`` words; the hash depends on the language too."""
        at = np.flatnonzero(self.follow >= size - 1)
        h = self._seed[at] + np.uint64(size)
        for k in range(size):
            h = h + self._hash[at + k] * _STEP[k]
        return at, mix64(h)

    def numbers(self, at: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the phrases at ``at``, equal for the same words in the same language and no others."""
        out = self.lang[at]
        for k in range(size):
            out = np.unique(out << 32 | self.ids[at + k], return_inverse=True)[1].reshape(-1).astype(np.int64)
        return out


# ---------------------------------------------------------------- first pass: summaries


def pack_summary(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 40-bit keys as a directory of their top eight bits and four bytes each; counts as bytes, larger ones after."""
    directory = np.bincount((keys >> _LOW).astype(np.int64), minlength=256).astype("<u4")
    large = counts >= 255
    return b"".join([np.uint32(len(keys)).tobytes(), directory.tobytes(), keys.astype("<u4").tobytes(), np.minimum(counts, 255).astype("u1").tobytes(), counts[large].astype("<u8").tobytes()])


def unpack_summary(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    directory = np.frombuffer(raw, "<u4", 256, 4)
    keys = np.frombuffer(raw, "<u4", n, 4 + 1024).astype(np.uint64) | np.repeat(np.arange(256, dtype=np.uint64), directory) << _LOW
    counts = np.frombuffer(raw, "u1", n, 4 + 1024 + 4 * n).astype(np.int64)
    large = np.flatnonzero(counts == 255)
    counts[large] = np.frombuffer(raw, "<u8", len(large), 4 + 1024 + 5 * n).astype(np.int64)
    return keys, counts


class MisraGries:
    """A summary of at most ``capacity`` keys; ``taken`` is what a key's count may lack."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge another summary; several small ones are merged at once."""
        self._waiting.append((keys, counts))
        self._size += len(keys)
        if self._size > max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self._waiting)])
        self._waiting, self._size = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first)
        if len(self.keys) > self.capacity:
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            self.taken += off
            keep = self.counts > off
            self.keys, self.counts = self.keys[keep], self.counts[keep] - off


def _partition_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> _LOW) * np.uint64(parts) >> _LOW).astype(np.int64)


_KEY = np.uint64((1 << 40) - 1)


def _summaries(docs: DataFrame, parts: int) -> DataFrame:
    """``(part, body, mass, summary)``: for every slice and hash partition its mass, and its summary."""

    def run(batches):
        for b in small_batches(batches, "text", SLICE_BYTES):
            words = Words(b.column("text"), b.column("lang"))
            found = [words.phrases(size)[1] for size in range(1, LONGEST + 1)]
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            if not len(keys):
                continue
            # hashes ascend, so partitions do; within one the keys are put in their own order
            cuts = np.searchsorted(_partition_of(keys, parts), np.arange(parts + 1))
            rows = []
            for p, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                if i < j:
                    short, first = np.unique(keys[i:j] & _KEY, return_index=True)
                    c = counts[i:j].astype(np.int64)
                    if len(short) < j - i:  # two hashes with one key
                        c = np.bincount(np.searchsorted(short, keys[i:j] & _KEY), c, len(short)).astype(np.int64)
                    else:
                        c = c[first]
                    rows.append((p, int(c.sum()), pack_summary(short, c)))
            p, m, s = zip(*rows)
            # the masses stand before the summaries when a partition is sorted
            empty, n = [None] * len(rows), len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array([0] * n, pa.int32()), pa.array(m, pa.int64()), pa.array(empty, pa.binary())], names=["part", "body", "mass", "summary"])
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array([1] * n, pa.int32()), pa.array([0] * n, pa.int64()), pa.array(s, pa.binary())], names=["part", "body", "mass", "summary"])

    return docs.mapInArrow(run, "part int, body int, mass long, summary binary")


def survivors(docs: DataFrame, threshold: int, parts: int) -> DataFrame:
    """``(part, key)``: the hash keys of all phrases that may have ``threshold`` occurrences, by partition."""

    def run(batches):
        part, mass, summary = None, 0, None

        def finished():
            if summary is None:
                return []
            summary.settle()
            keep = summary.counts + summary.taken >= threshold
            keys = summary.keys[keep].astype(np.int64)
            return [pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), part), pa.int32()), pa.array(keys, pa.int64())], names=["part", "key"])]

        for b in batches:
            for p, body, m, raw in zip(b.column("part").to_pylist(), b.column("body").to_pylist(), b.column("mass").to_pylist(), b.column("summary")):
                if p != part:
                    yield from finished()
                    part, mass, summary = p, 0, None
                if not body:
                    mass += m
                    continue
                if summary is None:
                    summary = MisraGries(mass // threshold + 1)
                summary.add(*unpack_summary(raw.as_buffer()))
        yield from finished()

    dealt = _summaries(docs, parts).repartitionById(shuffle_partitions(docs.sparkSession), F.expr(f"part % {shuffle_partitions(docs.sparkSession)}")).sortWithinPartitions("part", "body")
    return dealt.mapInArrow(run, "part int, key long")


# ---------------------------------------------------------------- second pass: exact counts


def _place(part, key, bits: int):
    """The bit of a survivor: every hash partition has ``2 ** bits`` of its own."""
    return part.astype(np.uint64) << np.uint64(bits) | mix64(key.astype(np.uint64)) & np.uint64((1 << bits) - 1)


def _bitmap(kept: DataFrame, parts: int, bits: int) -> np.ndarray:
    """The bits of all survivors; a task sets those of whole partitions, and the driver puts the partitions' bytes (of fixed size) together."""
    size = (1 << bits) // 32

    def run(batches):
        rows: dict[int, np.ndarray] = {}
        for b in batches:
            part, key = np.asarray(b.column("part")), np.asarray(b.column("key"))
            at = _place(part, key, bits) - (part.astype(np.uint64) << np.uint64(bits))
            for p in np.unique(part).tolist():
                word = rows.setdefault(p, np.zeros(size, np.uint32))
                mine = at[part == p]
                np.bitwise_or.at(word, (mine >> np.uint64(5)).astype(np.int64), np.uint32(1) << (mine & np.uint64(31)).astype(np.uint32))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array([w.tobytes() for w in rows.values()], pa.binary())], names=["part", "words"])

    out = np.zeros(parts * size, np.uint32)
    n = shuffle_partitions(kept.sparkSession)
    for r in kept.repartitionById(n, F.expr(f"part % {n}")).mapInArrow(run, "part int, words binary").toLocalIterator():
        out[r.part * size : (r.part + 1) * size] = np.frombuffer(r.words, np.uint32)
    return out


def _exact_counts(docs: DataFrame, kept: DataFrame, parts: int, filter_bits: int) -> DataFrame:
    """``(lang, phrase, words, a)`` of the phrases that the survivors' bitmap lets through, and ``(lang, null, 0, words)``."""
    many = kept.count()
    bits = max(5, min(filter_bits - (parts - 1).bit_length(), (16 * many // parts).bit_length()))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(kept, parts, bits))
    crowded = 4 * many > parts << bits

    def run(batches):
        bit = shared.value
        for b in small_batches(batches, "text", SLICE_BYTES):
            words = Words(b.column("text"), b.column("lang"))
            total = np.bincount(words.lang, minlength=len(words.langs))
            lang, phrase, size, a = [x for x, t in zip(words.langs, total) if t], [None] * int((total > 0).sum()), [0] * int((total > 0).sum()), total[total > 0].tolist()
            part, key = [0] * len(lang), [0] * len(lang)
            values = [v.decode() for v in words.values.to_pylist()]
            for n in range(1, LONGEST + 1):
                at, h = words.phrases(n)
                p, k = _partition_of(h, parts), h & _KEY
                place = _place(p, k, bits)
                here = (bit[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)
                at, p, k = at[here], p[here], k[here]
                if not len(at):
                    continue
                _, first, counts = np.unique(words.numbers(at, n), return_index=True, return_counts=True)
                ids = np.stack([words.ids[at[first] + j] for j in range(n)], axis=1).tolist()
                lang += [words.langs[x] for x in words.lang[at[first]].tolist()]
                phrase += [" ".join([values[x] for x in row]) for row in ids]
                size += [n] * len(first)
                a += counts.tolist()
                part += p[first].tolist()
                key += k[first].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(phrase, pa.string()), pa.array(size, pa.int32()), pa.array(a, pa.int64()), pa.array(part, pa.int32()), pa.array(key, pa.int64())],
                names=["lang", "phrase", "words", "a", "part", "key"],
            )

    found = docs.mapInArrow(run, "lang string, phrase string, words int, a long, part int, key long")
    if crowded:
        alone = found.filter("phrase IS NULL")
        found = found.groupBy("lang", "phrase", "words", "part", "key").agg(F.sum("a").alias("a")).join(kept, ["part", "key"], "left_semi").select("lang", "phrase", "words", "a").unionByName(alone.select("lang", "phrase", "words", "a"))
    return found.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a"))


def count_frequent_phrases(
    docs: DataFrame, threshold: int = THRESHOLD, text_col: str = "text", lang_col: str = "lang", parts: int | None = None, filter_bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """``(phrases, totals)``: ``(lang, phrase, words, a)`` of all phrases of one to four words with at least ``threshold`` occurrences, and ``(lang, n)``."""
    d = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    parts = parts or shuffle_partitions(docs.sparkSession)
    kept = materialize(survivors(d, threshold, parts), "phrase-survivors")
    counts = materialize(_exact_counts(d, kept, parts, filter_bits).filter((F.col("a") >= threshold) | F.col("phrase").isNull()), "phrase-counts")
    return counts.filter("phrase IS NOT NULL AND words > 0"), counts.filter("phrase IS NULL").select("lang", F.col("a").alias("n"))


# ---------------------------------------------------------------- collocations


def score_cuts(phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, words, a, l, r, score)`` of every candidate, by its cut of lowest score (then the first one)."""
    cand = phrases.filter("words > 1")
    cuts = cand.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).selectExpr("*", "substring_index(phrase, ' ', k) AS head", "substring_index(phrase, ' ', k - words) AS tail")
    part = lambda side, f: phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(f))
    both = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    scored = both.withColumn("score", F.expr("2000000 * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + r)"))
    best = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def without_covered(candidates: DataFrame, phrases: DataFrame, percent: int = COVERED) -> DataFrame:
    """The candidates that no longer candidate holds nearly always (``100 * f(longer) >= percent * a``)."""
    long = phrases.filter("words > 2").select("lang", "words", "a", F.split("phrase", " ").alias("w"))
    inner = long.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    most = inner.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    joined = candidates.join(most, ["lang", "phrase"], "left")
    return joined.filter(F.expr(f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(20,0)) < {percent} * CAST(a AS DECIMAL(20,0))")).drop("longer")


def mine_collocations(docs: DataFrame, threshold: int = THRESHOLD, keep: int = KEEP, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``keep`` phrases by score, occurrences and text."""
    phrases, totals = count_frequent_phrases(docs, threshold, text_col, lang_col, **options)
    left = without_covered(score_cuts(phrases), phrases)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    top = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
