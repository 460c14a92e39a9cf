"""Byte-level BPE as Spark jobs: learn merges (T3), encode (T4, T6, T7), decode (T5), save/load.

Learning works on the distinct pre-token table ``(word array<int>, n bigint)``,
never on documents. The driver keeps a bounded queue of the most frequent pairs. Every round takes its first
candidates, accepts those that merging one at a time
would also pick in that order (see ``_accept_batch``), and one job makes them in the tasks and brings back what they
change of the counts. A round is a single stage over blocks of words in a persisted RDD (``_Blocks``), as its time is that of planning and starting it; the blocks
are checkpointed to the shared folder every few rounds, which cuts lineage and survives lost executors.

The model (vocabulary and ordered merges, bounded by ``vocab_size``) and the queue are
the only state held on the driver.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEFAULT_VOCAB_SIZE, SPECIAL_TOKENS
from ..session import checkpoint_dir, file_store, materialize, remove_table, scratch_path
from .pieces import PieceEncoder, encode_batch
from .pretoken import piece_list, pretokens

_SHIFT = 1 << 32
#: Distinct words a task takes at least; a round is a short job, whose time is that of starting tasks. Words of a block.
WORDS_A_TASK, WORDS_A_BLOCK = 10_000, 1 << 17
#: With more tasks than this, what they found is summed in the tasks before the driver gets it.
TOLD_TASKS = 16


def byte_to_char() -> dict[int, str]:
    """The reversible byte -> printable character map of byte-level BPE (GPT-2 rule).

    Printable Latin-1 bytes map to themselves; the other 68 bytes map, in byte
    order, to code points 256, 257, ...
    """
    keep = (
        list(range(ord("!"), ord("~") + 1))
        + list(range(ord("¡"), ord("¬") + 1))
        + list(range(ord("®"), ord("ÿ") + 1))
    )
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


def word_bytes(piece) -> Column:
    """UTF-8 bytes of a string as ``array<int>`` (0..255), built JVM-side."""
    h = F.hex(F.encode(piece if isinstance(piece, Column) else F.col(piece), "UTF-8"))
    return F.transform(F.regexp_extract_all(h, F.lit("(..)"), 1), lambda x: F.conv(x, 16, 10).cast("int"))


@dataclass
class BpeModel:
    """Vocabulary (id -> token string of byte characters) and merges in rank order."""

    vocab: list[str]
    merges: list[tuple[int, int, int]] = field(default_factory=list)  # (left, right, out)
    specials: list[str] = field(default_factory=lambda: list(SPECIAL_TOKENS))

    def token_id(self) -> dict[str, int]:
        ids: dict[str, int] = {}
        for i, t in enumerate(self.vocab):
            ids.setdefault(t, i)
        return ids

    def vocab_frame(self, spark: SparkSession) -> DataFrame:
        b2c = byte_to_char()
        c2b = {c: b for b, c in b2c.items()}
        rows = []
        for i, tok in enumerate(self.vocab):
            special = i < len(self.specials)
            hexs = "" if special else "".join(f"{c2b[ch]:02X}" for ch in tok)
            rows.append((i, tok, hexs, special))
        return spark.createDataFrame(rows, "id int, token string, hex string, special boolean")

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(r, a, b, o) for r, (a, b, o) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left int, right int, out int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Vocabulary and merges as two parquet tables."""
        self.vocab_frame(spark).write.mode("overwrite").parquet(f"{path}/vocab")
        self.merges_frame(spark).write.mode("overwrite").parquet(f"{path}/merges")

    def save_file(self, path: str) -> None:
        """The one JSON file that tokenizer libraries load (byte-level BPE; its size is that of the vocabulary)."""
        added = [{"id": i, "content": t, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True} for i, t in enumerate(self.specials)]
        level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        model = {
            "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False,
            "ignore_merges": False, "vocab": self.token_id(), "merges": [[self.vocab[a], self.vocab[b]] for a, b, _ in self.merges],
        }
        spec = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": added, "normalizer": None, "pre_tokenizer": level, "post_processor": None, "decoder": level, "model": model}
        store, name = file_store(path)
        store.create_dir(name.rpartition("/")[0], recursive=True)
        with store.open_output_stream(name, compression=None) as out:
            out.write(json.dumps(spec, ensure_ascii=False, indent=1).encode())

    @staticmethod
    def load_file(path: str) -> "BpeModel":
        """The model of a byte-level BPE file, ours or one that a library wrote; merges may be pairs or strings with a blank."""
        store, name = file_store(path)
        with store.open_input_stream(name, compression=None) as f:
            spec = json.loads(f.read())
        ids = spec["model"]["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        by_id = {i: t for t, i in (ids | added).items()}
        if sorted(by_id) != list(range(len(by_id))):
            raise ValueError("the ids of the vocabulary are not 0 .. n - 1")
        specials = [by_id[i] for i in range(len(added))]
        if set(specials) != set(added):
            raise ValueError("special tokens must have the first ids")
        return BpeModel([by_id[i] for i in range(len(by_id))], [(ids[a], ids[b], ids[a + b]) for a, b in pairs], specials)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BpeModel":
        v = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
        m = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        specials = [r.token for r in v if r.special]
        return BpeModel([r.token for r in v], [(r.left, r.right, r.out) for r in m], specials)


def word_table(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """A8 + bytes: distinct pre-tokens as byte arrays with their corpus counts."""
    pieces = texts.select(F.explode(pretokens(text_col)).alias("piece"))
    hist = pieces.groupBy("piece").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return hist.select(word_bytes("piece").alias("w"), "n")


def _before(count: int, key: tuple[int, int], bound) -> bool:
    """Whether one-at-a-time merging takes this pair before ``bound``, a ``(count, key)`` or None."""
    return bound is None or count > bound[0] or (count == bound[0] and key < bound[1])


def _accept_batch(top, near, model: BpeModel, tok_ids: dict[str, int], room: int) -> list[tuple[int, int, int]]:
    """Merges ``(left, right, out)`` that one-at-a-time merging would make next, in its order; new tokens are entered in the model.

    ``top``: [(left, right, count)] sorted by count desc, then (left, right). ``near``: ``(best, joined)`` of :func:`_triples`.
    Pairs and triples of symbols that exist never gain count. So a listed pair still has its count after some
    merges unless a triple joins it to one of them; then it has at most its count less the triple's, and is passed over.
    A merge (a, b) gives pairs (x, ab) at most the count of (x, a, b), and (ab, y) that of (a, b, y). A pair is
    accepted if it comes before all that is bounded so; at equal counts the keys decide, new symbols having
    the largest ids. After (a, a) a pair joined to it ends the batch, as the last symbol of an odd run stays. So does a merge to an id
    in use: pairs with that id may gain count.
    """
    best, joined = near
    accepted, taken, bound = [], set(), None
    for left, right, count in top:
        key = (left, right)
        if len(accepted) >= room or not _before(count, key, bound):
            break
        meets = [(o, c) for o, c in joined.get(key, ()) if o in taken]
        if any(a == b for (a, b), _ in meets):
            break
        lost = max((c for _, c in meets), default=0)
        news = [(count - lost, key)]
        if not lost:
            tok = model.vocab[left] + model.vocab[right]
            out = tok_ids.get(tok)
            reused = out is not None
            if not reused:
                out = tok_ids[tok] = len(model.vocab)
                model.vocab.append(tok)
            accepted.append((left, right, out))
            taken.add(key)
            if reused:
                break
            before, after = best.get(key, (None, None))
            news = [(c, (o, out)) for c, o in filter(None, [before])] + [(c, (out, o)) for c, o in filter(None, [after])]
        for new in news:
            if _before(*new, bound):
                bound = new
    return accepted


class _Words:
    """The words of an Arrow batch as one array of symbols with offsets; pairs are keyed ``left << 32 | right``."""

    def __init__(self, flat: np.ndarray, off: np.ndarray, n: np.ndarray):
        self.flat, self.off, self.n = flat, off, n

    @staticmethod
    def of(batch: pa.RecordBatch) -> "_Words":
        w = batch.column("w")
        off = np.concatenate([[0], np.cumsum(np.asarray(w.value_lengths(), dtype=np.int64))])
        return _Words(np.asarray(w.flatten()).astype(np.int64), off, np.asarray(batch.column("n")))

    @staticmethod
    def joined(parts: list["_Words"]) -> "_Words":
        lengths = [w.off[1:] - w.off[:-1] for w in parts]
        return _Words(np.concatenate([w.flat for w in parts]), np.concatenate([[0], np.cumsum(np.concatenate(lengths))]), np.concatenate([w.n for w in parts]))

    def keys(self) -> np.ndarray:
        """The key of the pair that begins at each place, -1 at the last place of a word."""
        out = np.full(len(self.flat), -1, np.int64)
        out[:-1] = self.flat[:-1] << 32 | self.flat[1:]
        ends = self.off[1:] - 1
        out[ends[self.off[1:] > self.off[:-1]]] = -1
        return out

    def at(self, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of pairs among ``wanted`` (sorted), and their numbers in it."""
        lefts = wanted >> 32
        flags = np.zeros(int(lefts[-1]) + 1, bool)
        flags[lefts] = True
        # most places are told by their left symbol
        place = np.flatnonzero((keys >= 0) & (self.flat < len(flags)))
        place = place[flags[self.flat[place]]]
        found = keys[place]
        number = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
        same = wanted[number] == found
        return place[same], number[same]

    def counts(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pair keys in the flagged words and the words' counts, one entry a place."""
        lengths = self.off[1:] - self.off[:-1]
        keys = self.keys()
        keep = np.repeat(rows, lengths) & (keys >= 0)
        return keys[keep], np.repeat(self.n, lengths)[keep]

    def merge(self, wanted: np.ndarray, outs: np.ndarray) -> np.ndarray:
        """Make the merges of a batch; flags of the words that changed. Accepted pairs overlap only with themselves: of a run of one symbol every second place counts."""
        place, number = self.at(self.keys(), wanted)
        run = np.arange(len(place)) - np.maximum.accumulate(np.where(np.diff(place, prepend=-2) > 1, np.arange(len(place)), 0)) if len(place) else place
        place, number = place[run % 2 == 0], number[run % 2 == 0]
        changed = np.zeros(len(self.n), bool)
        changed[np.searchsorted(self.off, place, "right") - 1] = True
        keep = np.ones(len(self.flat), bool)
        keep[place + 1] = False
        self.flat[place] = outs[number]
        self.flat = self.flat[keep]
        self.off = np.concatenate([[0], np.cumsum(keep)])[self.off]
        return changed

    def subset(self, rows: np.ndarray) -> "_Words":
        """The flagged words."""
        lengths = self.off[1:] - self.off[:-1]
        return _Words(self.flat[np.repeat(rows, lengths)], np.concatenate([[0], np.cumsum(lengths[rows])]), self.n[rows])

    def open(self) -> "_Words":
        """The words of several symbols; one symbol has no pair to merge."""
        return self.subset(self.off[1:] - self.off[:-1] > 1)

    def triples(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every place of an asked pair with a neighbour ``o`` in the word, as ``code << 32 | o``, and the word's count; the code is twice the pair's number, plus 1 where the neighbour comes after it."""
        place, number = self.at(self.keys(), asked)
        word = np.searchsorted(self.off, place, "right") - 1
        codes, n = [], []
        for side, beside, inside in ((0, place - 1, place > self.off[word]), (1, place + 2, place + 2 < self.off[word + 1])):
            codes.append((2 * number[inside] + side) << 32 | self.flat[beside[inside]])
            n.append(self.n[word[inside]])
        return np.concatenate(codes), np.concatenate(n)

    def batch(self) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(self.off, pa.int32()), pa.array(self.flat, pa.int32()))
        return pa.RecordBatch.from_arrays([lists, pa.array(self.n, pa.int64())], names=["w", "n"])


def _sums(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    if not len(k):
        return k, c
    order = np.argsort(k)
    k = k[order]
    first = np.flatnonzero(np.diff(k, prepend=k[0] - 1))
    return k[first], np.add.reduceat(c[order], first)


def _tables(pending) -> list[tuple[np.ndarray, np.ndarray]]:
    """Batches of merges as sorted keys with their new symbols."""
    out = []
    for merges in pending:
        t = sorted((a << 32 | b, o) for a, b, o in merges)
        out.append((np.array([k for k, _ in t], np.int64), np.array([o for _, o in t], np.int64)))
    return out


def _rewritten(words: DataFrame, pending) -> DataFrame:
    """The words after some batches of merges."""
    tables = _tables(pending)

    def run(batches):
        for b in batches:
            w = _Words.of(b)
            for t in tables:
                w.merge(*t)
            yield w.open().batch()

    return words.mapInArrow(run, "w array<int>, n long")


def _pair_histogram(words: DataFrame) -> DataFrame:
    """Weighted count ``(k, c)`` of every adjacent symbol pair, keyed ``left << 32 | right``; summed in each Arrow batch first."""

    def run(batches):
        for b in batches:
            w = _Words.of(b)
            if len(w.n):
                k, c = _sums(*([x] for x in w.counts(np.ones(len(w.n), bool))))
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["k", "c"])

    return words.mapInArrow(run, "k long, c long").groupBy("k").agg(F.sum("c").alias("c"))


def pair_histogram(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """A9 over texts: ``(left, right, n)`` of every pair of adjacent bytes inside pre-tokens."""
    k = F.col("k")
    pairs = _pair_histogram(word_table(texts, text_col))
    return pairs.select(F.shiftright(k, 32).cast("int").alias("left"), k.bitwiseAND(F.lit(_SHIFT - 1)).cast("int").alias("right"), F.col("c").alias("n"))


class _Queue:
    """Counts of the pairs the driver keeps, largest first: a heap whose stale entries are dropped when they come up."""

    def __init__(self, rows):
        self.counts = {k: c for k, c in rows}
        self.heap = [(-c, k) for k, c in rows]
        heapq.heapify(self.heap)

    def add(self, key: int, change: int, fresh: bool) -> None:
        """A change of a kept pair's count; other pairs are only taken up when ``fresh``."""
        if key in self.counts or fresh:
            c = self.counts.get(key, 0) + change
            if c > 0:
                self.counts[key] = c
                heapq.heappush(self.heap, (-c, key))
            else:
                self.counts.pop(key, None)

    def first(self, n: int, above: int) -> list[tuple[int, int, int]]:
        """The first ``n`` pairs ``(left, right, count)`` with more than ``above``, ties by the pair's ids."""
        if len(self.heap) > 3 * len(self.counts) + (1 << 14):
            self.__init__(list(self.counts.items()))
        out, seen = [], set()
        while self.heap and len(out) < n and -self.heap[0][0] > above:
            c, k = heapq.heappop(self.heap)
            if self.counts.get(k) == -c and k not in seen:
                seen.add(k)
                out.append((k >> 32, k & (_SHIFT - 1), -c))
        for left, right, c in out:
            heapq.heappush(self.heap, (-c, left << 32 | right))
        return out

    def keep(self, n: int) -> int:
        """With a quarter more pairs than ``n``, leave the ``n`` largest; returns the largest count that went (0 where none did)."""
        if len(self.counts) <= n + n // 4:
            return 0
        keys, counts = (np.fromiter(x, np.int64, len(self.counts)) for x in (self.counts.keys(), self.counts.values()))
        order = np.argpartition(-counts, n)
        self.__init__(list(zip(keys[order[:n]].tolist(), counts[order[:n]].tolist())))
        return int(counts[order[n]])


def _has(k: np.ndarray, symbols) -> np.ndarray:
    return np.isin(k >> 32, symbols) | np.isin(k & (_SHIFT - 1), symbols)


def _is_new(k: np.ndarray, fresh_id: int) -> np.ndarray:
    return np.maximum(k >> 32, k & (_SHIFT - 1)) >= fresh_id


def _is_link(triple: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Whether a triple (a, b, y) joins the asked pair (a, b) to the asked pair (b, y)."""
    code = triple >> 32
    return (code & 1 == 1) & np.isin((asked[code >> 1] & (_SHIFT - 1)) << 32 | triple & (_SHIFT - 1), asked)


def _found(blocks: Iterator[_Words], pending, known: np.ndarray | None, fresh_id: int, again: list[int], asked: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """What a task tells of a round, sums by key: what the last batch changes (of ``known`` pairs, None for all, and of new ones), whole counts of pairs with a symbol of ``again``, and triples of asked pairs."""
    none = np.zeros(0, np.int64)
    tables = _tables(pending)
    changed, whole, triples = ([none], [none]), ([none], [none]), ([none], [none])

    def put(to, k, c):
        k, c = _sums([k], [c])
        to[0].append(k)
        to[1].append(c)

    for w in blocks:
        for t in tables[:-1]:
            w.merge(*t)
        if tables:
            old = _Words(w.flat.copy(), w.off, w.n)
            rows = w.merge(*tables[-1])
            ones = np.ones(int(rows.sum()), bool)
            (k0, c0), (k1, c1) = old.subset(rows).counts(ones), w.subset(rows).counts(ones)
            k, c = _sums([k0, k1], [-c0, c1])
            keep = c != 0
            if known is not None:
                is_known = known[np.minimum(np.searchsorted(known, k), len(known) - 1)] == k if len(known) else np.zeros(len(k), bool)
                keep &= is_known | _is_new(k, fresh_id)
            put(changed, k[keep], c[keep])
        if again:
            k, c = w.counts(np.ones(len(w.n), bool))
            has = _has(k, again)
            put(whole, k[has], c[has])
        if len(asked):
            put(triples, *w.triples(asked))
    return [_sums(*changed), _sums(*whole), _sums(*triples)]


def _together(told: list[list[tuple[np.ndarray, np.ndarray]]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The sums by key of what tasks found."""
    return [_sums(*zip(*tables)) for tables in zip(*told)]


class _Blocks:
    """The word table as blocks of numpy arrays in a persisted RDD, with the batches of merges made since; every ``keep_batches`` batches the blocks are made anew and checkpointed."""

    def __init__(self, words: DataFrame, parts: int, keep_batches: int):
        def run(batches):
            rows, size = [], 0
            for b in batches:
                rows.append(_Words.of(b))
                size += b.num_rows
                if size >= WORDS_A_BLOCK:
                    yield pa.RecordBatch.from_pylist([packed(rows)])
                    rows, size = [], 0
            if size:
                yield pa.RecordBatch.from_pylist([packed(rows)])

        def packed(rows):
            w = _Words.joined(rows)
            return {"flat": w.flat.astype("<i4").tobytes(), "off": w.off.astype("<i8").tobytes(), "n": w.n.astype("<i8").tobytes()}

        checkpoint_dir(words.sparkSession)
        rows = words.repartition(parts).mapInArrow(run, "flat binary, off binary, n binary").rdd
        self.rdd = rows.map(lambda r: (np.frombuffer(r.flat, "<i4"), np.frombuffer(r.off, "<i8"), np.frombuffer(r.n, "<i8"))).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts, self.keep_batches, self.pending, self.before = parts, keep_batches, [], None

    def made(self, batch) -> None:
        """The next round makes this batch."""
        if len(self.pending) >= self.keep_batches:
            tables = _tables(self.pending)

            def run(blocks):
                for flat, off, n in blocks:
                    w = _Words(flat.astype(np.int64), off, n)
                    for t in tables:
                        w.merge(*t)
                    w = w.open()
                    yield w.flat.astype(np.int32), w.off, w.n

            self.drop(self.before)
            self.before, self.rdd, self.pending = self.rdd, self.rdd.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK), []
            self.rdd.checkpoint()
        self.pending.append(batch)

    @staticmethod
    def drop(rdd) -> None:
        if rdd is not None:
            rdd.unpersist()
            if path := rdd.getCheckpointFile():
                remove_table(path)

    def close(self) -> None:
        self.drop(self.before)
        self.drop(self.rdd)

    def round(self, queue: "_Queue", above: int, fresh_id: int, again: list[int], ask: list[tuple[int, int]]):
        """One job: make the last batch of merges, and return ``(changes, totals, best, joined)``.

        ``changes``: what the batch changes of the counts, ``(pair, change)``, of the kept pairs and of pairs with a new symbol (``fresh_id``
        or later) that have more than ``above``. ``totals``: the counts of pairs with a symbol of ``again``. ``best`` and ``joined`` tell of the words after it: of the triples (x, a, b) and (a, b, y) of each asked pair
        the most frequent as ``(count, x or y)``, the smallest symbol at equal counts, and the asked pairs that a triple joins to it, with the triple's count.
        """
        asked = np.array(sorted(a << 32 | b for a, b in ask), np.int64)
        pending = list(self.pending)
        known = self.rdd.context.broadcast(np.sort(np.fromiter(queue.counts, np.int64, len(queue.counts)))) if above and pending else None

        def run(blocks):
            words = (_Words(flat.astype(np.int64), off, n) for flat, off, n in blocks)
            yield _found(words, pending, None if known is None else known.value, fresh_id, again, asked)

        told = self.rdd.mapPartitions(run)
        found = told.treeReduce(lambda a, b: _together([a, b])) if self.parts > TOLD_TASKS else _together(told.collect())
        if known is not None:
            known.destroy()
        (k, d), (of, total), (triple, c) = found
        keep = (d != 0) & (~_is_new(k, fresh_id) | (d > above))
        changes = list(zip(k[keep].tolist(), d[keep].tolist()))
        best, joined = {}, {}
        if len(triple):
            code, o = triple >> 32, triple & (_SHIFT - 1)
            a, b = asked[code >> 1] >> 32, asked[code >> 1] & (_SHIFT - 1)
            order = np.lexsort((o, -c, code))
            for i in order[np.diff(code[order], prepend=-1) > 0].tolist():
                two = list(best.get((int(a[i]), int(b[i])), (None, None)))
                two[int(code[i]) & 1] = (int(c[i]), int(o[i]))
                best[int(a[i]), int(b[i])] = tuple(two)
            link = _is_link(triple, asked)
            for x, y, z, n in zip(a[link].tolist(), b[link].tolist(), o[link].tolist(), c[link].tolist()):
                joined.setdefault((x, y), []).append(((y, z), n))
                joined.setdefault((y, z), []).append(((x, y), n))
        return changes, dict(zip(of.tolist(), total.tolist())), best, joined


def _next_asked(queue: _Queue, above: int, batch, best, n: int) -> list[tuple[int, int]]:
    """Pairs that are likely to lead next: the first ones kept besides the batch's own, and the batch's new symbols with their best neighbours."""
    gone = {(a, b) for a, b, _ in batch}
    ask = {(a, b) for a, b, _ in queue.first(n + len(gone), above)} - gone
    for a, b, out in batch:
        before, after = best.get((a, b), (None, None))
        if before and before[0] > above:
            ask.add((before[1], out))
        if after and after[0] > above:
            ask.add((out, after[1]))
    return list(ask)


def learn_bpe(
    texts: DataFrame,
    vocab_size: int = DEFAULT_VOCAB_SIZE,
    *,
    text_col: str = "text",
    specials=SPECIAL_TOKENS,
    max_batch: int = 1024,
    top_k: int = 1 << 16,
    bounded: int = 1024,
    keep_batches: int = 8,
    progress=None,
) -> BpeModel:
    """Learn byte-level BPE merges until ``vocab_size`` or no pair remains.

    ``max_batch=1`` gives the one-merge-per-round reference mode used by tests.
    The driver keeps the ``top_k`` most frequent pairs (a bound, whatever the corpus) in a queue, with exact counts. All other pairs have at most the count
    ``above`` and can't gain any; so the order of merges is known down to that count, and a round is one job: the tasks make the accepted merges, and return what
    changed of the kept pairs, new pairs beyond ``above``, and the triples around the pairs that are likely to lead next. Where a symbol in use is made again its pairs may gain; then
    the tasks return their whole counts. The full histogram is
    only made at the start and when the queue has come down to ``above``. ``bounded`` pairs can be accepted together; none of these numbers changes the
    result. Ties between equal counts go to the smallest (left id, right id).
    The blocks of words are made anew after every ``keep_batches`` rounds, until then the tasks make the batches of merges since then; the ones before are deleted when
    the next ones are there. ``progress(round, tokens)`` is called after every round.
    """
    spark = texts.sparkSession
    b2c = byte_to_char()
    words = materialize(word_table(texts, text_col), "bpe-words")
    seen = [r.b for r in words.select(F.explode("w").alias("b")).distinct().collect()]  # <= 256 rows
    alphabet = sorted(seen, key=lambda b: ord(b2c[b]))
    vocab = list(specials) + [b2c[b] for b in alphabet]
    ids = {t: i for i, t in enumerate(vocab)}
    byte_id = {b: ids[b2c[b]] for b in alphabet}
    m = F.map_from_arrays(
        F.array(*[F.lit(b) for b in alphabet]), F.array(*[F.lit(byte_id[b]) for b in alphabet])
    )
    parts = max(1, min(spark.sparkContext.defaultParallelism, words.count() // WORDS_A_TASK + 1))

    def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    words, path = written(
        words.select(F.transform("w", lambda b: F.element_at(m, b)).alias("w"), "n").where(F.size("w") > 1), "bpe-words"
    )
    model = BpeModel(vocab, [], list(specials))
    tok_ids = model.token_id()
    pending: list[list[tuple[int, int, int]]] = []  # all since ``words`` was written
    queue, blocks, above, best, joined, asked = None, None, 0, {}, {}, set()
    reach, rounds = 256, 0
    while len(model.vocab) < vocab_size:
        room = vocab_size - len(model.vocab)
        top = [] if queue is None else queue.first(min(room, max_batch, bounded, reach), above)
        if not top:
            if queue is not None and not above:
                break
            if blocks is not None:
                blocks.close()
            if pending:
                words, path, pending = _rewrite(words, pending, path, written)
            rows = _pair_histogram(words).orderBy(F.col("c").desc(), F.col("k").asc()).limit(top_k + 1).collect()
            # of pairs with the count of the first one left out the keys are not all known
            queue, above = _Queue([(r.k, r.c) for r in rows[:top_k]]), rows[top_k].c if len(rows) > top_k else 0
            top = queue.first(min(room, max_batch, bounded, reach), above)
            if not top and rows:  # more pairs with one count than are kept
                top_k *= 4
                queue, blocks, above = None, None, 0
                continue
            blocks, asked = None, set()
            if not top:
                break
            blocks = _Blocks(words, parts, keep_batches)
            if len(top) > 1:
                asked = {t[:2] for t in top}
                _, _, best, joined = blocks.round(queue, above, 0, [], list(asked))
        # the first pair needs no triples; the others do
        at = next((i for i, t in enumerate(top) if t[:2] not in asked), len(top))
        top = top[: max(1, at)]
        fresh_id = len(model.vocab)
        batch = _accept_batch(top, (best, joined), model, tok_ids, min(room, max_batch))
        model.merges += batch
        pending.append(batch)
        reach, rounds = max(256, 4 * len(batch)), rounds + 1
        if progress:
            progress(rounds, len(model.vocab))
        if len(model.vocab) >= vocab_size:
            break
        ask = _next_asked(queue, above, batch, best, min(max_batch, bounded, reach)) if max_batch > 1 else []
        again = [out for _, _, out in batch if out < fresh_id]
        blocks.made(batch)
        changes, totals, best, joined = blocks.round(queue, above, fresh_id, again, ask)
        asked = set(ask)
        for k, d in changes:
            queue.add(k, d, max(k >> 32, k & (_SHIFT - 1)) >= fresh_id)
        if again:  # pairs with a symbol in use may gain count
            for k in [k for k in queue.counts if k >> 32 in again or k & (_SHIFT - 1) in again]:
                queue.add(k, totals.pop(k, 0) - queue.counts[k], False)
            for k, c in totals.items():
                queue.add(k, c, c > above)
        above = max(above, queue.keep(4 * top_k))
    if blocks is not None:
        blocks.close()
    remove_table(path)
    return model


def _rewrite(words: DataFrame, pending, path: str, written):
    """The word table after its batches of merges, written; the one before is deleted."""
    words, after = written(_rewritten(words, pending), "bpe-words")
    remove_table(path)
    return words, after, []


# ---------------------------------------------------------------- encoding


def encode_documents(df: DataFrame, model: BpeModel, key_col: str, text_col: str = "text") -> DataFrame:
    """``(key, ids array<bigint>)`` for every document, in the scan that reads it.

    Texts are cut at special tokens (T2) and into pieces (T1) by SQL functions; the pieces of an Arrow batch
    are encoded once each, with the ones a task has met lately kept. Special tokens map
    straight to their ids; bytes never seen in training have no id and are dropped, as in the
    original. Nothing is shuffled, so no piece is a hot key. A null text has no ids (the original fails on one).
    """
    b2c = byte_to_char()
    tok_ids = model.token_id()
    byte_ids = {b: tok_ids[c] for b, c in b2c.items() if c in tok_ids}
    special_ids = {t: tok_ids[t] for t in model.specials}
    merges = list(model.merges)
    d = df.select(F.col(key_col), F.coalesce(piece_list(text_col), F.array().cast("array<string>")).alias("_pieces"))

    def run(batches):
        encoder = PieceEncoder(byte_ids, merges, special_ids)
        for b in batches:
            yield encode_batch(b, key_col, "_pieces", encoder)

    return d.mapInArrow(run, f"`{key_col}` {df.schema[key_col].dataType.simpleString()}, ids array<bigint>")


def decode_documents(df: DataFrame, model: BpeModel, key_col: str, ids_col: str = "ids") -> DataFrame:
    """T5: ids -> token bytes -> UTF-8 text; special tokens and unknown ids are skipped.

    The vocabulary (bounded by its size) is one folded literal, so decoding is a projection. Invalid UTF-8 (a cut
    multi-byte char) decodes to U+FFFD.
    """
    c2b = {c: b for b, c in byte_to_char().items()}
    skip = len(model.specials)
    hexes = ["" if i < skip else "".join(f"{c2b[ch]:02X}" for ch in tok) for i, tok in enumerate(model.vocab)]
    tokens = F.split(F.lit(",".join(hexes)), ",")
    raw = F.array_join(F.transform(ids_col, lambda x: F.coalesce(F.get(tokens, x.cast("int")), F.lit(""))), "")
    return df.select(key_col, F.coalesce(F.make_valid_utf8(F.unhex(raw).cast("string")), F.lit("")).alias("text"))


def encode_gated(
    df: DataFrame, model: BpeModel, key_col: str, text_col: str = "text", *, keep_rejected: bool = False
) -> DataFrame:
    """Length gate on the raw text, strip, encode, append the end id; ``(key, ids, n_tokens)``.

    Rejected documents are dropped, or kept with null ids and 0 tokens when ``keep_rejected``.
    """
    from ..constants import EOD_ID
    from ..functions import text as TX

    ok = df.where(TX.length_gate(text_col)).select(key_col, TX.strip(text_col).alias(text_col))
    enc = encode_documents(ok, model, key_col, text_col)
    enc = enc.select(key_col, F.concat("ids", F.array(F.lit(EOD_ID).cast("bigint"))).alias("ids"))
    enc = enc.withColumn("n_tokens", F.size("ids").cast("bigint"))
    if not keep_rejected:
        return enc
    return df.select(key_col).join(enc, key_col, "left").select(
        key_col, "ids", F.coalesce("n_tokens", F.lit(0).cast("bigint")).alias("n_tokens")
    )
