"""N-gram Jaccard join by a count-vector R-tree (dealt operator 6).

A document's set holds its distinct five-word shingles; two documents link when
``100 * intersection >= 80 * union``. The join is exact; only links between different sets
are searched, equal sets are one class from the start. ``link_documents`` gives components and looks for no more links than
decide them; ``link_classes`` verifies every pair of classes that the bounds leave, and ``count_links`` counts a row's links.

* Points: the shingles are hashed into ``GROUPS`` groups; the counts of a set in them are its
  point. The overlap of two sets is at most the sum of the coordinate minima.
* Root level: with uniform groups all documents of one size lie near the same point, so boxes
  around arbitrary points can't be told apart. The tree is therefore rooted in cells: a set
  enters the cells of its ``n - ceil(0.8 n) + 1`` rarest shingles (rare by a fixed-size sketch
  of counts over all documents), and sets that link share a cell.
* Contraction: in every cell neighbours by size, and each set and the cell's smallest in ``CONTRACT_CELLS`` cells, are
  verified first. Their links already join most of large groups of copies, so no group is paired out.
* Tree: cells that still hold several components. One of up to ``PAGE`` members is a leaf; a larger
  one is packed into pages of ``PAGE`` points (sorted by component and size) with the largest
  coordinate of each group, and page pairs whose summed coordinate minima can't reach the needed
  overlap are dropped. Pairs of members must fit by size and by the places of the cell among their
  rarest shingles, then by the summed minima of their points; the exact sets of the survivors decide.
* Rounds: for components the tree's pairs are taken in rounds. A hash of a pair puts it into a round of its cell: of a cell of ``m`` members
  round 0 takes the share ``FIRST_PAIRS / m`` of the pairs, every further round ``FIRST_PAIRS`` times as much, the last one
  the rest. Only pairs of different components are looked at, and components are formed anew after a round; so a group of
  near copies grows together from few pairs of each member, and every pair that could still join two components is verified.

Defined results: null text, texts without words: empty set, linked with nothing, component
is the document itself. Fewer than five words: the whole sequence is the one shingle. Repeated
rows with one id and text fall into one class; rows that share an id but not a text are
separate nodes that report the smallest id they reach. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import fold_ascii, kept, mix64, shuffle_partitions, small_batches, small_side, span_hashes, split_by_ids, utf8_column, word_spans
from .components import connected_components

SHINGLE = 5
PERCENT = 80
GROUPS = 256
SKETCH_BITS = (22, 24)  # least and most; between them 16 slots a document
PAGE = 256
CONTRACT_CELLS = 3
FIRST_PAIRS = 8
FILTER_BITS = 24
#: Cells of a bucket, and of a task's pack of them.
POSTS = 1 << 20
#: Tables of up to so many narrow rows are sent to all executors (some 10 MB); larger ones are joined by shuffles.
MANY_ROWS = 1 << 18


def _word_bytes() -> np.ndarray:
    t = np.ones(256, bool)
    t[9:14] = t[32] = False
    return t


_IS_WORD, _FOLD = _word_bytes(), fold_ascii()
_STEP = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(SHINGLE)]


def shingle_sets(texts) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    kept("shingle_rtree")
    data, off = utf8_column(texts)
    starts, ends, row = word_spans(data, off, _IS_WORD)
    words = span_hashes(data, starts, ends, _FOLD)
    n = len(words)
    full = max(0, n - SHINGLE + 1)
    h = np.zeros(full, np.uint64)
    for k in range(SHINGLE):
        h += words[k : k + full] * _STEP[k]
    h = mix64(h)
    first = np.searchsorted(row, np.arange(len(off)))
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= SHINGLE:
            out.append(np.unique(h[a : z - SHINGLE + 1]))
        elif z > a:
            short = (words[a:z] * np.array(_STEP[: z - a])).sum(dtype=np.uint64, keepdims=True)
            out.append(mix64(short + np.array([z - a], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class_of(s: np.ndarray) -> int:
    """A number for the set, equal for equal sets."""
    total = mix64(s * _STEP[1]).sum(dtype=np.uint64, keepdims=True)
    return int(mix64(total + np.array([len(s)], np.uint64)).view(np.int64)[0])


def _point(s: np.ndarray) -> bytes:
    """The counts of a set's shingles in the groups, one, two or four bytes each as the largest needs."""
    counts = np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    return counts.astype("<u1" if counts.max() < 1 << 8 else "<u2" if counts.max() < 1 << 16 else "<u4").tobytes()


def _coordinates(points: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(p, f"<u{len(p) // GROUPS}").astype(np.uint32) for p in points])


def _sketch(docs: DataFrame, bits: int) -> np.ndarray:
    """Rarity level (0..255) of every hash group, from counts over all sets; its size is ``2**bits`` bytes.

    Each task counts its sets in one array and passes it on in 64 segments that are added up; a slot counts up to 255 a task, as what matters is how rare the rare ones are.
    """
    segments, width = 64, (1 << bits) // 64
    text = docs.columns[0]

    def count(batches):
        total, seen = np.zeros(1 << bits, np.uint32), set()
        for b in small_batches(batches, text):
            sets = [s for s in shingle_sets(b.column(text)) if len(s)]
            fresh = []
            for s in sets:
                c = _class_of(s)
                if c not in seen:
                    seen.add(c)
                    fresh.append(s)
            if fresh:
                slots, times = np.unique(np.concatenate(fresh) >> np.uint64(64 - bits), return_counts=True)
                total[slots.astype(np.int64)] += times.astype(np.uint32)
        if seen:
            short = np.minimum(total, 255).astype(np.uint8)
            parts = [short[i * width : (i + 1) * width].tobytes() for i in range(segments)]
            yield pa.RecordBatch.from_arrays([pa.array(range(segments), pa.int32()), pa.array(parts, pa.binary())], names=["segment", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, raw in zip(b.column("segment").to_pylist(), b.column("counts")):
                part = np.frombuffer(raw.as_buffer(), np.uint8)
                sums[k] = sums[k] + part if k in sums else part.astype(np.int64)
        if sums:
            levels = [np.minimum(255, np.floor(4 * np.log2(v + 1))).astype(np.uint8).tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["segment", "levels"])

    counted = docs.mapInArrow(count, "segment int, counts binary").repartition(min(segments, shuffle_partitions(docs.sparkSession)), "segment")
    out = np.zeros(1 << bits, np.uint8)
    for r in counted.mapInArrow(add, "segment int, levels binary").collect():
        out[r.segment * width : (r.segment + 1) * width] = np.frombuffer(r.levels, np.uint8)
    return out


def _index(docs: DataFrame, levels, bits: int) -> DataFrame:
    """``(doc_id, key, n, cls, cells, point)``: set size, class, the keys of the rarest shingles (null where a task saw the class before), group counts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        seen, level = set(), levels.value
        for b in small_batches(batches, "text"):
            ns, cs, cells, points = [], [], [], []
            for s in shingle_sets(b.column("text")):
                ns.append(len(s))
                if not len(s):
                    cs.append(None)
                    cells.append(None)
                    points.append(None)
                    continue
                c = _class_of(s)
                cs.append(c)
                points.append(_point(s))
                if c in seen:
                    cells.append(None)
                    continue
                seen.add(c)
                key = (level[(s >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                take = len(s) - (PERCENT * len(s) + 99) // 100 + 1
                cells.append(np.sort(np.partition(key, take - 1)[:take] if take < len(key) else key).view(np.int64))
            lengths = np.array([0 if x is None else len(x) for x in cells])
            flat = np.concatenate([x for x in cells if x is not None]) if lengths.any() else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(ns, pa.int64()), pa.array(cs, pa.int64()), lists, pa.array(points, pa.binary())], names=["doc_id", "key", "n", "cls", "cells", "point"])

    return docs.mapInArrow(run, f"doc_id {id_type}, key long, n long, cls long, cells array<long>, point binary")


#: Whether two members can still reach the needed overlap if this cell is their first common one (it is for some cell of every link).
_REACH = f"(1 + least(n - pos, {{0}}.n - {{0}}.pos) - 1) * {100 + PERCENT} >= (n + {{0}}.n) * {PERCENT}"


def _planes(a: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: the bytes that are mostly alike compress."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _numbers(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _posts(index: DataFrame, buckets: int) -> DataFrame:
    """The cells of all sets dealt by a hash into buckets: ``(bucket, cells, pos, cls, n, times)`` holds what some hundred thousand cells of a task put into one, sets with their class and size once each."""

    def out(rows):
        cells = np.concatenate([c for _, _, c in rows])
        lengths = np.array([len(c) for _, _, c in rows])
        of = np.repeat(np.arange(len(rows)), lengths)
        pos = np.arange(len(cells)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        bucket = (mix64(cells.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        n, cls = np.array([x[0] for x in rows], "<i8"), np.array([x[1] for x in rows], "<i8")
        got = []
        for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            sets, times = np.unique(of[at], return_counts=True)
            got.append({"bucket": int(bucket[at[0]]), "cells": _planes(cells[at]), "pos": _planes(pos[at].astype("<i4")), "cls": _planes(cls[sets]), "n": _planes(n[sets]), "times": _planes(times.astype("<i4"))})
        return pa.RecordBatch.from_pylist(got, schema=schema)

    def run(batches):
        rows, size = [], 0
        for b in batches:
            cells = b.column("cells")
            flat, lengths = np.asarray(cells.flatten()).astype("<i8"), np.asarray(pc.fill_null(pc.list_value_length(cells), 0))
            ends = np.cumsum(lengths)
            for i in np.flatnonzero(lengths).tolist():
                rows.append((b.column("n")[i].as_py(), b.column("cls")[i].as_py(), flat[ends[i] - lengths[i] : ends[i]]))
                size += int(lengths[i])
                if size >= POSTS:
                    yield out(rows)
                    rows, size = [], 0
        if size:
            yield out(rows)

    blobs = ("cells", "pos", "cls", "n", "times")
    schema = pa.schema([("bucket", pa.int64())] + [(k, pa.binary()) for k in blobs])
    return index.select("n", "cls", "cells").mapInArrow(run, "bucket long, " + ", ".join(f"{k} binary" for k in blobs))


def _neighbours(index: DataFrame) -> DataFrame:
    """Members of cells with several classes, each with its neighbour by size and the smallest of the cell; ``pos``: the cell's place among the set's rarest.

    Most cells have one member; the cells are shuffled packed, a bucket (``POSTS`` cells or so) is sorted in one array, and only members of cells with several classes come out as rows.
    """
    total = index.agg(F.sum(F.size(F.coalesce("cells", F.array().cast("array<bigint>"))))).first()[0] or 0
    tasks = shuffle_partitions(index.sparkSession)
    kinds = {"cells": "<i8", "pos": "<i4", "cls": "<i8", "n": "<i8", "times": "<i4"}

    def out(parts):
        cell, pos, cls, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((pos, cls, n, cell))
        cell, pos, cls, n = cell[order], pos[order], cls[order], n[order]
        # copies of a class from several tasks stand next to each other: only the first counts
        keep = np.concatenate([[True], (cell[1:] != cell[:-1]) | (cls[1:] != cls[:-1])])
        cell, pos, cls, n = cell[keep], pos[keep], cls[keep], n[keep]
        first = np.concatenate([[True], cell[1:] != cell[:-1]])
        start = np.flatnonzero(first)
        lengths = np.diff(np.append(start, len(cell)))
        many = np.repeat(lengths > 1, lengths)
        at = np.flatnonzero(many)
        least, before = np.repeat(start, lengths)[many], np.maximum(at - 1, 0)

        def member(rows, mask=None):
            return pa.StructArray.from_arrays([pa.array(cls[rows]), pa.array(n[rows]), pa.array(pos[rows], pa.int32())], ["cls", "n", "pos"], mask=None if mask is None else pa.array(mask))

        return pa.RecordBatch.from_arrays([pa.array(cell[at]), pa.array(n[at]), pa.array(cls[at]), pa.array(pos[at], pa.int32()), member(before, first[at]), member(least)], names=["cell", "n", "cls", "pos", "before", "least"])

    def run(batches):
        bucket, parts = None, []
        for b in batches:
            for row in b.to_pylist():
                if row["bucket"] != bucket and parts:
                    yield from pieces(out(parts))
                    parts = []
                bucket = row["bucket"]
                x = {k: _numbers(row[k], kind) for k, kind in kinds.items()}
                parts.append((x["cells"], x["pos"], np.repeat(x["cls"], x["times"]), np.repeat(x["n"], x["times"])))
        if parts:
            yield from pieces(out(parts))

    def pieces(b):
        for i in range(0, b.num_rows, 1 << 15):
            yield b.slice(i, 1 << 15)

    dealt = _posts(index, max(tasks, total // POSTS + 1)).repartitionById(tasks, F.expr(f"int(bucket % {tasks})")).sortWithinPartitions("bucket")
    member = "struct<cls:bigint,n:bigint,pos:int>"
    return dealt.mapInArrow(run, f"cell long, n long, cls long, pos int, before {member}, least {member}")


def _pairs(members: DataFrame, looks: int = CONTRACT_CELLS) -> DataFrame:
    """Pairs that are tried first: of each set with its neighbour and with the smallest set, in the ``looks`` cells with the least hashes.

    Copies of one text agree on these cells, so a large group falls into few components; the pairs are at most
    ``2 * looks`` a set. Which pairs these are only matters for how much is left to the tree.
    """
    out = None
    for other in ("before", "least"):
        near = members.filter(f"{other}.cls != cls AND 100 * {other}.n >= {PERCENT} * n AND " + _REACH.format(other))
        picks = [F.min(F.struct(F.xxhash64(F.lit(k), "cell").alias("h"), F.col(f"{other}.cls").alias("o"))).alias(f"p{k}") for k in range(looks)]
        p = near.groupBy("cls").agg(*picks).select("cls", F.explode(F.array(*[f"p{k}" for k in range(looks)])).alias("p"))
        p = p.select(F.least("cls", "p.o").alias("a"), F.greatest("cls", "p.o").alias("b"))
        out = p if out is None else out.unionByName(p)
    return out.distinct()


def _mixed(members: DataFrame, labels: DataFrame | None, beyond: int = 0) -> DataFrame:
    """Members ``(cell, n, cls, pos, comp, m, large)`` of the cells of more than ``beyond`` members that still hold several components; without labels every class is one."""
    comp = members.select("cell", "n", "cls", "pos", F.col("cls").alias("comp")) if labels is None else members.join(small_side(labels, MANY_ROWS).withColumnRenamed("node", "cls"), "cls", "left").select("cell", "n", "cls", "pos", F.coalesce("root", "cls").alias("comp"))
    cells = comp.groupBy("cell").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("m")).filter(f"x != y AND m > {beyond}").select("cell", "m", (F.col("m") > PAGE).alias("large"))
    return materialize(comp.join(cells, "cell"), "shingle-mixed")


def _in_round(x: np.ndarray, y: np.ndarray, m: int, turn: int | None) -> np.ndarray:
    """Which pairs of classes a cell of ``m`` members takes in a round; all of them where there are no rounds."""
    if turn is None:
        return np.ones(len(x), bool)
    low, high = np.minimum(x, y).astype(np.uint64), np.maximum(x, y).astype(np.uint64)
    u = mix64(low * _STEP[2] + mix64(high * _STEP[3]))
    begin, end = (0.0 if k < 0 else min(1.0, float(FIRST_PAIRS) ** (k + 1) / m) for k in (turn - 1, turn))
    at = (u >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return (at >= begin) & (at < end)


def _texts(docs: DataFrame, ids: DataFrame, bits: int) -> DataFrame:
    """``(doc_id, text)`` of the rows with one of these ids (and, where there are very many, of a few more); written.

    A bitmap of the ids is only worth its pass through Python where a join would move the texts; with few ids the join is one with a table known to be small.
    """
    ids = materialize(ids.distinct(), "shingle-ids")
    if ids.count() <= MANY_ROWS:
        found = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    else:
        found = split_by_ids(docs, "doc_id", ids, "doc_id", bits)[1]
    return materialize(found.select("doc_id", "text"), "shingle-texts")


def _point_bound(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose summed coordinate minima reach the needed overlap; only the points of their classes are joined."""
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "shingle-wanted")
    p = materialize(points.select("cls", "n", "point").join(small_side(wanted, MANY_ROWS), "cls", "left_semi"), "shingle-near")
    joined = small_side(pairs, MANY_ROWS).join(p.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa")), "a").join(p.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb")), "b")

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (_coordinates(b.column(c).to_pylist()) for c in ("pa", "pb"))
                need = (np.asarray(b.column("na")) + np.asarray(b.column("nb"))) * PERCENT
                keep = np.minimum(x, y).sum(axis=1, dtype=np.int64) * (100 + PERCENT) >= need
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return joined.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, bits: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose exact sets link.

    Only ids and then the texts of the classes' documents move (texts pack better than sets of
    hashes); the sets are made again where two texts meet.
    """
    of = small_side(classes, MANY_ROWS).select("cls", "doc_id")
    known = pairs.join(of.select(F.col("cls").alias("a"), F.col("doc_id").alias("da")), "a").join(of.select(F.col("cls").alias("b"), F.col("doc_id").alias("db")), "b")
    known = materialize(known, "shingle-pairs")
    texts = _texts(docs, known.select(F.col("da").alias("doc_id")).unionByName(known.select(F.col("db").alias("doc_id"))), bits)
    both = small_side(known, MANY_ROWS).join(texts.select(F.col("doc_id").alias("da"), F.col("text").alias("ta")), "da").join(texts.select(F.col("doc_id").alias("db"), F.col("text").alias("tb")), "db")

    def run(batches):
        last, sets = None, None
        for whole in batches:
            for b in small_batches([whole], "ta"):
                second = shingle_sets(b.column("tb"))
                keep = []
                for k, (x, y, ta) in enumerate(zip(b.column("a").to_pylist(), b.column("b").to_pylist(), b.column("ta"))):
                    if x != last:
                        last, sets = x, shingle_sets(pa.array([ta.as_py()], pa.string()))[0]
                    t = second[k]
                    same = len(np.intersect1d(sets, t, assume_unique=True)) if len(sets) and len(t) else 0
                    # rows that share an id with another text belong to another class
                    right = _class_of(sets) == x and _class_of(t) == y
                    keep.append(right and same * (100 + PERCENT) >= (len(sets) + len(t)) * PERCENT)
                    if not right:
                        last = None
                yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialize(both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct(), "shingle-links")


def _leaf_pairs(hard: DataFrame, turn: int | None = None) -> DataFrame:
    """A round's pairs of different components in cells of one page: ``hard`` holds (cell, comp, n, cls, pos) of cells with up to ``PAGE`` members.

    Sizes and places are compared for the whole leaf at once. A pair shares many cells; a task passes it on once.
    """

    def run(batches):
        cell, rows, seen = None, [], set()

        def leaf():
            comp, n, cls, pos = (np.array(x) for x in zip(*rows))
            i, j = np.triu_indices(len(rows), 1)
            keep = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
            keep &= np.minimum(n[i] - pos[i], n[j] - pos[j]) * (100 + PERCENT) >= (n[i] + n[j]) * PERCENT
            i, j = i[keep], j[keep]
            keep = _in_round(cls[i], cls[j], len(rows), turn)
            for x, y in zip(cls[i[keep]].tolist(), cls[j[keep]].tolist()):
                pair = (x, y) if x < y else (y, x)
                if pair not in seen:
                    seen.add(pair)
                    yield pair
            if len(seen) > 1 << 18:
                seen.clear()

        def out(pairs):
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        for b in batches:
            got = []
            for c, *row in zip(*(b.column(x).to_pylist() for x in ("cell", "comp", "n", "cls", "pos"))):
                if c != cell and len(rows) > 1:
                    got += leaf()
                if c != cell:
                    cell, rows = c, []
                rows.append(row)
            yield out(got)
        if len(rows) > 1:
            yield out(list(leaf()))

    spread = hard.repartition(shuffle_partitions(hard.sparkSession), "cell").sortWithinPartitions("cell")
    return spread.select("cell", "comp", "n", "cls", "pos").mapInArrow(run, "a long, b long")


def _pages(large: DataFrame, order: tuple[str, ...] = ("comp", "n", "cls")) -> DataFrame:
    """Cells packed in this order into pages of points with their upper corner (the tree's nodes).

    ``large``: (cell, m, comp, n, cls, point, cells), ``cells`` being all large cells of the set.
    """
    spark = large.sparkSession
    numbers, blobs = ("cell", "members", "page", "low", "high", "first", "last"), ("corner", "comps", "classes", "sizes", "points", "cells", "ends")

    def run(batches):
        cell, rows, number = None, [], 0

        def page():
            members, comp, n, cls, points, cells = zip(*rows)
            point = _coordinates(list(points))
            return {
                "cell": cell, "members": members[0], "page": number, "low": min(n), "high": max(n), "first": comp[0], "last": comp[-1],
                "corner": point.max(axis=0).astype("<u4").tobytes(), "comps": np.array(comp, "<i8").tobytes(),
                "classes": np.array(cls, "<i8").tobytes(), "sizes": np.array(n, "<i8").tobytes(), "points": point.astype("<u1" if point.max() < 256 else "<u4").tobytes(),
                "cells": np.concatenate([np.array(c, "<i8") for c in cells]).tobytes(), "ends": np.cumsum([len(c) for c in cells]).astype("<i8").tobytes(),
            }

        for b in batches:
            out = []
            for c, *row in zip(*(b.column(x).to_pylist() for x in ("cell", "m", "comp", "n", "cls", "point", "cells"))):
                if rows and (c != cell or len(rows) == PAGE):
                    out.append(page())
                    number = 0 if c != cell else number + 1
                    rows = []
                cell = c
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if rows:
            yield pa.RecordBatch.from_pylist([page()], schema=schema)

    schema = pa.schema([(k, pa.int64()) for k in numbers] + [(k, pa.binary()) for k in blobs])
    spark_schema = ", ".join([f"{k} long" for k in numbers] + [f"{k} binary" for k in blobs])
    ordered = large.repartition(shuffle_partitions(spark), "cell").sortWithinPartitions("cell", *order)
    return ordered.select("cell", "m", "comp", "n", "cls", "point", "cells").mapInArrow(run, spark_schema)


def _tree_pairs(pages: DataFrame, turn: int | None = None) -> DataFrame:
    """A round's pairs of points of different components that pass the bounds of their pages and their own.

    Without rounds, a pair that meets in several large cells is passed on by the first of them alone.
    """
    p, q = pages.alias("p"), pages.alias("q")
    near = p.join(q, (F.col("p.cell") == F.col("q.cell")) & (F.col("p.page") <= F.col("q.page")))
    near = near.filter(
        (F.col("p.high") * 100 >= F.col("q.low") * PERCENT) & (F.col("q.high") * 100 >= F.col("p.low") * PERCENT)
        & ~((F.col("p.first") == F.col("p.last")) & (F.col("p.first") == F.col("q.first")) & (F.col("q.first") == F.col("q.last")))
    )
    names = ("low", "corner", "comps", "classes", "sizes", "points", "cells", "ends")
    near = near.select(F.col("p.cell").alias("cell"), F.col("p.members").alias("members"), (F.col("p.page") == F.col("q.page")).alias("same"), *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "pq" for c in names])

    def side(col, s, k):
        comp, cls, n, ends = (np.frombuffer(col[f"{s}_{c}"][k], "<i8") for c in ("comps", "classes", "sizes", "ends"))
        cells = np.frombuffer(col[f"{s}_cells"][k], "<i8")
        points = col[f"{s}_points"][k]
        return comp, cls, n, np.frombuffer(points, f"<u{len(points) // (GROUPS * len(cls))}").reshape(-1, GROUPS), [set(x.tolist()) for x in np.split(cells, ends[:-1])]

    def run(batches):
        for b in batches:
            col = {n: b.column(n).to_pylist() for n in b.schema.names}
            for k in range(b.num_rows):
                low = (col["p_low"][k] + col["q_low"][k]) * PERCENT
                corners = [np.frombuffer(col[f"{s}_corner"][k], "<u4") for s in "pq"]
                if int(np.minimum(*corners).sum(dtype=np.int64)) * (100 + PERCENT) < low:
                    continue
                (ca, xa, na, va, la), (cb, xb, nb, vb, lb) = side(col, "p", k), side(col, "q", k)
                pairs = []
                for i in range(len(xa)):
                    j = np.flatnonzero((cb != ca[i]) & (100 * nb >= PERCENT * na[i]) & (100 * na[i] >= PERCENT * nb))
                    if col["same"][k]:
                        j = j[j > i]
                    if len(j):
                        j = j[_in_round(np.full(len(j), xa[i]), xb[j], col["members"][k], turn)]
                    if len(j):
                        j = j[np.minimum(vb[j], va[i]).sum(axis=1, dtype=np.int64) * (100 + PERCENT) >= (nb[j] + na[i]) * PERCENT]
                        pairs += [(int(xa[i]), int(xb[m])) for m in j.tolist() if turn is not None or min(la[i] & lb[m]) == col["cell"][k]]
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array([min(x) for x in pairs], pa.int64()), pa.array([max(x) for x in pairs], pa.int64())], names=["a", "b"])

    return near.mapInArrow(run, "a long, b long")


def _prepared(docs: DataFrame, id_col: str, text_col: str, sketch_bits: int | None):
    """``(d, index, members, classes, wanted, points)``: what the joins start from; ids are keys in ``d``, ``wanted`` and ``points``."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if sketch_bits is None:
        sketch_bits = min(SKETCH_BITS[1], max(SKETCH_BITS[0], (16 * docs.count()).bit_length()))
    levels = spark.sparkContext.broadcast(_sketch(d.select("text"), sketch_bits))
    # a text is found again by its key: a hash of its id, or of the text itself where the id is null
    d = d.select("doc_id", "text", F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(1), "text")).otherwise(F.xxhash64("doc_id")).alias("key"))
    index = materialize(_index(d, levels, sketch_bits), "shingle-index")
    members = materialize(_neighbours(index), "shingle-cells")
    classes = index.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"))
    wanted = materialize(classes.join(members.select("cls").distinct(), "cls", "left_semi").select(F.col("key").alias("doc_id"), "cls"), "shingle-classes")
    points = materialize(index.select(F.col("key").alias("doc_id"), "cls", "n", "point").join(small_side(wanted, MANY_ROWS), ["doc_id", "cls"], "left_semi").dropDuplicates(["cls"]), "shingle-points")
    return d.select(F.col("key").alias("doc_id"), "text"), index, members, classes, wanted, points


def _left_pairs(mixed: DataFrame, points: DataFrame, order: tuple[str, ...] = ("comp", "n", "cls"), turn: int | None = None) -> DataFrame:
    """Pairs of classes of different components that leaves and tree leave over, all or those of a round."""
    large = mixed.filter("large")
    # what a set takes along is bounded by its own number of cells
    cells = materialize(large.groupBy("cls").agg(F.collect_set("cell").alias("cells")), "shingle-large").join(points.select("cls", "point"), "cls")
    tree = _pages(large.join(cells, "cls"), order)
    return _leaf_pairs(mixed.filter("NOT large"), turn).unionByName(_tree_pairs(materialize(tree, "shingle-pages"), turn)).distinct()


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketch_bits: int | None = None, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``(rows, links)``: ``(doc_id, n, cls)`` of every row, and all pairs ``(a, b)`` of distinct classes that link, each verified on exact sets.

    No pair is skipped for its component, so the work and the result grow with the links there are.
    """
    d, index, members, _, wanted, points = _prepared(docs, id_col, text_col, sketch_bits)
    pairs = _point_bound(materialize(_left_pairs(_mixed(members, None), points, ("n", "cls")), "shingle-pairs"), points)
    return index.select("doc_id", "n", "cls"), _verified(materialize(pairs, "shingle-pairs"), d, wanted, filter_bits)


def count_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketch_bits: int | None = None, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)`` of every row of ``docs``: the other rows whose sets link with its own (copies do), and the smallest id it reaches by links."""
    rows, links = link_classes(docs, id_col, text_col, sketch_bits, filter_bits)
    sizes = rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(sizes.select(F.col("cls").alias("b"), "copies"), "b").groupBy(F.col("a").alias("cls")).agg(F.sum("copies").alias("others"))
    labels = connected_components(links).withColumnRenamed("node", "cls")
    node = sizes.join(others, "cls", "left").join(labels, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    of = node.groupBy("root").agg(F.min("least").alias("component_id"))
    n = node.join(of, "root").select("cls", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")).filter("n_links > 0")
    return rows.join(n, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _components(docs: DataFrame, id_col: str, text_col: str, sketch_bits: int | None, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """``(index, node)``: every row with its class, and ``(cls, doc_id, copies, root)`` of every class, ``root`` naming its component."""
    d, index, members, classes, wanted, points = _prepared(docs, id_col, text_col, sketch_bits)
    tried = materialize(_pairs(members), "shingle-pairs")
    links = _verified(_point_bound(tried, points), d, wanted, filter_bits)
    labels = materialize(connected_components(links), "shingle-labels")
    turn, beyond = 0, 0
    while True:
        mixed = _mixed(members, labels, beyond)
        if mixed.isEmpty():
            break
        found = materialize(_left_pairs(mixed, points, turn=turn).join(tried, ["a", "b"], "left_anti"), "shingle-pairs")
        tried = tried.unionByName(found)
        late = _verified(_point_bound(found, points), d, wanted, filter_bits)
        if not late.isEmpty():
            links = links.unionByName(late)
            labels = materialize(connected_components(links), "shingle-labels")
        # cells of so many members have had all their pairs looked at; the others go on
        members, beyond, turn = mixed, FIRST_PAIRS ** (turn + 1), turn + 1

    return index, classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketch_bits: int | None = None, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``."""
    index, node = _components(docs, id_col, text_col, sketch_bits, filter_bits)
    least = node.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # a class that is its own smallest document and has no copies needs no look-up
    shared = node.join(least, "root").filter("component_id IS NOT NULL AND (copies > 1 OR doc_id IS NULL OR component_id != doc_id)").select("cls", "component_id")
    out = index.join(small_side(materialize(shared, "shingle-shared"), MANY_ROWS), "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without the linked copies: of each component one row stays.

    Rows are known by id and class, so rows that share an id but not a set are judged apart. The row with the smallest id stays (then
    the smallest class, then text); a null id comes after all others. Rows without words are linked with nothing and stay, those with one id and text once.
    """
    index, node = _components(docs, id_col, text_col, None, FILTER_BITS)
    rows = index.groupBy("doc_id", "cls").agg(F.count(F.lit(1)).alias("rows"))
    # a component of one row needs no look
    many = node.groupBy("root").agg(F.sum("copies").alias("rows")).filter("rows > 1").select("root")
    of = materialize(rows.join(node.select("cls", "root").join(many, "root"), "cls").select("root", "doc_id", "cls", "rows"), "shingle-nodes")
    first = of.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "cls")).alias("first"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("cls") == F.col("first.cls"))
    judged = of.join(first, "root").select(F.col("doc_id").alias("_id"), F.col("cls").alias("_of"), is_first.alias("_stays"), "rows").filter("NOT _stays OR rows > 1").drop("rows")
    empty = rows.filter("cls IS NULL AND doc_id IS NOT NULL AND rows > 1").select(F.col("doc_id").alias("_id"), F.col("cls").alias("_of"), F.lit(True).alias("_stays"))
    judged = materialize(judged.unionByName(empty), "shingle-judged")
    outside, inside = split_by_ids(docs, id_col, judged, "_id")
    names = docs.columns

    def run(batches):
        for b in small_batches(batches, text_col):
            of_row = [_class_of(x) if len(x) else None for x in shingle_sets(b.column(text_col))]
            yield pa.RecordBatch.from_arrays([*b.select(names).columns, pa.array(of_row, pa.int64())], names=[*names, "_cls"])

    classed = inside.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_cls", T.LongType())]))
    both = classed.join(judged, classed[id_col].eqNullSafe(judged["_id"]) & classed["_cls"].eqNullSafe(judged["_of"]), "left")
    alone = both.filter("_stays IS NULL").select(names)
    once = both.filter("_stays").withColumn("_row", F.struct(*names)).groupBy(id_col, "_cls", F.when(F.col("_cls").isNull(), F.col(text_col)).alias("_empty"))
    return outside.unionByName(alone).unionByName(once.agg(F.min_by("_row", text_col).alias("_row"), F.first("_row").alias("_any")).select(F.coalesce("_row", "_any").alias("_row")).select("_row.*"))
