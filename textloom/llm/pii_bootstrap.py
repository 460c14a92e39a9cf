r"""Personal data by bootstrapped contextual extraction (dealt operator 4).

Seeds are the spans of four fixed rules (email, ip, card, phone) and ``SEED_RULES`` for
further kinds. What stands around a seed gives its lexical patterns: the two words before,
the word before, the word after (lower-cased, digits as 0). Other identifier-shaped tokens
(``MIN_LENGTH`` characters with at least ``MIN_DIGITS`` digits, or an ``@``) in the same patterns are
instances without a kind; so are runs of groups that hold a digit, joined by single blanks, dots, dashes or brackets
(``DE89 3704 0044``, ``(555) 555-1234``), with the contexts outside the whole run. Spark scores the bipartite graph of patterns and instances in rounds:
a pattern's confidence in a kind is the weight of its distinct instances of that kind over all
of them plus two; a pattern needs ``CONFIDENCE``, hence several instances, to count. Instances
get the noisy-or of their confident patterns as weight and go into the next round, until neither patterns
nor weights change. At the end the confident patterns mark the unseen identifiers they surround; base spans always stay.

The documents are scanned once; what is written, joined and grouped are spans and contexts, never
texts. A frequent pattern is aggregated partially before it is shuffled.

Base rules, leftmost without overlap in each kind (failing matches are dropped, not retried):
email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``; ip ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, parts
at most 255; card ``[0-9]([\x20-]?[0-9])+``, 13 to 19 digits passing Luhn; phone
``\+[0-9][\x20().0-9-]+[0-9]``, 9 to 15 digits. Offsets are code points, ends exclusive.

Defined results: null and empty texts have no spans; repeated rows are found one by one; their
instances count once, as graph nodes are distinct values. Empty tables give empty results.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import kept, small_batches, split_by_ids, utf8_column

BASE_KINDS = ("email", "ip", "card", "phone")
#: Seeds of further kinds: name and pattern.
SEED_RULES = (("secret", r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])"),)
CONFIDENCE = 0.8
#: Default rounds of ``score_patterns``; the query scores until nothing changes by more than ``EPSILON``, and fails after ``MAX_ROUNDS``.
ROUNDS, EPSILON, MAX_ROUNDS = 4, 1e-9, 1000
MIN_LENGTH, MIN_DIGITS = 6, 3
CONTEXT = 80

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
# the first digit of a run is the only place in it where an address can start
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]")
_EDGE = "\"'`<>()[]{},;:!?.*#$%&|/\\=~^"
_STOP = re.compile(r"[\s\"'`<>()\[\]{},;|]")
_GROUP = r"[A-Za-z]*+[0-9][0-9A-Za-z]*+(?!\w)"
_RUN = re.compile(rf"(?<!\w)[(\[]?\+?{_GROUP}(?:(?:[)\]][\x20.-]?|[\x20.-][(\[]?|[(\[])\+?{_GROUP})++[)\]]?")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _local_start(text: str, low: int, at: int) -> int:
    """The first of the local characters that end before ``at``, not before ``low``."""
    step = 64
    while True:
        left = max(low, at - step)
        start = at - _LOCAL.match(text[left:at][::-1]).end()
        if start > left or left == low:
            return start
        step *= 4


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind as listed, then by start."""
    out = []
    pos, at = 0, text.find("@")
    while at >= 0:
        start = _local_start(text, pos, at)
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            pos = m.end()
        at = text.find("@", max(pos, at + 1))
    first = _DIGIT.search(text)
    if first is None:
        return out
    for m in _IP.finditer(text, first.start()):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text, first.start()):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


_SEEDS = tuple((k, re.compile(p)) for k, p in SEED_RULES)


class _Taken:
    """Spans that don't overlap each other, by start: whether another one overlaps any is told by its neighbours."""

    def __init__(self, spans):
        # base kinds may overlap one another; what counts is the ground they cover
        self.starts, self.ends = [], []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def overlaps(self, s: int, e: int) -> bool:
        k = bisect_left(self.starts, e)
        return k > 0 and self.ends[k - 1] > s

    def spans(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str | None, int, int]]:
    """Seeds of every kind, and identifier-shaped tokens and runs of groups (kind None) that overlap no seed."""
    out = list(base)
    ground = _Taken((s, e) for _, s, e in base)
    for kind, rule in _SEEDS:
        # matches of one rule don't overlap each other
        found = [(kind, m.start(), m.end()) for m in rule.finditer(text) if not ground.overlaps(m.start(), m.end())]
        out += found
        ground = _Taken([*ground.spans(), *((s, e) for _, s, e in found)])
    taken = ground.spans()
    runs, at = [], 0
    for s, e in [*taken, (len(text), len(text))]:  # between the seeds
        for m in _RUN.finditer(text, at, max(at, s)):
            a, z = _bracketed(text, m.start(), m.end())
            if z - a >= MIN_LENGTH and _STOP.search(text, a, z) and len(_DIGIT.findall(text, a, z)) >= MIN_DIGITS:
                runs.append((None, a, z))
        at = max(at, e)
    at, k = 0, 0
    while m := _MARK.search(text, at):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] <= m.start():
            at = taken[k][1]
            continue
        s = m.start()
        while s > at and not _STOP.match(text, s - 1):
            s -= 1
        stop = _STOP.search(text, m.start())
        e = at = stop.start() if stop else len(text)
        while s < e and text[s] in _EDGE:
            s += 1
        while e > s and text[e - 1] in _EDGE:
            e -= 1
        if e - s >= MIN_LENGTH and ("@" in text[s:e] or len(_DIGIT.findall(text, s, e)) >= MIN_DIGITS) and not ground.overlaps(s, e):
            out.append((None, s, e))
    held = {(s, e) for _, s, e in out}
    return out + [r for r in runs if r[1:] not in held]


def _bracketed(text: str, s: int, e: int) -> tuple[int, int]:
    """The run without a bracket at its ends whose other half is not in it."""
    if text[s] in "([" and ")]"["([".index(text[s])] not in text[s:e]:
        s += 1
    if text[e - 1] in ")]" and "(["[")]".index(text[e - 1])] not in text[s:e]:
        e -= 1
    if text[s] in "([" and text[e - 1] == ")]"["([".index(text[s])] and not _STOP.search(text[s + 1 : e - 1].replace(" ", "")):
        s, e = s + 1, e - 1  # brackets around the whole run are no part of it
    return s, e


def _word(w: str) -> str:
    return _DIGIT.sub("0", w.strip(_EDGE).lower() or w)


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span; only ``CONTEXT`` characters on each side are looked at."""
    before = [_word(w) for w in text[max(0, start - CONTEXT) : start].split()[-2:]]
    after = [_word(w) for w in text[end : end + CONTEXT].split()[:1]]
    out = []
    if len(before) == 2:
        out.append("LL " + " ".join(before))
    if before:
        out.append("L " + before[-1])
    if after:
        out.append("R " + after[0])
    return out


_FOUND = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
_FOUND_SPARK = "array<struct<kind:string,start:bigint,end:bigint,value:string,patterns:array<string>>>"


def _found(texts: pa.Array) -> list[tuple[list, list]]:
    """Base spans and candidates of each text; texts without a digit or ``@`` are told by their bytes."""
    kept("pii_bootstrap")
    data, off = utf8_column(texts)
    flags = np.zeros(256, np.int64)
    flags[48:58] = flags[64] = 1
    marks = np.concatenate([[0], np.cumsum(flags[data])])
    some = np.flatnonzero(marks[off[1:]] > marks[off[:-1]])
    out: list[tuple[list, list]] = [([], [])] * (len(off) - 1)
    for i in some.tolist():
        text = texts[i].as_py()
        base = base_spans(text)
        out[i] = (base, [{"kind": k, "start": s, "end": e, "value": text[s:e].lower(), "patterns": contexts(text, s, e)} for k, s, e in candidates(text, base)])
    return out


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_md5, base, found)`` of every row: base spans as kind:start:end, seeds and candidates with their patterns."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.md5(F.col(text_col)).alias("text_md5"))

    def run(batches):
        for b in small_batches(batches, "text"):
            r = _found(b.column("text"))
            base = [[f"{k}:{s}:{e}" for k, s, e in x] for x, _ in r]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_md5"), pa.array(base, pa.list_(pa.string())), pa.array([x for _, x in r], pa.list_(_FOUND))],
                names=["doc_id", "text_md5", "base", "found"],
            )

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, text_md5 string, base array<string>, found {_FOUND_SPARK}")


def score_patterns(edges: DataFrame, confidence: float = CONFIDENCE, rounds: int | None = ROUNDS) -> DataFrame:
    """Confident patterns ``(pattern, kind, confidence)`` of a graph ``edges(pattern, value, kind)``; ``kind`` is null for unknown values.

    Every round is two aggregations; tables are written so that the plan doesn't grow. A number of rounds stops early when
    no value is new; with None the rounds go on until the confident patterns are the same and their confidences, on which the weights depend, have settled.
    """
    seeds = edges.filter("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count(F.lit(1)).cast("double").alias("w"))
    totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    unknown = materialize(edges.filter("kind IS NULL").select("pattern", "value"), "pii-unknown")
    best_of = "row_number() OVER (PARTITION BY {0} ORDER BY {1} DESC, kind) AS place"
    known, count, best = None, 0, None
    for _ in range(MAX_ROUNDS if rounds is None else rounds):
        last = best
        weights = seeds
        if known is not None:
            got = unknown.join(known, "value").groupBy("pattern", "kind").agg(F.sum("weight").alias("w"))
            weights = seeds.unionByName(got).groupBy("pattern", "kind").agg(F.sum("w").alias("w"))
        scored = weights.join(totals, "pattern").select("pattern", "kind", (F.col("w") / (F.col("total") + 2)).alias("confidence")).filter(F.col("confidence") >= confidence)
        best = materialize(scored, "pii-patterns")  # at 0.8 and above only one kind of a pattern can pass
        doubt = unknown.join(best, "pattern").groupBy("value", "kind").agg(F.sum(F.log1p(-F.least("confidence", F.lit(0.999999)))).alias("log_doubt"))
        known = materialize(doubt.selectExpr("value", "kind", "1 - exp(log_doubt) AS weight", best_of.format("value", "-log_doubt")).filter("place = 1").drop("place"), "pii-values")
        if rounds is None:
            if last is not None and _same_scores(last, best):
                break
        elif (now := known.count()) == count:
            break
        else:
            count = now
    else:
        if rounds is None:
            raise RuntimeError("pattern scores did not settle")
    return best


def _same_scores(a: DataFrame, b: DataFrame) -> bool:
    both = a.withColumnRenamed("confidence", "x").join(b.withColumnRenamed("confidence", "y"), ["pattern", "kind"], "full")
    return both.filter(f"x IS NULL OR y IS NULL OR abs(x - y) > {EPSILON}").isEmpty()


def discover(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, added)``: ``extract``'s rows with a ``row`` number, and ``(row, kind, start, end)`` of seeds of further kinds and discovered spans."""
    rows = materialize(extract(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pii-found")
    found = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    edges = materialize(found.select(F.explode("patterns").alias("pattern"), "value", "kind").groupBy("pattern", "value").agg(F.min("kind").alias("kind")), "pii-edges")
    best = score_patterns(edges, rounds=None)
    open_spans = found.filter("kind IS NULL").select("row", "start", "end", F.explode("patterns").alias("pattern"))
    marked = open_spans.join(best, "pattern").groupBy("row", "start", "end").agg(F.max(F.struct("confidence", "kind")).alias("b")).select("row", F.col("b.kind").alias("kind"), "start", "end")
    seeds = found.filter(F.col("kind").isNotNull() & ~F.col("kind").isin(*BASE_KINDS)).select("row", "kind", "start", "end")
    return rows, seeds.unionByName(marked)


def _kind_order(kind: Column) -> Column:
    out = F.lit(len(BASE_KINDS))
    for i, k in enumerate(BASE_KINDS):
        out = F.when(kind == k, F.lit(i)).otherwise(out)
    return out


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, base, spans)`` of every row: kind:start:end strings, by kind (base kinds first), then start."""
    rows, added = discover(docs, id_col, text_col)
    extra = added.groupBy("row").agg(F.collect_list(F.concat_ws(":", "kind", "start", "end")).alias("extra"))
    # a row's spans are ordered natively: (kind order, kind, start, end)
    both = rows.join(extra, "row", "left").select("doc_id", "base", F.concat("base", F.coalesce("extra", F.array().cast("array<string>"))).alias("all"))
    parts = F.transform("all", lambda s: F.struct(
        _kind_order(F.split_part(s, F.lit(":"), F.lit(1))).alias("o"), F.split_part(s, F.lit(":"), F.lit(1)).alias("k"),
        F.split_part(s, F.lit(":"), F.lit(2)).cast("long").alias("a"), F.split_part(s, F.lit(":"), F.lit(3)).cast("long").alias("z")))
    spans = F.transform(F.array_sort(parts), lambda p: F.concat_ws(":", p["k"], p["a"], p["z"]))
    return both.select("doc_id", "base", spans.alias("spans"))


def personal_data_digest(found: DataFrame) -> DataFrame:
    """The columns of the query."""
    n = [F.expr(f"CAST(size(filter(base, s -> startswith(s, '{k}:'))) AS BIGINT) AS n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *n, F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join("spans", ",").alias("spans"), F.size("spans").cast("long").alias("n_found"))


def _masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with spans replaced by their kind; overlapping ones are merged under the first."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, with personal data in the texts replaced by ``[KIND]``.

    Base spans are found again in the same pass; discovered ones are joined by id and the text's MD5.
    """
    rows, added = discover(docs, id_col, text_col)
    extra = rows.join(added, "row").select("doc_id", "text_md5", F.struct("kind", "start", "end").alias("s")).distinct().groupBy("doc_id", "text_md5").agg(F.collect_list("s").alias("_pii_added"))
    extra = extra.select(F.col("doc_id").alias("_pii_id"), F.col("text_md5").alias("_pii_md5"), "_pii_added")
    extra = materialize(extra, "pii-added")
    outside, inside = split_by_ids(docs, id_col, extra, "_pii_id")  # texts without discovered spans are not shuffled
    found = inside.join(extra, inside[id_col].eqNullSafe(extra["_pii_id"]) & (F.md5(inside[text_col]) == extra["_pii_md5"]), "left").drop("_pii_id", "_pii_md5")
    joined = outside.withColumn("_pii_added", F.lit(None).cast(extra.schema["_pii_added"].dataType)).unionByName(found)

    def run(batches):
        for b in small_batches(batches, text_col):
            data, off = utf8_column(b.column(text_col))
            flags = np.zeros(256, np.int64)
            flags[48:58] = flags[64] = 1
            marks = np.concatenate([[0], np.cumsum(flags[data])])
            touched = set(np.flatnonzero(marks[off[1:]] > marks[off[:-1]]).tolist())
            more = b.column("_pii_added").to_pylist()
            texts = b.column(text_col).to_pylist()
            for i, t in enumerate(texts):
                if i in touched or more[i]:
                    spans = base_spans(t) + [(x["kind"], x["start"], x["end"]) for x in more[i] or []]
                    texts[i] = _masked(t, spans)
            k = b.schema.get_field_index(text_col)
            yield b.set_column(k, b.schema.field(k), pa.array(texts, b.schema.field(k).type)).select(names)

    names = docs.columns
    return joined.mapInArrow(run, T.StructType(docs.schema.fields))
