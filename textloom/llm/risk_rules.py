"""Quality rules with risk-controlled thresholds (dealt operator 12).

A document fails the base rules, or one of the statistics in ``STATISTICS`` lies above its cutoff. The cutoffs are
chosen for each stratum from labelled documents so that the share of good documents the rules reject is limited:

* The labelled documents that pass the base rules are split in two by a hash of their id. The first half makes a ladder of
  cutoffs for each statistic: on step ``j`` of ``STEPS`` the value that ``j`` times ``STEP_PER_10000`` of the good documents exceed. A statistic is used where,
  on the last step, bad documents exceed it at least ``LIFT`` times as often as good ones.
* The second half, the holdout, tests the ladder from its first step on: with ``n`` good documents of which ``k`` are rejected
  (by any statistic), the hypothesis that more than ``RISK_PERCENT`` of good documents are rejected falls if the exact binomial probability
  of ``k`` or fewer at that share is at most ``ERROR_PERCENT`` over the number of strata. The last step before the first failure is taken.
  Testing in a fixed order needs no correction within a stratum, and the division (Bonferroni) corrects for the strata:
  with the stated confidence no stratum's rules reject more than the stated share. Strata without a passing step, and strata
  that were never labelled, reject by the base rules alone.

The histograms are bounded: statistics are whole numbers up to ``TOP``, so a stratum has at most ``TOP + 1`` values of each.
Counting them, the ladders and the tests are Spark aggregations and windows; only the binomial sums are an Arrow function.

Defined results: null text counts as empty; null stratum is ``und``; a document with several labels is good if none says bad; labels
without a document, or null, are passed over; repeated rows are judged each; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import small_batches, span_ids, utf8_column, word_spans

WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
STEPS = 20
STEP_PER_10000 = 25
LIFT = 2
RISK_PERCENT = 5
ERROR_PERCENT = 5
TOP = 10000
UNKNOWN = "und"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")

#: Whole numbers from 0 to ``TOP``; larger is worse.
STATISTICS = {
    "long_words": f"least({TOP}, 100 * word_chars div greatest(n_words, 1))",
    "short_words": f"{TOP} - least({TOP}, 100 * word_chars div greatest(n_words, 1))",
    "few_words": f"{TOP} - least({TOP}, n_words)",
    "symbols": f"least({TOP}, 1000 * n_symbols div greatest(n_words, 1))",
    "capitals": f"least({TOP}, 1000 * n_capitals div greatest(word_chars, 1))",
    "marks": f"least({TOP}, 1000 * n_marks div greatest(n_words, 1))",
    "dup_lines": f"least({TOP}, 1000 * n_dup_lines div greatest(n_lines, 1))",
    "repeat_words": f"least({TOP}, 1000 * n_repeat_words div greatest(n_words, 1))",
}
BASE_FAILED = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"


def _flags(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


_IS_WORD = ~_flags("\t\n\x0b\x0c\r ")
_IS_LINE = ~_flags("\n")
_SYMBOLS, _CAPITALS, _MARKS = _flags("#*$%&|<>"), _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("!?")


def _numbered(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of pairs, equal for equal pairs."""
    return np.unique(left << 32 | right, return_inverse=True)[1].reshape(-1).astype(np.int64)


def _repeat_words(row: np.ndarray, ids: np.ndarray, rows: int) -> np.ndarray:
    """Words of each text in windows of ``WINDOW`` words that are found twice or more in it."""
    windows = len(ids) - WINDOW + 1
    if windows <= 0:
        return np.zeros(rows, np.int64)
    inside = row[:windows] == row[WINDOW - 1 :]
    one = _numbered(row, ids)
    two = _numbered(one[:-1], one[1:])
    four = _numbered(two[:-2], two[2:])
    five = _numbered(four[:windows], one[WINDOW - 1 :])[inside]
    at = np.flatnonzero(inside)[(np.bincount(five) > 1)[five]]
    change = np.zeros(len(ids) + 1, np.int64)
    change[at] += 1
    change[at + WINDOW] -= 1  # every window has its own begin and end
    return np.bincount(row[np.cumsum(change)[:-1] > 0], minlength=rows)


def text_counts(texts) -> dict[str, np.ndarray]:
    """The columns ``COUNTS`` of a batch of texts."""
    data, off = utf8_column(texts)
    rows = len(off) - 1
    starts, ends, row = word_spans(data, off, _IS_WORD)
    ids, _ = span_ids(data, starts, ends)

    def per_row(flags):
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[off])

    begin, end, line_row = word_spans(data, off, _IS_LINE)
    words_before = np.concatenate([[0], np.cumsum(_IS_WORD[data], dtype=np.int64)])
    filled = words_before[end] > words_before[begin]
    begin, end, line_row = begin[filled], end[filled], line_row[filled]
    lines = np.bincount(line_row, minlength=rows)
    once = np.bincount(np.unique(line_row << 32 | span_ids(data, begin, end)[0]) >> 32, minlength=rows)
    return {
        "n_words": np.bincount(row, minlength=rows),
        "word_chars": per_row(_IS_WORD[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": per_row(_SYMBOLS[data]),
        "n_dup_lines": lines - once,
        "n_repeat_words": _repeat_words(row, ids, rows),
        "n_lines": lines,
        "n_capitals": per_row(_CAPITALS[data]),
        "n_marks": per_row(_MARKS[data]),
    }


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``(doc_id, stratum, <COUNTS>, base_failed)`` of every row, from its whole text; one scan."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit(UNKNOWN)).alias("stratum"), F.col(text_col).alias("text"))

    def run(batches):
        for b in small_batches(batches, "text"):
            counts = text_counts(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("stratum"), *[pa.array(counts[c].astype(np.int64)) for c in COUNTS]], names=["doc_id", "stratum", *COUNTS])

    schema = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, stratum string, " + ", ".join(f"{c} long" for c in COUNTS)
    return d.mapInArrow(run, schema).withColumn("base_failed", F.expr(BASE_FAILED))


def binomial_tail(k: int, n: int, share: float) -> float:
    """The probability of at most ``k`` of ``n`` at this share, summed from its largest term on until terms no longer count."""
    if k >= n:
        return 1.0
    top = min(k, int((n + 1) * share))
    largest = math.exp(math.lgamma(n + 1) - math.lgamma(top + 1) - math.lgamma(n - top + 1) + top * math.log(share) + (n - top) * math.log1p(-share))
    total, term, i = largest, largest, top
    while i > 0 and term > total * 1e-18:
        term *= i * (1 - share) / ((n - i + 1) * share)
        i -= 1
        total += term
    term, i = largest, top
    while i < k and term > total * 1e-18:
        term *= (n - i) * share / ((i + 1) * (1 - share))
        i += 1
        total += term
    return min(1.0, total)


def _tail(k: pa.Array, n: pa.Array, share: pa.Array) -> pa.Array:
    return pa.array([binomial_tail(*x) for x in zip(k.to_pylist(), n.to_pylist(), share.to_pylist())], pa.float64())


def _labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents past the base rules: ``(stratum, good, holdout, <statistics>)``."""
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    rows = measured.filter("NOT base_failed").join(good, "doc_id")
    # a digest of the id; its second half is the holdout
    return rows.select("stratum", "good", (F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) >= "8").alias("holdout"), *[F.expr(e).cast("int").alias(s) for s, e in STATISTICS.items()])


def _ladders(labelled: DataFrame, steps: int, step: int, lift: int) -> DataFrame:
    """``(stratum, <statistics>)``: each statistic's cutoffs by step from the first half; null where it doesn't tell bad from good."""
    long = labelled.filter("NOT holdout").select("stratum", "good", F.explode(F.map_from_arrays(F.array(*[F.lit(s) for s in STATISTICS]), F.array(*STATISTICS))).alias("statistic", "value"))
    seen = long.groupBy("stratum", "statistic", "value").agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    by = Window.partitionBy("stratum", "statistic")
    up_to = by.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = seen.select("stratum", "statistic", "value", "good", "bad", F.sum("good").over(up_to).alias("below"), F.sum("good").over(by).alias("all_good"), F.sum("bad").over(by).alias("all_bad"))
    cut = [F.min(F.expr(f"CASE WHEN good > 0 AND 10000 * below >= {10000 - j * step} * all_good THEN value END")).alias(f"c{j}") for j in range(steps + 1)]
    last = run.groupBy("stratum", "statistic").agg(*cut)
    told = run.join(last.select("stratum", "statistic", F.col(f"c{steps}").alias("strict")), ["stratum", "statistic"]).groupBy("stratum", "statistic").agg(
        F.expr("sum(CASE WHEN value > strict THEN bad ELSE 0 END) * max(all_good)").alias("bad"), F.expr("sum(CASE WHEN value > strict THEN good ELSE 0 END) * max(all_bad)").alias("good")
    )
    useful = told.filter(F.expr(f"bad > 0 AND bad >= {lift} * good")).select("stratum", "statistic")
    ladders = last.join(useful, ["stratum", "statistic"]).select("stratum", "statistic", F.array(*[f"c{j}" for j in range(steps + 1)]).alias("cuts"))
    return ladders.groupBy("stratum").agg(*[F.first(F.when(F.col("statistic") == s, F.col("cuts")), ignorenulls=True).alias(f"{s}_cuts") for s in STATISTICS])


def _first_step(steps: int):
    """The first step of the ladders that rejects a row; ``steps + 1`` where none does."""
    return F.least(*[F.when(F.col(f"{s}_cuts").isNull(), steps + 1).otherwise(F.size(F.filter(f"{s}_cuts", _not_below(s)))) for s in STATISTICS], F.lit(steps + 1))


def _not_below(statistic: str):
    return lambda c: c >= F.col(statistic)


def choose_cutoffs(
    measured: DataFrame, labels: DataFrame, risk_percent: int = RISK_PERCENT, error_percent: int = ERROR_PERCENT, steps: int = STEPS, step: int = STEP_PER_10000, lift: int = LIFT
) -> DataFrame:
    """``(stratum, n, k, step, <statistic>_cut ...)``: one row a labelled stratum; a null step or cutoff rejects nothing."""
    labelled = materialize(_labelled(measured, labels), "rules-labelled")
    ladders = materialize(_ladders(labelled, steps, step, lift), "rules-ladders")
    holdout = labelled.filter("holdout AND good").join(ladders, "stratum", "left").select("stratum", _first_step(steps).alias("first"))
    counted = holdout.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.col("first") <= j).cast("long")).alias(f"k{j}") for j in range(steps + 1)])
    strata = Window.partitionBy(F.lit(1))  # one row a stratum
    tested = counted.withColumn("strata", F.count(F.lit(1)).over(strata)).select("stratum", "n", "strata", F.posexplode(F.array(*[f"k{j}" for j in range(steps + 1)])).alias("step", "k"))
    passed = tested.withColumn("passes", F.arrow_udf(_tail, "double")("k", "n", F.lit(risk_percent / 100)) * F.col("strata") <= error_percent / 100)
    # the steps before the first one that fails
    taken = passed.groupBy("stratum").agg(F.max("n").alias("n"), F.coalesce(F.min(F.expr("CASE WHEN NOT passes THEN step END")), F.lit(steps + 1)).alias("fails"), F.sort_array(F.collect_list(F.struct("step", "k"))).alias("ks"))
    chosen = ladders.join(taken, "stratum").filter("fails > 0")
    return chosen.select("stratum", "n", F.expr("ks[fails - 1].k").alias("k"), (F.col("fails") - 1).alias("step"), *[F.expr(f"{s}_cuts[fails - 1]").alias(f"{s}_cut") for s in STATISTICS])


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Every measured row with ``kept``: past the base rules and with no statistic above its stratum's cutoff."""
    above = " OR ".join(f"coalesce(({e}) > {s}_cut, false)" for s, e in STATISTICS.items())
    joined = measured.join(cutoffs.select("stratum", *[f"{s}_cut" for s in STATISTICS]), "stratum", "left")
    return joined.select("doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & ~F.expr(above)).alias("kept"))


def judge_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)`` of every row of ``docs``."""
    measured = materialize(measure(docs), "rules-measured")
    # one row a stratum, written: the join is planned by its true size, and no stratum's rows meet in one task
    return judge(measured, materialize(choose_cutoffs(measured, labels, **options), "rules-cutoffs"))
