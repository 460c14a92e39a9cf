"""Language identification by rank-order n-gram profiles (dealt operator 2).

A profile lists a language's ``PROFILE`` most frequent n-grams (one to three letters, words
padded with blanks, lower-cased, ties by code point) from all texts it is learned from. A
document's own list is compared with every profile: each n-gram adds how many places it is
out of place, or ``PROFILE`` if the profile lacks it. The nearest profile wins, equal
distances go to the smaller name. ``score`` is one minus the distance over the largest
possible one.

Learning counts n-grams of all texts inside the tasks and adds them up in one small shuffle
(language, n-gram, count); only the profiles (``PROFILE`` rows a language) reach the driver.
Predicting is a scan. Long texts are counted in pieces, so no list of all their n-grams is held.

Defined results: null text or text without a letter: ``und`` with score 0, also where nothing
could be learned; rows without text or language teach nothing; repeated rows count as often as
they occur; a null id isn't held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, small_batches

PROFILE = 300
UNKNOWN = "und"
PIECE = 1 << 20
_BITS = np.int64(21)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _grams(text: str) -> np.ndarray:
    """Codes of all n-grams of one to three letters of a text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _letters()[c]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after a word
    c = np.where(letter, c, 32)[keep]
    if not len(c):
        return c
    c = np.concatenate([[32], c, [32]]) if c[-1] != 32 else np.concatenate([[32], c])
    word = c != 32
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    return np.concatenate([c[word], two, three[word[1:-1]]])


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a whole text and how often they occur; pieces end between words where there is one."""
    if len(text) <= PIECE:
        return np.unique(_grams(text), return_counts=True)
    parts, at = [], 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end].isalpha() and end < at + 2 * PIECE:
            end += 1
        parts.append(np.unique(_grams(text[at:end]), return_counts=True))
        at = end
    return merge_counts(parts)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, ties in ascending order."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class Profiles:
    names: list[str]
    codes: np.ndarray  # all n-grams of any profile, ascending
    places: np.ndarray  # places[language, n-gram], ``size`` where it is absent
    size: int

    def nearest(self, text: str | None) -> tuple[str, float]:
        codes, counts = gram_counts(text or "")
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        place = np.where(self.codes[at] == own, self.places[:, at], self.size)
        away = np.where(place < self.size, np.abs(place - np.arange(len(own))), self.size).sum(axis=1)
        best = int(np.argmin(away))
        return self.names[best], 1.0 - float(away[best]) / (self.size * len(own))


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles of all languages in ``docs`` from all its texts."""

    def count(batches):
        sums: dict[str, list] = {}

        def squeeze(lang):
            sums[lang] = [merge_counts(sums[lang])]

        for b in small_batches(batches, "text"):
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                c = gram_counts(text)
                if len(c[0]):
                    sums.setdefault(lang, []).append(c)
                    if len(sums[lang]) >= 256:
                        squeeze(lang)
        for lang in sums:
            codes, counts = merge_counts(sums[lang])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], names=["lang", "gram", "n"])

    texts = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    grams = texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = grams.selectExpr("lang", "gram", "row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS place").filter(F.col("place") <= size).collect()  # every task keeps its first ones only
    names, codes = sorted({r.lang for r in top}), np.array(sorted({r.gram for r in top}), np.int64)
    at = {c: i for i, c in enumerate(codes.tolist())}
    places = np.full((len(names), len(codes)), size, np.int64)
    for r in top:
        places[names.index(r.lang), at[r.gram]] = r.place - 1
    return Profiles(names, codes, places, size)


def predict_languages(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row; nothing but the text is looked at."""
    model = docs.sparkSession.sparkContext.broadcast(profiles)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in small_batches(batches, "text"):
            found = [model.value.nearest(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return d.mapInArrow(run, T.StructType([d.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def keep_known_languages(docs: DataFrame, profiles: Profiles, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows whose language is found with at least ``least_score``; all columns as they were."""
    model = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        kept("language_profiles")
        for b in small_batches(batches, text_col):
            found = [model.value.nearest(t) for t in b.column(text_col).to_pylist()]
            yield b.filter(pa.array([lang != UNKNOWN and score >= least_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """The rows that nothing is learned from: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
