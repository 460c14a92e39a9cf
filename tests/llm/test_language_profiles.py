import zlib
from collections import Counter

from pyspark.sql import functions as F

from textloom.llm import language_profiles as L

from .conftest import CLASHING

SF = "/root/testdata/sf0.001"


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    out = Counter()
    for w in words:
        p = f" {w} "
        out.update(w)
        out.update(p[i : i + 2] for i in range(len(p) - 1))
        out.update(p[i : i + 3] for i in range(len(p) - 2))
    return out


def code(g):
    n = 0
    for c in g:
        n = n << 21 | ord(c)
    return n


def top(counts, size=L.PROFILE):
    return [code(g) for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


def brute(train, texts):
    sums = {}
    for t, lang in train:
        if t is not None and lang is not None and grams(t):
            sums.setdefault(lang, Counter()).update(grams(t))
    profiles = {lang: {g: i for i, g in enumerate(top(c))} for lang, c in sums.items()}
    out = []
    for t in texts:
        own = top(grams(t))
        if not own or not profiles:
            out.append(("und", 0.0))
            continue
        away = {lang: sum(abs(p[g] - i) if g in p else L.PROFILE for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(away, key=lambda x: (away[x], x))
        out.append((best, 1 - away[best] / (L.PROFILE * len(own))))
    return out


def test_against_brute_force_and_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    flag = L.held_out(F.col("doc_id"))
    got = {r.doc_id: r for r in L.predict_languages(docs, L.learn_profiles(docs.filter(~flag))).withColumn("held_out", flag).collect()}
    want = brute([(r.text, r.lang) for r in rows if not held[r.doc_id]], [r.text for r in rows])
    for r, (lang, score) in zip(rows, want):
        g = got[r.doc_id]
        assert (g.lang_pred, g.held_out) == (lang, held[r.doc_id]) and abs(g.score - score) < 1e-12
    out = [r for r in rows if held[r.doc_id]]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in out) >= 0.95 * len(out) > 0


def test_nulls_ties_repeats_clashing_names_empty(make):
    rows = [(1, "aaa bbb", "y"), (1, "aaa bbb", "y"), (2, "aaa bbb", "x"), (3, None, "x"), (4, "123 !!", "x"), (5, "zzz", None), (None, "ccc", "z"), (6, "", None)]
    docs = make([(*r, 1, 0.5, 2, "i", "k", 3, "p") for r in rows], CLASHING)
    profiles = L.learn_profiles(docs)
    assert profiles.names == ["x", "y", "z"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.predict_languages(docs, profiles).collect()]
    assert sorted(x for x in got if x[0] == 1) == [(1, "x", 1.0)] * 2  # equal profiles: the smaller name
    assert {x[0]: x[1] for x in got if x[0] in (3, 4, 6)} == {3: "und", 4: "und", 6: "und"}
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, _, s in got)
    none = L.learn_profiles(make([], CLASHING))
    assert none.names == [] and {r.lang_pred for r in L.predict_languages(docs, none).collect()} == {"und"}
    assert sorted(r.doc_id for r in L.keep_known_languages(docs, profiles, 0.2).filter("doc_id IS NOT NULL").collect()) == [1, 1, 2]


def test_long_text_in_pieces(monkeypatch):
    text = "Über, naïve Σίσυφος 'x' a1b2 " * 400
    whole = dict(zip(*(x.tolist() for x in L.gram_counts(text))))
    monkeypatch.setattr(L, "PIECE", 97)
    assert dict(zip(*(x.tolist() for x in L.gram_counts(text)))) == whole == {code(g): n for g, n in grams(text).items()}
