import random
import re
from collections import Counter

import numpy as np
import pytest

from textloom.llm import phrase_mining as P

from .conftest import CLASHING


def test_summaries_keep_every_frequent_key():
    rnd = random.Random(4)
    for threshold in (2, 3, 7, 30):
        stream = [int(rnd.paretovariate(0.6)) % 5000 for _ in range(20_000)]
        true = Counter(stream)
        summary = P.MisraGries(len(stream) // threshold + 1)
        at = 0
        while at < len(stream):
            n = rnd.randint(1, 900)
            keys, counts = np.unique(np.array(stream[at : at + n], np.uint64), return_counts=True)
            back = P.unpack_summary(P.pack_summary(keys, counts.astype(np.int64)))
            assert (back[0] == keys).all() and (back[1] == counts).all()
            summary.add(*back)
            if rnd.random() < 0.2:
                summary.settle()
            at += n
        summary.settle()
        assert len(summary.keys) <= summary.capacity and summary.taken < threshold
        held = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
        for k, c in true.items():
            assert c - summary.taken <= held.get(k, 0) <= c
        assert all(k in held or c < threshold for k, c in true.items())


def test_packed_counts_of_any_size():
    keys = np.array([0, 1, (1 << 32) + 5, (1 << 40) - 1], np.uint64)
    counts = np.array([254, 255, 1 << 40, 1], np.int64)
    got = P.unpack_summary(P.pack_summary(keys, counts))
    assert got[0].tolist() == keys.tolist() and got[1].tolist() == counts.tolist()


def brute(rows, threshold, keep):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= threshold}
    out = []
    for (lang, g), a in cand.items():
        longer = [b for (m, h), b in cand.items() if m == lang and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
        if any(100 * b >= 80 * a for b in longer):
            continue
        score, _, l, r = min((2000000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
        out.append((lang, -score, -a, " ".join(g).encode(), l, r, n[lang]))
    got, rank = [], Counter()
    for lang, s, a, g, l, r, m in sorted(out):
        rank[lang] += 1
        if rank[lang] <= keep:
            got.append((lang, rank[lang], g.decode(), -a, l, r, m, -s))
    return got


@pytest.mark.parametrize("threshold,options", [(30, {}), (4, {"parts": 3}), (3, {"parts": 2, "filter_bits": 6})])
def test_against_brute_force(make, threshold, options):
    rnd = random.Random(threshold)
    vocab = ["New", "york", "CITY", "été", "ÉTÉ", "漢字", "a", "b", "c-d", "x's", "😀"]
    sep = [" ", "  ", "\t", ", ", ".", "\n", " \x0b", "!?", "\r\n", "\x85", "\xa0"]
    rows = []
    for _ in range(150):
        text = "".join(rnd.choice(vocab[: rnd.choice([3, 6, 11])]) + rnd.choice(sep[: rnd.choice([2, 4, 11])]) for _ in range(rnd.randint(0, 60)))
        rows.append((text, rnd.choice(["en", "en", "en", "fr", None, "und"])))
    rows += [(None, "en"), ("", None), ("...", "de"), (rows[0][0], rows[0][1]), ("to be or " * 3000, "en")]
    docs = make([(i, t, g, 9, 0.1, 1, "i", "k", 2, "p") for i, (t, g) in enumerate(rows)], CLASHING, parts=4)
    got = [tuple(r) for r in P.mine_collocations(docs, threshold, 40, **options).collect()]
    want = brute(rows, threshold, 40)
    assert sorted(got) == sorted(want) and len(want) > 5


def test_nothing_frequent_and_empty(make):
    assert P.mine_collocations(make([(1, "a b c", "en")], "doc_id long, text string, lang string")).count() == 0
    assert P.mine_collocations(make([], "doc_id long, text string, lang string")).count() == 0
    assert P.mine_collocations(make([(1, None, None)], "doc_id long, text string, lang string")).count() == 0
