import hashlib
import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest

from textloom.llm import risk_rules as R


def test_binomial_tail_is_exact():
    for n in (1, 2, 7, 60, 300):
        for k in range(0, n + 1, max(1, n // 13)):
            for share in (Fraction(1, 20), Fraction(1, 2)):
                exact = sum(comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k + 1))
                assert R.binomial_tail(k, n, float(share)) == pytest.approx(float(exact), rel=1e-9)
    assert R.binomial_tail(0, 0, 0.05) == 1.0
    assert 0 < R.binomial_tail(49_000_000, 1_000_000_000, 0.05) < 1e-300 or R.binomial_tail(49_000_000, 1_000_000_000, 0.05) == 0.0


def brute_counts(text):
    t = text or ""
    w = re.findall("[^ \t-\r]+", t)
    lines = [x for x in t.split("\n") if re.search("[^ \t-\r]", x)]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {p for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
        "n_lines": len(lines), "n_capitals": sum("A" <= c <= "Z" for c in t), "n_marks": sum(c in "!?" for c in t),
    }


def statistics(c):
    top, n = R.TOP, max(c["n_words"], 1)
    mean = min(top, 100 * c["word_chars"] // n)
    return {
        "long_words": mean, "short_words": top - mean, "few_words": top - min(top, c["n_words"]), "symbols": min(top, 1000 * c["n_symbols"] // n),
        "capitals": min(top, 1000 * c["n_capitals"] // max(c["word_chars"], 1)), "marks": min(top, 1000 * c["n_marks"] // n),
        "dup_lines": min(top, 1000 * c["n_dup_lines"] // max(c["n_lines"], 1)), "repeat_words": min(top, 1000 * c["n_repeat_words"] // n),
    }


def brute(rows, labels, risk, error, steps, step, lift):
    of = {}
    for i, q in labels:
        if i is not None and q is not None:
            of[i] = min(of.get(i, 1), q)
    docs = []
    for i, t, lang in rows:
        c = brute_counts(t)
        failed = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        docs.append((i, lang or "und", c, statistics(c), failed))
    strata = {}
    for i, s, _, v, failed in docs:
        if i in of and not failed:
            held = hashlib.md5(str(i).encode()).hexdigest()[0] >= "8"
            strata.setdefault(s, {}).setdefault((held, of[i] > 0), []).append(v)
    cutoffs = {}
    tested = sum(bool(x.get((True, True))) for x in strata.values())
    for s, x in strata.items():
        good, bad, held = (x.get(k, []) for k in ((False, True), (False, False), (True, True)))
        ladders = {}
        for name in R.STATISTICS:
            values = sorted(v[name] for v in good)
            if not values:
                continue
            # the least value that enough good documents don't exceed
            cuts = [next(v for v in values if 10000 * sum(u <= v for u in values) >= (10000 - j * step) * len(values)) for j in range(steps + 1)]
            b, g = sum(v[name] > cuts[-1] for v in bad), sum(v > cuts[-1] for v in values)
            if b and b * len(good) >= lift * g * len(bad):
                ladders[name] = cuts
        last = None
        for j in range(steps + 1):
            k = sum(any(v[name] > cuts[j] for name, cuts in ladders.items()) for v in held)
            p = sum(comb(len(held), i) * Fraction(risk, 100) ** i * Fraction(100 - risk, 100) ** (len(held) - i) for i in range(k + 1)) if held else 2
            if p * tested > Fraction(error, 100):
                break
            last = j
        cutoffs[s] = {} if last is None else {name: cuts[last] for name, cuts in ladders.items()}
    return sorted(
        ((i, *[c[x] for x in R.COUNTS[:5]], failed, not failed and not any(v[name] > cut for name, cut in cutoffs.get(s, {}).items())) for i, s, c, v, failed in docs), key=repr
    ), cutoffs


def corpus(rnd, n):
    rows, labels = [], []
    for i in range(n):
        bad = rnd.random() < 0.25
        kind = rnd.choice(["###", "!!", "|"])
        words = ["".join(rnd.choice("abcdefghéß") for _ in range(rnd.randint(1, 8))) for _ in range(rnd.choice([3, 9, 10, 30, 80]))]
        words = [w + kind if bad and rnd.random() < 0.6 else w for w in words]
        text = "".join(w + rnd.choice([" ", " ", "\n", "\t"]) for w in words) * rnd.choice([1, 1, 1, 1, 2])
        rows.append((i, text, rnd.choice(["en", "en", "en", "de", None])))
        if rnd.random() < 0.9:
            labels.append((i, int(not bad)))
    return rows, labels


@pytest.mark.parametrize("n,options", [(700, (10, 20, 20, 25, 2)), (500, (5, 5, 5, 100, 2)), (40, (5, 5, 20, 25, 2))])
def test_against_brute_force(make, n, options):
    rnd = random.Random(n)
    rows, labels = corpus(rnd, n)
    rows += [(None, "a b c d e f g h i j k", "en"), (n, None, "en"), (n + 1, "", None), rows[0], (n + 2, "x! " * 5000, "xx"), (n + 3, "é " + "w" * 200_000, "de")]
    labels += [(None, 1), (n + 9, 1), (3, None), (4, 0), (4, 1), (n, 0)]
    docs = make([(i, t, g, 9, 1.0, 5, 6) for i, t, g in rows], "doc_id long, text string, lang string, n_words long, stratum double, good long, step long", parts=4)
    table = make([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int")
    names = ("risk_percent", "error_percent", "steps", "step", "lift")
    got = R.judge_documents(docs, table, **dict(zip(names, options)))
    want, cutoffs = brute(rows, labels, *options)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    if n == 700:
        assert any(cutoffs.values()) and any(not r[6] and not r[7] for r in want)


def test_no_labels_and_empty(make):
    docs = make([(1, "one two three four five six seven eight nine ten", "en"), (2, "#", None)], "doc_id long, text string, lang string")
    none = make([], "doc_id long, quality int, toxic int")
    assert sorted((r.doc_id, r.kept) for r in R.judge_documents(docs, none).collect()) == [(1, True), (2, False)]
    assert R.judge_documents(make([], "doc_id long, text string, lang string"), none).count() == 0
