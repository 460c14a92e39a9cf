import hashlib
import random
import zlib

import numpy as np
import pytest

from textloom.llm import periodic_runs as P

from .conftest import CLASHING


def brute_runs(w):
    """All maximal runs by definition, period by period."""
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(a <= i and j + q <= z for a, z, _ in found):
                found.append((i, j + q, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(w):
    return P.find_runs(np.zeros(len(w), np.int64), np.array(w, np.int64))


def test_transforms_and_zeros():
    rng = np.random.default_rng(1)
    for prime, root in P.PRIMES:
        for n in (2, 4, 8, 64, 1024):
            x = rng.integers(0, prime, (3, n)).astype(np.uint64)
            assert (P.backward(P.forward(x, prime, root), prime, root) == x).all()
    for size, top in ((2, 2), (4, 3), (16, 2), (16, 1 << 21), (256, 1 << 20)):
        blocks = rng.integers(0, top, (5, size))
        windows = rng.integers(0, top, (5, size + size // 2))
        windows[1, 3 % (size // 2) : 3 % (size // 2) + size] = blocks[1]
        got = P.zero_mismatch(blocks, windows)
        want = np.array([[(w[t : t + size] == b).all() for t in range(windows.shape[1] - size + 1)] for b, w in zip(blocks, windows)])
        assert (got == want).all() and got.any()


def test_runs_against_brute_force():
    rnd = random.Random(11)
    for k in range(1500):
        w = []
        for _ in range(rnd.randint(0, 5)):
            root = [rnd.randint(0, rnd.choice([1, 2, 5, 50])) for _ in range(rnd.choice([1, 2, 3, 4, 5, 6, 7, 10, 11, 12, 20, 21, 22, 33]))]
            w += (root * 12)[: rnd.randint(1, rnd.choice([5, 9]) * len(root))]
            w += [rnd.randint(0, 3) for _ in range(rnd.randint(0, 6))]
        assert runs_of(w) == brute_runs(w), w


def test_overlapping_words_of_few_letters():
    rnd = random.Random(12)
    fib = [0]
    prev = [1]
    while len(fib) < 700:
        fib, prev = fib + prev, fib
    cases = [fib, [0] * 500, [0, 1] * 200 + [0] * 30 + [0, 1] * 77, ([0] * 7 + [1]) * 40, (([0, 1] * 5 + [2]) * 9 + [3]) * 6]
    cases += [[rnd.randint(0, 1) for _ in range(600)] for _ in range(20)]
    for w in cases:
        assert runs_of(w) == brute_runs(w)


def test_long_run_of_one_word():
    assert runs_of([7] * 300_000) == [(0, 300_000, 1)]
    block = list(range(9_000))
    assert runs_of([-1 + 10_000] + block * 5 + [3, 10_001]) == [(1, 45_001, 9_000)]


def brute(doc_id, text):
    w = (text or "").translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ")
    w = [x for x in w if x]
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for a, z, q in runs for i in range(a + q, z)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = min(((a - z, a, q) for a, z, q in runs), default=None)
    best = (None,) * 4 if top is None else (top[1], -top[0], top[2], -1000 * top[0] // top[2])
    return (doc_id, len(runs), *best, digest("".join(f"{a},{z - a},{q}\n" for a, z, q in runs)), digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("parts", [1, 5])
def test_documents_against_brute_force(make, parts):
    rnd = random.Random(parts)
    rows = []
    for i in range(120):
        words = [rnd.choice(["a", "b", "Été", "漢", "😀", "\xa0", "x y"]) for _ in range(rnd.randint(0, 40))]
        words = words * rnd.choice([1, 1, 4, 5]) if rnd.random() < 0.5 else words
        rows.append((i * 7 - 100, "".join(w + rnd.choice([" ", "\n", "\t ", "\x0b\r", "  "]) for w in words)))
    rows += [(None, "a " * 30), (1, None), (2, ""), (3, " \n "), rows[5], (5, "b b b b b b"), (5, "b b b b b"), (11, "z" * 100_000 + " z" * 9)]
    docs = make([(i, t, "l", 9, 0.1, 1, "i", "k", 2, "p") for i, t in rows], CLASHING, parts=parts)
    got = P.run_digest(P.collapse_runs(docs, word_order=P.planted_order))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute(i, t) for i, t in rows), key=repr)
    plain = {r.doc_id: r for r in P.collapse_runs(make([(1, "x a b a b a b a b y")], "doc_id long, text string")).collect()}
    assert plain[1].collapsed == "x a b y" and [tuple(r) for r in plain[1].runs] == [(1, 8, 2)]


def test_empty(make):
    assert P.run_digest(P.collapse_runs(make([], "doc_id long, text string"))).count() == 0
