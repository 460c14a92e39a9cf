import hashlib
import random

import pytest

from textloom.llm import prefix_hash as H

from .conftest import CLASHING


def test_spans_and_extensions():
    rnd = random.Random(2)
    for _ in range(60):
        a, b = ("".join(rnd.choice("abé😀") for _ in range(rnd.randint(0, 80))) for _ in range(2))
        x, y = H.PrefixHashes(a), H.PrefixHashes(b)
        for _ in range(30):
            i, j, n = rnd.randint(0, len(a)), rnd.randint(0, len(b)), rnd.randint(0, 6)
            assert x.spans_equal(i, y, j, n) == (i + n <= len(a) and j + n <= len(b) and a[i : i + n] == b[j : j + n])
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            assert x.common_extension(i, y, j) == k


def brute_likeness(a, b):
    if a == b:
        return 1.0
    k = max(max(0, (len(t) // H.GRID).bit_length()) for t in (a, b))
    grid, low = 1 << k, min(len(a), len(b))
    head = max([x for x in range(0, low + 1, grid) if a[:x] == b[:x]], default=0)
    tail = max([x for x in range(0, low + 1, grid) if x == 0 or a[-x:] == b[-x:]], default=0)
    return min(head + tail, low) / max(len(a), len(b), 1)


def test_likeness_against_texts():
    rnd = random.Random(3)
    for _ in range(300):
        a = "".join(rnd.choice("ab") for _ in range(rnd.choice([0, 1, 5, 31, 32, 33, 200, 900])))
        b = a[: rnd.randint(0, len(a))] + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 20))) + (a[-rnd.randint(1, 300) :] if rnd.random() < 0.5 else "")
        assert H.likeness(H.fingerprint(a), H.fingerprint(b)) == pytest.approx(brute_likeness(a, b))
    assert H.likeness(H.fingerprint(""), H.fingerprint("")) == 1.0 and len(H.fingerprint("x" * 100_000)) < 560


def brute(rows):
    desc = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], r[1] or ""), reverse=True)
    out = []
    for k, (i, t) in enumerate(desc):
        t, nxt = t or "", desc[(k + 1) % len(desc)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, b, c = H.fingerprint(t), H.fingerprint(edited), H.fingerprint(nxt)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, H.likeness(a, b), H.likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_pairs_against_brute_force(make, n):
    rnd = random.Random(n)
    rows = [(rnd.randint(-50, 50), "".join(rnd.choice("ab 漢") for _ in range(rnd.randint(0, 300)))) for _ in range(n)]
    if n > 3:
        rows += [rows[0], (None, "null id"), (None, ""), (99, None), (7, "tie one"), (7, "tie two"), (-99, "z" * 200_000)]
    docs = make([(i, t, "l", 9, 0.1, 1, "i", "k", 2, "p") for i, t in rows], CLASHING, parts=4)
    assert sorted((tuple(r) for r in H.compare_with_next(docs).collect()), key=repr) == brute(rows)


def test_empty(make):
    assert H.compare_with_next(make([], "doc_id long, text string")).count() == 0
