import random
import re

import pytest

from textloom.llm import components as K
from textloom.llm import shingle_rtree as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sets(t):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    s = {i: sets(t) for i, t in docs}
    comp = {i: i for i in s}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(s)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in ids}


def corpus(seed, families, members, words=60, edits=3, shared=0):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(shared)]
    out = []
    for _ in range(families):
        base = [rnd.choice(vocab) for _ in range(words)]
        for _ in range(members):
            t = list(base)
            for _ in range(rnd.randint(0, edits)):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            out.append(" ".join(t + passage))
    rnd.shuffle(out)
    return list(enumerate(out))


def found(make, docs, **kw):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in S.link_documents(make(docs, "doc_id long, text string"), **kw).collect()}


@pytest.mark.parametrize("args", [(1, 6, 8), (2, 3, 25, 90, 4), (3, 10, 4, 12, 2, 30), (4, 8, 6, 30, 2, 25)])
def test_against_brute_force(make, args):
    docs = corpus(*args) + [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b"), (1004, "a b c"), (1005, " \t\n"), (1006, "a b c d e")]
    assert found(make, docs, sketch_bits=12, filter_bits=12) == brute(docs)


def test_tree_pages_find_what_is_left(make, spark, monkeypatch):
    """Without the contraction the tree alone finds every link."""
    docs = corpus(5, 3, 20, 60, 4, 20)
    monkeypatch.setattr(S, "_pairs", lambda m: m.sparkSession.createDataFrame([], "a long, b long"))
    for page in (4, 256):
        monkeypatch.setattr(S, "PAGE", page)
        assert found(make, docs, sketch_bits=12) == brute(docs)


def test_repeated_rows_nulls_extra_columns_empty(make):
    rows = [(1, "one two three four five six", 9, "x"), (1, "one two three four five six", 9, "x"), (2, "One two three four five six", 9, "y"), (None, "lonely text of its own here", 1, "z"), (3, None, None, None)]
    got = S.link_documents(make(rows, "doc_id long, text string, cls long, cells string"))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in got.collect()) == [(-1, 2, -1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    kept = S.keep_one_of_each(make(rows, "doc_id long, text string, cls long, cells string")).collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept) == [-1, 1, 3]
    assert S.link_documents(make([], "doc_id long, text string")).count() == 0


def test_long_text(make):
    rnd = random.Random(9)
    base = [f"v{rnd.randrange(5000)}" for _ in range(60_000)]
    near = list(base)
    for _ in range(500):
        near[rnd.randrange(len(near))] = "edited"
    far = list(base)
    for _ in range(4000):
        far[rnd.randrange(len(far))] = "edited"
    docs = [(7, " ".join(base)), (5, " ".join(near)), (3, " ".join(far))]
    assert found(make, docs) == brute(docs)


def test_components_of_chains_and_stars(make):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 400)]
    got = {r.node: r.root for r in K.connected_components(make(chain + star + [(7, 7)], "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(200, 400)]}


def brute_links(docs):
    s, comp = [sets(t) for _, t in docs], brute(docs)
    return sorted((i, len(x), comp[i][1], sum(k != j and bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y) for j, y in enumerate(s))) for k, ((i, _), x) in enumerate(zip(docs, s)))


@pytest.mark.parametrize("page", [4, 256])
def test_every_link_inside_components(make, monkeypatch, page):
    monkeypatch.setattr(S, "PAGE", page)
    docs = corpus(7, 3, 18, 60, 3, 20)
    docs += [(500 + k, docs[k][1]) for k in range(4)] + [(900, None), (901, "a b"), (902, "A b")]
    got = sorted(tuple(r) for r in S.count_links(make(docs, "doc_id long, text string"), sketch_bits=12, filter_bits=12).collect())
    assert got == brute_links(docs) and max(n for *_, n in got) > 4


def test_keeping_one_knows_rows_by_id_and_text(make):
    rnd = random.Random(3)

    def text():
        return [f"w{rnd.randrange(900)}" for _ in range(40)]

    a, b, c, d, e, f = (text() for _ in range(6))
    near = lambda t: " ".join(t[:-1] + ["end"])
    a, b, c2, d2, f2, c, d, e, f = " ".join(a), " ".join(b), near(c), near(d), near(f), " ".join(c), " ".join(d), " ".join(e), " ".join(f)
    rows = [(3, a), (5, a), (5, b)]  # only the copy under 5 goes
    rows += [(7, c), (7, c2)]  # near copies under one id
    rows += [(None, d), (None, d2), (None, e), (9, e), (None, f), (None, f), (None, f2)]  # null ids
    rows += [(11, None), (11, None), (None, None), (12, a + " "), (9, e.upper())]
    kept = [tuple(r) for r in S.keep_one_of_each(make(rows, "doc_id long, text string")).collect()]
    ids = sorted((-1 if i is None else i) for i, _ in kept)
    assert ids == [-1, -1, -1, 3, 5, 7, 9, 11]
    assert (5, b) in kept and (3, a) in kept and {t for i, t in kept if i == 7} < {c, c2}
    assert len({t for i, t in kept if i is None} & {d, d2}) == 1 and len({t for i, t in kept if i is None} & {f, f2}) == 1 and (None, None) in kept


def test_a_large_group_of_near_copies_takes_few_pairs(make, monkeypatch):
    """800 near copies and 300 others: right components, and verified pairs in proportion to the documents."""
    rnd = random.Random(21)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(vocab) for _ in range(200)]
    docs = []
    for _ in range(800):
        t = list(base)
        for _ in range(rnd.randint(1, 3)):
            t[rnd.randrange(len(t))] = rnd.choice(vocab)
        docs.append(" ".join(t))
    docs += [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(20, 200))) for _ in range(300)]
    rnd.shuffle(docs)
    docs = list(enumerate(docs))
    pairs, real = [], S._verified
    monkeypatch.setattr(S, "_verified", lambda p, *a: pairs.append(p.count()) or real(p, *a))
    assert found(make, docs, sketch_bits=14) == brute(docs)
    assert sum(pairs) < 16 * len(docs)


def test_hashes_have_no_collisions_by_construction(make):
    """Two words of 1,024 letters that agree under every polynomial hash modulo a power of two."""
    w = "a"
    while len(w) < 1024:
        w += w.translate(str.maketrans("ab", "ba"))
    swapped = w.translate(str.maketrans("ab", "ba"))
    docs = [(1, w), (2, swapped), (3, w), (4, f"x {w} y z q r"), (5, f"x {swapped} y z q r")]
    assert found(make, docs) == brute(docs)


def test_span_hashes_against_exact_arithmetic():
    import numpy as np

    from textloom.llm import common as C

    rnd = random.Random(8)
    fold = C.fold_ascii()
    cuts = sorted({0, 900, *(rnd.randrange(900, 9000) for _ in range(400)), 9000})
    data = np.array([rnd.randrange(256) for _ in range(9000)], np.uint8)
    spans = [(a, max(a, z - rnd.randrange(3))) for a, z in zip(cuts, cuts[1:])]
    starts, ends = np.array([a for a, _ in spans]), np.array([z for _, z in spans])
    for step in (1, 37, 1 << 20):
        got = C.span_hashes(data, starts, ends, fold, step)
        want = [sum((int(fold[b]) + 1) * pow(C._POINT, k, C._PRIME) for k, b in enumerate(data[a:z].tolist())) % C._PRIME for a, z in spans]
        assert got.tolist() == C.mix64(np.array(want, np.uint64)).tolist()


def test_cells_are_shuffled_packed(spark):
    """Members of cells with several classes, each with its neighbour and the smallest one, from far fewer shuffled rows than there are cells."""
    from textloom.llm import shingle_rtree as S

    rows = [(20 + k % 7, 1000 + k, [*range(k * 50, k * 50 + 40), -1 - k % 3]) for k in range(60)]
    rows += [rows[0], rows[1], (5, 2000, None), (None, None, None)]
    index = spark.createDataFrame(rows, "n long, cls long, cells array<long>").repartition(3)
    packed = S._posts(index, 2)
    assert packed.count() <= 2 * 3
    want = set()
    for cell in range(-3, 0):
        # all other cells have one class
        members = sorted({(n, cls) for n, cls, cells in rows if cells and cell in cells})
        for i, (n, cls) in enumerate(members):
            before = (members[i - 1][1], members[i - 1][0], 40) if i else None
            want.add((cell, n, cls, 40, before, (members[0][1], members[0][0], 40)))
    got = [(r.cell, r.n, r.cls, r.pos, r.before and tuple(r.before), tuple(r.least)) for r in S._neighbours(index).collect()]
    assert len(got) == len(want) and set(got) == want
    assert S._neighbours(index.filter("cls IS NULL")).collect() == []
