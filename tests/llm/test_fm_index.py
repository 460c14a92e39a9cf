import random
import re

import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import fm_index as X

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(texts, items, window=10):
    phrases = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            phrases.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(p) for p in phrases}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in phrases:
                    found |= phrases[tuple(w[k : k + size])]
                    hit |= set(range(k, k + size))
        out.append((len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


@pytest.mark.parametrize("n,top", [(1, 2), (7, 2), (300, 3), (2000, 50)])
def test_index_against_scan(n, top):
    rng = np.random.default_rng(n)
    text = np.append(rng.integers(0, top + 1, n), 0)
    index = X.FMIndex(text, top)
    phrases = np.array([np.append(np.zeros(5 - k, int), rng.integers(1, top + 1, k)) for k in rng.integers(1, 6, 40)])
    for p, low, high in zip(phrases, *index.search(phrases)):
        p = p[p > 0]
        assert sorted(index.locate(np.arange(low, max(low, high))).tolist()) == [i for i in range(len(text) - len(p) + 1) if (text[i : i + len(p)] == p).all()]


def random_case(seed):
    rnd = random.Random(seed)
    words = ["a", "b", "é", "x1", "The", "漢"]
    texts = [" ".join(rnd.choice(words) + rnd.choice(["", ",", "!\n"]) for _ in range(rnd.randint(0, 300))) for _ in range(40)] + [None, "", "...", "a"]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 10, 12])))) for i in range(3, 10)] + [(20, None), (21, "!!"), (None, "b b b")]
    return texts, items


@pytest.mark.parametrize("shard", [64, 1 << 20])
def test_against_brute_force(make, shard):
    for seed in (1, 2):
        texts, items = random_case(seed)
        docs = make([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in X.find_contamination(docs, make(items, "item_id long, text string"), shard_words=shard).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, items)


def test_blocks_give_the_same(make, tmp_path):
    texts, items = random_case(3)
    files = [X.prepare_phrases(make(items, "item_id long, text string"), block_bytes=size) for size in (1 << 20, 8)]
    assert len(files[0]) == 1 and len(files[1]) > 3
    a, b = (X.search_texts(pa.array(texts, pa.string()), f) for f in files)
    assert (a["n_hit"] == b["n_hit"]).all() and a["items"] == b["items"] and a["spans"] == b["spans"]


def test_empty_tables_and_extra_columns(make):
    docs = make([(1, "one two", "x", 7)], "doc_id long, text string, items string, n_hit long")
    none = X.contamination_digest(X.find_contamination(docs, make([], "item_id long, text string"))).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in none] == [(2, 0, False)]
    assert X.find_contamination(make([], "doc_id long, text string"), make([(1, "a")], "item_id long, text string")).count() == 0


def test_removal(make):
    passage = " ".join(f"w{i}" for i in range(14))
    texts = ["Before it, " + passage.upper() + "! after it.", passage, "clean text", None, "", " ".join(f"w{i}" for i in range(5)) + " " + passage + " " + " ".join(f"w{i}" for i in range(5, 14))]
    docs = make([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in X.remove_contamination(docs, make([(0, passage)], "item_id long, text string")).collect()}
    assert got[0].text == "Before it, \n! after it." and got[2].text == "clean text" and got[3].text is None and got[4].text == ""
    assert 1 not in got and 5 not in got  # nothing is left of these, the second only after its halves met
    assert got[0].lang == "en"
    again = X.find_contamination(make([(0, got[0].text)], "doc_id long, text string"), make([(0, passage)], "item_id long, text string")).first()
    assert again.n_hit == 0
