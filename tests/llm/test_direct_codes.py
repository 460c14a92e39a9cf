import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from textloom.llm import direct_codes as D
from textloom.llm import word_bpe as W

from .conftest import CLASHING

PATH = P.path("word_bpe_49k.json")
PARTS = ["a", " ", "  ", "\n", "é", "漢", "1", "22", "'s", "'", "'re", "'LL", "'ve x", "<|endoftext|>", "!", "...", " The", "　", "😀", "x" * 40, "\x00", "́", "İ", "Σ", "don't"]


@pytest.mark.parametrize("n", [1, 63, 64, 511, 512, 513, 6000])
def test_any_token_any_document(n):
    rng = np.random.default_rng(n)
    ids = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
    cuts = np.concatenate([[0], np.sort(rng.integers(0, n + 1, 9)), [n]])
    c = D.DirectCodes(D.pack(ids, [*range(9), None], np.diff(cuts)))
    at = rng.permutation(n)
    assert (c.at(at) == ids[at]).all() and c.doc_ids == [*range(9), None]
    assert all((c.document(k) == ids[cuts[k] : cuts[k + 1]]).all() for k in range(10))


def test_word_encoder_equals_the_library():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, k))) for k in (6, 40, 300) for _ in range(400)]
    texts += [f"a{chr(c)}1 {chr(c)}{chr(c)} 'a  {chr(c)}B's don'T{chr(c)}" for c in range(0, 0x10000, 3) if not 0xD800 <= c < 0xE000]
    enc = W.encoder(PATH)
    assert enc.fast is not None
    assert enc.encode(texts) == [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def brute(rows):
    t, at, out = Tokenizer.from_file(PATH), 0, []
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("file_tokens", [1 << 20, 30])
def test_files_against_the_library(make, file_tokens):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 80)))) for i in rnd.sample(range(-100, 400), 60)] + [(1000, None), (1001, ""), (None, "null id"), (1002, "word " * 30_000)]
    docs = make([(i, t, "l", 9, 0.1, 1, "i", "k", 2, "p") for i, t in rows], CLASHING, parts=4)
    manifest = D.write_codes(docs, PATH, end_id=1, file_tokens=file_tokens)
    assert sorted((tuple(r) for r in D.read_codes(manifest).collect()), key=repr) == brute(rows)


def test_repeated_rows_and_empty(make):
    got = D.read_codes(D.write_codes(make([(1, "a b"), (1, "a b"), (2, "c")], "doc_id long, text string"), PATH, end_id=1)).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in got) == [(1, 0, 3), (1, 3, 3), (2, 6, 2)]
    assert D.read_codes(D.write_codes(make([], "doc_id long, text string"), PATH, end_id=1)).count() == 0
