import random

import public_tokenizers as P
import pyarrow as pa
import pytest

from textloom.llm import token_counts as C

from .conftest import CLASHING

MODEL = P.path("piece_bpe_32k.model")
PARTS = ["a", " ", "  ", "\n", "\t", "é", "漢", "1", "'s", "<s>", "</s>", "<unk>", "<0x0A>", "!", " the", "▁", "　", "😀", "x" * 40, " b", "\x00", "́", "ﬁ"]


def texts(seed, n=400):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, k))) for k in (8, 60, 600) for _ in range(n)] + ["", None, " ", "  ", "a ", "a  ", " a"]


@pytest.mark.parametrize("slice_bytes", [1 << 22, 500])
def test_equal_to_the_library(monkeypatch, slice_bytes):
    import sentencepiece

    monkeypatch.setattr(C, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(C, "BATCH_BYTES", 300)
    t = texts(1)
    want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=MODEL).encode([x or "" for x in t])]
    counter = C.PieceCounter(MODEL)
    assert counter.splits
    assert counter.counts(pa.array(t, pa.string())).tolist() == want
    counter.splits = False  # a model that can't be split: whole texts
    assert counter.counts(pa.array(t[:300], pa.string())).tolist() == want[:300]


def test_store_starts_anew(monkeypatch):
    monkeypatch.setattr(C, "STORE_PARTS", 50)
    counter = C.PieceCounter(MODEL)
    t = pa.array(texts(2, 100), pa.string())
    assert counter.counts(t).tolist() == counter.counts(t).tolist() == C.PieceCounter(MODEL).counts(t).tolist()
    assert len(counter.known)


def test_column_function(make, spark):
    rows = [(1, "a b " * 3000), (2, None), (3, ""), (1, "a b " * 3000), (None, "x")]
    docs = make([(i, t, "l", 9, 0.1, 1, "i", "k", 2, "p") for i, t in rows], CLASHING)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in C.count_tokens(docs, MODEL).collect())
    assert got == [(0, 1, 1, False), (1, 12000, 6001, True), (1, 12000, 6001, True), (2, 0, 0, False), (3, 0, 0, False)]
    assert C.count_tokens(make([], "doc_id long, text string"), MODEL).count() == 0
    assert "Exchange" not in C.count_tokens(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), MODEL)._jdf.queryExecution().toString()


def test_library_files(make):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t = texts(3, 30)
    assert C.counter(path).counts(pa.array(t, pa.string())).tolist() == [len(e.ids) for e in Tokenizer.from_file(path).encode_batch([x or "" for x in t], add_special_tokens=False)]
