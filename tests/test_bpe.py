import random

import pytest
from pyspark.sql import functions as F

from textloom.constants import SPECIAL_TOKENS
from textloom.operators import bpe as B
from textloom.operators import pretoken as P

tokenizers = pytest.importorskip("tokenizers")


def library_vocab(texts, V):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tr = trainers.BpeTrainer(vocab_size=V, special_tokens=SPECIAL_TOKENS, show_progress=False)
    tok.train_from_iterator(texts, trainer=tr)
    return tok, [k for k, _ in sorted(tok.get_vocab().items(), key=lambda kv: kv[1])]


def texts_df(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def test_fixture_vocabularies(spark):
    m = B.learn_bpe(texts_df(spark, ["cccd cccd cccd"] * 5), 60)
    assert m.vocab == SPECIAL_TOKENS + ["c", "d", "Ġ", "cc", "cd", "cccd", "Ġcccd"]
    m = B.learn_bpe(texts_df(spark, ["ba dc ab cd"]), 60)
    assert m.vocab == SPECIAL_TOKENS + ["a", "b", "c", "d", "Ġ", "ab", "ba", "cd", "dc", "Ġab", "Ġcd", "Ġdc"]


def random_corpus(seed, n=30):
    rnd = random.Random(seed)
    words = ["aa", "ab", "aab", "ba", "bab", "abba", "é", "ü", "a  b", "x1", "12", "!?", "b"]
    return [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 12))) for _ in range(n)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_batched_equals_library_and_single(spark, seed):
    texts = random_corpus(seed)
    df = texts_df(spark, texts)
    batched = B.learn_bpe(df, 70)
    _, lib = library_vocab(texts, 70)
    assert batched.vocab == lib
    if seed == 0:
        single = B.learn_bpe(df, 70, max_batch=1)
        assert single.vocab == batched.vocab and single.merges == batched.merges


def test_encode_decode_against_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(40)
    texts = [r.text for r in docs.collect()]
    model = B.learn_bpe(docs.select("text"), 200)
    tok, lib = library_vocab(texts, 200)
    assert model.vocab == lib
    enc = {r.doc_id: r.ids for r in B.encode_documents(docs, model, "doc_id").collect()}
    for r in docs.collect():
        assert enc[r.doc_id] == tok.encode(r.text).ids
    dec = {r.doc_id: r.text for r in B.decode_documents(B.encode_documents(docs, model, "doc_id"), model, "doc_id").collect()}
    assert dec == {r.doc_id: r.text for r in docs.collect()}


def test_special_tokens_and_unseen_bytes(spark):
    model = B.learn_bpe(texts_df(spark, ["cccd cccd cccd"] * 5), 60)
    df = spark.createDataFrame([(0, "cccd<|endoftext|>cccd"), (1, "cqd")], "k bigint, text string")
    got = {r.k: r.ids for r in B.encode_documents(df, model, "k").collect()}
    ids = model.token_id()
    assert got[0] == [ids["cccd"], 1, ids["cccd"]]
    # 'q' was never seen: it has no id and is dropped before merging
    tok, _ = library_vocab(["cccd cccd cccd"] * 5, 60)
    assert got[1] == tok.encode("cqd").ids == [ids["cd"]]


def test_pretokens_match_library(spark):
    from tokenizers import pre_tokenizers

    pt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    samples = ["Hello world's end", "a  b\n\n c", "x1 23 !! ..", "tab\tend   ", "it'll   be", "日本 語"]
    df = spark.createDataFrame([(s,) for s in samples], "text string")
    got = [r.p for r in df.select(P.pretokens("text").alias("p")).collect()]
    b2c = B.byte_to_char()
    for s, pieces in zip(samples, got):
        lib = [w for w, _ in pt.pre_tokenize_str(s)]
        mine = ["".join(b2c[b] for b in p.encode("utf-8")) for p in pieces]
        assert mine == lib


def test_model_save_load(spark, tmp_path):
    model = B.learn_bpe(texts_df(spark, ["ba dc ab cd"]), 60)
    model.save(spark, str(tmp_path / "m"))
    back = B.BpeModel.load(spark, str(tmp_path / "m"))
    assert back.vocab == model.vocab and back.merges == model.merges


def test_long_piece_is_not_quadratic(spark):
    import time

    from textloom.operators.pieces import PieceEncoder

    model = B.learn_bpe(texts_df(spark, random_corpus(1)), 70)
    b2c, ids = B.byte_to_char(), model.token_id()
    enc = PieceEncoder({b: ids[c] for b, c in b2c.items() if c in ids}, model.merges, {})
    rnd = random.Random(2)
    word = "".join(rnd.choice("ab") for _ in range(80_000))
    t = time.time()
    got = enc.encode(word)
    assert time.time() - t < 5
    tok, _ = library_vocab(random_corpus(1), 70)
    assert got == tok.encode(word).ids


def test_null_text_unknown_ids_and_cut_characters(spark):
    model = B.learn_bpe(texts_df(spark, ["é é"]), 60)
    df = spark.createDataFrame([(0, None), (1, "é")], "k bigint, text string")
    assert {r.k: r.ids for r in B.encode_documents(df, model, "k").collect()}[0] == []
    cut = model.token_id()["Ã"]
    got = B.decode_documents(spark.createDataFrame([(0, [cut]), (1, [1, 10_000])], "k bigint, ids array<bigint>"), model, "k")
    assert {r.k: r.text for r in got.collect()} == {0: "\ufffd", 1: ""}


def test_rounds_leave_one_word_table(spark):
    from textloom.session import checkpoint_dir, file_store

    store, name = file_store(checkpoint_dir(spark))
    from pyarrow import fs

    def tables():
        return [f.path for f in store.get_file_info(fs.FileSelector(name, recursive=False)) if "bpe-words" in f.path]

    before = len(tables())
    B.learn_bpe(texts_df(spark, random_corpus(3)), 60)
    assert len(tables()) - before <= 2


def test_queries_learn_the_default_vocabulary(spark, tmp_path):
    """More tokens than the queries once stopped at, and batches that pass over joined pairs, against the library at 25,000."""
    from textloom.constants import DEFAULT_VOCAB_SIZE
    from textloom.plans import queries as Q

    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgé") for _ in range(rnd.randrange(2, 9))) for _ in range(600)] + ["aaaa", "aaaaaaa", "baaab"]
    docs = [" ".join(rnd.choice(words) for _ in range(12)) for _ in range(120)]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "conv_id string, turn int, role string, text string, ts timestamp").write.parquet(f"{tmp_path}/conversations.parquet")
    got = [r.token for r in Q.queries()["bpe_vocab"](spark, str(tmp_path)).orderBy("id").collect()]
    _, lib = library_vocab(docs, DEFAULT_VOCAB_SIZE)
    assert DEFAULT_VOCAB_SIZE == 25_000 and got == lib and len(got) > 600


def test_one_json_file_for_library_and_engine(spark, tmp_path):
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

    texts = random_corpus(5, 60)
    model = B.learn_bpe(texts_df(spark, texts), 90)
    model.save_file(str(tmp_path / "out" / "tokenizer.json"))
    lib = Tokenizer.from_file(str(tmp_path / "out" / "tokenizer.json"))
    samples = [*texts[:20], "<EMAIL> ab<|endoftext|>aab  ", "", "a\n\nb", "é<PHONE>"]
    docs = spark.createDataFrame(list(enumerate(samples)), "k bigint, text string")
    ours = {r.k: r.ids for r in B.encode_documents(docs, model, "k").collect()}
    assert all(ours[k] == lib.encode(t).ids for k, t in enumerate(samples))
    assert lib.decode(ours[0], skip_special_tokens=False) == samples[0]
    back = B.BpeModel.load_file(str(tmp_path / "out" / "tokenizer.json"))
    assert (back.vocab, back.merges, back.specials) == (model.vocab, model.merges, model.specials)
    # a file that the library wrote
    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer, tok.decoder = pre_tokenizers.ByteLevel(add_prefix_space=False), decoders.ByteLevel()
    tok.train_from_iterator(texts, trainer=trainers.BpeTrainer(vocab_size=90, special_tokens=SPECIAL_TOKENS, show_progress=False))
    tok.save(str(tmp_path / "theirs.json"))
    theirs = B.BpeModel.load_file(str(tmp_path / "theirs.json"))
    assert theirs.vocab == model.vocab and theirs.merges == model.merges and theirs.specials == SPECIAL_TOKENS
    assert spark.createDataFrame([(0,)], "a int").count() == 1


def test_long_alternating_text_with_specials(spark):
    texts = random_corpus(6, 40)
    model = B.learn_bpe(texts_df(spark, texts + ["😀 a😀"] * 4), 120)
    tok, lib = library_vocab(texts + ["😀 a😀"] * 4, 120)
    assert model.vocab == lib
    samples = ["<" + "a😀" * 60_000, "a😀" * 20_000 + "<EMAIL>" + "é" * 50_000 + "<|endoftext|>", "<" * 30_000]
    docs = spark.createDataFrame(list(enumerate(samples)), "k bigint, text string")
    got = {r.k: r.ids for r in B.encode_documents(docs, model, "k").collect()}
    for k, t in enumerate(samples):
        assert got[k] == tok.encode(t).ids


@pytest.mark.parametrize("kept", [4, 40])
def test_a_short_queue_gives_the_same_vocabulary(spark, kept):
    texts = random_corpus(7, 60)
    _, lib = library_vocab(texts, 110)
    jobs = []
    model = B.learn_bpe(texts_df(spark, texts), 110, top_k=kept, progress=lambda r, n: jobs.append(n))
    assert model.vocab == lib and jobs[-1] == len(lib)


def test_a_round_is_one_job(spark):
    """Rounds are as many as they are; each may start one job (and the checkpoint of the blocks another one now and then)."""
    texts = random_corpus(8, 60)
    sc, rounds = spark.sparkContext, []
    sc.setJobGroup("bpe-rounds", "")
    try:
        model = B.learn_bpe(texts_df(spark, texts), 120, progress=lambda r, n: rounds.append(r))
        jobs = len(sc.statusTracker().getJobIdsForGroup("bpe-rounds"))
        one = B.learn_bpe(texts_df(spark, texts), 120, max_batch=1, progress=lambda r, n: rounds.append(r))
        more = len(sc.statusTracker().getJobIdsForGroup("bpe-rounds")) - jobs
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert model.vocab == one.vocab == library_vocab(texts, 120)[1]
    assert more <= 1.5 * sum(1 for r in rounds[rounds.index(1, 1) :]) + 25


def test_a_queue_is_cut_with_its_bound():
    q = B._Queue([(k, 100 - k) for k in range(20)])
    assert q.keep(16) == 0 and len(q.counts) == 20
    assert q.keep(10) == 90 and sorted(q.counts) == list(range(10))
    assert q.first(2, 0) == [(0, 0, 100), (0, 1, 99)]
