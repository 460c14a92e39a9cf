import hashlib
import json
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from textloom.llm import chunked_bpe as C

from .conftest import CLASHING

PATH = P.path("byte_bpe_50k.json")
PARTS = ["a", " ", "  ", "\n", "\t", "é", "漢", "1", "'s", "<|endoftext|>", "!", " the", "　", "😀", "x" * 40, " b", "\x00", "́", "\r\n", "   \n"]


def texts(seed, n=80):
    rnd = random.Random(seed)
    passage = " ".join(rnd.choice(["alpha", "beta", "gamma,", "δέλτα"]) for _ in range(900))
    out = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, k))) for k in (10, 200, 2500) for _ in range(n)]
    out += [out[i] + passage + out[-i] for i in range(1, min(20, n))] + ["", None, " ", "x" * 70_000, " " * 5000, "a b " * 20_000]
    return out


@pytest.mark.parametrize("bits", [3, 9])
def test_equal_to_the_library(monkeypatch, bits):
    monkeypatch.setattr(C, "CUT_BITS", bits)
    t, lib, enc = texts(bits), Tokenizer.from_file(PATH), C.ByteBPE(PATH)
    assert enc.library is None
    ids, off = enc.encode_column(pa.array(t, pa.string()))
    for k, e in enumerate(lib.encode_batch([x or "" for x in t], add_special_tokens=False)):
        own = ids[off[k] : off[k + 1]]
        assert own.tolist() == e.ids and enc.decode(own) == lib.decode(e.ids, skip_special_tokens=False) == (t[k] or "")


def test_shared_passages_are_encoded_once():
    enc = C.ByteBPE(PATH)
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(4000)]
    passage = " ".join(words)
    enc.encode_column(pa.array(["first start " + passage]))
    before, calls = set(enc.store), []
    real = enc.encode_text
    enc.encode_text = lambda t: calls.append(t) or real(t)
    enc.encode_column(pa.array(["quite another beginning " + passage + " and end"]))
    assert before and sum(map(len, calls)) < 0.15 * len(passage)


def test_joins_are_repaired_and_chinese_text_is_shared(monkeypatch):
    monkeypatch.setattr(C, "CUT_BITS", 7)
    lib, rnd = Tokenizer.from_file(PATH), random.Random(9)
    han = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏"
    passage = "，".join("".join(rnd.choice(han) for _ in range(rnd.randint(3, 12))) for _ in range(900)) + "。"
    enc, calls = C.ByteBPE(PATH), []
    first = enc.encode_column(pa.array(["开始：" + passage]))[0]
    assert enc.repaired > 50 and enc.widened == 0
    real = enc.encode_text
    enc.encode_text = lambda t: calls.append(t) or real(t)
    second = enc.encode_column(pa.array(["另一个文档！" + passage + "完"]))[0]
    assert sum(map(len, calls)) < 0.05 * len(passage)
    assert first.tolist() == lib.encode("开始：" + passage, add_special_tokens=False).ids
    assert second.tolist() == lib.encode("另一个文档！" + passage + "完", add_special_tokens=False).ids


def test_disagreeing_repairs_are_widened(monkeypatch):
    monkeypatch.setattr(C, "CUT_BITS", 4)
    lib, rnd = Tokenizer.from_file(PATH), random.Random(10)
    t = [" ".join(rnd.choice(["alpha", "it's", "we're", "été", "12a"]) for _ in range(400)) for _ in range(4)]
    enc = C.ByteBPE(PATH)
    # positions in the middle of words are no agreement positions: the comparison must find that out
    monkeypatch.setattr(C, "agreement_positions", lambda raw, specials=(): C.np.arange(3, len(raw), 7)[[raw[i] & 0xC0 != 0x80 for i in range(3, len(raw), 7)]])
    enc.encode_column(pa.array(t))
    assert enc.widened > 0
    monkeypatch.undo()
    monkeypatch.setattr(C, "CUT_BITS", 4)
    enc = C.ByteBPE(PATH)
    ids, off = enc.encode_column(pa.array(t))
    assert enc.widened == 0 and [ids[off[k] : off[k + 1]].tolist() for k in range(4)] == [lib.encode(x, add_special_tokens=False).ids for x in t]


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, " " * 5_000_000 + "x", "ab" * 2_500_000, "😀" * 1_000_000, "a" + "\u3000" * 600_000 + " b" + "\t" * 9000 + "<|endoftext|>" + " " * 9000])
def test_very_long_runs(text):
    enc, lib = C.ByteBPE(PATH), Tokenizer.from_file(PATH)
    ids, off = enc.encode_column(pa.array([text, "short", text[:5000] + "<|endoftext|>x"]))
    assert ids[off[0] : off[1]].tolist() == lib.encode(text, add_special_tokens=False).ids
    assert ids[off[2] : off[3]].tolist() == lib.encode(text[:5000] + "<|endoftext|>x", add_special_tokens=False).ids
    assert enc.decode(ids[off[0] : off[1]]) == text


def test_every_pair_of_characters_at_a_position():
    """Pieces of the library never reach over an agreement position, for characters of all classes around it."""
    from tokenizers import pre_tokenizers

    split, rnd = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True), random.Random(3)
    chars = ["a", "s", "t", "'", "é", "漢", "٣", "1", "½", " ", "\n", "\u3000", "\x85", "!", "。", "’", "😀", "\x00", "\u0301", "Ⅷ", "ª", "𝒜", "\u200b", "\ufeff"]
    for _ in range(4000):
        t = "".join(rnd.choice(chars) for _ in range(rnd.randint(2, 14)))
        at = set(C.agreement_positions(t.encode()).tolist())
        ends = {len(t[: e].encode()) for _, (b, e) in split.pre_tokenize_str(t)}
        assert at <= ends, (t, at, ends)


def test_store_is_bounded(monkeypatch):
    monkeypatch.setattr(C, "STORE_BYTES", 4000)
    enc = C.ByteBPE(PATH)
    t = pa.array(texts(7, 10), pa.string())
    a = enc.encode_column(t)[0]
    assert enc.held <= 4000 + 400_000 and (a == C.ByteBPE(PATH).encode_column(t)[0]).all()


def test_other_files_go_through_the_library(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec), encoding="utf-8")
    enc, lib = C.ByteBPE(str(tmp_path / "t.json")), Tokenizer.from_file(str(tmp_path / "t.json"))
    assert enc.library is not None
    t = ["hello world", "", "é x"]
    ids, off = enc.encode_column(pa.array(t))
    assert [ids[off[k] : off[k + 1]].tolist() for k in range(3)] == [e.ids for e in lib.encode_batch(t, add_special_tokens=False)]


def test_documents_round_trip_and_digest(make):
    rows = [(i, t) for i, t in enumerate(texts(8, 6))] + [(3, "again"), (3, "again"), (None, "null id")]
    docs = make([(i, t, "l", 9, 0.1, 1, "i", "k", 2, "p") for i, t in rows], CLASHING)
    encoded = C.encode_documents(docs, PATH)
    back = sorted(((r.doc_id, r.text) for r in C.decode_documents(encoded, PATH).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t in rows), key=repr)
    lib = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in C.encoding_digest(encoded, PATH).collect()), key=repr) == sorted(want, key=repr)
    assert C.encode_documents(make([], "doc_id long, text string"), PATH).count() == 0


def test_decoding_foreign_ids():
    enc, lib = C.ByteBPE(PATH), Tokenizer.from_file(PATH)
    for ids in ([], [220], [172], [172, 102], [50256, 5], [10**6, 5]):
        assert enc.decode(ids) == lib.decode(ids, skip_special_tokens=False)
