import hashlib
import random

from textloom.llm import warc_dictionary as W

PAGES = "page_id long, url string, html string"


def pages(seed, n=120):
    rnd = random.Random(seed)
    words = ["<p>", "</p>", "<div class='x'>", "text", "été", "漢字", "\r\n\r\n", "more"]
    rows = [(i, f"http://h{i}.example/ {i}\n", "".join(rnd.choice(words) for _ in range(rnd.randint(0, 600)))) for i in range(n)]
    big = "<html>" + "b" * 1500
    rows += [(1000 + i, None, big) for i in range(30)] + [(2000 + i, "u", "small") for i in range(4)] + [(3000, None, None), (3001, "u", ""), (None, "u", big), (1005, "again", big), (1029, "again", big), (1007, "other", "q" * 2000)]
    return rows


def brute(rows):
    top = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            top[h] = max(top.get(h, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = i is not None and len(raw) >= 1000 and i < top[h]
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top[h] if again else None))
    return sorted(out, key=repr)


def test_round_trip_against_brute_force(make):
    rows = pages(1)
    got = sorted((tuple(r) for r in W.archive_round_trip(make(rows, PAGES)).collect()), key=repr)
    assert got == brute(rows)


def test_format_and_rotation(monkeypatch):
    monkeypatch.setattr(W, "SAMPLE_RECORDS", 60)
    records = [W.page_record(str(i), "http://x.example/", f"<p>page {i} of the same site</p>".encode() * 40, None) for i in range(300)]
    files = list(W.archive(iter(records), limit=8000))
    assert len(files) > 1 and sum(n for _, n in files) == 300
    back = []
    for chunks, n in files:
        raw = b"".join(chunks)
        parts = [bytes(f) for f in W.frames(memoryview(raw))]
        assert parts == chunks
        got = list(W.read_records(raw))
        assert got[0][0]["WARC-Type"] == "warcinfo" and len(got) == n + 1
        back += [f["WARC-Record-ID"] for f, _ in got[1:]]
    first = b"".join(files[0][0])
    assert first[:4] == (0x184D2A5D).to_bytes(4, "little") and first[8:12] == W.DICTIONARY_MAGIC
    assert back == [f"<urn:page:{i}>" for i in range(300)]


def test_a_record_reads_alone_with_the_dictionary():
    import zstandard

    chunks, _ = next(W.archive(W.page_record(str(i), None, f"<i>{i}</i> shared words ".encode() * 30, None) for i in range(100)))
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(chunks[0][8:]))
    assert b"<urn:page:41>" in press.decompress(chunks[2 + 41])


def test_small_empty_long_and_clashing(make):
    assert W.archive_round_trip(make([], PAGES)).count() == 0
    one = W.archive_round_trip(make([(1, "u", "é" * 2_000_000, "k", 5)], PAGES + ", key string, n long")).collect()
    assert [(r.page_id, r.payload_bytes, r.record_type) for r in one] == [(1, 4_000_000, "response")]


def test_every_archive_of_eight_records_has_a_dictionary(monkeypatch):
    rnd = random.Random(4)
    big = bytes(rnd.randrange(97, 123) for _ in range(1 << 20))
    alike = [W.page_record(str(i), "http://x.example/", f"<p>page {i} of the same site</p>".encode() * 40, None) for i in range(400)]
    cases = [
        [W.page_record("0", "u", big, None), *alike],  # a large first record
        [W.page_record(str(i), "u", big[i * 1000 :], None) for i in range(9)],
        [W.page_record(str(i), None, b"", None) for i in range(8)],  # nearly nothing to train on
        [W.page_record("1", None, b"same", None)] * 30,
    ]
    for records in cases:
        for limit in (W.ARCHIVE_BYTES, 3 << 20):
            back = []
            for chunks, n in W.archive(iter(records), limit):
                raw = b"".join(chunks)
                assert (raw[:4] == (0x184D2A5D).to_bytes(4, "little")) == (n >= 8), (n, len(raw))
                assert n < 8 or raw[8:12] == W.DICTIONARY_MAGIC
                back += [f["WARC-Record-ID"] for f, _ in W.read_records(raw)][1:]
            assert len(back) == len(records)
    few = list(W.archive(iter(alike[:7])))
    assert len(few) == 1 and few[0][0][0][:4] != (0x184D2A5D).to_bytes(4, "little")


def test_pages_that_are_no_revisit_are_not_joined(make, monkeypatch):
    rows = pages(6)
    monkeypatch.setattr(W, "materialize", lambda df, name: seen.append((name, df)) or real(df, name))
    from textloom.session import materialize as real

    seen = []
    got = sorted((tuple(r) for r in W.archive_round_trip(make(rows, PAGES)).collect()), key=repr)
    assert got == brute(rows)
    plan = dict(seen)["warc-manifest"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan
