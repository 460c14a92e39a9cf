import json

import pytest
from pyspark.sql import functions as F

from textloom.sources import readers as R
from textloom.sources.index import cached


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_jsonl_line_numbers_and_field(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", "\n".join(json.dumps({"text": f"doc {i}", "meta": {"x": i}}) for i in range(5)) + "\n")
    got = R.read_jsonl(spark, p, "text").orderBy("line_no").collect()
    assert [r.text for r in got] == [f"doc {i}" for i in range(5)] and [r.line_no for r in got] == list(range(5))


def test_jsonl_list_field_and_duplicate_key(spark, tmp_path):
    p = write(tmp_path / "b.jsonl", '{"cont": ["a", "bb"]}\n{"cont": ["x"], "cont": ["y", "z"]}\n')
    got = [r.cont for r in R.read_jsonl(spark, p, "cont", "array<string>").orderBy("line_no").collect()]
    assert got == [["a", "bb"], ["y", "z"]]


def test_failfast_and_permissive(spark, tmp_path):
    p = write(tmp_path / "c.jsonl", '{"text": "ok"}\nnot json\n')
    with pytest.raises(Exception):
        R.read_jsonl(spark, p, "text").collect()
    got = R.read_jsonl(spark, p, "text", mode="PERMISSIVE").orderBy("line_no").collect()
    assert [r.text for r in got] == ["ok", None]


def test_wholefile_and_wrapped(spark, tmp_path):
    p1 = write(tmp_path / "l.json", json.dumps([["hi", "yo"], ["x"]]))
    got = sorted(tuple(r.turns) for r in R.read_wholefile_json(spark, p1).collect())
    assert got == [("hi", "yo"), ("x",)]
    p2 = write(tmp_path / "w.json", json.dumps([[{"texts": ["a", "b"]}, {"texts": ["c"]}], [{"texts": ["ignored"]}]]))
    got = sorted(tuple(r.turns) for r in R.read_wholefile_json(spark, p2, wrapped=True).collect())
    assert got == [("a", "b"), ("c",)]


def test_text_table_column_choice(spark, tmp_path):
    p = write(tmp_path / "t.csv", 'body,text\n"x","y"\n')
    assert R.read_text_table(spark, p, "csv").first().text == "y"
    p = write(tmp_path / "u.csv", 'body,other\n"x","y"\n')
    assert R.read_text_table(spark, p, "csv").first().text == "x"
    p = write(tmp_path / "v.txt", "l1\nl2\n")
    assert sorted(r.text for r in R.read_text_table(spark, p, "txt").collect()) == ["l1\n", "l2\n"]
    with pytest.raises(ValueError):
        R.read_text_table(spark, p, "xml")


def test_compressed_refusal(spark, tmp_path):
    import gzip

    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.jsonl.gz", "wt") as f:
        f.write('{"text": "zipped"}\n')
    write(tmp_path / "in" / "b.jsonl", '{"text": "plain"}\n')
    for paths in (str(tmp_path / "in"), str(tmp_path / "in" / "*"), [str(tmp_path / "in" / "a.jsonl.gz")]):
        with pytest.raises(NotImplementedError):
            R.read_jsonl(spark, paths, "text", reject_compressed=True)
    assert sorted(r.text for r in R.read_jsonl(spark, str(tmp_path / "in"), "text").collect()) == ["plain", "zipped"]


@pytest.mark.parametrize("line", ['{"other": 1}', "", "   ", '{"text": 5}', '{"text": null}', '{"text": {"a": 1}}', '{"text": ["a", 1]}', "nope"])
def test_strict_scan_fails_on_what_the_original_fails_on(spark, tmp_path, line):
    p = write(tmp_path / "s.jsonl", f'{{"text": "ok"}}\n{line}\n{{"text": "ok"}}\n')
    with pytest.raises(Exception):
        R.read_jsonl(spark, p, "text").collect()
    got = R.read_jsonl(spark, p, "text", mode="PERMISSIVE").orderBy("line_no").collect()
    assert [r.text for r in got] == ["ok", None, "ok"]


def test_lists_under_a_scalar_field_are_joined(spark, tmp_path):
    p = write(tmp_path / "m.jsonl", '{"text": "ok"}\n{"text": ["a", "b"]}\n{"text": []}\n{"text": "[\\"x\\"]"}\n')
    assert [r.text for r in R.read_jsonl(spark, p, "text").orderBy("line_no").collect()] == ["ok", "ab", "", '["x"]']


def test_json_table_takes_the_first_column_of_the_file(spark, tmp_path):
    p = write(tmp_path / "z.json", '{"zeta": "first", "alpha": "second"}\n{"zeta": "third", "alpha": "x"}\n')
    assert sorted(r.text for r in R.read_text_table(spark, p, "json").collect()) == ["first", "third"]
    p = write(tmp_path / "y.json", '{"alpha": "x", "text": "t"}\n')
    assert R.read_text_table(spark, p, "json").first().text == "t"


def test_last_line_without_break(spark, tmp_path):
    (tmp_path / "t").mkdir()
    write(tmp_path / "t" / "a.txt", "l1\nl2")
    write(tmp_path / "t" / "b.txt", "é3\n\n")
    assert sorted(r.text for r in R.read_text_table(spark, str(tmp_path / "t"), "txt").collect()) == ["\n", "l1\n", "l2", "é3\n"]


def test_line_numbers_over_splits_and_no_shuffle_of_lines(spark, tmp_path):
    paths = [write(tmp_path / f"{n}.jsonl", "".join(json.dumps({"text": f"{n} {i}"}) + "\n" for i in range(4000))) for n in "ab"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = R.read_jsonl(spark, paths, "text")
        assert df.rdd.getNumPartitions() > 4
        got = [(r.file.rsplit("/", 1)[1][0], r.line_no, r.text) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted((n, i, f"{n} {i}") for n in "ab" for i in range(4000))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "value" in x] and "rangepartitioning" not in plan


def test_cache_load_or_build(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "idx")
    assert cached(spark, path, build).count() == 3
    assert cached(spark, path, build).count() == 3 and len(calls) == 1
    assert cached(spark, path, build, recache=True).count() == 3 and len(calls) == 2


@pytest.mark.parametrize("query", ["jsonl_scan", "scanned_union_index"])
def test_ordered_sets_have_part_files_by_size(spark, tmp_path, monkeypatch, query):
    """The files of a set, and so the tasks that write it, grow with its text; numbers and index go on over them."""
    from textloom.plans import order_plans, queries, source_plans

    docs = [(i, f"text {i} " + "x" * (i * 13 % 90), "s", "en") for i in range(203) if i % 7]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, f"item {i}") for i in range(9)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i // 2, i % 2, "user", f"turn {i}") for i in range(40)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    monkeypatch.setattr(R, "FILE_BYTES", 512, raising=False)
    paths = []
    for module in (source_plans, order_plans):
        monkeypatch.setattr(module, "scratch_path", lambda s, name: paths.append(f"{tmp_path}/out-{query}-{name}") or paths[-1])
    got = queries.queries()[query](spark, str(tmp_path)).collect()
    if query == "jsonl_scan":
        want, seen = [], {}
        for i, text, _, _ in docs:
            want.append((i, text, len(text), seen.get(i % 4, 0)))
            seen[i % 4] = seen.get(i % 4, 0) + 1
    else:
        rows = [(0, d[0], len(d[1])) for d in docs] + [(1, i, len(f"item {i}")) for i in range(9)]
        rows += [(2, i, len(f"turn {2 * i}<|endoftext|>turn {2 * i + 1}")) for i in range(20)]
        want = [(*r, k) for k, r in enumerate(rows)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    names = {p.rsplit("part-", 1)[1][:5] for p in spark.read.text([f"{paths[0]}/*/*.json" if query == "jsonl_scan" else paths[0]]).inputFiles()}
    assert len(names) > 10
