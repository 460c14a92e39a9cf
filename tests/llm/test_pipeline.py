import random
import re

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from textloom.session import materialize

from .test_fm_index import brute as hits
from .test_shingle_rtree import brute as components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and that with from this have are which".split(), "de": "der die und das nicht ein sich auf für werden".split()}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(11)
    folder = tmp_path_factory.mktemp("corpus")

    def text(lang, n):
        return " ".join(rnd.choice(WORDS[lang]) + rnd.choice(["", "er", "ing", "s", "ly", "en"]) for _ in range(n))

    items = [(i, text("en", 14)) for i in range(5)]
    rows = [(i, text(lang, rnd.randint(20, 80)), lang) for i, lang in enumerate(rnd.choice(list(WORDS)) for _ in range(60))]
    rows += [(100, rows[3][1], "en"), (101, rows[3][1] + " end", "en"), (102, None, "en"), (103, "12345 !!", "de"), (104, "漢字" * 30, None)]
    rows += [(105, text("en", 30) + " " + items[2][1].upper() + " " + text("en", 30), "en"), (106, items[1][1], "en")]
    rows += [(107, text("en", 30) + " mail a.b7@mail.example.com or +1 (555) 555-1234 " + text("en", 9), "en")]
    spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, items


def test_each_stage_on_its_own_input(spark, tables):
    folder, rows, items = tables
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in P.STAGES:
        out = materialize(stage(spark, docs, folder), "stage")
        kept.append({r.doc_id: r for r in out.collect()})
        if name != P.STAGES[-1][0]:
            assert out.schema.names == docs.schema.names
        docs = out
    lang, near, clean, masked, ids = kept
    assert {i for i, _, _ in rows} - set(lang) == {102, 103, 104}
    found = components([(i, r.text) for i, r in lang.items()])
    assert set(near) == {i for i, (_, c) in found.items() if i == c} and {100, 101} & set(near) == set()
    assert 106 in near and 106 not in clean and set(near) - set(clean) == {106}
    assert all(h == 0 for _, h, _ in hits([r.text for r in clean.values()], items))
    touched = {i for i, r in near.items() if hits([r.text], items)[0][1]}
    assert 105 in touched and all(clean[i].text == near[i].text for i in clean if i not in touched)
    assert "@" not in masked[107].text and "555" not in masked[107].text and "[EMAIL]" in masked[107].text and "[PHONE]" in masked[107].text
    assert all(masked[i].text == clean[i].text for i in masked if not re.search("[0-9@]", clean[i].text))
    assert all(r.n_chars == len(r.text) for r in masked.values())
    assert set(ids) == set(masked) and all(r.n_tokens == len(r.ids) > 0 for r in ids.values())


def test_run_equals_its_stages_and_empty(spark, tables, tmp_path):
    folder, rows, _ = tables
    out = P.run(spark, folder)
    assert out.columns == ["doc_id", "ids", "n_tokens"] and 0 < out.count() < len(rows)
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").filter(F.lit(False)).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
