"""Softmax and nucleus of large groups, shuffles by random access, scanned indexes, batch store, incremental index, hooks, continuous batches."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators import hooks as H
from textloom.operators import metrics as M
from textloom.operators import order as O
from textloom.operators import pretoken as P
from textloom.operators import select as G
from textloom.operators import sequence as Q
from textloom.operators.position import global_prefix_sum
from textloom.sources import batch_store as BS
from textloom.sources import incremental as INC
from textloom.sources import readers as R
from textloom.streaming import encode as S


def brute_nucleus(rows, p):
    """Rows kept by definition: (group, item, prob)."""
    out, groups = [], {}
    for g, i, s in rows:
        groups.setdefault(g, []).append((s, i))
    for g, items in groups.items():
        items.sort(key=lambda x: (-x[0], x[1]))
        top = items[0][0]
        total = math.fsum(math.exp(s - top) for s, _ in items)
        before = 0.0
        for s, i in items:
            prob = math.exp(s - top) / total
            if before <= p:
                out.append((g, i, round(prob, 12)))
            before += prob
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_nucleus_over_partitions(spark, partitions):
    rnd = random.Random(partitions)
    # one group of most rows, whose scores tie in long runs, so borders fall among equal scores
    rows = [("hot", i, float(rnd.randint(0, 3))) for i in range(3000)] + [(rnd.choice(["a", "b", None]), i, rnd.random() * 700 - 350) for i in range(200)]
    rows.append(("one", 0, -1e300))
    df = spark.createDataFrame(rows, "group_id string, item_id long, score double").repartition(5)
    for p in (0.3, 0.77):
        got = G.nucleus(df, p, partitions=partitions).select("group_id", "item_id", F.round("prob", 12)).collect()
        assert sorted(map(tuple, got), key=repr) == brute_nucleus(rows, p)
        small = G.nucleus(df, p, small_groups=True).select("group_id", "item_id").collect()
        assert sorted(map(tuple, small), key=repr) == [r[:2] for r in brute_nucleus(rows, p)]
    sums = G.softmax(df, partitions=partitions).groupBy("group_id").agg(F.sum("prob").alias("s")).collect()
    assert len(sums) == 5 and all(abs(r.s - 1) < 1e-9 for r in sums)
    assert G.nucleus(df, 0, partitions=partitions).count() == len(rows)
    assert G.softmax(df.limit(0)).count() == 0


def test_nucleus_ties_at_the_edge_and_spread(spark):
    df = spark.range(0, 64, numPartitions=4).select(F.lit("g").alias("group_id"), F.col("id").alias("item_id"), F.lit(2.5).alias("score"))
    # 1/64 each: 17 rows have at most 0.25 before them
    assert sorted(r.item_id for r in G.nucleus(df, 0.25, partitions=8).collect()) == list(range(17))
    hot = spark.range(0, 400_000, numPartitions=8).select(F.lit("g").alias("group_id"), F.col("id").alias("item_id"), (F.col("id") % 7).cast("double").alias("score"))
    rows = G._task_sums(hot, "group_id", "score", [F.col("score").desc(), F.col("item_id")], 16)
    per = [r["count"] for r in rows.groupBy("_pid").count().collect()]
    assert len(per) >= 12 and max(per) < 100_000  # one group, many tasks
    kept = G.nucleus(hot, 0.5, partitions=16).agg(F.count("*"), F.min("score")).first()
    e = [math.exp(s - 6) for s in range(7)]
    assert kept[1] == 6.0 and abs(kept[0] - 0.5 * sum(e) * 400_000 / 7) < 2


def test_special_split_of_long_texts(spark):
    specials = P.SPECIAL_TOKENS
    long = ("a😀" * 200_000) + "<" + specials[2] + "<|endof" + specials[1] * 2 + " x"
    rows = [(0, long), (1, ""), (2, specials[0]), (3, "plain <b> text"), (4, "<EMAIL><PHONE> a<EMAIL>"), (5, None), (6, "漢" * 5_000_000), (7, " " * 5_000_000 + "<"), (8, "😀" * 1_000_000 + "<")]
    df = spark.createDataFrame(rows, "k long, text string")
    got = {r.k: r.p for r in df.filter("k < 6").select("k", P.special_parts("text").alias("p")).collect()}
    assert got[0] == ["a😀" * 200_000 + "<", specials[2], "<|endof", specials[1], specials[1], " x"]
    assert got[1] == [] and got[2] == [specials[0]] and got[3] == ["plain <b> text"] and got[4] == ["<EMAIL>", "<PHONE>", " a", "<EMAIL>"] and got[5] is None
    sizes = {r.k: r.n for r in df.select("k", F.length(F.array_join(P.piece_list("text"), "")).alias("n")).collect()}
    assert sizes[0] == len(long) and sizes[6] == 5_000_000 and sizes[7] == 5_000_001 and sizes[8] == 1_000_001


def test_shuffle_is_a_permutation_for_every_size(spark):
    sizes = [1, 2, 3, 4, 5, 7, 10, 50, 97, 1000, 4999, 5000]
    df = spark.createDataFrame([(n,) for n in sizes], "n_total long").withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_total") - 1)))
    df = df.withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(3))))
    placed = O.unshuffled_position(O.shuffled_place(df, 7, "epoch"), 7, "epoch", out_col="back").collect()
    seen = {}
    for r in placed:
        assert r.back == r.pos
        seen.setdefault((r.n_total, r.epoch), []).append((r.pos, r.place))
    for (n, _), pairs in seen.items():
        assert sorted(p for _, p in pairs) == list(range(n))
    assert sorted(seen[1000, 0]) != sorted(seen[1000, 3])
    moved = sum(abs(a - b) for a, b in seen[5000, 0]) / 5000
    assert 1400 < moved < 1950  # a third of the range on average


def test_every_size_up_to_5000_is_a_bijection():
    """The network itself, restated: all sizes, walking over the cells beyond the last position."""
    import hashlib

    def net(x, a, b, key):
        l, r = x % a, x // a
        for i in range(6):
            value = lambda h, i=i: int(hashlib.md5(f"{key}:{i}:{h}".encode()).hexdigest()[:12], 16)
            if i % 2 == 0:
                l = (l + value(r)) % a
            else:
                r = (r + value(l)) % b
        return l + a * r

    for n in [*range(1, 60), 4999]:
        a = math.ceil(math.sqrt(n))
        b = -(-n // a)
        out = []
        for x in range(n):
            y = net(x, a, b, "7:0")
            while y >= n:
                y = net(y, a, b, "7:0")
            out.append(y)
        assert sorted(out) == list(range(n))


def test_prefix_sum_and_scanned_index(spark, tmp_path):
    rows = [(i, (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    got = {r.k: r.s for r in global_prefix_sum(df, ["k"], "v", "s").collect()}
    assert all(got[k] == sum(v for j, v in rows if j < k) for k, _ in rows)
    for name, count in (("a", 23), ("b", 0), ("c", 41)):
        d = spark.range(count).select(F.col("id").alias("local"), F.concat(F.lit(name), F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") * 13 % 50).cast("int"))).alias("text"))
        R.write_jsonl(d.repartitionByRange(3, "local").sortWithinPartitions("local"), str(tmp_path / name))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        sets = [R.scan_jsonl(spark, str(tmp_path / n), "text", extra="local bigint") for n in "abc"]
        out = O.scanned_index(sets)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
        got = sorted((r.idx, r.text[0], r.local) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, "a", i) for i in range(23)] + [(23 + i, "c", i) for i in range(41)]


def test_batch_store_opens_only_what_is_left(spark, tmp_path):
    rows = [(r, b, s, r * 1000 + b * 10 + s) for r in range(2) for b in range(40) for s in range(3)]
    df = spark.createDataFrame(rows, "rank long, batch long, slot long, idx long")
    path = str(tmp_path / "store")
    manifest = BS.write_batches(df, path, batches_per_range=4)
    assert {(r["rank"], r["first"], r["last"]) for r in manifest.collect()} == {(r, b, b + 3) for r in range(2) for b in range(0, 40, 4)}
    files = lambda d: d.select(F.col("_metadata.file_path")).distinct().count()
    everything = files(spark.read.parquet(f"{path}/batches"))
    opened = []
    for step in (0, 3, 4, 21, 39, 40):
        got = BS.read_from(spark, path, step)
        assert sorted((r["rank"], r["batch"], r["slot"], r["idx"]) for r in got.collect()) == [x for x in sorted(rows) if x[1] >= step]
        scanned = got._jdf.queryExecution().executedPlan()
        opened.append(len({r.f for r in got.select(F.input_file_name().alias("f")).collect()}))
        assert step == 0 or "PartitionFilters: [isnotnull(range" in scanned.toString() or step == 40
    assert opened[0] == everything == 20 and opened == [20, 20, 18, 10, 2, 0]
    epochs = BS.resume_epochs(spark, path, 3, "checkpoints/weights_38").groupBy("epoch").count().collect()
    assert {r.epoch: r["count"] for r in epochs} == {0: 12, 1: 240, 2: 240}
    assert BS.resume_epochs(spark, path, 1, None).count() == 240


def test_incremental_index_reads_new_files_alone(spark, tmp_path):
    src, seen = tmp_path / "src", []
    src.mkdir()

    def put(i, lines):
        (src / f"f{i:03d}.txt").write_text("\n".join(lines) + "\n")

    def build(session, files):
        seen.append(sorted(f.rsplit("/", 1)[1] for f in files))
        return session.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.length("value").alias("n_chars"))

    def rebuild():
        d = spark.read.text(str(src)).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("f"), F.length("value").alias("n_chars"))
        return sorted(map(tuple, d.collect()))

    def read(ix):
        return sorted((r.file.rsplit("/", 1)[1], r.n_chars) for r in ix.read().collect())

    ix = INC.IncrementalIndex(spark, str(tmp_path / "ix"), build)
    with pytest.raises(ValueError):
        ix.read()
    for i in range(100):
        put(i, ["a" * i, "b"])
    assert ix.update(str(src)) == {"read": 100, "kept": 0, "dropped": 0} and read(ix) == rebuild()
    put(100, ["new", "lines here"])
    assert ix.update(str(src)) == {"read": 1, "kept": 100, "dropped": 0}
    assert seen[-1] == ["f100.txt"] and read(ix) == rebuild()
    assert ix.update(str(src)) == {"read": 0, "kept": 101, "dropped": 0} and len(seen) == 2
    (src / "f003.txt").unlink()
    put(7, ["changed", "and longer than before"])
    assert ix.update(str(src)) == {"read": 1, "kept": 99, "dropped": 2}
    assert seen[-1] == ["f007.txt"] and read(ix) == rebuild()
    ix.compact()
    assert read(ix) == rebuild() and ix.manifest().select("fragment").distinct().count() == 1
    # an update that fails before its manifest leaves the index as it was
    put(200, ["later"])
    broken = INC.IncrementalIndex(spark, str(tmp_path / "ix"), lambda session, files: session.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.raise_error(F.lit("no"))))
    with pytest.raises(Exception):
        broken.update(str(src))
    assert ("f200.txt", 5) not in read(ix) and ix.update(str(src))["read"] == 1 and read(ix) == rebuild()


def test_two_phase_metric(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        n = rnd.choice([0, 1, 2, 9])
        labels = [rnd.randint(0, 2) for _ in range(n)]
        rows.append((rnd.choice(["a", "b", None]), [rnd.randint(0, 2) for _ in range(n if i % 9 else max(0, n - 3))], labels))
    df = spark.createDataFrame(rows, "g string, p array<long>, l array<long>").repartition(11)
    for groups in ([], ["g"]):
        want = M.shifted_accuracy(df, "p", "l", groups).collect()
        got = H.two_phase(df, M.accuracy_metric("p", "l"), groups).select(*groups, "hits", "n_pred", "accuracy").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
    assert H.two_phase(df.limit(0), M.accuracy_metric("p", "l"), ["g"]).count() == 0
    loss = spark.createDataFrame([("a", 1e6, 3), ("a", 1e6, 1), ("b", 2.0, 4)], "g string, s double, n long")
    got = {r.g: (r.mean_nll, r.perplexity) for r in H.two_phase(loss, M.perplexity_metric("s", "n"), ["g"]).collect()}
    assert got["a"] == (500000.0, math.inf) and got["b"] == (0.5, math.exp(0.5))
    grows = H.TwoPhaseMetric(lambda b: {"all": b.column("s").to_pylist() * 100}, lambda a, b: {"all": a["all"] + b["all"]}, lambda s: {"n": len(s["all"])}, "n long", state_bytes=100)
    with pytest.raises(Exception, match="metric state"):
        H.two_phase(loss, grows).collect()


def test_table_functions(spark):
    rnd = random.Random(6)
    rows = [(i // 5, i, [rnd.randrange(100) for _ in range(rnd.choice([0, 1, 2, 5, 13]))]) for i in range(60)]
    df = spark.createDataFrame(rows, "grp bigint, idx bigint, input_ids array<bigint>").repartition(6)
    want = Q.pack_blocks(df.drop("grp"), "input_ids", "idx", 4, group_rows=5).select("grp", "blk", "input_ids", "labels").collect()
    got = H.run_over_groups(df, H.PackRows, ["grp"], ["idx"], 4).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got[0].asDict().keys() == {"grp", "blk", "input_ids", "labels"}
    lens = Q.packed_lengths(df.select("idx", F.size("input_ids").alias("n")), "n", "idx", 4, group_rows=5).collect()
    assert sorted(map(tuple, lens)) == sorted((r.grp, r.blk, len(r.input_ids)) for r in want)
    batches = df.select((F.col("idx") % 2).alias("rank"), F.col("grp").alias("batch"), F.col("idx").alias("slot"), F.lit("kept").alias("other"), "input_ids", F.col("input_ids").alias("labels"))
    want = Q.collate(batches, pad_cols={"input_ids": 0, "labels": -100}).collect()
    got = H.run_over_groups(batches, H.PadRows, ["rank", "batch"], ["slot"]).collect()
    assert sorted(tuple(r[c] for c in want[0].asDict()) for r in got) == sorted(map(tuple, want))
    assert [f.name for f in H.run_over_groups(batches, H.PadRows, ["rank"], ["slot"]).schema][-1] == "batch_width"

    class Running(H.GroupFunction):
        """A sum that is carried from row to row."""

        def __init__(self):
            self.total = 0

        @staticmethod
        def schema(table, *options):
            return T.StructType([table["grp"], T.StructField("total", T.LongType())])

        def row(self, row, by):
            self.total += by * row["idx"]
            yield row["grp"], self.total

    got = {}
    for r in H.run_over_groups(df, Running, ["grp"], ["idx"], 2).collect():
        got.setdefault(r.grp, []).append(r.total)
    assert sorted(got[1]) == [10, 22, 36, 52, 70]


def test_continuous_batches_over_arrivals_and_restart(spark, tmp_path):
    lines = {}
    src = tmp_path / "src"

    def arrive(k, sizes):
        (src / str(k)).mkdir(parents=True)
        for f, n in enumerate(sizes):
            name = src / str(k) / f"part-{f}.json"
            ids = [k * 1000 + f * 100 + i for i in range(n)]
            name.write_text("".join('{"conv_id": %d, "texts": ["%s"]}\n' % (i, "x" * (i % 7 + 1)) for i in ids))
            lines.setdefault(k, []).append(ids)

    sink, state, ckpt = (str(tmp_path / n) for n in ("sink", "state", "ckpt"))
    R_, B = 2, 4

    def run(fn):
        stream = S.conversation_stream(spark, str(src / "*"))
        enc = S.encode_stream(stream, F.transform(F.split(F.array_join("texts", ""), ""), lambda c: F.ascii(c).cast("bigint")), 100, key_cols=("conv_id", "file", "block"))
        S.run_foreach_batch(enc, fn, ckpt)

    for k, sizes in enumerate([(5, 0, 3), (1,), (9, 2)]):
        arrive(k, sizes)
        if k == 1:  # a run that fails after its outputs were written is repeated from the checkpoint

            def failing(batch, number):
                S.ContinuousBatches(spark, R_, B, sink, state)(batch, number)
                raise RuntimeError("lost")

            with pytest.raises(Exception, match="lost"):
                run(failing)
        run(S.ContinuousBatches(spark, R_, B, sink, state))
    ranks = {r: [] for r in range(R_)}
    for k in sorted(lines):
        for ids in lines[k]:
            for i, x in enumerate(ids):
                ranks[i % R_].append(x)
    want = []
    for r, ids in ranks.items():
        for at, x in enumerate(ids):
            b = ids[at // B * B : at // B * B + B]
            want.append((r, at // B, at % B, x, max(y % 7 + 1 for y in b)))
    got = S.ContinuousBatches(spark, R_, B, sink, state).finish()
    assert sorted((r["rank"], r["batch"], r["slot"], r["conv_id"], len(r["input_ids"])) for r in got.collect()) == sorted(want)


def test_json_table_finds_text_in_later_objects(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"id": 1}\n{"id": 2, "text": "b"}\n')
    got = [r.text for r in R.read_text_table(spark, str(tmp_path / "t.json"), "json").collect()]
    assert sorted(got, key=str) == sorted([None, "b"], key=str)
