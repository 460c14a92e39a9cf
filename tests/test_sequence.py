import random

from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.operators import sequence as Q


def spark_pack(spark, rows, S, group):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "idx bigint, input_ids array<bigint>")
    got = Q.pack_blocks(df, "input_ids", "idx", S, group_rows=group).collect()
    return [r.input_ids for r in sorted(got, key=lambda r: (r.grp, r.blk))]


def test_pack_fixtures(spark):
    assert spark_pack(spark, [[1, 2, 3], [], [4, 5, 6, 7], [8, 9]], 4, 1000) == [[1, 2, 3, 4], [5, 6, 7, 8]]
    assert spark_pack(spark, [[1], [2, 3]], 4, 1000) == [[1, 2, 3]]
    assert spark_pack(spark, [[], []], 4, 1000) == []


@settings(max_examples=10, deadline=None)
@given(seed=st.integers(0, 10_000), S=st.integers(1, 7), group=st.integers(1, 5))
def test_pack_property(spark, seed, S, group):
    rnd = random.Random(seed)
    rows = [[rnd.randrange(100) for _ in range(rnd.choice([0, 1, 2, 5, 13]))] for _ in range(rnd.randrange(1, 14))]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "idx bigint, input_ids array<bigint>")
    by_group = {}
    for r in sorted(Q.pack_blocks(df, "input_ids", "idx", S, group_rows=group).collect(), key=lambda r: (r.grp, r.blk)):
        by_group.setdefault(r.grp, []).append(r.input_ids)
    for g in range((len(rows) + group - 1) // group):
        tokens = [t for r in rows[g * group : (g + 1) * group] for t in r]
        blocks = by_group.pop(g, [])
        joined = [t for b in blocks for t in b]
        assert joined == tokens[: len(joined)]  # a prefix of the group's tokens
        full = all(len(b) == S for b in blocks)
        assert full or [len(b) for b in blocks] == [len(tokens)]  # full blocks, or a single short one
        assert len(tokens) - len(joined) < S  # less than a block is left over
    assert not by_group


def test_pack_long_document_spans_blocks(spark):
    got = spark_pack(spark, [list(range(1000))], 64, 1000)
    assert [len(b) for b in got] == [64] * 15 and [t for b in got for t in b] == list(range(960))
