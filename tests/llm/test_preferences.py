from textloom.llm import preferences as P

TURNS = "pair_id long, side string, turn long, role string, text string"


def run(make, rows, schema=TURNS):
    return {r.pair_id: r for r in P.format_preferences(make(rows, schema)).collect()}


def r(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_prefix_once_and_masks(make):
    rows = [(1, s, 0, "user", "hi") for s in ("chosen", "rejected")] + [(1, "chosen", 1, "assistant", "yes"), (1, "rejected", 1, "assistant", "no!"), (1, "chosen", 2, "user", "k"), (1, "chosen", 3, "assistant", "é")]
    x = run(make, rows)[1]
    assert (x.prompt, x.prompt_turns) == (r("user", "hi"), 1)
    assert x.chosen == r("assistant", "yes") + r("user", "k") + r("assistant", "é") and x.rejected == r("assistant", "no!")
    learned = [x.chosen[int(a) : int(b)] for a, b in (m.split(":") for m in x.chosen_mask.split(","))]
    assert learned == ["yes<|im_end|>\n", "é<|im_end|>\n"]


def test_equal_sides_one_side_nulls(make):
    rows = [(1, s, 0, None, None) for s in ("chosen", "rejected")] + [(2, "chosen", 0, "assistant", "a"), (None, "chosen", 0, "user", "x"), (3, "other", 0, "user", "x")]
    got = run(make, rows)
    assert set(got) == {1, 2}
    assert got[1].prompt == r("user", "") and got[1].chosen == got[1].rejected == "" and got[1].chosen_mask == ""
    assert got[2].prompt == "" and got[2].rejected == "" and got[2].prompt_turns == 0


def test_same_prefix_after_a_difference_is_not_shared(make):
    rows = [(1, s, t, "user", x) for s, texts in (("chosen", "axc"), ("rejected", "ayc")) for t, x in enumerate(texts)]
    x = run(make, rows)[1]
    assert x.prompt_turns == 1 and x.chosen == r("user", "x") + r("user", "c")


def test_repeated_turns_long_text_clashing_columns_empty(make):
    big = "z" * 300_000
    rows = [(1, s, 0, "user", big, 5, "q") for s in ("chosen", "rejected")] * 2
    x = run(make, rows, TURNS + ", at long, split string")[1]
    assert x.prompt == r("user", big) * 2
    assert run(make, []) == {}


def test_native_plan(spark, make):
    plan = P.format_preferences(P.pairs_from_conversations(make([(0, 0, "user", "a"), (0, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pairs_keep_every_conversation_with_an_answer(make):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "late"), (1, 0, "assistant", "c"), (2, 0, "assistant", None), (5, 0, "user", "no answer")]
    got = run(make, [tuple(x) for x in P.pairs_from_conversations(make(rows, "conv_id long, turn long, role string, text string")).collect()])
    assert set(got) == {0, 1, 2}
    assert got[0].prompt == r("user", "a") and got[0].chosen == r("assistant", "b") and got[0].rejected == r("assistant", "c")
    assert got[1].rejected == r("assistant", "b")
    assert got[2].chosen == got[2].rejected == r("assistant", "") and got[2].prompt_turns == 0  # a null and an empty text differ
