"""Preference formatting (dealt operator 1), in DataFrame functions only.

Input: turns of pairs of conversations, ``(pair_id, side, turn, role, text)`` with side ``chosen`` or
``rejected``. The turns both sides begin with (same position, role and text; two nulls are the
same) are the prompt, rendered once; what follows on each side is its completion. A completion comes with
the spans that are learned from: the texts of assistant turns with their closing mark, as
``start:end`` code points; everything else in it is masked.

The common prefix is found without gathering conversations: the turns of both sides are grouped by position, and
the prefix ends before the first position where they differ, a minimum per pair. Texts are put
together once, when a pair's rows are aggregated to its one output row, whose size is that of the pair.

Defined results: turns are numbered by ``turn``, ties by role, then text (nulls first); a turn with null text is
rendered empty; a null role renders as ``user``; a null pair id or another side is left out; a pair that lacks a
side has that side empty, so its prompt is empty; repeated rows are repeated turns. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How a turn is opened and closed.
OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def turn_text(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("user")), F.lit(BREAK), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def format_preferences(turns: DataFrame) -> DataFrame:
    """``(pair_id, prompt, chosen, rejected, chosen_mask, rejected_mask, prompt_turns)``, one row a pair."""
    t = turns.select("pair_id", "side", "turn", "role", "text").filter(F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected"))
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    t = t.withColumn("at", F.row_number().over(order))
    # one row a position: what each side has there
    side = lambda s: F.first(F.when(F.col("side") == s, F.struct("role", "text")), ignorenulls=True).alias(s)
    both = t.groupBy("pair_id", "at").agg(side("chosen"), side("rejected"))
    differ = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    pair = Window.partitionBy("pair_id")
    both = both.withColumn("split", F.min(F.when(differ, F.col("at"))).over(pair))
    shared = F.col("split").isNull() | (F.col("at") < F.col("split"))

    def rendered(column: str, keep: Column) -> Column:
        c = F.col(column)
        piece = F.struct(F.col("at"), turn_text(c["role"], c["text"]).alias("s"), (c["role"] == LEARNED_ROLE).alias("learn"), F.char_length(F.coalesce(c["role"], F.lit("user"))).alias("r"))
        return F.array_sort(F.collect_list(F.when(keep & c.isNotNull(), piece)))

    rows = both.groupBy("pair_id").agg(rendered("chosen", shared).alias("p"), rendered("chosen", ~shared).alias("c"), rendered("rejected", ~shared).alias("r"))
    text = lambda a: F.array_join(F.transform(a, lambda x: x["s"]), "")

    def mask(a: str) -> Column:
        lead = len(OPEN) + len(BREAK)
        walk = F.aggregate(
            a, F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("spans")),
            lambda s, x: F.struct(
                (s["end"] + F.char_length(x["s"])).alias("end"),
                F.when(F.coalesce(x["learn"], F.lit(False)), F.concat(s["spans"], F.array(F.concat_ws(":", s["end"] + lead + x["r"], s["end"] + F.char_length(x["s"]))))).otherwise(s["spans"]).alias("spans"),
            ),
        )
        return F.array_join(walk["spans"], ",")

    return rows.select("pair_id", text("p").alias("prompt"), text("c").alias("chosen"), text("r").alias("rejected"), mask("c").alias("chosen_mask"), mask("r").alias("rejected_mask"), F.size("p").cast("long").alias("prompt_turns"))


def pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """Preference pairs of a table of single conversations: every conversation is the chosen side; in the rejected one
    its last assistant turn is replaced by the last assistant text of the conversation next to it (ids 2k and 2k + 1;
    empty where there is none). Turns after it are dropped, conversations without an assistant turn have no pair.
    """
    c = conversations.select("conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
    last = c.filter(F.col("role") == LEARNED_ROLE).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.coalesce(F.col("last.text"), F.lit("")).alias("other"))
    ends = last.select("conv_id", F.col("last.turn").alias("end")).join(other, "conv_id", "left").withColumn("other", F.coalesce("other", F.lit("")))
    kept = c.join(ends, "conv_id").filter(F.col("turn") <= F.col("end"))
    replaced = F.when((F.col("turn") == F.col("end")) & (F.col("role") == LEARNED_ROLE), F.col("other")).otherwise(F.col("text"))
    side = F.explode(F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")), F.struct(F.lit("rejected").alias("side"), replaced.alias("text"))))
    return kept.select(F.col("conv_id").alias("pair_id"), "turn", "role", side.alias("v")).select("pair_id", F.col("v.side").alias("side"), "turn", "role", F.col("v.text").alias("text"))
