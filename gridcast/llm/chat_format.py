"""Preference pairs for training: the turns that chosen and rejected conversations share become one prompt.

A conversation is its turns in order of the turn number (then role and text; null first). The prompt is the longest
common prefix of equal turns (role and text, nulls equal to nulls), rendered once. What follows is rendered as two
completions, each with the character spans that carry loss: the texts of its assistant turns with their end marker.

All of it is array expressions on one row per pair; the one shuffle gathers the turns of a pair. A conversation is one
output row, so its turns meet in one row. Turns without a conversation id belong to none and are left out. A pair that
lacks a side has null for its completion. Null roles and texts render as empty strings. A pair is usable if both
completions have an assistant turn and differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD = ("<|", "|>\n")
END = "<|end|>\n"


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD[0]), F.coalesce(t["role"], F.lit("")), F.lit(HEAD[1]), F.coalesce(t["text"], F.lit("")), F.lit(END))), "")


def _spans(turns: Column, role: str) -> Column:
    """"start-end" of each turn of the role, in characters of the rendered turns, joined by commas."""
    head = lambda t: F.length(F.coalesce(t["role"], F.lit(""))) + len(HEAD[0]) + len(HEAD[1])
    end = lambda t: head(t) + F.length(F.coalesce(t["text"], F.lit(""))) + len(END)
    return F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + end(t)).alias("at"),
            F.when(
                t["role"].eqNullSafe(F.lit(role)),
                F.concat(acc["spans"], F.when(acc["spans"] == "", "").otherwise(","), (acc["at"] + head(t)).cast("string"), F.lit("-"), (acc["at"] + end(t)).cast("string")),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )


def preference_pairs(turns: DataFrame, pair: Column, is_chosen: Column, role: str = "assistant") -> DataFrame:
    """One row per pair: pair_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans, usable.

    `turns` has turn, role, text; `pair` and `is_chosen` say to which pair and side a turn belongs.
    """
    rows = turns.select(pair.alias("pair_id"), is_chosen.alias("_side"), F.struct("turn", "role", "text").alias("_turn"))
    sides = (
        rows.where(F.col("pair_id").isNotNull() & F.col("_side").isNotNull())
        .groupBy("pair_id")
        .agg(*(F.sort_array(F.collect_list(F.when(F.col("_side") == chosen, F.col("_turn")))).alias(name) for name, chosen in (("_c", True), ("_r", False))))
    )
    equal = F.zip_with("_c", "_r", lambda a, b: a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    differs = F.array_position(equal, F.lit(False))
    common = F.when(differs > 0, differs - 1).otherwise(F.size("_c")).cast("int")
    cut = sides.select("pair_id", "_c", "_r", common.alias("n_common"))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c), F.lit(1)))
    cut = cut.select("pair_id", "n_common", F.slice("_c", 1, F.col("n_common")).alias("_p"), rest("_c").alias("_rc"), rest("_r").alias("_rr"), F.size("_c").alias("_nc"), F.size("_r").alias("_nr"))
    there = lambda n, value: F.when(F.col(n) > 0, value)
    return cut.select(
        "pair_id",
        "n_common",
        _render(F.col("_p")).alias("prompt"),
        there("_nc", _render(F.col("_rc"))).alias("chosen"),
        there("_nr", _render(F.col("_rr"))).alias("rejected"),
        there("_nc", _spans(F.col("_rc"), role)).alias("chosen_spans"),
        there("_nr", _spans(F.col("_rr"), role)).alias("rejected_spans"),
    ).withColumn("usable", F.coalesce((F.col("chosen_spans") != "") & (F.col("rejected_spans") != "") & (F.col("chosen") != F.col("rejected")), F.lit(False)))
