"""Preference data: paired, masked completions after a prompt that is rendered once.

For a chosen and a rejected conversation the longest common prefix of turns is the prompt; what follows in each
is its completion, cut into segments with a training mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators.scale import global_positions

ROLE_OPEN, ROLE_CLOSE, TURN_END = "<|", "|>\n", "<|end|>\n"
TRAINED = ("assistant",)


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(ROLE_OPEN), turn["role"], F.lit(ROLE_CLOSE), turn["text"], F.lit(TURN_END))


def gathered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation with its turns in order; null roles and texts are empty, repeated rows count once.

    A conversation is one record: its turns fit a row, as the text of a document does.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).dropDuplicates()
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return rows.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Prompt and masked completions of rows (chosen_id, rejected_id, kind, chosen, rejected).

    ``chosen`` and ``rejected`` are arrays of (role, text). The prompt is their longest common prefix of whole turns,
    rendered once. A completion is the rest, as segments (text, trained): a turn's header is not trained, its text
    and end mark are if the role is in ``TRAINED``. Pairs of equal conversations have nothing to prefer and give no row; where
    one is a prefix of the other, its completion is empty. An empty table gives no rows.
    """
    shortest = F.least(F.size("chosen"), F.size("rejected"))
    same = F.transform(F.sequence(F.lit(1), shortest), lambda i: F.element_at("chosen", i) == F.element_at("rejected", i))
    differs = F.when(shortest > 0, F.array_position(same, F.lit(False))).otherwise(F.lit(0))
    common = F.when(differs > 0, differs - 1).otherwise(shortest).cast("int")
    cut = pairs.withColumn("common", common).filter((F.col("common") < F.size("chosen")) | (F.col("common") < F.size("rejected")))

    def completion(side: str) -> Column:
        rest = F.slice(side, F.col("common") + 1, F.greatest(F.size(side) - F.col("common"), F.lit(0)))
        return F.flatten(F.transform(rest, lambda t: F.array(
            F.struct(F.concat(F.lit(ROLE_OPEN), t["role"], F.lit(ROLE_CLOSE)).alias("text"), F.lit(False).alias("trained")),
            F.struct(F.concat(t["text"], F.lit(TURN_END)).alias("text"), t["role"].isin(*TRAINED).alias("trained")),
        )))

    prompt = F.array_join(F.transform(F.slice("chosen", F.lit(1), F.col("common")), rendered), "")
    return cut.select(
        "chosen_id", "rejected_id", "kind", F.col("common").cast("long").alias("common_turns"), prompt.alias("prompt"),
        completion("chosen").alias("chosen"), completion("rejected").alias("rejected"),
    )


def preference_pairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Chosen and rejected conversations of a table of turns.

    ``opening``: of conversations that open with the same turn and differ, the one with the smallest id is chosen over
    each other one; equal conversations count once, under their smallest id. One row per rejected conversation, so
    a group of any size gives as many rows as it has texts. ``reply``: a conversation that ends with a trained turn is
    chosen over itself with the final reply of the next such conversation by id in place of its own, when that reply differs: all
    but the last take part, whatever the gaps between ids. Conversations without turns and null ids take no part.
    """
    whole = gathered(turns, conv, turn, role, text)
    keyed = whole.withColumn("digest", F.sha2(F.to_json("turns"), 256)).withColumn("opening", F.sha2(F.to_json(F.element_at("turns", 1)), 256))
    distinct = keyed.groupBy("opening", "digest").agg(F.min("conv_id").alias("conv_id"))
    first = distinct.groupBy("opening").agg(F.min("conv_id").alias("chosen_id"), F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    ids = distinct.join(first, "opening").filter(F.col("conv_id") != F.col("chosen_id")).select("chosen_id", F.col("conv_id").alias("rejected_id"))
    chosen = whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    rejected = whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    openings = ids.join(rejected, "rejected_id").join(chosen, "chosen_id").select("chosen_id", "rejected_id", F.lit("opening").alias("kind"), "chosen", "rejected")
    last = F.element_at("turns", -1)
    ended = whole.filter(last["role"].isin(*TRAINED))
    placed = global_positions(ended.select("conv_id"), [F.asc("conv_id")])
    after = placed.select(F.col("conv_id").alias("rejected_id"), (F.col("position") - 1).alias("position"))
    following = placed.select(F.col("conv_id").alias("chosen_id"), "position").join(after, "position").select("chosen_id", "rejected_id")
    replies = ended.select(F.col("conv_id").alias("rejected_id"), last.alias("other"))
    own = ended.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    swapped = following.join(replies, "rejected_id").join(own, "chosen_id").filter(F.element_at("chosen", -1)["text"] != F.col("other.text"))
    rest = F.slice("chosen", F.lit(1), F.size("chosen") - 1)
    return openings.unionByName(swapped.select("chosen_id", "rejected_id", F.lit("reply").alias("kind"), "chosen", F.concat(rest, F.array("other")).alias("rejected")))
