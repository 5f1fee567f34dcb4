"""Preference formatting: chosen and rejected conversations with one prompt and masked completions.

DataFrame functions only. The longest common prefix of turns of both conversations is rendered
once as the prompt; what follows in each is its completion. A completion comes with its mask: runs
of characters, `1` where a model learns (the text of the learned role and its end mark), `0` where
it does not (other turns and all turn heads).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.timeslice import prefix_scan
from slotwise.llm.common import stored

HEAD, END, LEARNED = "<|{}|>\n", "<|end|>\n", "assistant"


def _turn() -> Column:
    return F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (turn, role, text).

    Null roles and texts count as empty; turns without conv_id belong to none. Repeated rows are
    one turn; turns of equal number are ordered by role and text, a null number comes first.
    """
    rows = turns.where("conv_id IS NOT NULL").select("conv_id", _turn().alias("t")).distinct()
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def _said(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def common_turns(one: Column, two: Column) -> Column:
    """How many turns two conversations have in common from the start on."""
    shorter = F.least(F.size(one), F.size(two))
    differs = F.zip_with(F.slice(one, 1, shorter), F.slice(two, 1, shorter), lambda x, y: x != y)
    at = F.array_position(differs, True)
    return F.when(at == 0, shorter).otherwise(at - 1).cast("int")


def _head(turn: Column, head: str) -> Column:
    before, after = head.split("{}")
    return F.concat(F.lit(before), turn["role"], F.lit(after))


def rendered(turns: Column, head: str = HEAD, end: str = END) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(_head(t, head), t["text"], F.lit(end))))


def mask(turns: Column, head: str = HEAD, end: str = END, learned: str = LEARNED) -> Column:
    """Runs `bit:characters` of a rendered completion, joined by commas."""

    def runs(t: Column) -> Column:
        first = F.concat(F.lit("0:"), F.char_length(_head(t, head)).cast("string"))
        bit = F.when(t["role"] == learned, "1:").otherwise("0:")
        return F.concat(first, F.lit(","), bit, (F.char_length(t["text"]) + len(end)).cast("string"))

    return F.concat_ws(",", F.transform(turns, runs))


def formatted(pairs: DataFrame, head: str = HEAD, end: str = END, learned: str = LEARNED) -> DataFrame:
    """`pairs` has columns chosen and rejected (turns as `conversations` gives them; rejected may
    be null, for a conversation without partner: its leading turns of other roles than the learned
    one are then the prompt). Adds n_common, prompt, and for both sides completion and mask; equal
    conversations have empty completions, conversations without a common turn an empty prompt."""
    one, two = _said(F.col("chosen")), _said(F.col("rejected"))
    alone = F.array_position(F.transform(one, lambda t: t["role"] == learned), True)
    own = F.when(alone == 0, F.size(one)).otherwise(alone - 1).cast("int")
    shared = F.coalesce(common_turns(one, two), own)
    out = pairs.withColumn("n_common", shared).withColumn("prompt", rendered(F.slice(one, 1, shared), head, end))
    for name, turns in (("chosen", one), ("rejected", two)):
        rest = F.slice(turns, F.col("n_common") + 1, F.greatest(F.size(turns), F.lit(0)))
        out = out.withColumn(f"{name}_completion", F.when(F.col(name).isNotNull(), rendered(rest, head, end)))
        out = out.withColumn(f"{name}_mask", F.when(F.col(name).isNotNull(), mask(rest, head, end, learned)))
    return out


def preference_pairs(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, chosen, rejected) of all conversations: those that open with the
    same turn are answers to the same request and paired as neighbours by conv_id, the first of
    two being chosen. The last of an odd number stays without partner, as does one whose opening
    is its own. Places within a common opening are counted by ranges of conv_id, so that it is no
    large group."""
    first = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.min(_turn()).alias("t"))
    opening = F.sha2(F.concat_ws("\n", "t.role", "t.text"), 256).alias("opening")
    ranges = first.select(opening, "conv_id").repartitionByRange("opening", "conv_id")
    spans = stored(ranges.withColumn("span", F.spark_partition_id()), "openings")
    placed = prefix_scan(spans, ["opening"], "span", ["conv_id"], {"place": ("sum", F.lit(1))})
    pair = placed.select("conv_id", "opening", F.expr("(place - 1) div 2").alias("pair"))
    group = conversations(turns).join(pair, "conv_id").groupBy("opening", "pair")
    two = group.agg(F.array_sort(F.collect_list(F.struct("conv_id", "turns"))).alias("two"))
    rows = two.select(F.get("two", F.lit(0)).alias("c"), F.get("two", F.lit(1)).alias("r"))
    return rows.select(
        F.col("c.conv_id").alias("chosen_id"), F.col("r.conv_id").alias("rejected_id"),
        F.col("c.turns").alias("chosen"), F.col("r.turns").alias("rejected"),
    )
