"""Logged conversations to training texts, without those that a longer one begins with.

A log may hold a conversation many times, as it grew. Conversations are compared by turn-prefix
hashes: the hash of a prefix is the sum of the hashes of its turns (number, role and text), taken in
four parts of 31 bits, so it rolls on from turn to turn, and within parts of ``PART`` turns that are
joined by their totals. A conversation goes if its whole hash and length are those of another one's
shorter prefix (an anti-join); of equal ones that with the least id stays. The rest is rendered.

No task holds a conversation: hashes and texts are put together by parts. Equal conversations and
equal prefixes are folded before the anti-join, so neither side of it has a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import keep

PART = 256
HASHES = ["h0", "h1", "h2", "h3"]
KEY = [*HASHES, "n_turns"]
# A text cannot forge a turn: its own "<|" is parted.
MARK, PARTED = "<|", "< |"


def turns_of(df: DataFrame) -> DataFrame:
    """(conv_id, turn, part, role, text); turns without conversation or number have no place and are left out."""
    placed = df.where("conv_id is not null and turn is not null")
    part = F.floor(F.col("turn") / PART).alias("part")
    return placed.select("conv_id", "turn", part, "role", "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, last_turn, hashes, n_turns): hash and length of each conversation up to each turn."""
    text = [x for c in ("role", "text") for x in (F.col(c).isNull(), F.coalesce(c, F.lit("")))]
    one, two = F.xxhash64("turn", *text), F.xxhash64(*text, "turn")
    # Equal rows of one turn count once; different ones are turns of their own.
    seen = turns.select("conv_id", "part", "turn", one.alias("one"), two.alias("two")).distinct()
    pieces = [F.shiftrightunsigned(h, shift).bitwiseAND(0x7FFFFFFF) for h in ("one", "two") for shift in (0, 32)]
    sums = [F.sum(p).alias(h) for p, h in zip(pieces, HASHES, strict=True)]
    each = keep(seen.groupBy("conv_id", "part", "turn").agg(*sums, F.count("*").alias("n_turns")), "turn-hashes")
    totals = each.groupBy("conv_id", "part").agg(*(F.sum(c).alias(c) for c in KEY), F.max("turn").alias("last"))
    by = W.partitionBy("conv_id")
    before = by.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "conv_id", "part", F.max("last").over(by).alias("last_turn"),
        *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in KEY),
    )
    up_to = W.partitionBy("conv_id", "part").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    rolled = each.select("conv_id", "part", "turn", *(F.sum(c).over(up_to).alias(c) for c in KEY))
    return rolled.join(starts, ["conv_id", "part"]).select(
        "conv_id", "turn", "last_turn", *((F.col(c) + F.col(f"{c}_before")).alias(c) for c in KEY)
    )


def maximal(df: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): the conversations that no longer one begins with.

    ``n_copies`` counts the conversations with the same turns, itself included.
    """
    prefixes = keep(prefix_hashes(turns_of(df)), "prefixes")
    whole = prefixes.where("turn = last_turn").groupBy(*KEY)
    whole = whole.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    shorter = prefixes.where("turn < last_turn").select(*KEY).distinct()
    return whole.join(shorter, KEY, "left_anti").select("conv_id", "n_turns", "n_copies")


def rendered_turn(turn: Column) -> Column:
    role, text = (F.replace(F.coalesce(turn[c], F.lit("")), F.lit(MARK), F.lit(PARTED)) for c in ("role", "text"))
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def formatted(df: DataFrame, by_part: bool = False) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, n_chars, rendered) of the maximal conversations.

    Turns stand in order of number, then role and text. A conversation is one row, with part 0; its text is
    rendered by parts of PART turn numbers and then joined. With ``by_part`` the parts stay rows of their own, for
    conversations too long for one value. Null roles and texts are rendered empty, but are not equal to empty
    ones. Equal rows count once. An empty table gives no rows.
    """
    kept = keep(maximal(df), "maximal")
    turns = turns_of(df).join(kept.select("conv_id"), "conv_id", "left_semi")
    # Dealt anew by part, so the semi-join's hot side may be split and no task gathers a conversation.
    turns = turns.repartition("conv_id", "part").groupBy("conv_id", "part")
    turns = turns.agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    text = F.array_join(F.transform("turns", rendered_turn), "")
    texts = turns.select("conv_id", "part", text.alias("rendered"))
    if not by_part:
        pieces = F.array_sort(F.collect_list(F.struct("part", "rendered")))["rendered"]
        texts = texts.groupBy("conv_id").agg(F.array_join(pieces, "").alias("rendered")).withColumn("part", F.lit(0).cast("long"))
    out = texts.join(kept, "conv_id")
    return out.select("conv_id", "part", "n_turns", "n_copies", F.length("rendered").cast("long").alias("n_chars"), "rendered")
