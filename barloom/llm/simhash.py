"""Near copies by SimHash fingerprints and meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits of each other have a value halfway between them: one within
``radius // 2`` flips of the first and ``radius - radius // 2`` of the second. Every fingerprint is
sent to all values in such a ball around it, the shuffle on the values brings neighbours together,
and what met is linked.

At radius 3 the larger half is two flips. Two fingerprints three bits apart have one-counts of
different parity, so only even ones need the two-flip values; and of any three bits two lie in the
same 32-bit half, so two flips within one half are enough: 1 + 64 + 992 values for even and 65 for
odd fingerprints.

No pairs are listed. Whatever reaches a value with one flip is within two bits of everything else
that does, and within three of what reaches it with two flips; all of them are linked to the least
one-flip fingerprint at that value. That is the same connectivity as all pairs, with one link for
each (fingerprint, value). Distinct fingerprints bound what one value can receive, however many
copies a text has. Each link is still verified by its bit count.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keep
from barloom.llm.components import components

SEED = 42
HALVES = (range(0, 32), range(32, 64))


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits, each set if set in over half the XXH64 values of the text's word shingles.

    Words are runs of characters other than space and tab to carriage return. Repeated shingles
    count each time; a text of fewer words is one shingle; a text without words gives zero.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(g, seed) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 14):  # the bits of a long text are eight times its hashes
        block = hashes[start : start + (1 << 14)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_bits(df: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """Adds ``bits`` long, the fingerprint as a signed number. A null text counts as empty."""

    @F.pandas_udf("long")
    def bits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return df.withColumn("bits", bits(F.col(text)))


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def one_flip() -> list[int]:
    return [0, *(signed(1 << i) for i in range(64))]


def two_flips() -> list[int]:
    """Two flips within one half; see above why those are enough."""
    return [signed(1 << i | 1 << j) for half in HALVES for i, j in combinations(half, 2)]


def screened(prints: DataFrame) -> DataFrame:
    """Fingerprints (bits) that may have a neighbour within three bits; none with one is lost.

    Of at most three differing bits one half has at most one. So a fingerprint with a neighbour
    finds, at one of its halves with at most one flip, a value that another one holds exactly.
    This spares most fingerprints of texts without near copies the ball of two flips.
    """
    low, high = F.col("bits").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("bits", 32)
    halves = prints.select("bits", F.posexplode(F.array(low, high)).alias("half", "value"))
    held = halves.groupBy("half", "value").agg(F.count("*").alias("n"), F.min("bits").alias("one"))
    flips = F.array(*(F.lit(m) for m in [0, *(1 << i for i in range(32))]))
    near = halves.select("bits", "half", "value", F.explode(flips).alias("flip"))
    near = near.select("bits", "half", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    # Size estimates don't see what explode adds, so nothing here may be broadcast on their word.
    met = near.join(held.hint("merge"), ["half", "value"]).where("n > 1 or one <> bits")
    return met.select("bits").distinct()


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Distinct fingerprints (bits) to links (a, b) with the components of all pairs within ``radius``."""
    if radius not in (1, 2, 3):
        raise ValueError("the radius is 1 to 3 bits")

    def ball(rows: DataFrame, masks: list[int]) -> DataFrame:
        flipped = rows.select("bits", F.explode(F.array(*(F.lit(m) for m in masks))).alias("flip"))
        return flipped.select("bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("value"))

    near = ball(prints, [0] if radius == 1 else one_flip())
    far = near
    if radius == 1:
        far = ball(prints, one_flip())
    elif radius == 3:
        far = near.unionByName(ball(prints.where(F.bit_count("bits") % 2 == 0), two_flips()))
    least = near.groupBy("value").agg(F.min("bits").alias("b"))
    met = far.join(least.hint("merge"), "value").where("bits <> b")
    met = met.where(F.bit_count(F.col("bits").bitwiseXOR(F.col("b"))) <= radius)
    return met.select(F.col("bits").alias("a"), "b").distinct()


def linked_prints(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Distinct fingerprints (bits) that have a neighbour, as (bits, root)."""
    if radius == 0:
        return prints.select("bits", F.col("bits").alias("root")).limit(0)
    found = keep(screened(prints), "screened")
    return components(links(found, radius)).withColumnRenamed("node", "bits")


def near_copies(
    df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One row per row of ``df``: (key, text_hash long, bits long, root long, component_id).

    Texts are linked if their fingerprints differ in at most ``radius`` bits; ``root`` names the
    connected component and ``component_id`` is its least key. A null or empty text has fingerprint
    zero and is linked like any other. Rows with a null key belong to their component but never name
    it, unless no row of it has a key: then component_id is null. Repeated rows stay repeated. An
    empty table gives no rows. ``text_hash`` tells apart texts of one key.
    """
    rows = with_bits(df.select(F.col(key), F.col(text).alias("_text")), "_text", shingle)
    rows = keep(rows.select(key, F.xxhash64("_text").alias("text_hash"), "bits"), "bits")
    prints = keep(rows.groupBy("bits").agg(F.min(key).alias("least")), "prints")
    roots = linked_prints(prints.select("bits"), radius)
    named = prints.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    named = keep(named, "named")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.select("bits", "root").join(names, "root"), "bits").select(
        key, "text_hash", "bits", "root", "component_id"
    )


def one_of_each(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``df`` with one row left of each group of near copies: that with the least key.

    Of several rows with that key, one with the least text hash stays; of equal rows, any one.
    A group without keys keeps one row too. All columns of ``df`` are returned as they are.
    """
    rows = near_copies(df, text, key, shingle, radius).where(F.col(key).eqNullSafe(F.col("component_id")))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("text_hash"), F.col(key).alias("k"))).alias("kept"))
    chosen = keep(first.select("kept.text_hash", "kept.k"), "chosen")
    repeats = rows.join(chosen, rows["text_hash"].eqNullSafe(chosen["text_hash"]) & rows[key].eqNullSafe(chosen["k"]), "left_semi")
    repeats = repeats.groupBy(F.col(key).alias("k"), "text_hash").count().where("count > 1")
    same = lambda other: F.col(key).eqNullSafe(other["k"]) & F.col("_llm_hash").eqNullSafe(other["text_hash"])
    hashed = df.withColumn("_llm_hash", F.xxhash64(text))
    left = hashed.join(chosen, same(chosen), "left_semi")
    if repeats.isEmpty():
        return left.drop("_llm_hash")
    repeats = keep(repeats, "repeats")
    single = left.join(repeats, same(repeats), "left_anti")
    several = left.join(repeats, same(repeats), "left_semi").dropDuplicates([key, "_llm_hash"])
    return single.unionByName(several).drop("_llm_hash")
