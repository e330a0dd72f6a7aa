"""Rows to shards by a weighted hash tree of regions, racks and shards.

A row descends level by level: every child of the node it has reached draws ``-ln(u) / weight``, with
``u`` from a hash of row key, level and child, and the row goes to the child of the least draw. That is
an exponential variable whose rate is the weight of the child's whole subtree, so children are chosen
in proportion to their weights, and only the children on a row's own path are drawn for.

A draw depends on row key, child and the child's weight alone. Where weights change, rows move only
between the children of nodes on the way to the change: into a child that gained, out of one that
lost. A shard that is to take rows only into itself (``grown``) therefore gets a region and a rack of
its own: no other draw changes, so a row either stays on its path or goes to the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import keep

RACK, REGION = 4, 2
SLOT_GROUP = 2000

# Region to rack to shard to weight.
Tree = dict[int, dict[int, dict[int, float]]]


def even_tree(shards: int) -> Tree:
    """Shards of weight 1, RACK to a rack and REGION racks to a region; further shards go on in order."""
    tree: Tree = {}
    for shard in range(shards):
        rack = shard // RACK
        tree.setdefault(rack // REGION, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, which takes rows only into itself: it stands in a region of its own."""
    shard = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    rack = 1 + max(k for racks in tree.values() for k in racks)
    return {**tree, 1 + max(tree): {rack: {shard: weight}}}


def _levels(tree: Tree) -> list[dict[int, dict[int, float]]]:
    """For each level, node to child to weight of the child's subtree; the root is node 0. Weights of 0 draw nothing."""
    rack = {k: sum(shards.values()) for racks in tree.values() for k, shards in racks.items()}
    region = {r: sum(rack[k] for k in racks) for r, racks in tree.items()}
    levels = [
        {0: region},
        {r: {k: rack[k] for k in racks} for r, racks in tree.items()},
        {k: shards for racks in tree.values() for k, shards in racks.items()},
    ]
    return [{node: {c: w for c, w in children.items() if w > 0} for node, children in level.items()} for level in levels]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the rows do not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _draw(key: str, level: int, child: Column) -> Column:
    """struct<draw, child>: how late a child comes for a row; the least is taken, of equal ones the smaller child."""
    bits = F.xxhash64(F.col(key), F.lit(level).cast("long"), child["child"].cast("long"))
    uniform = (F.shiftrightunsigned(bits, 11).cast("double") + 1) / float(1 << 53)
    return F.struct((-F.log(uniform) / child["weight"]).alias("draw"), child["child"].alias("child"))


def descended(df: DataFrame, tree: Tree, key: str, name: str) -> DataFrame:
    """Adds ``name`` int, the shard the row's key descends to. A null key is a key like any other."""
    out, (node,) = df, fresh(df, "_node")
    out = out.withColumn(node, F.lit(0))
    for number, level in enumerate(_levels(tree)):
        children = F.create_map(*(
            item
            for parent, weights in level.items()
            if weights  # others are never reached
            for item in (F.lit(parent), F.array(*(
                F.struct(F.lit(c).alias("child"), F.lit(float(w)).alias("weight")) for c, w in sorted(weights.items())
            )))
        ))
        drawn = F.transform(F.element_at(children, F.col(node)), lambda c: _draw(key, number, c))  # noqa: B023
        out = out.withColumn(node, F.array_min(drawn)["child"])
    return out.withColumn(name, F.col(node).cast("int")).drop(node)


def slots(df: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Adds ``slot`` long: 0, 1, 2 ... within each shard, without gaps.

    A shard is numbered in groups of about SLOT_GROUP rows dealt at random, then by ``order``, and a
    group starts where those before it end; no task holds a shard. The rows are written down first,
    so that the deal is one and the same for numbering and counting.
    """
    deal, group, start, at = fresh(df, "_deal", "_group", "_start", "_place")
    dealt = keep(df.withColumn(deal, F.xxhash64(F.monotonically_increasing_id())), "dealt")
    sizes = dealt.groupBy(shard).count()
    groups = max(1, -(-(sizes.agg(F.max("count")).first()[0] or 0) // SLOT_GROUP))
    dealt = dealt.withColumn(group, F.pmod(deal, F.lit(groups)))
    counted = dealt.groupBy(shard, group).count()
    before = W.partitionBy(shard).orderBy(group).rowsBetween(W.unboundedPreceding, -1)
    starts = counted.select(shard, group, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(start))
    place = F.row_number().over(W.partitionBy(shard, group).orderBy(*order, deal)) - 1
    out = dealt.withColumn(at, place).join(starts, [shard, group])
    return out.withColumn("slot", F.col(start) + F.col(at)).drop(deal, group, start, at)


def sharded(df: DataFrame, tree: Tree, later: Tree, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard, slot) for every row.

    ``grown_shard`` is the shard by ``later``, whose draws are those of ``tree`` but for other weights.
    ``size`` is the text's UTF-8 bytes plus 1; a null text has none, and the checksum of an empty
    one. Equal keys go to one shard; repeated rows take a slot each. An empty table gives no rows.
    """
    rows = df.select(
        key, (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    rows = descended(descended(rows, tree, key, "shard"), later, key, "grown_shard")
    return slots(rows, "shard", [key, "text_crc32", "size"])
