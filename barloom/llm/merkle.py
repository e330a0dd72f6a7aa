"""A Merkle manifest of a dataset: one root for all rows, and for each row the siblings that prove it.

Rows are the leaves of a ternary tree for each group, and the roots of the groups, in order, are the
leaves of one tree above them. Both are cut into aligned subtrees of LEVELS levels. A subtree is one
stored block of 32-byte digests in van Emde Boas layout: the upper half of its levels comes first, then
the lower subtrees one after the other, each laid out alike, so nodes of a path lie close together
at every scale. The same address arithmetic places nodes when a block is built from its leaves and finds
siblings when proofs are read. Block roots are the leaves of the next tier of blocks, and so on until
a group has one block.

Spark numbers the leaves (by range, so a hot group is spread), packs them into blocks of bounded size,
and hands every block the proof of its own root by a join on the block; a task only ever holds
blocks. Everything shared is a written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keep, ranked

ARITY = 3
LEVELS = 6  # of a block, above its leaves: 729 leaves, 1,093 digests
DIGEST = 32

BLOCK = "group string, block long, total long, n long, nodes binary"
PROOF = "group string, place long, proof binary, subroot binary, root binary"


@lru_cache(maxsize=64)
def layout(levels: int) -> tuple[np.ndarray, ...]:
    """Addresses of the nodes of a complete tree with so many levels of nodes, one array a depth."""
    if levels == 1:
        return (np.zeros(1, dtype=np.int64),)
    upper = levels // 2
    top, bottom = layout(upper), layout(levels - upper)
    size = sum(map(len, bottom))
    starts = sum(map(len, top)) + size * np.arange(ARITY**upper)
    return top + tuple((starts[:, None] + depth[None, :]).ravel() for depth in bottom)


def levels_over(leaves: int, cut: int = LEVELS) -> int:
    """Levels above so many leaves until one node is left, but at most ``cut``."""
    levels = 0
    while levels < cut and ARITY**levels < leaves:
        levels += 1
    return levels


def joined_hash(hexes: str) -> bytes:
    return hashlib.sha256(hexes.encode()).digest()


def built_block(leaves: bytes, levels: int) -> bytes:
    """The block over some leaves (digests one after the other). Addresses without a node hold zeros."""
    at = layout(levels + 1)
    count = len(leaves) // DIGEST
    nodes = np.zeros((sum(map(len, at)), DIGEST), dtype=np.uint8)
    nodes[at[-1][:count]] = np.frombuffer(leaves, dtype=np.uint8).reshape(count, DIGEST)
    for depth in range(levels - 1, -1, -1):
        hexed = nodes[at[depth + 1][:count]].tobytes().hex()
        step = 2 * DIGEST * ARITY
        count = -(-count // ARITY)
        above = b"".join(joined_hash(hexed[i * step:(i + 1) * step]) for i in range(count))
        nodes[at[depth][:count]] = np.frombuffer(above, dtype=np.uint8).reshape(count, DIGEST)
    return nodes.tobytes()


class Block:
    """A stored block, read by address."""

    def __init__(self, nodes: bytes, n: int, levels: int):
        self.at = layout(levels + 1)
        self.nodes = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, DIGEST)
        self.counts = [n]
        for _ in range(levels):
            self.counts.append(-(-self.counts[-1] // ARITY))
        self.counts.reverse()  # of each depth

    def digests(self, depth: int) -> list[bytes]:
        raw = self.nodes[self.at[depth][:self.counts[depth]]].tobytes()
        return [raw[i:i + DIGEST] for i in range(0, len(raw), DIGEST)]

    def siblings(self) -> list[list[tuple[bytes, bytes]]]:
        """From the leaves' level up: what stands before and after each node in its run."""
        out = []
        for depth in range(len(self.at) - 1, 0, -1):
            nodes = self.digests(depth)
            runs = [i - i % ARITY for i in range(len(nodes))]
            out.append([
                (b"".join(nodes[s:i]), b"".join(nodes[i + 1:s + ARITY])) for i, s in enumerate(runs)
            ])
        return out

    def proofs(self) -> Iterator[list[tuple[bytes, bytes]]]:
        """For each leaf the siblings from its level up to under the block's root."""
        levels = self.siblings()
        for leaf in range(self.counts[-1]):
            yield [level[leaf // ARITY**up] for up, level in enumerate(levels)]


def packed_proof(steps: list[tuple[bytes, bytes]]) -> bytes:
    """Two counts and the digests of each level."""
    return b"".join(bytes((len(b) // DIGEST, len(a) // DIGEST)) + b + a for b, a in steps)


def unpacked_proof(packed: bytes) -> list[tuple[bytes, bytes]]:
    steps, i = [], 0
    while i < len(packed):
        before, after = packed[i] * DIGEST, packed[i + 1] * DIGEST
        i += 2
        steps.append((packed[i:i + before], packed[i + before:i + before + after]))
        i += before + after
    return steps


def folded(leaf: bytes, steps: list[tuple[str, str]]) -> bytes:
    """The root that a leaf and the siblings (as hex) of its levels give."""
    node = leaf
    for before, after in steps:
        node = joined_hash(before + node.hex() + after)
    return node


def row_digest(fields: list[Column]) -> Column:
    """SHA-256 (binary) of the fields: ``-`` for null, else byte count, colon and value as text."""
    texts = [f.cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*framed), 256))


@dataclass
class Manifest:
    """Written tables: ``leaves`` packed by block, ``tiers`` of blocks of the groups, and the same above them."""

    leaves: DataFrame
    tiers: list[DataFrame]
    names: DataFrame | None = None
    above: list[DataFrame] = field(default_factory=list)


def _packed(leaves: DataFrame, carried: list[str]) -> DataFrame:
    """(group, block, total, rows): the leaves of each block in order, at most 729."""
    row = F.struct("place", "digest", *carried)
    block = F.floor(F.col("place") / ARITY**LEVELS).alias("block")
    return leaves.groupBy("group", block).agg(F.first("total").alias("total"), F.sort_array(F.collect_list(row)).alias("rows"))


def _blocks(packed: DataFrame) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = batch.column("total").to_pylist()
            lists = batch.column("digests").to_pylist()
            nodes = [built_block(b"".join(x), levels_over(t)) for x, t in zip(lists, totals, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("block"), batch.column("total"),
                 pa.array([len(x) for x in lists], pa.int64()), pa.array(nodes, pa.binary())],
                names=["group", "block", "total", "n", "nodes"],
            )

    return packed.select("group", "block", "total", F.col("rows")["digest"].alias("digests")).mapInArrow(build, BLOCK)


def _block_roots(blocks: DataFrame) -> DataFrame:
    """A block's root is at the first address."""
    return blocks.withColumn("digest", F.substring("nodes", 1, DIGEST))


def _tiers(packed: DataFrame) -> list[DataFrame]:
    """Blocks of blocks until every group has one. The number of tiers is the logarithm of the largest group."""
    tiers = [keep(_blocks(packed), "merkle-tier")]
    cut = ARITY**LEVELS
    while not tiers[-1].where(F.col("total") > cut).isEmpty():
        roots = _block_roots(tiers[-1].where(F.col("total") > cut))
        above = roots.select(
            "group", F.col("block").alias("place"), F.ceil(F.col("total") / cut).alias("total"), "digest"
        )
        tiers.append(keep(_blocks(_packed(above, [])), "merkle-tier"))
    return tiers


def _tops(tiers: list[DataFrame]) -> DataFrame:
    """The one last block of each group, in whatever tier."""
    tops = [t.where(F.col("total") <= ARITY**LEVELS) for t in tiers]
    out = tops[0]
    for top in tops[1:]:
        out = out.unionByName(top)
    return out


def manifest(leaves: DataFrame, order: list[str], carried: list[str]) -> Manifest:
    """The manifest of leaves (group string without nulls, digest binary, the order and carried columns).

    Leaves of a group ascend by ``order``, null first, and where that ties by digest; equal rows stay apart,
    each with a leaf of its own. Groups ascend bytewise. Texts are hashed whole where they lie, of any length, and
    only digests are moved. No rows give a manifest without blocks. Further columns of the input are not read.
    """
    named = keep(leaves.withColumn("_no", F.monotonically_increasing_id()), "merkle-leaves")
    packed = keep(_packed(ranked(named, "group", [*order, "digest", "_no"], "merkle-sorted"), carried), "merkle-packed")
    tiers = _tiers(packed)
    subroots = _block_roots(_tops(tiers)).select(F.lit("").alias("group"), F.col("group").alias("name"), "digest")
    names = keep(_packed(ranked(subroots, "group", ["name"], "merkle-groups"), ["name"]), "merkle-names")
    return Manifest(packed, tiers, names, _tiers(names))


def _proofs(blocks: DataFrame, of_groups: bool) -> DataFrame:
    """Proofs of all leaves of blocks that have their own proof: a block's comes below its leaves'.

    ``of_groups``: the leaves are the roots of groups.
    """

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = levels_over(row["total"])
                block = Block(row["nodes"], row["n"], levels)
                first = row["block"] * ARITY**LEVELS
                proofs = [packed_proof(p) + row["proof"] for p in block.proofs()]
                subroots = block.digests(levels) if of_groups else [row["subroot"]] * len(proofs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["group"]] * len(proofs), pa.string()),
                     pa.array(range(first, first + len(proofs)), pa.int64()), pa.array(proofs, pa.binary()),
                     pa.array(subroots, pa.binary()), pa.array([row["root"]] * len(proofs), pa.binary())],
                    names=["group", "place", "proof", "subroot", "root"],
                )

    return blocks.mapInArrow(unfold, PROOF)


def _with_proofs(tiers: list[DataFrame], tops: DataFrame, of_groups: bool) -> DataFrame:
    """The blocks of the lowest tier, each with the proof of its root.

    ``tops`` (group, proof, subroot, root) are the proofs of the groups' own roots.
    """
    cut = ARITY**LEVELS
    given = None
    for tier in reversed(tiers):
        last = tier.where(F.col("total") <= cut).join(tops, "group")
        if given is not None:
            inner = tier.where(F.col("total") > cut).join(given.withColumnRenamed("place", "block"), ["group", "block"])
            last = last.unionByName(inner)
        blocks = keep(last, "merkle-proofs")
        if tier is not tiers[0]:
            given = _proofs(blocks, of_groups=False)
    return blocks


def _of_groups(made: Manifest) -> DataFrame:
    """(group, proof, subroot, root) of every group, in the tree over the groups."""
    none = F.lit(b"").alias("proof")
    root = _block_roots(_tops(made.above)).select("group", none, F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    proofs = _proofs(_with_proofs(made.above, root, of_groups=True), of_groups=True)
    place = made.names.select(F.explode("rows").alias("r")).select(F.col("r")["place"].alias("place"), F.col("r")["name"].alias("name"))
    return proofs.drop("group").join(place, "place").select(F.col("name").alias("group"), "proof", "subroot", "root")


def verified(made: Manifest, carried: dict[str, str], against: str | None = None) -> DataFrame:
    """A row for each leaf: its carried columns (name and type), leaf, subroot, root, proof_sha256, folded_root, verified.

    Digests are lowercase hex. ``proof_sha256`` is of the siblings' hex text from the leaf up; a leaf
    without siblings has that of nothing. ``against`` names a carried binary column with the digest of the row
    as it is found now (null: unchanged), which is folded with the stored siblings and compared with
    the root. Proofs of all leaves are made block by block; a task holds one batch of blocks.
    """
    wanted = [c for c in carried if c != against]
    blocks = _with_proofs(made.tiers, _of_groups(made), of_groups=False)
    rows = made.leaves.select("group", "block", *(F.col("rows")[c].alias(f"c_{c}") for c in carried))
    hexes = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    schema = ", ".join([*(f"`{c}` {carried[c]}" for c in wanted), hexes])

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(f"c_{against}") if against else None
            blocks = batch.select(["total", "n", "nodes", "proof", "subroot", "root"]).to_pylist()
            out: list[list] = [[] for _ in range(6)]
            for i, row in enumerate(blocks):
                levels = levels_over(row["total"])
                block = Block(row["nodes"], row["n"], levels)
                above = [(b.hex(), a.hex()) for b, a in unpacked_proof(row["proof"])]
                ending = "".join(b + a for b, a in above)
                root, subroot = row["root"].hex(), row["subroot"].hex()
                now = found[i].as_py() if found is not None else [None] * row["n"]
                hexed = [[(b.hex(), a.hex()) for b, a in level] for level in block.siblings()]
                for j, leaf in enumerate(block.digests(levels)):
                    steps = [level[j // ARITY**up] for up, level in enumerate(hexed)]
                    own = "".join(b + a for b, a in steps)
                    end = folded(now[j] or leaf, steps + above).hex()
                    values = (leaf.hex(), subroot, root, joined_hash(own + ending).hex(), end, end == root)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            arrays = [batch.column(f"c_{c}").flatten() for c in wanted]
            arrays += [pa.array(c, pa.string()) for c in out[:5]] + [pa.array(out[5], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*wanted, *(f.split(" ")[0] for f in hexes.split(", "))])

    return blocks.join(rows, ["group", "block"]).mapInArrow(unfold, schema)


def group_name(column: Column) -> Column:
    """A group as text without nulls that sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))
