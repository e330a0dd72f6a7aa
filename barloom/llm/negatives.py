"""Hard negatives by exact integer scores: residue-number-system matrix products and a score window.

Scores are inner products of integer vectors. For a pair of blocks the component matrices are taken
modulo several small primes, with residues around zero, and multiplied in float32, where every partial sum
stays exact; Chinese remaindering puts the signed scores together again. As many primes are taken as
the blocks' largest components ask for.

Rows lie in blocks in order of their label, so a block holds one label or a few. Positives come from the
pairs of blocks whose labels overlap, negatives from the pairs that are not of one and the same label
throughout, so hardly a product is computed twice. Each pair of blocks yields its best few rows
per anchor or positive, which a ranking with a map-side limit brings together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import keep, ranked

VECTOR_BLOCK = 4096
ANCHOR_BLOCK = 1024
TASKS = 20_000
# Products of residues are summed over so many components, so sums stay below 2**24, exact in float32.
DEPTH = 64
LARGEST_PRIME = 1024
TOP = (1 << 63) - 1  # scores are cut there

PACKED = "width int, block long, n int, low long, high long, peak long, ids binary, labels binary, comps binary"
POSITIVES = "anchor_block long, anchor_no int, anchor_id long, positive_id long, positive_score long"
NEGATIVES = "anchor_block long, anchor_no int, positive_rank int, negative_id long, negative_score long"


def primes_for(bound: int) -> list[int]:
    """The largest primes under LARGEST_PRIME whose product exceeds twice the bound."""
    found: list[int] = []
    product = 1
    for n in range(LARGEST_PRIME - 1, 2, -1):
        if product > 2 * bound + 1:
            break
        if all(n % d for d in range(2, int(n**0.5) + 1)):
            found.append(n)
            product *= n
    return found


def residues(comps: np.ndarray, prime: int) -> np.ndarray:
    """Around zero, as float32."""
    rest = np.mod(comps.astype(np.int64), prime)
    return np.where(rest > prime // 2, rest - prime, rest).astype(np.float32)


def product_modulo(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """The matrix product of residues, modulo the prime, as int64."""
    total = None
    for start in range(0, a.shape[1], DEPTH):
        part = (a[:, start:start + DEPTH] @ b[:, start:start + DEPTH].T).astype(np.int32)
        part = np.mod(part, np.int32(prime))
        total = part if total is None else np.mod(total + part, np.int32(prime))
    return total.astype(np.int64)


def scores(anchors: np.ndarray, vectors: np.ndarray, bound: int) -> np.ndarray:
    """Exact inner products (int64, cut at 64 bits) of all anchors with all vectors; none is beyond the bound."""
    primes = primes_for(bound)
    parts = [product_modulo(residues(anchors, p), residues(vectors, p), p) for p in primes]
    modulus = 1
    for p in primes:
        modulus *= p
    # Mixed radix digits (Garner): each digit stays below its prime, the sum below the product of all.
    wide = modulus >= TOP // 2
    value = parts[0].astype(object) if wide else parts[0].copy()
    weight = primes[0]
    for p, part in zip(primes[1:], parts[1:], strict=True):
        seen = (value % p).astype(np.int64)
        digit = np.mod((part - seen) * pow(weight, -1, p), p)
        value += (digit.astype(object) if wide else digit) * weight
        weight *= p
    value = np.where(value > modulus // 2, value - modulus, value)
    return np.clip(value, -TOP, TOP).astype(np.int64) if wide else value


def quantised(df: DataFrame, key: str, vector: str, label: Column, scale: int = 256) -> DataFrame:
    """(vec_id, label long, comps array<long>): floor of ``scale`` times each component as double.

    Rows without a key or label, and vectors that are null, empty or hold null or non-finite components, take no
    part. Rows equal in all three count once; rows that share a key but differ stay rows of their own.
    """
    comps = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(comps, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = df.where(F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & fine)
    floors = F.transform(comps, lambda x: F.greatest(F.floor(x * scale).cast("long"), F.lit(-TOP)))
    return whole.select(F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), floors.alias("comps")).distinct()


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows of one vector length in order of label, cut into blocks of ``size``, each packed in the order of ids."""
    mixed = rows.withColumn("width", F.size("comps")).withColumn("_mix", F.xxhash64("vec_id", "comps"))
    placed = ranked(mixed, "width", ["label", "_mix", "vec_id", "comps"], name)
    packed = placed.groupBy("width", F.floor(F.col("place") / size).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("vec_id", "label", "comps"))).alias("rows")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in PACKED.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values.to_numpy()
                labels = batch.column("labels")[i].values.to_numpy()
                comps = batch.column("comps")[i].values.flatten().to_numpy()
                peak = max(int(comps.max()), -int(comps.min()))
                kind = np.int16 if peak < 1 << 14 else np.int64
                values = [
                    batch.column("width")[i].as_py(), batch.column("block")[i].as_py(), len(ids), int(labels.min()),
                    int(labels.max()), peak, ids.tobytes(), labels.tobytes(), comps.astype(kind).tobytes(),
                ]
                yield pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))], schema=pa.schema([
                    ("width", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("low", pa.int64()), ("high", pa.int64()),
                    ("peak", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("comps", pa.binary()),
                ]))

    lists = packed.select("width", "block", *(F.col("rows")[c].alias(a) for c, a in (("vec_id", "ids"), ("label", "labels"), ("comps", "comps"))))
    return keep(lists.mapInArrow(pack, PACKED), f"{name}-blocks")


def _named(rows: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return rows.select("width", *(F.col(c).alias(f"{prefix}_{c}") for c in columns))


def _paired(vectors: DataFrame, anchors: DataFrame, wanted: Column, extra: list[str]) -> DataFrame:
    """The wanted pairs of a block of vectors and a block of anchors, dealt out evenly.

    Which pairs those are is told from the small columns of the blocks; payloads are joined to them.
    """
    small = ["block", "low", "high"]
    pairs = keep(_named(vectors, "v", small).join(_named(anchors, "a", small), "width").where(wanted), "block-pairs")
    pairs = pairs.select("width", "v_block", "a_block")
    full = ["block", "n", "peak", "ids", "labels", "comps"]
    loaded = pairs.join(_named(vectors, "v", full), ["width", "v_block"]).join(_named(anchors, "a", [*full, *extra]), ["width", "a_block"])
    # A pair is little data and much work, so pairs are dealt by number.
    return loaded.repartition(min(TASKS, max(1, pairs.count())))


def _matrix(row: dict, side: str) -> np.ndarray:
    width, n = row["width"], row[f"{side}_n"]
    raw = row[f"{side}_comps"]
    return np.frombuffer(raw, dtype=np.int16 if len(raw) == 2 * n * width else np.int64).reshape(n, width)


class Pair:
    """Scores of one pair of blocks, with what tells its rows apart."""

    def __init__(self, row: dict):
        self.anchors, self.vectors = _matrix(row, "a"), _matrix(row, "v")
        self.bound = row["width"] * row["a_peak"] * row["v_peak"]
        self.anchor_ids, self.ids = (np.frombuffer(row[f"{s}_ids"], dtype=np.int64) for s in "av")
        self.anchor_labels, self.labels = (np.frombuffer(row[f"{s}_labels"], dtype=np.int64) for s in "av")

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return scores(self.anchors[rows], self.vectors, self.bound)

    def own(self, row: int) -> np.ndarray:
        """Places of the anchor's own row: equal in id, label and vector."""
        near = np.flatnonzero((self.ids == self.anchor_ids[row]) & (self.labels == self.anchor_labels[row]))
        return near[(self.vectors[near] == self.anchors[row]).all(axis=1)] if len(near) else near


def _first(values: np.ndarray, count: int) -> np.ndarray:
    """Places of the largest values, descending; equal values keep their order, which is that of ids."""
    if len(values) > count:
        least = np.partition(values, len(values) - count)[len(values) - count]
        places = np.flatnonzero(values >= least)
    else:
        places = np.arange(len(values))
    return places[np.argsort(-values[places], kind="stable")][:count]


STEP = 256  # anchors scored at a time


def _best_positives(pair: Pair, block: int, count: int) -> list[tuple]:
    out = []
    for start in range(0, len(pair.anchors), STEP):
        rows = np.arange(start, min(start + STEP, len(pair.anchors)))
        table = pair.scores(rows)
        for row, values in zip(rows.tolist(), table, strict=True):
            same = np.flatnonzero(pair.labels == pair.anchor_labels[row])
            same = np.setdiff1d(same, pair.own(row), assume_unique=True)
            for place in same[_first(values[same], count)]:
                out.append((block, row, int(pair.anchor_ids[row]), int(pair.ids[place]), int(values[place])))
    return out


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores n with low * score <= 100 * n <= high * score, as least and largest."""
    return -(-low * score // 100), high * score // 100


def _best_negatives(pair: Pair, block: int, wanted: list[dict], count: int, low: int, high: int) -> list[tuple]:
    """For each wanted (anchor_no, positive_rank, positive_score) the first rows inside its window.

    An anchor's scores are put in order once; all its windows are then cut from that order.
    """
    of_anchor: dict[int, list[dict]] = {}
    for item in wanted:
        of_anchor.setdefault(item["anchor_no"], []).append(item)
    numbers = np.array(sorted(of_anchor), dtype=np.int64)
    out = []
    for start in range(0, len(numbers), STEP):
        rows = numbers[start:start + STEP]
        for row, values in zip(rows.tolist(), pair.scores(rows), strict=True):
            spans = [(item, *window(item["positive_score"], low, high)) for item in of_anchor[row]]
            least, most = min(s[1] for s in spans), max(s[2] for s in spans)
            places = np.flatnonzero((pair.labels != pair.anchor_labels[row]) & (values >= least) & (values <= most))
            if not len(places):
                continue
            order = places[np.argsort(values[places], kind="stable")]
            ascending = values[order]
            for item, lowest, highest in spans:
                end = np.searchsorted(ascending, highest, side="right")
                begin = np.searchsorted(ascending, lowest, side="left")
                if end <= begin:
                    continue
                # From the last score that may be among the first few on, ties in order of ids.
                cut = np.searchsorted(ascending, ascending[max(begin, end - count)], side="left")
                some = order[max(begin, cut):end]
                for place in some[_first(values[some], count)]:
                    out.append((block, row, item["positive_rank"], int(pair.ids[place]), int(values[place])))
    return out


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [f.split(" ") for f in schema.split(", ")]
    kinds = [pa.int32() if kind == "int" else pa.int64() for _, kind in names]
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in names])


def mined(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """Hard negatives of anchors, for rows as ``quantised`` gives them.

    An anchor's positives are the other rows of its label with the highest scores, ties to the smaller
    id. For each of them, the negatives are the highest-scored rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. Returns (anchor_id, positive_id, rank int,
    negative_id, positive_score, negative_score); fewer rows than asked for are all returned, and a positive
    without negatives gives none. Vectors meet those of their own length only. Scores are exact up to 64
    bits and cut there. Rows of one id that differ are rows of their own, on every side. Empty tables
    give no rows.
    """
    rows = keep(rows, "negative-rows")
    vectors = blocks(rows, VECTOR_BLOCK, "negative-vectors")
    anchors = blocks(rows.where(is_anchor), ANCHOR_BLOCK, "negative-anchors")
    overlap = (F.col("v_low") <= F.col("a_high")) & (F.col("a_low") <= F.col("v_high"))

    def positive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _columns(_best_positives(Pair(row), row["a_block"], positives), POSITIVES)

    # Blocks of other lengths number their anchors likewise, so the length goes first in the number.
    def with_width(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("a_block", F.shiftleft(F.col("width").cast("long"), 40) + F.col("a_block"))

    found = with_width(_paired(vectors, anchors, overlap, [])).mapInArrow(positive, POSITIVES)
    anchor = ["anchor_block", "anchor_no"]
    place = F.row_number().over(W.partitionBy(*anchor).orderBy(F.desc("positive_score"), "positive_id"))
    first = keep(found.withColumn("positive_rank", place).where(F.col("positive_rank") <= positives), "positives")

    items = first.groupBy("anchor_block").agg(
        F.collect_list(F.struct("anchor_no", "positive_rank", "positive_score")).alias("wanted")
    )
    asked = items.select(
        F.shiftright("anchor_block", 40).cast("int").alias("width"),
        F.col("anchor_block").bitwiseAND((1 << 40) - 1).alias("block"), "wanted",
    )
    unlike = (F.col("v_low") != F.col("v_high")) | (F.col("a_low") != F.col("a_high")) | (F.col("v_low") != F.col("a_low"))

    def negative(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                best = _best_negatives(Pair(row), row["a_block"], row["a_wanted"], negatives, low, high)
                yield _columns(best, NEGATIVES)

    pairs = with_width(_paired(vectors, anchors.join(asked, ["width", "block"]), unlike, ["wanted"]))
    near = pairs.mapInArrow(negative, NEGATIVES)
    rank = F.row_number().over(W.partitionBy(*anchor, "positive_rank").orderBy(F.desc("negative_score"), "negative_id"))
    best = near.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return best.join(first, [*anchor, "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
