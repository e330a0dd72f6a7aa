"""Exact best inner products by no-random-access aggregation over sorted lists.

A block of vectors has one list for each dimension, sorted by component. For a query each list is
read from the end that gives the larger products, all of them to the same depth. What was read of a
vector, and what the unread lists can still give it at least and at most, bound its score from below
and above. A vector whose upper bound is under the k-th best lower bound is an outsider. Lists are
read on, twice as deep each time, until few vectors are left that could qualify; the final scores of
those are then resolved from their whole vectors.

Queries and vectors are dealt into blocks, and each pair of blocks is a task's unit of work, so its
size doesn't depend on the tables'. The bounds of all queries and vectors of a pair are matrix
products over the parts read so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import keep

VECTOR_BLOCK = 4096
QUERY_BLOCK = 256
FIRST_DEPTH = 16
TASKS = 20_000
# Scores up to here are exact in floating point.
EXACT = float(1 << 53)
# Components and scores are cut here.
TOP = (1 << 63) - 1
RESULT = "query_no int, query_id long, vec_id long, score long"


def quantised(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(key, comps array<long>): floor of ``scale`` times each component as double, cut at 64 bits.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows
    without a key. Rows equal in key and vector count once; rows of one key that differ stay rows of their own.
    """
    comps = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(comps, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & fine)
    floors = F.transform(comps, lambda x: F.greatest(F.floor(x * scale).cast("long"), F.lit(-TOP)))
    return whole.select(F.col(key), floors.alias("comps")).distinct()


def best_of_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[int, int, int, int]]:
    """(query number, query id, vector id, score) of each query's k best other rows of the block, ties to smaller ids."""
    n, width = vectors.shape
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * width
    q, x = queries.astype(np.float64), vectors.astype(np.float64)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    order = np.argsort(x, axis=0, kind="stable")
    lists = np.take_along_axis(x, order, axis=0)
    place = np.argsort(order, axis=0, kind="stable")
    # The least a list can give: its far end.
    worst_up, worst_down = up * lists[0], down * lists[-1]
    out: list[tuple[int, int, int, int]] = []
    active = np.arange(len(q))
    depth = n if largest >= EXACT else min(n, max(FIRST_DEPTH, k))
    while len(active):
        if depth >= n and largest >= EXACT:
            left = np.ones((len(active), n), dtype=bool)
        else:
            # Lists of positive weights are read from the top, those of negative ones from the bottom.
            top, bottom = place >= n - depth, place < depth
            u, d = up[active], down[active]
            read = u @ np.where(top, x, 0).T + d @ np.where(bottom, x, 0).T
            least, most = read, read
            if depth < n:
                open_top, open_bottom = (~top).astype(np.float64).T, (~bottom).astype(np.float64).T
                least = read + worst_up[active] @ open_top + worst_down[active] @ open_bottom
                most = read + (u * lists[n - depth]) @ open_top + (d * lists[depth - 1]) @ open_bottom
            kth = np.partition(least, max(0, n - k), axis=1)[:, max(0, n - k)]
            left = most >= kth[:, None]
        ready = np.flatnonzero((left.sum(axis=1) <= max(8 * k, n // 64)) | (depth >= n))
        for row in ready:
            query, rest = queries[active[row]], np.flatnonzero(left[row])
            name = int(query_ids[active[row]])
            own = (ids[rest] == name) & (vectors[rest] == query).all(axis=1)
            rest = rest[~own]
            if largest >= EXACT:
                exact = (sum(int(a) * int(b) for a, b in zip(query, vectors[r], strict=True)) for r in rest)
                scores = [max(-TOP, min(TOP, score)) for score in exact]
            else:
                scores = (vectors[rest] @ query).tolist()
            ranked = sorted(zip(scores, ids[rest].tolist(), strict=True), key=lambda p: (-p[0], p[1]))
            out += [(int(active[row]), name, vec, score) for score, vec in ranked[:k]]
        active = np.delete(active, ready)
        depth = min(n, 2 * depth)
    return out


def blocks(df: DataFrame, key: str, rows: int, name: str) -> DataFrame:
    """(width, block, ids, comps): the vectors of one length dealt into blocks of about ``rows``."""
    count = df.count()
    dealt = df.withColumn(name, F.pmod(F.xxhash64(key, "comps"), F.lit(max(1, -(-count // rows)))).cast("int"))
    packed = dealt.groupBy(F.size("comps").alias("width"), name).agg(F.collect_list(F.struct(key, "comps")).alias("rows"))
    return packed.select("width", name, F.col("rows")[key].alias(f"{name}_ids"), F.flatten(F.col("rows")["comps"]).alias(f"{name}_comps"))


def best(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id") -> DataFrame:
    """(query_id, rank int, vec_id, score): each query's k highest scores over all other vectors.

    Both sides are tables of ``quantised``; queries meet vectors of their own length only. A query's
    own row, equal in key and vector, is no candidate; with fewer candidates than k all are returned. Ties go to
    the smaller key. Rows that share a key but differ are queries and candidates of their own. Scores are cut at
    64 bits. Empty tables give no rows.
    """
    left = keep(blocks(queries, key, QUERY_BLOCK, "query"), "query-blocks")
    right = keep(blocks(vectors, key, VECTOR_BLOCK, "vector"), "vector-blocks")
    # Each block of vectors is sent to the blocks of the stated queries, one pair of blocks at a time.
    of_query = left.groupBy("width").agg(F.collect_set("query").alias("queries"))
    sent = right.join(of_query, "width").withColumn("query", F.explode("queries")).drop("queries")
    # A pair is little data and much work, so it is dealt by number, not by size.
    count = min(TASKS, max(1, left.count() * right.count()))
    pairs = sent.join(left, ["width", "query"]).repartition(count)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                wanted, given = (np.asarray(a, dtype=np.int64).reshape(-1, row.width) for a in (row.query_comps, row.vector_comps))
                # One more than k: the query itself may be among them.
                found = best_of_block(wanted, np.asarray(row.query_ids), given, np.asarray(row.vector_ids), k + 1)
                frame = pd.DataFrame(found, columns=["query_no", "query_id", "vec_id", "score"]).astype("int64")
                yield frame.assign(query_no=frame["query_no"].astype("int32"), width=row.width, query=row.query)

    found = pairs.mapInPandas(search, f"{RESULT}, width int, query int")
    one = W.partitionBy("width", "query", "query_no")
    rank = F.row_number().over(one.orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
