"""A batch of bars into staging, by files: only files that can hold a key of the batch are written anew.

A staged file covers a range of times of one (market, year), which its commit records. A batch meets the files
whose range holds one of its keys; their bars and the batch's become new files, cut by time again, and all other
files stay as they are. Bars outside every range become files of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.merge import upsert
from barloom.plans.warehouse import PART, Warehouse
from barloom.schemas import SLICE_KEY, STAGING_KEY
from barloom.sinks.tables import rebalanced
from barloom.sinks.versions import Change, DataFile, State

ROWS_PER_FILE = 4_000_000
SPANS = "market string, year int, spans array<struct<least: bigint, most: bigint, base: int, pieces: int>>"

Slice = tuple[str, str]


def _micros() -> Column:
    return F.unix_micros(F.col("time").cast("timestamp"))


def _holds(span: Column) -> Column:
    return (span["least"] <= _micros()) & (_micros() <= span["most"])


def _span_rows(wh: Warehouse, spans: dict[Slice, list[tuple[int, int, int, int]]]) -> DataFrame:
    return wh.spark.createDataFrame([(m, int(y), rows) for (m, y), rows in spans.items()], SPANS)


def _parted(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Adds the number of the file within its slice: the first span that holds the time, cut into pieces of time."""
    known = rows.join(spans, SLICE_KEY)
    first = F.filter("spans", _holds)[0]
    width = first["most"] - first["least"] + 1
    piece = F.floor((_micros() - first["least"]) / width * first["pieces"]).cast("int")
    return known.withColumn(PART, first["base"] + F.least(piece, first["pieces"] - 1)).drop("spans")


def _pieces(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_FILE))


def met_files(wh: Warehouse, batch: DataFrame, staged: list[DataFile]) -> dict[str, int]:
    """Paths of the staged files whose range holds a key of the batch, with the number of such keys."""
    ranges: dict[Slice, list[tuple[int, int, int, int]]] = {}
    for number, file in enumerate(staged):
        ranges.setdefault(file.slice[:2], []).append((file.least, file.most, number, 1))
    if not ranges:
        return {}
    met = batch.join(_span_rows(wh, ranges), SLICE_KEY).select(F.explode(F.filter("spans", _holds)["base"]).alias("number"))
    return {staged[r["number"]].path: r["keys"] for r in met.groupBy("number").agg(F.count(F.lit(1)).alias("keys")).collect()}


def _written(wh: Warehouse, rows: DataFrame, spans: dict[Slice, list[tuple[int, int, int, int]]]) -> list[DataFile]:
    keys = [*SLICE_KEY, PART]
    parted = rebalanced(_parted(rows, _span_rows(wh, spans)), keys)
    return wh.write("staging", parted.sortWithinPartitions(*keys, "time"))


def merge_into_staging(
    wh: Warehouse, batch: DataFrame | None, run_id: str, emptied: list[str] | None = None
) -> Callable[[State], Change]:
    """The change that a batch, unique per key, makes to staging: a function of the state it is made to.

    The batch replaces bars of equal key and joins the others. With ``emptied`` these markets hold nothing but
    the batch afterwards. Which slices are touched, with their rows in the batch, is part of the change; a slice
    that is emptied has none. The names and time ranges of slices and files pass the driver, no bars.
    """
    counted: list[tuple[str, int, int, int, int]] = []
    if batch is not None:
        time = _micros()
        measures = [F.count(F.lit(1)).alias("n"), F.min(time).alias("least"), F.max(time).alias("most")]
        counted = [tuple(r) for r in batch.groupBy(*SLICE_KEY).agg(*measures).collect()]
    own = {(m, str(y)): (least, most, n) for m, y, n, least, most in counted}
    ready: list[DataFile] | None = None  # of a batch that meets nothing, written once

    def touched(empty: set[Slice]) -> list[DataFile]:
        rows = [(run_id, m, int(y), n) for (m, y), (_, _, n) in own.items()]
        rows += [(run_id, m, int(y), 0) for m, y in empty - own.keys()]
        if not rows:
            return []
        return wh.write("slices", wh.spark.createDataFrame(rows, "load_id string, market string, year int, rows bigint").coalesce(1))

    def alone() -> list[DataFile]:
        nonlocal ready
        if ready is None:
            spans = {s: [(least, most, 0, _pieces(n))] for s, (least, most, n) in own.items()}
            ready = _written(wh, batch, spans) if own else []
        return ready

    def change(state: State) -> Change:
        out = Change()
        if emptied is not None:
            markets = {(m,) for m in emptied}
            old = state.files("staging", markets | own.keys())
            out.read["staging"] = markets | own.keys()
            out.put("staging", alone(), old)
            out.put("slices", touched({f.slice[:2] for f in old}))
            return out
        staged = state.files("staging", own.keys())
        met = met_files(wh, batch, staged) if staged else {}
        out.read["staging"] = set(own.keys())
        if not met:
            out.put("staging", alone())
        else:
            spans: dict[Slice, list[tuple[int, int, int, int]]] = {}
            base: dict[Slice, int] = {}

            def add(slice_: Slice, least: int, most: int, rows: int) -> None:
                first = base.get(slice_, 0)
                spans.setdefault(slice_, []).append((least, most, first, _pieces(rows)))
                base[slice_] = first + _pieces(rows)

            old = [f for f in staged if f.path in met]
            for f in sorted(old, key=lambda f: (f.least, f.path)):
                add(f.slice[:2], f.least, f.most, f.rows + met[f.path])
            for slice_, (least, most, n) in own.items():
                add(slice_, least, most, n)
            kept = wh.rows("staging", old)
            merged = upsert(kept, batch.select(*kept.columns), STAGING_KEY)
            out.put("staging", _written(wh, merged, spans), old)
        out.put("slices", touched(set()))
        return out

    return change
