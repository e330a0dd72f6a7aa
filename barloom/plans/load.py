"""Files to landing, landing to staging, or files to staging directly."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.parsing import never
from barloom.operators.changes import of_market
from barloom.plans import audit
from barloom.plans.arguments import FULL, check_mode, check_text
from barloom.plans.staging import merge_into_staging
from barloom.plans.warehouse import Warehouse
from barloom.schemas import STAGING_KEY
from barloom.session import scratch_folder
from barloom.sinks.tables import claim, working_copy
from barloom.sinks.versions import Change, Overtaken, State
from barloom.sources.clean import parse_bars, rejected_bars, tag_load
from barloom.sources.files import ROW_ORDER, file_key, list_files, read_files, with_checksums


@dataclass(frozen=True)
class LoadReport:
    """What a load did. ``run_id`` is None if there was nothing to do.

    All counts are taken from what was written, so a task that ran twice counts once.
    """

    run_id: str | None
    files: int = 0
    rows_read: int = 0
    rows_rejected: int = 0


NOTHING = LoadReport(None)


def pick_files(wh: Warehouse, layer: str, listed: DataFrame, mode: str, folder: str, market: str) -> DataFrame:
    """The files a run has to read: all (full) or those whose content its market has not seen, one per content."""
    known = audit.audit_runs(wh, layer, market).where(F.col("status") == audit.OK)
    manifest = with_checksums(listed, known.select("uri", "file_size", "file_time", "checksum"), wh.identity)
    if mode == FULL:
        picked = audit.one_per_checksum(manifest)
    else:
        picked = audit.unseen_files(manifest, audit.seen_checksums(wh, layer, market))
    return working_copy(picked, f"{folder}/manifest")


def _paths(files: DataFrame) -> list[str]:
    return [r.path for r in files.select("path").collect()]


def load_landing(
    wh: Warehouse,
    directory: str,
    market: str,
    mode: str,
    run_ts: datetime | None = None,
    task: str = "files to landing",
) -> LoadReport:
    """Raw text rows of a directory into the landing table.

    ``full`` replaces what the market had, ``incremental`` adds the files not loaded before.
    """
    check_text("market", market), check_text("task", task), check_mode(mode)
    time = audit.now(wh.spark, run_ts)
    with claim(wh.database, market), scratch_folder(wh.spark, "landing") as folder:
        files = pick_files(wh, audit.LANDING, list_files(wh.spark, directory), mode, folder, market)
        paths = _paths(files)
        if not paths and mode != FULL:
            return NOTHING
        run_id = audit.new_run_id()
        audit.audit_start(wh, audit.LANDING, run_id, time, task, files, market)
        status = audit.FAILED
        try:
            change, counts = Change(), None
            if paths:
                change.put("landing", wh.write("landing", tag_load(read_files(files, wh.spark), market, run_id, time)))
                landed = wh.rows("landing", change.add["landing"])
                counts = landed.groupBy(F.col("source_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))

            def finish(state: State) -> None:
                own, reset = Change(), None
                if mode == FULL:  # rows of runs that are reset go in the same commit
                    own.put("landing", [], state.files("landing", [(market,)]))
                    own.read["landing"] = {(market,)}
                    reset = audit.resets(wh, audit.LANDING, audit.one_market(wh.spark, market), state)
                end = audit.now(wh.spark, run_ts)
                audit.audit_finish(
                    wh, audit.LANDING, run_id, end, audit.OK, counts, ["file"], reset, change=change.joined(own), seen=state
                )

            until_not_overtaken(wh, finish)
            status = audit.OK
        finally:
            if status != audit.OK:
                audit.audit_finish(wh, audit.LANDING, run_id, audit.now(wh.spark, run_ts), audit.FAILED)
        return LoadReport(run_id, len(paths), sum(f.rows for f in change.add.get("landing", [])))


def until_not_overtaken(wh: Warehouse, commit: Callable[[State], None]) -> None:
    """Computes and commits from the newest state, anew each time another run changed what was read."""
    while True:
        try:
            return commit(wh.log.state())
        except Overtaken:
            continue


def _typed_batch(
    wh: Warehouse, raw: DataFrame, run_id: str, time: datetime, order: list[str], folder: str
) -> tuple[DataFrame, int, int]:
    """Clean rows, one per key, written once; and how many rows were read and rejected.

    Newest row wins in the same aggregation that counts: copies of a key and rejects of a reason fold
    before the shuffle, and what a lost task had counted is not counted again.
    """
    keyed = raw.withColumn("file_key", file_key(F.col("source_file")))
    parsed = parse_bars(keyed, wh.price_type)
    good = F.col("reject_reason").isNull()
    values = [c for c in dict.fromkeys([*order, "open", "close", "load_id"])]
    rows = parsed.select("market", "reject_reason", *(F.when(good, F.col(c)).alias(c) for c in dict.fromkeys(["time", *values, "file_key"])))
    rest = [c for c in dict.fromkeys([*values, "file_key"]) if c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    folded = rows.groupBy(*STAGING_KEY, "reject_reason").agg(newest, F.count(F.lit(1)).alias("copies"))
    copy = working_copy(
        folded.select(
            *STAGING_KEY, F.col("newest.open"), F.col("newest.close"), F.col("newest.load_id").alias("landed_by"),
            F.lit(run_id).alias("load_id"), F.lit(time).cast("timestamp").alias("load_time"), F.year("time").alias("year"),
            F.col("newest.file_key"), "reject_reason", "copies",
        ),
        f"{folder}/batch",
    )
    read = F.coalesce(F.sum("copies"), F.lit(0))
    rejected = F.coalesce(F.sum(F.when(F.col("reject_reason").isNotNull(), F.col("copies"))), F.lit(0))
    counts = copy.agg(read.alias("read"), rejected.alias("rejected")).first()
    return copy.where(F.col("reject_reason").isNull()).drop("reject_reason", "copies"), counts["read"], counts["rejected"]


def landing_rows(wh: Warehouse, loads: DataFrame, market: str | None) -> DataFrame:
    """Landed rows of some finished loads. Only files of these loads are listed, and no others read."""
    finished = loads.where(F.col("finish_time") > never())
    named = [(r.market, r.load_id) for r in finished.select("market", "load_id").distinct().collect()]
    return of_market(wh.table("landing", within=named), market)


def clean_to_staging(
    wh: Warehouse,
    mode: str,
    market: str | None = None,
    run_ts: datetime | None = None,
    task: str = "landing to staging",
) -> LoadReport:
    """Landed rows of finished loads into typed bars, newest row per (market, time).

    ``incremental`` takes the finished landing loads that no run has taken up. ``full`` replaces the
    markets that have landing loads (or the one named); bars of other markets are not its own.
    """
    check_mode(mode), check_text("task", task)
    time = audit.now(wh.spark, run_ts)
    with claim(wh.database, market), scratch_folder(wh.spark, "staging") as folder:
        if mode == FULL:
            loads = audit.successful_loads(wh, audit.LANDING, market)
        else:
            loads = audit.new_loads(wh, audit.LANDING, audit.STAGING, market)
        loads = working_copy(loads, f"{folder}/loads")
        if market is not None:
            markets = audit.one_market(wh.spark, market)
        else:  # those with landed rows, and those whose bars came from landing before
            earlier = audit.taken(wh, audit.STAGING).select("market")
            markets = loads.select("market").union(earlier).distinct()
        markets = working_copy(markets, f"{folder}/markets")
        if loads.isEmpty() and (mode != FULL or markets.isEmpty()):
            return NOTHING
        run_id = audit.new_run_id()
        audit.audit_start(wh, audit.STAGING, run_id, time, task, markets)
        status = audit.FAILED
        try:
            rows = landing_rows(wh, loads, market)
            batch, read, rejected = _typed_batch(wh, rows, run_id, time, ["load_time", "load_id", *ROW_ORDER], folder)
            counts = batch.groupBy("market").agg(F.count(F.lit(1)).alias("rows"))
            emptied = [r.market for r in markets.collect()] if mode == FULL else None
            merge = merge_into_staging(wh, batch, run_id, emptied)

            def finish(state: State) -> None:
                reset = audit.resets(wh, audit.STAGING, markets, state) if mode == FULL else None
                end = audit.now(wh.spark, run_ts)
                audit.audit_finish(
                    wh, audit.STAGING, run_id, end, audit.OK, counts, ["market"], reset, loads, merge(state), state
                )

            until_not_overtaken(wh, finish)
            status = audit.OK
        finally:
            if status != audit.OK:
                audit.audit_finish(wh, audit.STAGING, run_id, audit.now(wh.spark, run_ts), audit.FAILED)
        return LoadReport(run_id, 0, read, rejected)


def load_staging(
    wh: Warehouse,
    directory: str,
    market: str,
    mode: str,
    run_ts: datetime | None = None,
    task: str = "files to staging",
) -> LoadReport:
    """Files of a directory straight into typed bars, without landing."""
    check_text("market", market), check_text("task", task), check_mode(mode)
    listed = list_files(wh.spark, directory)
    return load_listed(wh, listed, market, mode, run_ts, task)


def load_listed(
    wh: Warehouse, listed: DataFrame, market: str, mode: str, run_ts: datetime | None, task: str
) -> LoadReport:
    """``load_staging`` for files that are listed already."""
    time = audit.now(wh.spark, run_ts)
    with claim(wh.database, market), scratch_folder(wh.spark, "staging") as folder:
        files = pick_files(wh, audit.STAGING, listed, mode, folder, market)
        paths = _paths(files)
        if not paths and mode != FULL:
            return NOTHING
        run_id = audit.new_run_id()
        audit.audit_start(wh, audit.STAGING, run_id, time, task, files, market)
        status = audit.FAILED
        try:
            batch, read, rejected, counts = None, 0, 0, None
            if paths:
                raw = tag_load(read_files(files, wh.spark), market, run_id, time)
                batch, read, rejected = _typed_batch(wh, raw, run_id, time, ROW_ORDER, folder)
                per_file = batch.groupBy("file_key").agg(F.count(F.lit(1)).alias("rows"))
                names = files.select("file", file_key(F.col("file")).alias("file_key"))
                counts = names.join(per_file, "file_key")
            merge = merge_into_staging(wh, batch, run_id, [market] if mode == FULL else None)

            def finish(state: State) -> None:
                one = audit.one_market(wh.spark, market)
                reset = audit.resets(wh, audit.STAGING, one, state) if mode == FULL else None
                end = audit.now(wh.spark, run_ts)
                audit.audit_finish(
                    wh, audit.STAGING, run_id, end, audit.OK, counts, ["file"], reset, change=merge(state), seen=state
                )

            until_not_overtaken(wh, finish)
            status = audit.OK
        finally:
            if status != audit.OK:
                audit.audit_finish(wh, audit.STAGING, run_id, audit.now(wh.spark, run_ts), audit.FAILED)
        return LoadReport(run_id, len(paths), read, rejected)


def landing_rejects(wh: Warehouse, market: str | None = None) -> DataFrame:
    """Landed rows that are no valid bars, with the reason."""
    return rejected_bars(parse_bars(of_market(wh.table("landing"), market), wh.price_type))
