"""Audit log: events are only ever appended, and folded into runs on read.

A run has a ``start`` and a ``finish`` event per file (loads) or per market (later layers). With the finish
come ``took`` events, one per load that the run took up, and for a full run ``reset`` events, one per
earlier run of its layer and market, which count no longer. What is new is told by these ids alone: the
times of events are for readers, and no decision compares them.

Events of runs that are over are folded, now and then, into the tables ``runs`` and ``taken``, by layer and
market. What is read then is that and the few events since (``pending``), so the work of a run does not grow with
the length of the log; ``audit`` keeps every event.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.plans.warehouse import PENDING, Warehouse
from barloom.schemas import AUDIT, RUNS, TAKEN
from barloom.sinks.versions import Change, Overtaken, State

LANDING, STAGING, OVERVIEW = "landing", "staging", "overview"
OK, FAILED = "ok", "failed"
# Writes of events after which they are folded.
FOLD_AT = 32


def new_run_id() -> str:
    return uuid.uuid4().hex


def now(spark: SparkSession, run_ts: datetime | None = None) -> datetime:
    """Time of a run: the argument, or the clock."""
    return run_ts if run_ts is not None else spark.sql("SELECT current_timestamp() AS t").first()["t"]


def _events(files: DataFrame, **constant) -> DataFrame:
    """Rows with file columns, completed to audit events by constants; the rest is null."""
    columns = []
    for field in AUDIT:
        if field.name in constant:
            value = F.lit(constant[field.name])
        elif field.name in files.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return files.select(*columns)


def record(wh: Warehouse, events: DataFrame, change: Change | None = None, seen: State | None = None, run_id: str = "") -> None:
    """Adds events to the log, in one commit with the change of tables that they tell of."""
    files = wh.write("audit", events)
    told = Change()
    told.put("audit", files)
    told.put(PENDING, files)
    wh.log.commit(told if change is None else change.joined(told), seen or wh.log.state(), run_id)


def one_market(spark: SparkSession, market: str) -> DataFrame:
    return spark.createDataFrame([(market,)], "market string")


def resets(wh: Warehouse, layer: str, markets: DataFrame, state: State | None = None) -> DataFrame:
    """For the finish of a full run: (market, source_id) of the runs of these markets that counted until then."""
    runs = stored_runs(wh, layer, state=state).select("market", F.col("run_id").alias("source_id")).distinct()
    return runs.join(markets.select("market").distinct(), "market", "left_semi")


def audit_start(
    wh: Warehouse, layer: str, run_id: str, time: datetime, task: str, items: DataFrame, market: str | None = None
) -> None:
    """One start event per item. Items are files of one market, or rows with a ``market``."""
    fixed = {} if market is None else {"market": market}
    record(wh, _events(items, layer=layer, event="start", run_id=run_id, event_time=time, task=task, **fixed), run_id=run_id)


def audit_finish(
    wh: Warehouse,
    layer: str,
    run_id: str,
    time: datetime,
    status: str = OK,
    rows: DataFrame | None = None,
    keys: list[str] | None = None,
    reset: DataFrame | None = None,
    took: DataFrame | None = None,
    change: Change | None = None,
    seen: State | None = None,
) -> None:
    """Close a run: one finish event per start event, with row counts from ``rows`` (keys, rows).

    If the run went well, ``reset`` (from ``resets``) names the earlier runs that no longer count, and
    ``took`` (market, load_id) the loads that it took up. All of it, and the ``change`` of tables that was computed
    from what ``seen`` holds, is one commit: it happens or ``Overtaken`` is raised and nothing happened.
    """
    started = wh.table(PENDING).where(
        (F.col("layer") == layer) & (F.col("event") == "start") & (F.col("run_id") == run_id)
    )
    closing = started
    if rows is not None:
        closing = closing.drop("rows").join(rows.select(*keys, "rows"), keys, "left").fillna({"rows": 0})
    events = _events(closing, event="finish", event_time=time, status=status)
    if reset is not None and status == OK:
        events = events.unionByName(_events(reset, layer=layer, event="reset", run_id=run_id, event_time=time))
    if took is not None and status == OK:
        named = took.select("market", F.col("load_id").alias("source_id"))
        events = events.unionByName(_events(named, layer=layer, event="took", run_id=run_id, event_time=time))
    record(wh, events, change, seen, run_id)
    # A write is a folder; what a fold leaves pending is one, however many files it takes.
    if len({f.path.rsplit("/", 1)[0] for f in wh.log.state().files(PENDING)}) >= FOLD_AT:
        fold_log(wh)


def runs_of_events(events: DataFrame) -> DataFrame:
    """Events folded to one row per (layer, run, market, file): start, finish, rows, status, is_stored.

    ``is_stored`` tells whether the run finished well and was not reset since. All markets and files
    fold in parallel, with a map-side half.
    """
    at = F.col("event_time")

    def when(event: str, value: Column) -> Column:
        return F.max(F.when(F.col("event") == event, value))

    item = ["layer", "run_id", "market", "task", "uri", "file", "checksum", "file_size", "file_time"]
    folded = (
        events.where(F.col("event").isin("start", "finish"))
        .groupBy(*item)
        .agg(
            when("start", at).alias("start_time"),
            when("finish", at).alias("finish_time"),
            when("finish", F.col("rows")).alias("rows"),
            when("finish", F.col("status")).alias("status"),
        )
    )
    over = events.where(F.col("event") == "reset").select(
        "layer", "market", F.col("source_id").alias("run_id"), F.lit(True).alias("over")
    )
    finished = F.col("finish_time").isNotNull() & (F.col("status") == OK)
    return (
        folded.join(over.distinct(), ["layer", "market", "run_id"], "left")
        .withColumn("is_stored", F.coalesce(finished, F.lit(False)) & F.col("over").isNull())
        .drop("over")
    )


def _slice(layer: str, market: str | None) -> list[tuple[str, ...]]:
    return [(layer,) if market is None else (layer, market)]


def _of(events: DataFrame, layer: str, market: str | None) -> DataFrame:
    events = events.where(F.col("layer") == layer)
    return events if market is None else events.where(F.col("market") == market)


def _reset_since(events: DataFrame) -> DataFrame:
    resets = events.where(F.col("event") == "reset")
    return resets.select("layer", "market", F.col("source_id").alias("run_id"), F.lit(True).alias("over")).distinct()


def _still_stored(runs: DataFrame, events: DataFrame) -> DataFrame:
    """Folded runs, of which later events may have reset some."""
    known = runs.join(_reset_since(events), ["layer", "market", "run_id"], "left")
    return known.withColumn("is_stored", F.col("is_stored") & F.col("over").isNull()).select(*RUNS.fieldNames())


def audit_runs(wh: Warehouse, layer: str, market: str | None = None, state: State | None = None) -> DataFrame:
    """One row per (run, market, file) of a layer: the folded ones, and those of the events since."""
    state = state or wh.log.state()
    events = _of(wh.table(PENDING, state), layer, market)
    fresh = runs_of_events(events)
    if not state.files("runs", _slice(layer, market)):
        return fresh
    folded = _still_stored(wh.table("runs", state, _slice(layer, market)), events)
    return folded.unionByName(fresh.select(*RUNS.fieldNames()))


def stored_runs(wh: Warehouse, layer: str, market: str | None = None, state: State | None = None) -> DataFrame:
    """Finished runs that still count."""
    return audit_runs(wh, layer, market, state).where(F.col("is_stored"))


def fold_log(wh: Warehouse) -> bool:
    """Folds the events of runs that are over into ``runs`` and ``taken``. False if another driver did so meanwhile.

    Only the layers and markets that have such events are rewritten, and only the names of these pass the
    driver. Events of open runs stay pending.
    """
    state = wh.log.state()
    files = state.files(PENDING)
    events = wh.rows(PENDING, files)
    over = events.where(F.col("event") == "finish").select("layer", "run_id").distinct()
    done = events.join(over, ["layer", "run_id"], "left_semi")
    slices = [(r.layer, r.market) for r in done.select("layer", "market").distinct().collect()]
    if not slices:
        return False
    old_runs, old_taken = state.files("runs", slices), state.files("taken", slices)
    fresh = runs_of_events(done).select(*RUNS.fieldNames())
    runs = _still_stored(wh.rows("runs", old_runs), done).unionByName(fresh)
    change = Change(read={"runs": set(slices), "taken": set(slices)})
    change.put("runs", wh.write("runs", runs), old_runs)
    written = wh.rows("runs", change.add["runs"])
    took = done.where(F.col("event") == "took").withColumn("load_id", F.col("source_id")).select(*TAKEN.fieldNames())
    stored = written.where(F.col("is_stored")).select("layer", "market", "run_id")
    taken_up = wh.rows("taken", old_taken).unionByName(took).join(stored, ["layer", "market", "run_id"], "left_semi")
    change.put("taken", wh.write("taken", taken_up.distinct()), old_taken)
    # As few files as their size asks for; a single task would join and write all open runs.
    still_open = events.join(over, ["layer", "run_id"], "left_anti").hint("rebalance")
    change.put(PENDING, wh.write(PENDING, still_open), files)
    try:
        wh.log.commit(change, state)
    except Overtaken:
        return False
    return True


def seen_checksums(wh: Warehouse, layer: str, market: str | None = None) -> DataFrame:
    """Checksums of a market's finished loads. Content counts, whatever the file is called.

    A file does not say which market it is of, so equal content of another market is another load.
    """
    return stored_runs(wh, layer, market).select("checksum").distinct()


def unseen_files(manifest: DataFrame, seen: DataFrame) -> DataFrame:
    """Files whose content was not loaded yet, one file per content."""
    fresh = manifest.join(seen.select("checksum"), "checksum", "left_anti")
    return one_per_checksum(fresh)


def one_per_checksum(manifest: DataFrame) -> DataFrame:
    rest = [c for c in manifest.columns if c != "checksum"]
    first = F.min_by(F.struct(*rest), F.col("file")).alias("first")
    return manifest.groupBy("checksum").agg(first).select("checksum", "first.*").select(*manifest.columns)


def successful_loads(wh: Warehouse, layer: str, market: str | None = None, state: State | None = None) -> DataFrame:
    """(market, load_id, finish_time) of finished loads, each once."""
    runs = stored_runs(wh, layer, market, state)
    return runs.groupBy("market", F.col("run_id").alias("load_id")).agg(F.max("finish_time").alias("finish_time"))


def last_start(wh: Warehouse, layer: str, market: str | None = None) -> DataFrame:
    """(market, last_start): when the last finished run of each market began."""
    return stored_runs(wh, layer, market).groupBy("market").agg(F.max("start_time").alias("last_start"))


def last_refresh(wh: Warehouse, market: str) -> datetime | None:
    """When the last finished refresh of a market began; None if there was none."""
    return last_start(wh, OVERVIEW, market).agg(F.max("last_start").alias("t")).first()["t"]


def taken(wh: Warehouse, layer: str, market: str | None = None, state: State | None = None) -> DataFrame:
    """(market, load_id) that finished runs of a layer took up."""
    state = state or wh.log.state()
    events = _of(wh.table(PENDING, state), layer, market)
    runs = runs_of_events(events).where(F.col("is_stored")).select("market", "run_id")
    took = events.where(F.col("event") == "took").join(runs, ["market", "run_id"], "left_semi")
    took = took.select("market", F.col("source_id").alias("load_id"))
    if state.files("taken", _slice(layer, market)):
        folded = wh.table("taken", state, _slice(layer, market))
        kept = folded.join(_reset_since(events), ["layer", "market", "run_id"], "left_anti")
        took = took.unionByName(kept.select("market", "load_id"))
    return took.distinct()


def new_loads(wh: Warehouse, source: str, target: str, market: str | None = None) -> DataFrame:
    """Finished loads of the source layer that no run of the target layer has taken up.

    Told by their ids: a load that was running while the target ran, or whose run time lies before
    that of the target, is new all the same.
    """
    state = wh.log.state()
    loads = successful_loads(wh, source, market, state)
    return loads.join(taken(wh, target, market, state), ["market", "load_id"], "left_anti")


def latest_run_per_checksum(runs: DataFrame) -> DataFrame:
    """The newest run of each file content."""
    row = F.struct("run_id", "file", "start_time", "finish_time", "rows")
    newest = F.max_by(row, F.struct("start_time", "run_id"))
    return runs.groupBy("checksum").agg(newest.alias("newest")).select("checksum", "newest.*")
