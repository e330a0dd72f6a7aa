"""Results from staging: everything, or only the years that new loads touched."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import MONTH_NAMES
from barloom.operators.changes import changes_of_prices, of_market
from barloom.operators.merge import except_keys, only_keys, replace_slices
from barloom.operators.periods import period_open_close
from barloom.operators.pivots import average_row, pivot_months
from barloom.operators.selection import filled, refresh_reach, total_rows, yearly_rows
from barloom.plans import audit
from barloom.plans.arguments import FULL, check_basis, check_mode, check_text
from barloom.plans.warehouse import Warehouse
from barloom.schemas import SLICE_KEY
from barloom.session import scratch_folder
from barloom.sinks.tables import claim, rebalanced, working_copy
from barloom.sinks.versions import Change, Overtaken, State


def loads_to_show(wh: Warehouse, mode: str, market: str | None = None) -> DataFrame:
    """(market, load_id, finish_time) of the loads the results do not hold yet; all of them for a full refresh."""
    if mode == FULL:
        return audit.successful_loads(wh, audit.STAGING, market)
    return audit.new_loads(wh, audit.STAGING, audit.OVERVIEW, market)


def changed_slices(wh: Warehouse, loads: DataFrame, state: State | None = None) -> DataFrame:
    """(market, year, rows) touched by the loads, from the small table of touched slices, not from the bars."""
    touched = only_keys(wh.table("slices", state), loads, ["market", "load_id"])
    return touched.groupBy(*SLICE_KEY).agg(F.sum("rows").alias("rows"))


def staged_bars(
    wh: Warehouse, market: str | None = None, slices: DataFrame | None = None, state: State | None = None
) -> DataFrame:
    """Staged bars of one version. Only files of the wanted slices are listed, and no others read.

    A file is part of staging from the commit that finishes its load on, so no bar has to be looked up in the
    audit log.
    """
    if slices is None:
        return wh.table("staging", state, None if market is None else [(market,)])
    wanted = slices if market is None else slices.where(F.col("market") == market)
    names = [(r.market, str(r.year)) for r in filled(wanted).distinct().collect()]
    return wh.table("staging", state, names)


def refreshed_prices(
    prices: DataFrame, bars: DataFrame, slices: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """Month prices with the given slices computed anew from their bars and the others kept."""
    return replace_slices(prices, period_open_close(bars), slices, keys or SLICE_KEY)


def refreshed_changes(
    changes: DataFrame, prices: DataFrame, reach: DataFrame, dropped: DataFrame, keys: list[str], carry: bool
) -> DataFrame:
    """Long changes: rows of dropped keys go, rows of reached slices come from the price table.

    The price table holds at most twelve rows per market and year. The previous close is looked up over
    whole markets of it, so a year that is not reached can still serve as the one before.
    """
    around = only_keys(prices, reach, ["market"])
    fresh = only_keys(changes_of_prices(around, "both", carry), reach, SLICE_KEY)
    return except_keys(changes, dropped, keys).unionByName(fresh, allowMissingColumns=True)


def refreshed_overview(
    overview: DataFrame, fresh_changes: DataFrame, dropped: DataFrame, keys: list[str], missing: str
) -> DataFrame:
    """Wide rows: reached years anew, other years as they were, average rows rebuilt from yearly rows."""
    fresh = pivot_months(fresh_changes, missing).withColumn("year", F.col("year").cast("string"))
    if "year" in dropped.columns:
        dropped = dropped.withColumn("year", F.col("year").cast("string"))
    kept = except_keys(yearly_rows(overview), dropped, keys)
    yearly = kept.unionByName(fresh, allowMissingColumns=True)
    averages = average_row(only_keys(yearly, dropped, ["market"]), MONTH_NAMES)
    untouched = except_keys(total_rows(overview), dropped, ["market"])
    return yearly.unionByName(averages, allowMissingColumns=True).unionByName(untouched)


def refresh(
    wh: Warehouse,
    mode: str,
    market: str | None = None,
    run_ts: datetime | None = None,
    task: str = "staging to overview",
) -> bool:
    """Bring month prices, changes and overview up to date. False if there was nothing to do."""
    check_mode(mode), check_text("task", task)
    time = audit.now(wh.spark, run_ts)
    with claim(wh.database, market):
        while True:
            with scratch_folder(wh.spark, "refresh") as folder:
                try:
                    return _refresh_once(wh, mode, market, time, run_ts, task, folder)
                except Overtaken:
                    continue


def _refresh_once(
    wh: Warehouse, mode: str, market: str | None, time: datetime, run_ts: datetime | None, task: str, folder: str
) -> bool:
    """One attempt; its run is closed as failed if another run changed a market it wrote."""
    spark = wh.spark
    # Loads first: what they did is part of every state from now on.
    loads = working_copy(loads_to_show(wh, mode, market), f"{folder}/loads")
    state = wh.log.state()
    # The names of slices pass the driver anyway, to list their files.
    rows = [tuple(r) for r in changed_slices(wh, loads, state).collect()]
    if mode != FULL and not rows:
        return False
    changed = spark.createDataFrame(rows, "market string, year int, rows bigint")
    names = sorted({r[0] for r in rows}) if market is None else [market]
    markets = spark.createDataFrame([(n,) for n in names], "market string")
    run_id = audit.new_run_id()
    audit.audit_start(wh, audit.OVERVIEW, run_id, time, task, markets)
    status = audit.FAILED
    try:
        change = _rewrite(wh, mode, market, changed, markets, time, state)
        reset = audit.resets(wh, audit.OVERVIEW, markets, state) if mode == FULL else None
        end = audit.now(spark, run_ts)
        audit.audit_finish(wh, audit.OVERVIEW, run_id, end, audit.OK, reset=reset, took=loads, change=change, seen=state)
        status = audit.OK
    finally:
        if status != audit.OK:
            audit.audit_finish(wh, audit.OVERVIEW, run_id, audit.now(spark, run_ts), audit.FAILED)
    return True


def _rewrite(
    wh: Warehouse, mode: str, market: str | None, changed: DataFrame, markets: DataFrame, time: datetime, state: State
) -> Change:
    """One pass over the changed bars, then three small tables, of which only the markets concerned are written.

    Each table is computed from the new files of the one before. All three come with one commit, which fails if
    one of the markets was changed since ``state``.
    """
    stamped = F.lit(time).cast("timestamp")
    # A full run replaces whole markets (all of them if none is named), an incremental one slices.
    keys = ["market"] if mode == FULL else SLICE_KEY
    if market is not None:
        within = {(market,)}
    elif mode == FULL:
        within = {()}
    else:
        within = {(r.market,) for r in markets.collect()}  # local rows
    change = Change()

    def stored(table: str) -> DataFrame:
        return wh.table(table, state, set() if mode == FULL else within)

    def write(rows: DataFrame, table: str) -> DataFrame:
        change.read[table] = within
        change.put(table, wh.write(table, rebalanced(rows, ["market"])), state.files(table, within))
        return wh.rows(table, change.add[table])

    bars = staged_bars(wh, market, None if mode == FULL else changed, state)
    gone = markets if mode == FULL else changed
    prices = write(refreshed_prices(stored("prices"), bars, gone, keys), "prices")

    # A full run shows all that is staged, also bars of loads that finished since it looked for loads.
    reach = prices.select(*SLICE_KEY).distinct() if mode == FULL else refresh_reach(prices, changed, wh.carry)
    dropped = markets if mode == FULL else reach
    changes = refreshed_changes(stored("changes"), prices, reach, dropped, keys, wh.carry)
    changes = write(changes.withColumn("updated_at", F.coalesce("updated_at", stamped)), "changes")

    fresh = only_keys(changes, reach, SLICE_KEY)
    concerned = prices.select("market").distinct() if mode == FULL else dropped
    wide = refreshed_overview(stored("overview"), fresh, concerned, keys, wh.missing)
    write(wide.withColumn("updated_at", F.coalesce("updated_at", stamped)), "overview")
    return change


def overview(wh: Warehouse, market: str | None = None, basis: str = "both") -> DataFrame:
    """The stored result, optionally of one market or one basis."""
    check_basis(basis)
    rows = of_market(wh.table("overview"), market)
    return rows if basis == "both" else rows.where(F.col("basis") == basis)
