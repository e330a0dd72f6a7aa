"""The same results in plain SQL over the sample tables, query by query."""

from __future__ import annotations

from barloom.catalog.queries import CUT, MARKET
from barloom.functions.calendar import MONTH_NAMES, WEEKDAY_NAMES

# ---- building blocks ---------------------------------------------------------------------------

ORDERS = """
    SELECT o_orderpriority AS market, o_orderdate AS time,
           arg_min(o_totalprice, o_orderkey) AS open, arg_max(o_totalprice, o_orderkey) AS close
    FROM orders GROUP BY o_orderpriority, o_orderdate"""

ONE_MARKET = f"""
    SELECT '{MARKET}' AS market, o_orderdate AS time,
           arg_min(o_totalprice, o_orderkey) AS open, arg_max(o_totalprice, o_orderkey) AS close
    FROM orders GROUP BY o_orderdate"""

LINEITEM = """
    SELECT l_returnflag AS market, l_shipdate AS time,
           arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS open,
           arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS close
    FROM lineitem GROUP BY l_returnflag, l_shipdate"""

EVENTS = "SELECT event_type AS market, ts AS time, value AS open, value AS close FROM events"

OLD = ORDERS.replace("FROM orders", "FROM orders WHERE o_orderstatus = 'F'")
NEW = ORDERS.replace("FROM orders", "FROM orders WHERE o_orderstatus <> 'F'")

MARKS = """
    SELECT o_orderpriority AS market, max(o_orderdate) AS mark
    FROM orders WHERE o_totalprice > 490000 GROUP BY o_orderpriority"""


def _r(column: str, name: str | None = None) -> str:
    return f"round(CAST({column} AS DOUBLE), 6) + 0.0 AS {name or column}"


def _prices(bars: str, grain: str = "month") -> str:
    period = "CAST(month(time) AS INTEGER) AS month" if grain == "month" else "CAST(time AS DATE) AS day"
    return f"""
    SELECT market, CAST(year(time) AS INTEGER) AS year, {period},
           arg_min(open, time) AS open, arg_max(close, time) AS close
    FROM ({bars}) GROUP BY ALL"""


def _previous(bars: str, carry: bool = False, grain: str = "month") -> str:
    window = f"PARTITION BY market ORDER BY year, {grain}" if carry else f"PARTITION BY market, year ORDER BY {grain}"
    return f"""
    SELECT *, coalesce(lag(close) OVER ({window}), open) AS prev_close
    FROM ({_prices(bars, grain)})"""


def _changes(bars: str, basis: str = "both", carry: bool = False, grain: str = "month") -> str:
    parts = []
    for name, reference in (("open", "open"), ("prev", "prev_close")):
        if basis in ("both", name):
            parts.append(
                f"SELECT market, year, {grain}, '{name}' AS basis, "
                f"(close - {reference}) / nullif({reference}, 0) * 100 AS pct FROM p"
            )
    return f"WITH p AS ({_previous(bars, carry, grain)}) " + " UNION ALL ".join(parts)


def _pivot(changes: str, missing: str = "null", grain: str = "month", cell: str = "sum") -> str:
    number = "month" if grain == "month" else "(dayofweek(day) + 6) % 7"
    names, first = (MONTH_NAMES, 1) if grain == "month" else (WEEKDAY_NAMES, 0)

    def filled(e: str) -> str:
        return f"coalesce({e}, 0)" if missing == "zero" else e

    cells = ", ".join(
        filled(f"{cell}(CASE WHEN {number} = {k} THEN pct END)") + f" AS {n}" for k, n in enumerate(names, first)
    )
    total = filled(f"{cell}(pct)")
    return f"SELECT market, year, basis, {cells}, {total} AS total FROM ({changes}) GROUP BY market, year, basis"


def _average(wide: str, names: list[str]) -> str:
    means = ", ".join(f"avg({n}) AS {n}" for n in [*names, "total"])
    return f"SELECT market, 'total' AS year, basis, {means} FROM ({wide}) GROUP BY market, basis"


def _overview(
    bars: str, basis: str = "both", carry: bool = False, missing: str = "null", grain: str = "month",
    cell: str = "sum",
) -> str:
    names = MONTH_NAMES if grain == "month" else WEEKDAY_NAMES
    wide = _pivot(_changes(bars, basis, carry, grain), missing, grain, cell)
    cells = ", ".join([*names, "total"])
    rounded = ", ".join(_r(n) for n in [*names, "total"])
    return f"""
    WITH wide AS ({wide}),
    rows AS (
        SELECT market, CAST(year AS VARCHAR) AS year, basis, {cells} FROM wide
        UNION ALL
        {_average("SELECT * FROM wide", names)}
    )
    SELECT market, year, basis, {rounded} FROM rows"""


def _bars(bars: str, more: str = "") -> str:
    return f"SELECT market, time, {_r('open')}, {_r('close')}{more} FROM ({bars})"


def _month_prices(bars: str, grain: str = "month") -> str:
    return f"SELECT market, year, {grain}, {_r('open')}, {_r('close')} FROM ({_prices(bars, grain)})"


def _rounded_changes(bars: str, basis: str = "both", carry: bool = False, grain: str = "month") -> str:
    return f"SELECT market, year, {grain}, basis, {_r('pct')} FROM ({_changes(bars, basis, carry, grain)})"


def _rounded_pivot(missing: str = "null") -> str:
    cells = ", ".join(_r(n) for n in [*MONTH_NAMES, "total"])
    return f"SELECT market, year, basis, {cells} FROM ({_pivot(_changes(ORDERS), missing)})"


UPSERTED = f"""
    SELECT * FROM ({OLD}) o WHERE NOT EXISTS
        (SELECT 1 FROM ({NEW}) n WHERE n.market = o.market AND n.time = o.time)
    UNION ALL SELECT * FROM ({NEW})"""

UPSERTED_ONE = UPSERTED.replace("o_orderpriority AS market", f"'{MARKET}' AS market").replace(
    "GROUP BY o_orderpriority, o_orderdate", "GROUP BY o_orderdate"
)

YEARLY_AVERAGE = f"""
    SELECT market, year, basis, {", ".join(_r(n) for n in [*MONTH_NAMES, "total"])}
    FROM ({_average(_pivot(_changes(ORDERS)), MONTH_NAMES)})"""

COARSE = ORDERS.replace("o_totalprice", "(floor(o_totalprice / 200000) * 200000.0)")


def _comma(column: str) -> str:
    return f"replace(CAST(CAST({column} AS DECIMAL(12,3)) AS VARCHAR), '.', ',')"


RAW_LINES = f"""
    SELECT l_returnflag AS market, l_shipdate AS time,
           TRY_CAST(replace({_comma('l_quantity')}, ',', '.') AS DECIMAL(7,3)) AS open,
           TRY_CAST(replace({_comma('l_extendedprice')}, ',', '.') AS DECIMAL(7,3)) AS close
    FROM lineitem"""

WIDE_LINES = RAW_LINES.replace("DECIMAL(7,3)", "DECIMAL(12,3)")

VALID = "open IS NOT NULL AND open <> 0 AND close IS NOT NULL AND close <> 0"
REASON = "CASE WHEN open IS NULL OR open = 0 THEN 'open' WHEN close IS NULL OR close = 0 THEN 'close' END"

EVENT_LOG = """
    SELECT event_type AS market, date_trunc('second', ts) AS time,
           TRY_CAST(CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS DECIMAL(7,3)) AS open,
           CASE WHEN event_type = 'error' THEN TRY_CAST(replace(props, ',', '.') AS DECIMAL(7,3))
                ELSE TRY_CAST(CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS DECIMAL(7,3)) END AS close
    FROM events"""

BAR_TEXT = f"""
    SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS time, {_comma('open')} AS open,
           {_comma('greatest(open, close)')} AS high, {_comma('least(open, close)')} AS low,
           {_comma('close')} AS close, '0' AS volume
    FROM ({ORDERS})"""

RUNS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS market, o_orderdate AS start_time,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY END AS finish_time,
           CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'P' THEN 'failed' END AS status,
           o_orderstatus = 'F' AS is_stored, sha256(CAST(o_custkey AS VARCHAR)) AS checksum
    FROM orders"""

RUNS_AFTER_RESET = RUNS.replace(
    "o_orderstatus = 'F' AS", f"o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '{CUT}' AS"
)


def _run_counts(runs: str) -> str:
    return f"""
    SELECT market, status, is_stored, count(*) AS n, count(finish_time) AS n_closed, max(start_time) AS last_start
    FROM ({runs}) GROUP BY market, status, is_stored"""


# ---- one statement per query -------------------------------------------------------------------

_FULL_RUN = _overview(ONE_MARKET)

ORACLE: dict[str, str] = {
    "orders_daily_bars": _bars(ORDERS),
    "lineitem_daily_bars": _bars(LINEITEM),
    "month_open_close": _month_prices(ORDERS),
    "month_open_close_events": _month_prices(EVENTS),
    "day_open_close_events": _month_prices(EVENTS, "day"),
    "month_open_close_newest": f"""
        SELECT o_orderpriority AS market, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month,
               round(arg_max(o_totalprice, row(-epoch_us(o_orderdate), o_orderkey)), 6) AS open,
               round(arg_max(o_totalprice, row(o_orderdate, o_orderkey)), 6) AS close
        FROM orders GROUP BY ALL""",
    "previous_close": f"""
        SELECT market, year, month, {_r('open')}, {_r('close')}, {_r('prev_close')} FROM ({_previous(ORDERS)})""",
    "previous_close_carried": f"""
        SELECT market, year, month, {_r('open')}, {_r('close')}, {_r('prev_close')}
        FROM ({_previous(ORDERS, carry=True)})""",
    "change_open_basis": _rounded_changes(ORDERS, "open"),
    "change_prev_basis": _rounded_changes(ORDERS, "prev"),
    "change_prev_carry": _rounded_changes(ORDERS, "prev", carry=True),
    "change_both_bases": _rounded_changes(ORDERS),
    "change_both_bases_lineitem": _rounded_changes(LINEITEM),
    "change_exact_decimal": _rounded_changes(ORDERS),
    "change_zero_reference": _rounded_changes(COARSE),
    "daily_change_events": _rounded_changes(EVENTS, carry=True, grain="day"),
    "month_pivot": _rounded_pivot(),
    "month_pivot_zero_missing": _rounded_pivot("zero"),
    "yearly_average_row": YEARLY_AVERAGE,
    "monthly_overview_orders": _overview(ORDERS),
    "monthly_overview_lineitem": _overview(LINEITEM),
    "monthly_overview_events": _overview(EVENTS),
    "monthly_overview_carry": _overview(ORDERS, carry=True),
    "monthly_overview_zero_missing": _overview(ORDERS, missing="zero"),
    "monthly_overview_decimal": _overview(ORDERS),
    "monthly_overview_one_market": _overview(f"SELECT * FROM ({ORDERS}) WHERE market = '1-URGENT'", "open"),
    "overview_yearly_rows": f"SELECT * FROM ({_overview(ORDERS)}) WHERE year <> 'total'",
    "overview_total_rows": f"SELECT * FROM ({_overview(ORDERS)}) WHERE year = 'total'",
    "weekday_overview_orders": _overview(ORDERS, grain="day"),
    "weekday_overview_mean": _overview(ORDERS, carry=True, grain="day", cell="avg"),
    "weekday_overview_events": _overview(EVENTS, grain="day"),
    "bars_latest_wins": """
        SELECT o_orderpriority AS market, o_orderdate AS time, max(o_orderkey) AS seq,
               round(arg_max(o_totalprice, o_orderkey), 6) AS open,
               round(arg_max(o_totalprice, o_orderkey), 6) AS close
        FROM orders GROUP BY o_orderpriority, o_orderdate""",
    "bars_upsert": _bars(UPSERTED),
    "bars_not_replaced": _bars(
        f"SELECT * FROM ({OLD}) o WHERE NOT EXISTS "
        f"(SELECT 1 FROM ({NEW}) n WHERE n.market = o.market AND n.time = o.time)"
    ),
    "bars_sent_again": _bars(f"SELECT * FROM ({OLD}) WHERE (market, time) IN (SELECT market, time FROM ({NEW}))"),
    "changed_years": f"""
        SELECT DISTINCT b.market, CAST(year(b.time) AS INTEGER) AS year
        FROM ({ORDERS}) b LEFT JOIN ({MARKS}) m ON b.market = m.market
        WHERE b.time > coalesce(m.mark, TIMESTAMP '1970-01-01')""",
    "refresh_reach_carried": f"""
        WITH years AS (
            SELECT market, CAST(year(time) AS INTEGER) AS year, bool_or(close > 490000) AS hit
            FROM ({ORDERS}) GROUP BY ALL
        ), marked AS (
            SELECT *, lag(hit) OVER (PARTITION BY market ORDER BY year) AS hit_before FROM years
        )
        SELECT market, year FROM marked WHERE hit OR coalesce(hit_before, FALSE)""",
    "refresh_changed_years": _overview(ORDERS),
    "refresh_changed_years_carried": _overview(ORDERS, carry=True),
    "clean_decimal_comma": f"SELECT market, time, {_r('open')}, {_r('close')} FROM ({WIDE_LINES}) WHERE {VALID}",
    "rejected_prices": f"""
        SELECT market, {REASON} AS reject_reason, count(*) AS n FROM ({RAW_LINES})
        WHERE NOT coalesce({VALID}, FALSE) GROUP BY ALL""",
    "clean_wide_prices": f"""
        SELECT '{MARKET}' AS market, o_orderdate AS time, {_r('o_totalprice', 'open')}, {_r('o_totalprice', 'close')}
        FROM orders""",
    "event_log_as_bars": f"""
        SELECT market, {REASON} AS reject_reason, count(*) AS n, min(time) AS first_time, max(time) AS last_time
        FROM ({EVENT_LOG}) GROUP BY ALL""",
    "event_times": """
        SELECT event_id, date_trunc('second', ts) AS parsed, date_trunc('second', ts) AS truncated,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(year(ts) AS VARCHAR) AS year_text, CAST((dayofweek(ts) + 6) % 7 AS INTEGER) AS weekday,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS text, ts > TIMESTAMP '1970-01-01' AS ever
        FROM events""",
    "previous_event_value": f"""
        SELECT event_id, {_r('value')}, round(lag(value) OVER (ORDER BY ts, event_id), 6) AS previous FROM events""",
    "previous_bar_close": f"""
        SELECT market, time, {_r('open')}, {_r('close')},
               round(coalesce(lag(close) OVER (PARTITION BY market ORDER BY time), open), 6) AS prev_close
        FROM ({EVENTS})""",
    "label_flags": """
        SELECT d.doc_id, coalesce(l.quality = 1, FALSE) AS is_good, CAST(NULL AS BOOLEAN) AS no_flag
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "page_names": "SELECT page_id, string_split(url, '/')[-1] AS name FROM pages",
    "bar_lines": f"SELECT concat_ws(';', time, open, high, low, close, volume) AS value FROM ({BAR_TEXT})",
    "bar_fields": f"SELECT time, close, CAST(6 AS INTEGER) AS n_fields FROM ({BAR_TEXT})",
    "bar_files_round_trip": _bars(ONE_MARKET),
    "bar_files_per_market": _bars(ORDERS),
    "files_not_loaded": """
        WITH docs AS (SELECT printf('doc-%08d', doc_id) AS file, sha256(text) AS checksum, doc_id FROM documents)
        SELECT min(file) AS file, checksum FROM docs
        WHERE checksum NOT IN (
            SELECT checksum FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)
        ) GROUP BY checksum""",
    "files_of_equal_content": f"""
        SELECT CAST(year(time) * 100 + month(time) AS INTEGER) AS period, min(close) >= 3000 AS same
        FROM ({ONE_MARKET}) GROUP BY ALL""",
    "quoted_fields": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, 'a;' || props AS props, CAST(NULL AS VARCHAR) AS bad_line FROM events""",
    "fields_with_line_breaks": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, 'a;' || chr(10) || replace(props, ':', ':' || chr(10)) || chr(10) || 'z' AS props,
               event_type, CAST(NULL AS VARCHAR) AS bad_line
        FROM events""",
    "contents_by_identity": f"""
        SELECT CAST(year(time) * 100 + month(time) AS INTEGER) AS period, identity,
               CASE identity WHEN 'lines' THEN 1 ELSE 2 END AS contents
        FROM ({ONE_MARKET}), (SELECT unnest(['lines', 'bytes']) AS identity) GROUP BY ALL""",
    "short_and_long_rows": """
        SELECT CASE WHEN l_linenumber % 3 <> 1 THEN 'field count' WHEN l_quantity = 0 THEN 'open' END AS reject_reason,
               count(*) AS n
        FROM lineitem GROUP BY ALL""",
    "bars_exported": _bars(ORDERS),
    "tables_of_markets": f"SELECT 'm' || left(market, 1) AS table, count(*) AS rows FROM ({ORDERS}) GROUP BY market",
    "markets_with_high_prices": f"SELECT market, bool_or(close > 499950) AS any_high FROM ({ORDERS}) GROUP BY market",
    "overview_first_rows": f"SELECT * FROM ({_overview(ORDERS)}) ORDER BY market, basis, year LIMIT 10",
    "refused_modes": f"""
        SELECT DISTINCT market AS value, TRUE AS refused FROM ({ORDERS})
        UNION ALL SELECT unnest(['full', 'incremental']), FALSE""",
    "table_append": _bars(f"{OLD} UNION ALL {NEW}"),
    "table_replace_all": _bars(NEW),
    "table_swap_upsert": _bars(UPSERTED),
    "table_replace_slices": _bars(ORDERS, ", CAST(year(time) AS INTEGER) AS year"),
    "table_delete_years": _bars(ORDERS, ", CAST(year(time) AS INTEGER) AS year")
    + " WHERE market <> '4-NOT SPECIFIED' AND NOT (market = '5-LOW' AND year(time) IN (1996, 1997))",
    "table_missing_is_empty": _bars(ORDERS),
    "audit_runs_folded": _run_counts(RUNS),
    "audit_runs_after_reset": _run_counts(RUNS_AFTER_RESET),
    "rows_of_successful_loads": """
        SELECT l_returnflag, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS line_sum
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
        GROUP BY l_returnflag""",
    "load_counts": f"""
        SELECT count(*) AS rows, count(*) FILTER (WHERE NOT coalesce({VALID}, FALSE)) AS rejected FROM ({RAW_LINES})""",
    "last_refresh_per_market": f"""
        SELECT market, max(start_time) AS last_start FROM ({RUNS_AFTER_RESET}) WHERE is_stored GROUP BY market""",
    "latest_audit_row": f"""
        SELECT checksum, arg_max(run_id, row(start_time, run_id)) AS run_id,
               'order-' || arg_max(run_id, row(start_time, run_id)) AS file,
               max(start_time) AS start_time, max(start_time) + INTERVAL 1 DAY AS finish_time
        FROM ({RUNS}) WHERE is_stored GROUP BY checksum""",
    "loads_since_refresh": f"""
        SELECT r.market, r.run_id, r.finish_time
        FROM ({RUNS}) r LEFT JOIN ({MARKS}) m ON r.market = m.market
        WHERE r.is_stored AND r.start_time > coalesce(m.mark, TIMESTAMP '1970-01-01')""",
    "load_and_refresh": _FULL_RUN,
    "load_and_refresh_incremental": _FULL_RUN,
    "load_staging_incremental_carry": _overview(ONE_MARKET, carry=True),
    "staged_bars_upserted": _bars(UPSERTED_ONE, ", CAST(year(time) AS INTEGER) AS year"),
    "landed_rejects": f"""
        WITH typed AS (
            SELECT market, TRY_CAST(CAST(CAST(open AS DECIMAL(12,3)) AS VARCHAR) AS DECIMAL(8,3)) AS open,
                   TRY_CAST(CAST(CAST(close AS DECIMAL(12,3)) AS VARCHAR) AS DECIMAL(8,3)) AS close
            FROM ({ONE_MARKET})
        )
        SELECT market, coalesce({REASON}, 'none') AS reject_reason, count(*) AS n FROM typed GROUP BY ALL""",
    "stream_then_refresh": _FULL_RUN,
    "lineitem_files_to_staging": """
        WITH last AS (
            SELECT l_returnflag AS market, l_shipdate AS time, arg_max(l_extendedprice, row(l_orderkey, l_linenumber)) AS price
            FROM lineitem GROUP BY ALL
        )
        SELECT market, time, round(price, 6) AS open, round(price, 6) AS close FROM last""",
    "equal_looking_files": f"""
        SELECT market, time, round(open + more, 6) AS open, round(close + more, 6) AS close
        FROM ({ONE_MARKET.replace(f"'{MARKET}' AS market, ", "")}),
             (VALUES ('A', 0.0), ('B', 1.0), ('C', 0.0)) AS markets(market, more)""",
    "markets_refreshed_at_once": _overview(ORDERS),
    "cleaned_while_loaded": _overview(ORDERS),
    "late_bars_into_many_files": f"""
        SELECT market, time, round(open, 6) AS open,
               round(close + CASE WHEN year(time) = 1997 AND day(time) = 1 THEN 1 ELSE 0 END, 6) AS close
        FROM ({ONE_MARKET})""",
    "log_folded_between_loads": _run_counts(RUNS_AFTER_RESET),
    "run_times_out_of_order": _FULL_RUN,
    "full_clean_of_one_route": f"""
        SELECT market, time, round(open, 6) AS open, round(close, 6) AS close
        FROM ({ONE_MARKET.replace(f"'{MARKET}' AS market, ", "")}), (VALUES ('A'), ('B')) AS markets(market)""",
    "load_row_counts": f"""
        SELECT market, CASE WHEN time < TIMESTAMP '{CUT}' THEN TIMESTAMP '2002-01-01'
                            ELSE TIMESTAMP '2002-01-02' END AS start_time, count(*) AS rows
        FROM ({ONE_MARKET}) GROUP BY ALL""",
}
