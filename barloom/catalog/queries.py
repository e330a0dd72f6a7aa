"""Named queries over the sample tables: (spark, directory) to DataFrame.

Numbers are rounded to 6 digits on output only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schemas
from barloom.functions.calendar import DAY, MONTH_NAMES, WEEKDAY_NAMES, weekday_number
from barloom.functions.parsing import bar_time, base_name, comma_text, flag, never, time_text, whole_second
from barloom.operators.changes import as_double_prices, changes_of_prices, daily_changes, monthly_changes
from barloom.operators.merge import except_keys, latest_wins, only_keys, upsert
from barloom.operators.periods import (
    period_open_close, with_previous_bar_close, with_previous_close, with_previous_value,
)
from barloom.operators.pivots import (
    average_row, display_order, monthly_overview, overview_of_changes, pivot_months, weekday_overview,
)
from barloom.operators.selection import any_per_key, newer_than, refresh_reach, slices_of, total_rows, yearly_rows
from barloom.plans import audit
from barloom.plans.arguments import check_mode
from barloom.plans.load import clean_to_staging, landing_rejects, load_landing, load_staging
from barloom.plans.refresh import overview, refresh, refreshed_changes, refreshed_overview, refreshed_prices
from barloom.plans.run import run
from barloom.plans.warehouse import Warehouse, init_tables
from barloom.session import pin_session, scratch_path
from barloom.sinks import exports, tables as sink
from barloom.sources.adapters import events_bars, lineitem_bars, order_ticks, orders_bars, sample_table
from barloom.sources.clean import clean_bars, parse_bars, rejected_bars, tag_load, valid_bars
from barloom.sources.files import BYTES, LINES, file_manifest, read_bars, read_files
from barloom.sources.tables import literal_rows, read_table, table_or_empty
from barloom.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Order prices reach six digits before the point.
ORDER_PRICE = "decimal(12,3)"
# Orders from this day on play the part of a later delivery.
CUT = "1999-06-15"
MARKET = "orders"
# Fixed run times keep results repeatable.
_TIME = datetime(2002, 1, 1)
_LATER = datetime(2002, 1, 2)


def query(function: Query) -> Query:
    def pinned(spark: SparkSession, directory: str) -> DataFrame:
        return function(pin_session(spark), directory)

    QUERIES[function.__name__] = pinned
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles with 6 digits; adding zero turns a negative zero into a plain one."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) + F.lit(0.0) for c in columns})


def month_table(df: DataFrame) -> DataFrame:
    return rounded(df.select("market", "year", "basis", *MONTH_NAMES, "total"), *MONTH_NAMES, "total")


def weekday_table(df: DataFrame) -> DataFrame:
    return rounded(df.select("market", "year", "basis", *WEEKDAY_NAMES, "total"), *WEEKDAY_NAMES, "total")


def _orders(spark: SparkSession, directory: str) -> DataFrame:
    return orders_bars(sample_table(spark, directory, "orders"))


def _lineitem(spark: SparkSession, directory: str) -> DataFrame:
    return lineitem_bars(sample_table(spark, directory, "lineitem"))


def _events(spark: SparkSession, directory: str) -> DataFrame:
    return events_bars(sample_table(spark, directory, "events"))


def _ticks(spark: SparkSession, directory: str) -> DataFrame:
    return order_ticks(sample_table(spark, directory, "orders"))


def _one_market(spark: SparkSession, directory: str) -> DataFrame:
    """All orders as the daily bars of a single market."""
    orders = sample_table(spark, directory, "orders").withColumn("o_orderpriority", F.lit(MARKET))
    return orders_bars(orders)


def _before_cut(rows: DataFrame, time: str = "time") -> DataFrame:
    return rows.where(F.col(time) < F.lit(CUT).cast("timestamp"))


def _from_cut(rows: DataFrame, time: str = "time") -> DataFrame:
    return rows.where(F.col(time) >= F.lit(CUT).cast("timestamp"))


# ---- bars and periods --------------------------------------------------------------------------


@query
def orders_daily_bars(spark, directory):
    return rounded(_orders(spark, directory), "open", "close")


@query
def lineitem_daily_bars(spark, directory):
    return rounded(_lineitem(spark, directory), "open", "close")


@query
def month_open_close(spark, directory):
    return rounded(period_open_close(_orders(spark, directory)), "open", "close")


@query
def month_open_close_events(spark, directory):
    return rounded(period_open_close(_events(spark, directory)), "open", "close")


@query
def day_open_close_events(spark, directory):
    return rounded(period_open_close(_events(spark, directory), DAY), "open", "close")


@query
def month_open_close_newest(spark, directory):
    """Newest row per time and first/last per month in one aggregation."""
    return rounded(period_open_close(_ticks(spark, directory), tie="seq"), "open", "close")


@query
def previous_close(spark, directory):
    prices = with_previous_close(period_open_close(_orders(spark, directory)))
    return rounded(prices, "open", "close", "prev_close")


@query
def previous_close_carried(spark, directory):
    prices = with_previous_close(period_open_close(_orders(spark, directory)), carry=True)
    return rounded(prices, "open", "close", "prev_close")


# ---- changes -----------------------------------------------------------------------------------


@query
def change_open_basis(spark, directory):
    return rounded(monthly_changes(_orders(spark, directory), "open", as_double=True), "pct")


@query
def change_prev_basis(spark, directory):
    return rounded(monthly_changes(_orders(spark, directory), "prev", as_double=True), "pct")


@query
def change_prev_carry(spark, directory):
    return rounded(monthly_changes(_orders(spark, directory), "prev", carry=True, as_double=True), "pct")


@query
def change_both_bases(spark, directory):
    return rounded(monthly_changes(_orders(spark, directory), as_double=True), "pct")


@query
def change_both_bases_lineitem(spark, directory):
    return rounded(monthly_changes(_lineitem(spark, directory), as_double=True), "pct")


@query
def change_exact_decimal(spark, directory):
    """Exact decimal quotients of order prices."""
    bars = _orders(spark, directory)
    bars = bars.withColumns({c: F.col(c).cast(ORDER_PRICE) for c in ("open", "close")})
    return rounded(monthly_changes(bars), "pct")


@query
def change_zero_reference(spark, directory):
    """Prices cut down to coarse steps, so some are zero: a zero reference gives null, not an error."""
    orders = sample_table(spark, directory, "orders")
    bars = orders_bars(orders.withColumn("o_totalprice", F.floor(F.col("o_totalprice") / 200000) * 200000.0))
    return rounded(monthly_changes(bars, as_double=True), "pct")


@query
def daily_change_events(spark, directory):
    bars = _events(spark, directory)
    return rounded(daily_changes(bars, carry=True, as_double=True), "pct")


# ---- wide tables -------------------------------------------------------------------------------


@query
def month_pivot(spark, directory):
    wide = pivot_months(monthly_changes(_orders(spark, directory), as_double=True))
    return rounded(wide, *MONTH_NAMES, "total")


@query
def month_pivot_zero_missing(spark, directory):
    wide = pivot_months(monthly_changes(_orders(spark, directory), as_double=True), missing="zero")
    return rounded(wide, *MONTH_NAMES, "total")


@query
def yearly_average_row(spark, directory):
    wide = pivot_months(monthly_changes(_orders(spark, directory), as_double=True))
    return rounded(average_row(wide, MONTH_NAMES), *MONTH_NAMES, "total")


@query
def monthly_overview_orders(spark, directory):
    """The flagship: year by month table with average row, both bases, all markets."""
    return month_table(monthly_overview(_orders(spark, directory), as_double=True))


@query
def monthly_overview_lineitem(spark, directory):
    return month_table(monthly_overview(_lineitem(spark, directory), as_double=True))


@query
def monthly_overview_events(spark, directory):
    return month_table(monthly_overview(_events(spark, directory), as_double=True))


@query
def monthly_overview_carry(spark, directory):
    return month_table(monthly_overview(_orders(spark, directory), carry=True, as_double=True))


@query
def monthly_overview_zero_missing(spark, directory):
    return month_table(monthly_overview(_orders(spark, directory), missing="zero", as_double=True))


@query
def monthly_overview_decimal(spark, directory):
    bars = _orders(spark, directory)
    bars = bars.withColumns({c: F.col(c).cast(ORDER_PRICE) for c in ("open", "close")})
    return month_table(monthly_overview(bars))


@query
def monthly_overview_one_market(spark, directory):
    return month_table(monthly_overview(_orders(spark, directory), "open", as_double=True, market="1-URGENT"))


@query
def overview_yearly_rows(spark, directory):
    return month_table(yearly_rows(monthly_overview(_orders(spark, directory), as_double=True)))


@query
def overview_total_rows(spark, directory):
    return month_table(total_rows(monthly_overview(_orders(spark, directory), as_double=True)))


@query
def weekday_overview_orders(spark, directory):
    return weekday_table(weekday_overview(_orders(spark, directory), as_double=True))


@query
def weekday_overview_mean(spark, directory):
    """A cell is the mean change of such days, with the close carried over the turn of the year."""
    bars = _orders(spark, directory)
    return weekday_table(weekday_overview(bars, carry=True, as_double=True, cell="avg"))


@query
def weekday_overview_events(spark, directory):
    bars = _events(spark, directory)
    return weekday_table(weekday_overview(bars, as_double=True))


# ---- newest row wins, upsert, slices -----------------------------------------------------------


def _old_and_new(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Finished orders as stored bars, the others as a delivery that partly replaces them."""
    orders = sample_table(spark, directory, "orders")
    old = orders_bars(orders.where(F.col("o_orderstatus") == "F"))
    new = orders_bars(orders.where(F.col("o_orderstatus") != "F"))
    return old, new


@query
def bars_latest_wins(spark, directory):
    newest = latest_wins(_ticks(spark, directory), ["market", "time"], ["seq"])
    return rounded(newest, "open", "close")


@query
def bars_upsert(spark, directory):
    return rounded(upsert(*_old_and_new(spark, directory), ["market", "time"]), "open", "close")


@query
def bars_not_replaced(spark, directory):
    return rounded(except_keys(*_old_and_new(spark, directory), ["market", "time"]), "open", "close")


@query
def bars_sent_again(spark, directory):
    return rounded(only_keys(*_old_and_new(spark, directory), ["market", "time"]), "open", "close")


@query
def changed_years(spark, directory):
    """Slices with bars later than a watermark per market: the latest finished order."""
    bars = _orders(spark, directory)
    marks = _marks(spark, directory)
    return slices_of(newer_than(bars, marks, "time", "mark", ["market"]).withColumn("year", F.year("time")))


def _marks(spark: SparkSession, directory: str) -> DataFrame:
    orders = sample_table(spark, directory, "orders").where(F.col("o_totalprice") > 490000)
    return orders.groupBy(F.col("o_orderpriority").alias("market")).agg(F.max("o_orderdate").alias("mark"))


@query
def refresh_reach_carried(spark, directory):
    """Years to recompute when the close is carried: the changed ones and the next after each."""
    bars = _orders(spark, directory)
    prices = period_open_close(bars)
    busy = bars.where(F.col("close") > 490000).withColumn("year", F.year("time"))
    return refresh_reach(prices, slices_of(busy), carry=True)


def _refreshed(spark: SparkSession, directory: str, carry: bool) -> DataFrame:
    bars = as_double_prices(_orders(spark, directory))
    # What an earlier run stored: results of the bars before the cut.
    prices = _stored(period_open_close(_before_cut(bars)))
    changes = _stored(changes_of_prices(prices, carry=carry))
    table = _stored(overview_of_changes(changes))

    dated = bars.withColumn("year", F.year("time"))
    changed = _stored(slices_of(_from_cut(dated)))
    prices = _stored(refreshed_prices(prices, only_keys(dated, changed, schemas.SLICE_KEY), changed))
    reach = refresh_reach(prices, changed, carry)
    changes = refreshed_changes(changes, prices, reach, reach, schemas.SLICE_KEY, carry)
    fresh = only_keys(changes, reach, schemas.SLICE_KEY)
    return refreshed_overview(table, fresh, reach, schemas.SLICE_KEY, "null")


def _stored(df: DataFrame) -> DataFrame:
    return sink.working_copy(df, scratch_path(df.sparkSession, "stored"))


@query
def refresh_changed_years(spark, directory):
    """Results of the bars before a day, then only the years touched by later bars computed anew."""
    return month_table(_refreshed(spark, directory, carry=False))


@query
def refresh_changed_years_carried(spark, directory):
    return month_table(_refreshed(spark, directory, carry=True))


# ---- text in, typed rows out -------------------------------------------------------------------


def _raw_ticks(spark: SparkSession, directory: str) -> DataFrame:
    """Every order as a text row, decimal comma and all."""
    ticks = _ticks(spark, directory)
    text = exports.as_bar_text(ticks, ORDER_PRICE).withColumn("load_time", F.lit("2002-01-01").cast("timestamp"))
    return text.withColumn("market", F.lit(MARKET))


def _raw_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Line items as text rows: quantity as open price, extended price as close price."""
    lines = sample_table(spark, directory, "lineitem")
    return lines.select(
        time_text(F.col("l_shipdate")).alias("time"),
        comma_text(F.col("l_quantity").cast("decimal(12,3)")).alias("open"),
        comma_text(F.col("l_extendedprice").cast("decimal(12,3)")).alias("close"),
        F.col("l_returnflag").alias("market"),
        F.lit("2002-01-01").cast("timestamp").alias("load_time"),
    )


@query
def clean_decimal_comma(spark, directory):
    """Comma numbers to decimals."""
    rows = clean_bars(_raw_lines(spark, directory), ORDER_PRICE).select("market", "time", "open", "close")
    return rounded(rows, "open", "close")


@query
def rejected_prices(spark, directory):
    rows = rejected_bars(parse_bars(_raw_lines(spark, directory)))
    return rows.groupBy("market", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def clean_wide_prices(spark, directory):
    rows = valid_bars(parse_bars(_raw_ticks(spark, directory), ORDER_PRICE))
    return rounded(rows.select("market", "time", "open", "close"), "open", "close")


@query
def event_log_as_bars(spark, directory):
    """JSON text in the place of a price is rejected row by row."""
    events = sample_table(spark, directory, "events")
    raw = events.select(
        F.col("ts").cast("string").alias("time"),
        comma_text(F.col("value").cast("decimal(12,2)")).alias("open"),
        F.when(F.col("event_type") == "error", F.col("props"))
        .otherwise(comma_text(F.col("value").cast("decimal(12,2)")))
        .alias("close"),
        F.col("event_type").alias("market"),
        F.lit("2024-02-01").cast("timestamp").alias("load_time"),
    )
    return parse_bars(raw).groupBy("market", "reject_reason").agg(
        F.count(F.lit(1)).alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )


@query
def event_times(spark, directory):
    """Time functions: first 19 characters, whole seconds, year, month, weekday, text."""
    events = sample_table(spark, directory, "events")
    second = bar_time(F.col("ts").cast("string"))
    return events.select(
        "event_id",
        second.alias("parsed"),
        whole_second(F.col("ts")).alias("truncated"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.year("ts").cast("string").alias("year_text"),
        weekday_number(F.col("ts")).alias("weekday"),
        time_text(F.col("ts")).alias("text"),
        (F.col("ts") > never()).alias("ever"),
    )


@query
def previous_event_value(spark, directory):
    """All events as one series, each with the value of the event before it; windows hold an hour."""
    events = sample_table(spark, directory, "events").withColumn("series", F.lit("all"))
    rows = with_previous_value(events, "series", ["ts", "event_id"], "value", F.date_trunc("hour", "ts"), "previous")
    return rounded(rows.select("event_id", "value", "previous"), "value", "previous")


@query
def previous_bar_close(spark, directory):
    """Event bars by type, each measured from the close before it over the turn of days."""
    bars = with_previous_bar_close(_events(spark, directory).select("market", "time", "open", "close"))
    return rounded(bars, "open", "close", "prev_close")


@query
def label_flags(spark, directory):
    """Text to boolean, with null for what is neither."""
    labels = sample_table(spark, directory, "labels")
    docs = sample_table(spark, directory, "documents")
    quality = F.when(F.col("quality") == 1, "true").otherwise("false")
    rows = docs.join(labels, "doc_id", "left").select("doc_id", quality.alias("t"), "lang")
    return rows.select("doc_id", flag(F.col("t")).alias("is_good"), flag(F.col("lang")).alias("no_flag"))


@query
def page_names(spark, directory):
    """Last part of a path."""
    return sample_table(spark, directory, "pages").select("page_id", base_name(F.col("url")).alias("name"))


@query
def bar_lines(spark, directory):
    """Rows joined with semicolons."""
    text = exports.as_bar_text(_orders(spark, directory), ORDER_PRICE)
    return exports.joined_text(text)


@query
def bar_fields(spark, directory):
    """Lines split at semicolons again."""
    fields = F.split("value", ";")
    return bar_lines(spark, directory).select(
        fields[0].alias("time"), fields[4].alias("close"), F.size(fields).alias("n_fields")
    )


# ---- files and tables --------------------------------------------------------------------------


def _bar_files(spark: SparkSession, bars: DataFrame, mode: str = "overwrite", path: str | None = None) -> str:
    """Bars written as semicolon files with decimal commas; gives the directory."""
    path = path or scratch_path(spark, "bars")
    text = exports.as_bar_text(bars, ORDER_PRICE)
    text.write.mode(mode).option("sep", ";").option("header", True).csv(path)
    return path


@query
def bar_files_round_trip(spark, directory):
    """Bars to delimited text files and back to typed rows."""
    path = _bar_files(spark, _one_market(spark, directory))
    raw = tag_load(read_bars(spark, path), MARKET, "load", _TIME)
    rows = clean_bars(raw, ORDER_PRICE).select("market", "time", "open", "close")
    return rounded(rows, "open", "close")


@query
def bar_files_per_market(spark, directory):
    """One folder of files per market, read back as a table."""
    path = scratch_path(spark, "by-market")
    exports.export_by_key(_orders(spark, directory), path, ["market"])
    schema = "time timestamp, open double, close double, market string"
    rows = spark.read.schema(schema).option("sep", ";").option("header", True).csv(path)
    return rounded(rows, "open", "close")


@query
def files_not_loaded(spark, directory):
    """Documents as files: content not among the labelled ones, each content once."""
    docs = sample_table(spark, directory, "documents").select(
        F.format_string("doc-%08d", "doc_id").alias("file"), F.sha2("text", 256).alias("checksum"), "doc_id"
    )
    seen = docs.join(sample_table(spark, directory, "labels"), "doc_id", "left_semi").select("checksum")
    return audit.unseen_files(docs.drop("doc_id"), seen)


@query
def files_of_equal_content(spark, directory):
    """Bars of each month as two files, one without low prices: equal checksums where there were none."""
    bars = _one_market(spark, directory).withColumn("period", F.year("time") * 100 + F.month("time"))
    manifests = []
    for rows in (bars, bars.where(F.col("close") >= 3000)):
        path = scratch_path(spark, "months")
        one_file = rows.repartition("period").sortWithinPartitions("period", "time")
        exports.export_by_key(one_file.select("time", "open", "close", "period"), path, ["period"])
        period = F.regexp_extract("uri", "period=([0-9]+)", 1).cast("int").alias("period")
        manifests.append(file_manifest(spark, f"{path}/*").select(period, "checksum"))
    both = manifests[0].join(manifests[1].withColumnRenamed("checksum", "other"), "period", "left")
    return both.select("period", F.coalesce(F.col("checksum") == F.col("other"), F.lit(False)).alias("same"))


@query
def quoted_fields(spark, directory):
    """Event properties, with quotes and separators in them, as a field of a bar file."""
    events = sample_table(spark, directory, "events")
    path = scratch_path(spark, "quoted")
    rows = events.select(
        F.col("event_id").cast("string").alias("time"), F.concat(F.lit("a;"), "props").alias("open"),
        *(F.lit("1").alias(c) for c in ("high", "low", "close", "volume")),
    )
    exports.export_csv(rows, path)
    return read_bars(spark, path).select(F.col("time").alias("event_id"), F.col("open").alias("props"), "bad_line")


@query
def fields_with_line_breaks(spark, directory):
    """Event properties, a line for each, as a field of a bar file that is read by records."""
    events = sample_table(spark, directory, "events")
    path = scratch_path(spark, "broken")
    props = F.concat(F.lit("a;\n"), F.replace(F.col("props"), F.lit(":"), F.lit(":\n")), F.lit("\nz"))
    rows = events.select(
        F.col("event_id").cast("string").alias("time"), props.alias("open"), *(F.lit("1").alias(c) for c in ("high", "low", "close")),
        F.col("event_type").alias("volume"),
    )
    exports.export_csv(rows, path)
    found = read_files(file_manifest(spark, path))
    return found.select(F.col("time").alias("event_id"), F.col("open").alias("props"), F.col("volume").alias("event_type"), "bad_line")


@query
def contents_by_identity(spark, directory):
    """Bars of each month as files of either line end: one content by lines, two by bytes."""
    bars = _one_market(spark, directory).withColumn("period", F.year("time") * 100 + F.month("time"))
    found = []
    for end in ("\n", "\r\n"):
        path = scratch_path(spark, "months")
        one_file = bars.repartition("period").sortWithinPartitions("period", "time")
        text = one_file.select(F.concat_ws(";", time_text(F.col("time")), "open", "close").alias("value"), "period")
        text.write.partitionBy("period").option("lineSep", end).text(path)
        period = F.regexp_extract("uri", "period=([0-9]+)", 1).cast("int").alias("period")
        for identity in (LINES, BYTES):
            manifest = file_manifest(spark, f"{path}/*", identity=identity)
            found.append(manifest.select(period, "checksum", F.lit(identity).alias("identity")))
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy("period", "identity").agg(F.count_distinct("checksum").alias("contents"))


@query
def short_and_long_rows(spark, directory):
    """Line items as rows of five, six and seven fields."""
    number = F.col("l_linenumber") % 3
    items = sample_table(spark, directory, "lineitem").select(
        time_text(F.col("l_shipdate")).alias("time"), comma_text(F.col("l_quantity").cast("decimal(12,3)")).alias("price"),
        F.when(number == 0, 3).when(number == 1, 4).otherwise(5).alias("more"),
    )
    text = F.concat_ws(";", "time", "price", F.array_join(F.array_repeat("price", F.col("more")), ";"))
    # A file written under this header begins with it, and its lines need no quotes.
    path = scratch_path(spark, "lines")
    named = items.select(text.alias(";".join(schemas.RAW_COLUMNS)))
    named.write.option("sep", "|").option("header", True).option("quote", "").csv(path)
    parsed = parse_bars(tag_load(read_bars(spark, path), MARKET, "load", _TIME), ORDER_PRICE)
    return parsed.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def bars_exported(spark, directory):
    """Bars as one text export, read back."""
    path = scratch_path(spark, "export")
    exports.export_csv(_orders(spark, directory).select("market", "time", "open", "close"), path)
    schema = "market string, time timestamp, open double, close double"
    return rounded(spark.read.schema(schema).option("sep", ";").option("header", True).csv(path), "open", "close")


@query
def tables_of_markets(spark, directory):
    """A database with a table for each market, as the catalog lists it, with the rows of each."""
    orders = _orders(spark, directory)
    name = f"barloom_{uuid.uuid4().hex}"
    root = scratch_path(spark, name)
    spark.sql(f"CREATE DATABASE {name} LOCATION {sink.text_literal(root)}")
    markets = [r["market"] for r in orders.select("market").distinct().collect()]
    for market in markets:
        table = f"{name}.m{market[0]}"
        rows = orders.where(F.col("market") == market).select("time", "close")
        sink.create_table(spark, table, rows.schema, f"{root}/m{market[0]}/v-0")
        sink.append(rows, table)
    found = [(t, read_table(spark, f"{name}.{t}").count()) for t in sink.tables(spark, name)]
    assert name in sink.databases(spark)
    return literal_rows(spark, found, schemas.struct(table="string", rows="bigint"))


@query
def markets_with_high_prices(spark, directory):
    """Whether a market has any price above a mark."""
    return any_per_key(_orders(spark, directory), ["market"], F.col("close") > 499950, "any_high")


@query
def overview_first_rows(spark, directory):
    """The first ten rows as the table is shown."""
    shown = display_order(monthly_overview(_orders(spark, directory), as_double=True))
    return month_table(shown.limit(10))


@query
def refused_modes(spark, directory):
    """Market names in the place of a run mode are refused."""
    names = [r["market"] for r in _orders(spark, directory).select("market").distinct().collect()]

    def refused(value: str) -> bool:
        try:
            check_mode(value)
        except ValueError:
            return True
        return False

    rows = [(n, refused(n)) for n in [*names, "full", "incremental"]]
    return spark.createDataFrame(rows, "value string, refused boolean")


def _warehouse(spark: SparkSession, **options) -> Warehouse:
    name = f"barloom_{uuid.uuid4().hex}"
    return init_tables(spark, name, scratch_path(spark, name), ORDER_PRICE, **options)


def _price_table(spark: SparkSession, by: list[str] | None) -> str:
    """An empty table of bars, partitioned or not."""
    name = f"barloom_{uuid.uuid4().hex}"
    root = scratch_path(spark, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {sink.text_literal(root)}")
    columns = {"time": "timestamp", "open": "double", "close": "double", "market": "string"}
    schema = schemas.struct(**columns, **({"year": "int"} if by else {}))
    sink.create_table(spark, f"{name}.bars", schema, f"{root}/bars/v-0", by)
    return f"{name}.bars"


@query
def table_append(spark, directory):
    old, new = _old_and_new(spark, directory)
    table = _price_table(spark, None)
    sink.append(old, table)
    sink.append(new, table)
    return rounded(spark.table(table), "open", "close")


@query
def table_replace_all(spark, directory):
    old, new = _old_and_new(spark, directory)
    table = _price_table(spark, None)
    sink.append(old, table)
    sink.replace_all(new, table)
    return rounded(spark.table(table), "open", "close")


@query
def table_swap_upsert(spark, directory):
    """A table overwritten by rows computed from itself."""
    old, new = _old_and_new(spark, directory)
    table = _price_table(spark, None)
    sink.append(old, table)
    sink.swap_write(upsert(spark.table(table), new, ["market", "time"]), table)
    sink.compact(spark, table)
    return rounded(spark.table(table), "open", "close")


@query
def table_replace_slices(spark, directory):
    """Only the (market, year) partitions that get new bars are written."""
    bars = _orders(spark, directory).withColumn("year", F.year("time"))
    table = _price_table(spark, ["market", "year"])
    sink.overwrite_slices(_before_cut(bars), table, schemas.SLICE_KEY)
    late = _from_cut(bars)
    kept = only_keys(spark.table(table), slices_of(late), schemas.SLICE_KEY)
    sink.overwrite_slices(upsert(kept, late.select(*kept.columns), ["market", "time"]), table, schemas.SLICE_KEY)
    return rounded(spark.table(table), "open", "close")


@query
def table_delete_years(spark, directory):
    bars = _orders(spark, directory).withColumn("year", F.year("time"))
    table = _price_table(spark, ["market", "year"])
    sink.overwrite_slices(bars, table, schemas.SLICE_KEY)
    sink.delete_where(spark, table, "5-LOW", [1996, 1997])
    sink.delete_where(spark, table, "4-NOT SPECIFIED")
    return rounded(spark.table(table), "open", "close")


@query
def table_missing_is_empty(spark, directory):
    """A first load merges into a table that does not exist yet."""
    bars = _orders(spark, directory)
    old = table_or_empty(spark, f"default.barloom_{uuid.uuid4().hex}", bars.schema)
    return rounded(upsert(old, bars, ["market", "time"]), "open", "close")


# ---- audit -------------------------------------------------------------------------------------


def _audit_events(spark: SparkSession, directory: str) -> DataFrame:
    """Every order as a load of its line items: F finished, P failed a day later, O still open."""
    orders = sample_table(spark, directory, "orders")
    status = F.when(F.col("o_orderstatus") == "F", audit.OK).otherwise(audit.FAILED)
    start = F.struct(F.lit("start").alias("event"), F.col("o_orderdate").alias("event_time"),
                     F.lit(None).cast("string").alias("status"))
    finish = F.struct(F.lit("finish").alias("event"),
                      (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("event_time"),
                      status.alias("status"))
    events = F.when(F.col("o_orderstatus") == "O", F.array(start)).otherwise(F.array(start, finish))
    return orders.select(
        F.lit(audit.LANDING).alias("layer"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("market"),
        F.lit("lines").alias("task"),
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("file"),
        F.sha2(F.col("o_custkey").cast("string"), 256).alias("checksum"),
        F.lit(0).cast("bigint").alias("file_size"),
        F.col("o_orderdate").alias("file_time"),
        F.lit(1).cast("bigint").alias("rows"),
        F.concat(F.lit("file:/orders/"), F.col("o_orderkey").cast("string")).alias("uri"),
        F.lit(None).cast("string").alias("source_id"),
        F.inline(events),
    ).select(*schemas.AUDIT.fieldNames())


def _with_reset(spark: SparkSession, directory: str) -> DataFrame:
    """The same log with a full load of each market that resets the runs begun up to the cut day."""
    events = _audit_events(spark, directory)
    empty = {f.name: F.lit(None).cast(f.dataType) for f in schemas.AUDIT}
    earlier = events.where((F.col("event") == "start") & (F.col("event_time") <= F.lit(CUT).cast("timestamp")))
    named = earlier.select("market", F.col("run_id").alias("source_id"))
    resets = named.withColumns(
        {**{k: v for k, v in empty.items() if k not in named.columns}, "layer": F.lit(audit.LANDING),
         "event": F.lit("reset"), "run_id": F.lit("none"), "event_time": F.lit(CUT).cast("timestamp")}
    )
    return events.unionByName(resets)


def _run_counts(events: DataFrame) -> DataFrame:
    runs = audit.runs_of_events(events)
    return runs.groupBy("market", "status", "is_stored").agg(
        F.count(F.lit(1)).alias("n"), F.count("finish_time").alias("n_closed"), F.max("start_time").alias("last_start")
    )


@query
def audit_runs_folded(spark, directory):
    """Start and finish events folded to runs."""
    return _run_counts(_audit_events(spark, directory))


@query
def audit_runs_after_reset(spark, directory):
    return _run_counts(_with_reset(spark, directory))


def _logged(spark: SparkSession, events: DataFrame) -> Warehouse:
    """A warehouse with these events in its audit log."""
    wh = _warehouse(spark)
    audit.record(wh, events)
    return wh


@query
def rows_of_successful_loads(spark, directory):
    """Line items of finished loads, counted per load and return flag."""
    wh = _logged(spark, _audit_events(spark, directory))
    lines = sample_table(spark, directory, "lineitem").withColumn("load_id", F.col("l_orderkey").cast("string"))
    kept = only_keys(lines, audit.successful_loads(wh, audit.LANDING), ["load_id"])
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_linenumber").cast("bigint")).alias("line_sum")
    )


@query
def load_counts(spark, directory):
    """Rows read and rejected, counted while they pass by."""
    rejected = F.count_if(F.col("reject_reason").isNotNull())
    rows, seen = sink.counted(parse_bars(_raw_lines(spark, directory)), rows=F.count(F.lit(1)), rejected=rejected)
    rows.write.format("noop").mode("overwrite").save()
    counts = seen.get
    return literal_rows(spark, [(counts["rows"], counts["rejected"])], schemas.struct(rows="bigint", rejected="bigint"))


@query
def last_refresh_per_market(spark, directory):
    return audit.last_start(_logged(spark, _with_reset(spark, directory)), audit.LANDING)


@query
def latest_audit_row(spark, directory):
    """Newest finished run per content; the run id breaks ties."""
    wh = _logged(spark, _audit_events(spark, directory))
    newest = audit.latest_run_per_checksum(audit.stored_runs(wh, audit.LANDING))
    return newest.select("checksum", "run_id", "file", "start_time", "finish_time")


@query
def loads_since_refresh(spark, directory):
    """Loads that no run of the next layer has taken up; one run of each market took those up to its mark."""
    events = _audit_events(spark, directory)
    marks = _marks(spark, directory).select("market", "mark")
    empty = {f.name: F.lit(None).cast(f.dataType) for f in schemas.AUDIT}

    def next_layer(rows: DataFrame, event: str, **more) -> DataFrame:
        fixed = {"layer": F.lit(audit.STAGING), "event": F.lit(event), "run_id": F.lit("next"),
                 "event_time": F.lit(CUT).cast("timestamp"), **more}
        out = rows.withColumns({**{k: v for k, v in empty.items() if k not in rows.columns}, **fixed})
        return out.select(*schemas.AUDIT.fieldNames())

    loads = events.where(F.col("event") == "start").join(marks, "market").where(F.col("event_time") <= F.col("mark"))
    took = next_layer(loads.select("market", F.col("run_id").alias("source_id")), "took")
    markets = marks.select("market")
    log = events.unionByName(took).unionByName(next_layer(markets, "start"))
    wh = _logged(spark, log.unionByName(next_layer(markets, "finish", status=F.lit(audit.OK))))
    fresh = audit.new_loads(wh, audit.LANDING, audit.STAGING)
    return fresh.select("market", F.col("load_id").alias("run_id"), "finish_time")


# ---- whole runs --------------------------------------------------------------------------------


@query
def load_and_refresh(spark, directory):
    """Files to landing to staging to overview, in one full run."""
    wh = _warehouse(spark)
    path = _bar_files(spark, _one_market(spark, directory))
    return month_table(run(wh, path, MARKET, "full", run_ts=_TIME))


@query
def load_and_refresh_incremental(spark, directory):
    """A full run, more files, then an incremental run that reads only those."""
    wh = _warehouse(spark)
    bars = _one_market(spark, directory)
    path = _bar_files(spark, _before_cut(bars))
    run(wh, path, MARKET, "full", run_ts=_TIME)
    _bar_files(spark, _from_cut(bars), "append", path)
    return month_table(run(wh, path, MARKET, "incremental", run_ts=_LATER))


@query
def load_staging_incremental_carry(spark, directory):
    """Straight to staging, with the close carried over the turn of the year."""
    wh = _warehouse(spark, carry=True)
    bars = _one_market(spark, directory)
    path = _bar_files(spark, _from_cut(bars))
    run(wh, path, MARKET, "full", through_landing=False, run_ts=_TIME)
    _bar_files(spark, _before_cut(bars), "append", path)
    return month_table(run(wh, path, MARKET, "incremental", through_landing=False, run_ts=_LATER))


@query
def staged_bars_upserted(spark, directory):
    """A second delivery replaces bars of equal time in staging."""
    wh = _warehouse(spark)
    orders = sample_table(spark, directory, "orders").withColumn("o_orderpriority", F.lit(MARKET))
    old = orders_bars(orders.where(F.col("o_orderstatus") == "F"))
    new = orders_bars(orders.where(F.col("o_orderstatus") != "F"))
    load_staging(wh, _bar_files(spark, old), MARKET, "full", _TIME)
    load_staging(wh, _bar_files(spark, new), MARKET, "incremental", _LATER)
    return rounded(wh.table("staging").select("market", "time", "open", "close", "year"), "open", "close")


@query
def landed_rejects(spark, directory):
    """Prices too large for the staging type stay in landing and are told apart."""
    wh = init_tables(spark, f"barloom_{uuid.uuid4().hex}", scratch_path(spark, "wh"), "decimal(8,3)")
    path = _bar_files(spark, _one_market(spark, directory))
    load_landing(wh, path, MARKET, "full", _TIME)
    clean_to_staging(wh, "full", MARKET, _TIME)
    rejects = landing_rejects(wh).groupBy("market", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
    staged = wh.table("staging").groupBy("market").agg(F.count(F.lit(1)).alias("n"))
    return rejects.unionByName(staged.withColumn("reject_reason", F.lit("none")))


@query
def stream_then_refresh(spark, directory):
    """Files picked up as a stream in two calls, then one refresh."""
    wh = _warehouse(spark)
    bars = _one_market(spark, directory)
    checkpoint = scratch_path(spark, "stream")
    path = _bar_files(spark, _before_cut(bars))
    ingest_stream(wh, path, MARKET, checkpoint)
    _bar_files(spark, _from_cut(bars), "append", path)
    ingest_stream(wh, path, MARKET, checkpoint)
    refresh(wh, "incremental")
    return month_table(overview(wh, MARKET))


@query
def load_row_counts(spark, directory):
    """Row counts the audit log keeps per load, against the rows delivered."""
    wh = _warehouse(spark)
    bars = _one_market(spark, directory)
    path = _bar_files(spark, _before_cut(bars))
    load_landing(wh, path, MARKET, "full", _TIME)
    _bar_files(spark, _from_cut(bars), "append", path)
    load_landing(wh, path, MARKET, "incremental", _LATER)
    runs = audit.stored_runs(wh, audit.LANDING, MARKET)
    return runs.groupBy("market", "start_time").agg(F.sum("rows").alias("rows"))


@query
def lineitem_files_to_staging(spark, directory):
    """All line items as one file for each market, in order, to staging: of equal times the last line wins."""
    wh = _warehouse(spark)
    lines = sample_table(spark, directory, "lineitem")
    price = F.col("l_extendedprice")
    bars = lines.select(
        F.col("l_shipdate").alias("time"), price.alias("open"), price.alias("close"),
        F.col("l_returnflag").alias("market"), "l_orderkey", "l_linenumber",
    )
    for market in [r["market"] for r in bars.select("market").distinct().collect()]:
        path = scratch_path(spark, "bars")
        own = bars.where(F.col("market") == market)
        exports.export_in_order(own, path, ["l_orderkey", "l_linenumber"], lambda rows: exports.as_bar_text(rows, ORDER_PRICE))
        load_staging(wh, path, market, "full")
    return rounded(wh.table("staging").select("market", "time", "open", "close"), "open", "close")


@query
def equal_looking_files(spark, directory):
    """Files of one name and time in two folders, for two markets; and one folder's for a third market."""
    wh = _warehouse(spark)
    bars = _one_market(spark, directory)
    first = _bar_files(spark, bars.coalesce(1))
    second = _bar_files(spark, bars.withColumns({c: F.col(c) + 1 for c in ("open", "close")}).coalesce(1))
    for market, path in (("A", first), ("B", second), ("C", first)):
        load_staging(wh, path, market, "incremental", _TIME)
    return rounded(wh.table("staging").select("market", "time", "open", "close"), "open", "close")


@query
def markets_refreshed_at_once(spark, directory):
    """Every market loaded and refreshed by a thread of its own."""
    wh = _warehouse(spark)
    bars = _orders(spark, directory)
    markets = [r["market"] for r in bars.select("market").distinct().collect()]

    def whole(market: str) -> bool:
        path = _bar_files(spark, bars.where(F.col("market") == market))
        load_staging(wh, path, market, "incremental")
        return refresh(wh, "incremental", market)

    with ThreadPoolExecutor(len(markets)) as pool:
        list(pool.map(whole, markets))
    return month_table(overview(wh))


@query
def cleaned_while_loaded(spark, directory):
    """A clean of all landed markets, while each market also gets a load of its own straight to staging."""
    wh = _warehouse(spark)
    bars = _orders(spark, directory)
    markets = [r["market"] for r in bars.select("market").distinct().collect()]
    for market in markets:
        load_landing(wh, _bar_files(spark, _before_cut(bars.where(F.col("market") == market))), market, "incremental")

    def direct(market: str) -> None:
        load_staging(wh, _bar_files(spark, _from_cut(bars.where(F.col("market") == market))), market, "incremental")

    with ThreadPoolExecutor(len(markets) + 1) as pool:
        cleaned = pool.submit(clean_to_staging, wh, "incremental")
        list(pool.map(direct, markets))
        cleaned.result()
    refresh(wh, "incremental")
    return month_table(overview(wh))


@query
def late_bars_into_many_files(spark, directory):
    """Corrections of some days meet a few of the many files a market is staged in; the others stay."""
    wh = _warehouse(spark)
    bars = _one_market(spark, directory)
    load_staging(wh, _bar_files(spark, bars), MARKET, "full", _TIME)
    late = bars.where((F.year("time") == 1997) & (F.dayofmonth("time") == 1))
    load_staging(wh, _bar_files(spark, late.withColumn("close", F.col("close") + 1)), MARKET, "incremental", _LATER)
    return rounded(wh.table("staging").select("market", "time", "open", "close"), "open", "close")


@query
def log_folded_between_loads(spark, directory):
    """Loads of a log that was folded before the resets came."""
    events = _with_reset(spark, directory)
    wh = _logged(spark, events.where(F.col("event") != "reset"))
    audit.fold_log(wh)
    audit.record(wh, events.where(F.col("event") == "reset"))
    runs = audit.audit_runs(wh, audit.LANDING)
    return runs.groupBy("market", "status", "is_stored").agg(
        F.count(F.lit(1)).alias("n"), F.count("finish_time").alias("n_closed"), F.max("start_time").alias("last_start")
    )


@query
def run_times_out_of_order(spark, directory):
    """A landing run whose time lies before the last staging run is taken up all the same."""
    wh = _warehouse(spark)
    bars = _one_market(spark, directory)
    path = _bar_files(spark, _before_cut(bars))
    run(wh, path, MARKET, "incremental", run_ts=_LATER)
    _bar_files(spark, _from_cut(bars), "append", path)
    return month_table(run(wh, path, MARKET, "incremental", run_ts=_TIME))


@query
def full_clean_of_one_route(spark, directory):
    """A market that came straight to staging outlives a full clean of the landed ones."""
    wh = _warehouse(spark)
    bars = _one_market(spark, directory)
    path = _bar_files(spark, bars)
    load_landing(wh, path, "A", "full", _TIME)
    load_staging(wh, path, "B", "full", _TIME)
    for _ in range(2):
        clean_to_staging(wh, "full", run_ts=_LATER)
    return rounded(wh.table("staging").select("market", "time", "open", "close"), "open", "close")
