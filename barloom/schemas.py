"""Explicit schemas of every table in the library. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The header of a bar file, in file order.
RAW_COLUMNS = ["time", "open", "high", "low", "close", "volume"]

# Name of the column that keeps the text of a row with too few or too many fields.
BAD_LINE = "bad_line"

DEFAULT_PRICE_TYPE = "decimal(7,3)"
# Wide enough for the exact quotient of the default price type (11 digits) and its average (15).
PERCENT_TYPE = "decimal(38,15)"

# The two reference prices a change can be measured from.
BASIS_OPEN = "open"
BASIS_PREV = "prev"

TOTAL = "total"

_SIMPLE_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "binary": T.BinaryType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _type(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = name.removeprefix("decimal(").rstrip(")").split(",")
        return T.DecimalType(int(precision), int(scale))
    return _SIMPLE_TYPES[name]


def struct(**fields: str) -> T.StructType:
    """Column names and type names; needs no running session, unlike parsing of DDL text."""
    return T.StructType([T.StructField(name, _type(kind)) for name, kind in fields.items()])


RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in RAW_COLUMNS] + [T.StructField(BAD_LINE, T.StringType())]
)


def landing_schema() -> T.StructType:
    return struct(
        **{c: "string" for c in [*RAW_COLUMNS, BAD_LINE]},
        source_file="string", file_time="timestamp", block_start="bigint", row_no="bigint",
        load_time="timestamp", market="string", load_id="string",
    )


def staging_schema(price_type: str = DEFAULT_PRICE_TYPE) -> T.StructType:
    return struct(
        time="timestamp", open=price_type, close=price_type, landed_by="string", load_id="string",
        load_time="timestamp", market="string", year="int",
    )


def slices_schema() -> T.StructType:
    return struct(load_id="string", market="string", year="int", rows="bigint")


def prices_schema(price_type: str = DEFAULT_PRICE_TYPE) -> T.StructType:
    return struct(market="string", year="int", month="int", open=price_type, close=price_type)


def changes_schema(percent_type: str = PERCENT_TYPE) -> T.StructType:
    return struct(
        market="string", year="int", month="int", basis="string", pct=percent_type, updated_at="timestamp"
    )


def overview_schema(names: list[str], percent_type: str = PERCENT_TYPE) -> T.StructType:
    return struct(
        market="string", year="string", basis="string",
        **{n: percent_type for n in [*names, TOTAL]}, updated_at="timestamp",
    )


AUDIT = struct(
    layer="string", event="string", run_id="string", event_time="timestamp", market="string", task="string",
    uri="string", file="string", checksum="string", file_size="bigint", file_time="timestamp", rows="bigint",
    status="string", source_id="string",
)

# Runs folded from finished events, and the loads that finished runs took up.
RUNS = struct(
    layer="string", run_id="string", market="string", task="string", uri="string", file="string", checksum="string",
    file_size="bigint", file_time="timestamp", start_time="timestamp", finish_time="timestamp", rows="bigint",
    status="string", is_stored="boolean",
)
TAKEN = struct(layer="string", market="string", run_id="string", load_id="string")

LANDING_KEY = ["market", "time"]
STAGING_KEY = ["market", "time"]
SLICE_KEY = ["market", "year"]
PRICES_KEY = ["market", "year", "month"]
CHANGES_KEY = ["market", "year", "month", "basis"]
OVERVIEW_KEY = ["market", "year", "basis"]
