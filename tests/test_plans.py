"""What the physical plans look like: few shuffles, one scan, pruned reads, no Python."""

import os

import pytest

from barloom.catalog.queries import QUERIES
from barloom.operators.changes import monthly_changes
from barloom.operators.merge import latest_wins
from barloom.operators.periods import period_open_close
from barloom.operators.pivots import monthly_overview
from barloom.plans import staging
from barloom.plans.load import landing_rows
from barloom.plans.refresh import staged_bars
from barloom.plans.staging import merge_into_staging
from barloom.schemas import slices_schema
from barloom.session import scratch_path
from barloom.sinks.tables import working_copy
from barloom.sources.clean import clean_bars, tag_load
from barloom.sources.files import read_bars
from conftest import ts

DIRECTORY = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no sample tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan_of(df).count("Exchange hashpartitioning")


@pytest.fixture
def staged(spark, warehouse):
    """Two markets over three years in a staging table."""
    wh = warehouse()
    bars = spark.sql(
        "SELECT timestamp_seconds(1577836800 + id * 86400) AS time, id % 7 + 1 AS open, id % 5 + 1 AS close, "
        "'r' AS landed_by, 'l' AS load_id, timestamp_seconds(0) AS load_time, "
        "CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B' END AS market FROM range(1000)"
    ).selectExpr("*", "year(time) AS year")
    merge = merge_into_staging(wh, bars, "l")
    state = wh.log.state()
    wh.log.commit(merge(state), state)
    return wh


def test_period_prices_shuffle_once_after_a_partial_hash_aggregate(staged):
    df = period_open_close(staged.table("staging"))
    plan = plan_of(df)
    assert shuffles(df) == 1 and "partial_min_by" in plan and "partial_max_by" in plan
    assert "SortAggregate" not in plan and "Join" not in plan and "Window" not in plan


def test_overview_scans_the_bars_once(staged):
    df = monthly_overview(staged.table("staging"))
    assert plan_of(df).count("FileScan") == 1
    # Bars to months, months to years, years to average rows: only the first moves more than a few rows.
    assert shuffles(df) == 3


def test_pivot_reuses_the_partitioning_of_the_window(staged):
    assert shuffles(monthly_changes(staged.table("staging"))) == 2


def test_only_used_columns_and_partitions_are_read(staged):
    plan = staged.table("staging").where("market = 'A' AND year = 2021")
    plan = plan_of(period_open_close(plan))
    assert "ReadSchema: struct<time:timestamp,open:decimal(7,3),close:decimal(7,3)>" in plan
    assert "market#" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("market", [None, "A"])
def test_slices_of_a_batch_list_only_their_files(spark, staged, market):
    touched = working_copy(
        spark.createDataFrame([("l", "A", 2021, 5)], slices_schema()), scratch_path(spark, "touched")
    )
    files = staged_bars(staged, market, touched).inputFiles()
    assert files and all("/market=A/year=2021/" in f for f in files)


@pytest.mark.parametrize("market", [None, "A"])
def test_loads_list_only_their_landing_files(spark, staged, market):
    row = "'2020-01-01' AS time, market, load_id, timestamp_seconds(0) AS load_time"
    source = spark.sql("SELECT * FROM VALUES ('A', 'l'), ('A', 'k'), ('B', 'l') AS t(market, load_id)").selectExpr(*row.split(", "))
    nulls = [f.name for f in staged.table("landing").schema if f.name not in source.columns]
    staged.append("landing", source.selectExpr("*", *(f"null AS {n}" for n in nulls)))
    rows = [("A", "l", ts("2030-01-01"))]
    loads = spark.createDataFrame(rows, "market string, load_id string, finish_time timestamp")
    files = landing_rows(staged, loads, market).inputFiles()
    assert files and all("/market=A/load_id=l/" in f for f in files)


def test_a_hot_slice_is_written_by_many_tasks(spark, warehouse, monkeypatch):
    wh = warehouse()
    rows = spark.range(0, 400000, 1, 8).selectExpr(
        "timestamp_seconds(1577836800 + id) AS time", "rand(1) * 1000 AS open", "rand(2) * 1000 AS close",
        "'r' AS landed_by", "'l' AS load_id", "timestamp_seconds(0) AS load_time", "'A' AS market", "2020 AS year",
    )
    monkeypatch.setattr(staging, "ROWS_PER_FILE", 100_000)
    state = wh.log.state()
    wh.log.commit(merge_into_staging(wh, rows, "l")(state), state)
    assert wh.table("staging").count() == 400000
    files = wh.log.state().files("staging")
    assert [f.rows for f in sorted(files, key=lambda f: f.least)] == [100_000] * 4


def test_copies_of_a_key_are_folded_before_the_shuffle(staged):
    plan = plan_of(latest_wins(staged.table("staging"), ["market", "time"], ["load_time"]))
    before, after = plan.split("Exchange hashpartitioning")
    assert "partial_max(" in after and "Window" not in plan


def test_text_is_converted_once(spark, tmp_path, bar_file):
    bar_file(tmp_path / "a.csv", [("2012-01-01 00:00:00", 1, 2)])
    raw = tag_load(read_bars(spark, str(tmp_path)), "M", "run", ts("2030-01-01"))
    plan = plan_of(clean_bars(raw).select("market", "time", "open", "close"))
    assert plan.count("gettimestamp") == 1 and plan.count("try_cast") == 2


@needs_tables
@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("month", "change", "weekday", "bars", "refresh"))])
def test_no_python_and_no_cartesian_product(spark, name):
    plan = plan_of(QUERIES[name](spark, DIRECTORY))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
