import pytest
from pyspark.sql import functions as F

from barloom.plans import audit
from barloom.plans.arguments import check_basis, check_mode, check_text, one_basis, one_mode
from conftest import rows_of, ts


def files(spark, *names):
    rows = [("file:/in/" + n, n, "sum-" + n, 10, ts("2020-01-01")) for n in names]
    return spark.createDataFrame(rows, "uri string, file string, checksum string, file_size bigint, file_time timestamp")


def resets(wh, market):
    return audit.resets(wh, audit.LANDING, audit.one_market(wh.spark, market))


def test_start_and_finish_fold_to_runs(spark, warehouse):
    wh = warehouse()
    audit.audit_start(wh, audit.LANDING, "r1", ts("2030-01-01"), "t", files(spark, "a", "b"), "M")
    open_run = audit.audit_runs(wh, audit.LANDING)
    assert rows_of(open_run, "file", "finish_time", "is_stored") == [("a", None, False), ("b", None, False)]
    counts = spark.createDataFrame([("a", 7)], "file string, rows bigint")
    audit.audit_finish(wh, audit.LANDING, "r1", ts("2030-01-02"), audit.OK, counts, ["file"])
    runs = audit.audit_runs(wh, audit.LANDING)
    assert rows_of(runs, "file", "rows", "status", "is_stored") == [("a", 7, "ok", True), ("b", 0, "ok", True)]
    assert rows_of(runs, "start_time", "finish_time")[0] == (ts("2030-01-01"), ts("2030-01-02"))
    assert rows_of(audit.seen_checksums(wh, audit.LANDING), "checksum") == [("sum-a",), ("sum-b",)]
    assert audit.seen_checksums(wh, audit.STAGING).isEmpty()


def test_failed_and_open_runs_do_not_count(spark, warehouse):
    wh = warehouse()
    audit.audit_start(wh, audit.LANDING, "bad", ts("2030-01-01"), "t", files(spark, "a"), "M")
    audit.audit_finish(wh, audit.LANDING, "bad", ts("2030-01-01"), audit.FAILED)
    audit.audit_start(wh, audit.LANDING, "open", ts("2030-01-02"), "t", files(spark, "b"), "M")
    assert audit.successful_loads(wh, audit.LANDING).isEmpty()
    assert audit.seen_checksums(wh, audit.LANDING).isEmpty()
    assert audit.last_refresh(wh, "M") is None


def test_runs_in_one_second_stay_apart(spark, warehouse):
    wh = warehouse()
    for run in ("r1", "r2"):
        audit.audit_start(wh, audit.LANDING, run, ts("2030-01-01"), "t", files(spark, run), "M")
    audit.audit_finish(wh, audit.LANDING, "r2", ts("2030-01-01"))
    assert rows_of(audit.successful_loads(wh, audit.LANDING), "load_id") == [("r2",)]


def test_reset_ends_earlier_runs_of_the_market(spark, warehouse):
    wh = warehouse()
    for run, market, day, reset in [("r1", "A", 1, False), ("r2", "B", 1, False), ("r3", "A", 2, True)]:
        audit.audit_start(wh, audit.LANDING, run, ts(f"2030-01-0{day}"), "t", files(spark, run), market)
        audit.audit_finish(wh, audit.LANDING, run, ts(f"2030-01-0{day}"),
                           reset=resets(wh, market) if reset else None)
    assert rows_of(audit.successful_loads(wh, audit.LANDING), "load_id") == [("r2",), ("r3",)]
    assert rows_of(audit.successful_loads(wh, audit.LANDING, "A"), "load_id") == [("r3",)]


def test_a_failed_full_load_resets_nothing(spark, warehouse):
    wh = warehouse()
    audit.audit_start(wh, audit.LANDING, "r1", ts("2030-01-01"), "t", files(spark, "a"), "M")
    audit.audit_finish(wh, audit.LANDING, "r1", ts("2030-01-01"))
    audit.audit_start(wh, audit.LANDING, "r2", ts("2030-01-02"), "t", files(spark, "b"), "M")
    audit.audit_finish(wh, audit.LANDING, "r2", ts("2030-01-02"), audit.FAILED,
                       reset=resets(wh, "M"))
    assert rows_of(audit.successful_loads(wh, audit.LANDING), "load_id") == [("r1",)]


def test_a_load_running_during_a_refresh_is_new_after_it(spark, warehouse):
    wh = warehouse()
    market = spark.createDataFrame([("M",)], "market string")
    audit.audit_start(wh, audit.STAGING, "slow", ts("2030-01-01"), "t", market)
    audit.audit_start(wh, audit.OVERVIEW, "o", ts("2030-01-02"), "t", market)
    audit.audit_finish(wh, audit.OVERVIEW, "o", ts("2030-01-02"))
    audit.audit_finish(wh, audit.STAGING, "slow", ts("2030-01-03"))
    assert rows_of(audit.new_loads(wh, audit.STAGING, audit.OVERVIEW), "load_id") == [("slow",)]
    assert audit.last_refresh(wh, "M") == ts("2030-01-02")


def test_latest_run_per_checksum(spark, warehouse):
    wh = warehouse()
    for run, day in [("r1", 1), ("r2", 2)]:
        audit.audit_start(wh, audit.LANDING, run, ts(f"2030-01-0{day}"), "t", files(spark, "a"), "M")
    newest = audit.latest_run_per_checksum(audit.audit_runs(wh, audit.LANDING))
    assert rows_of(newest, "checksum", "run_id") == [("sum-a", "r2")]


def test_run_time(spark):
    assert audit.now(spark, ts("2030-01-01")) == ts("2030-01-01")
    assert audit.now(spark) <= audit.now(spark)
    assert spark.range(1).select(F.current_timestamp().alias("t")).first().t is not None


def test_arguments():
    assert one_mode(full=True) == "full" and one_mode(incremental=True) == "incremental"
    assert one_basis(open_close=True) == "open" and one_basis(close_close=True) == "prev"
    assert check_mode("full") == "full" and check_basis("both") == "both" and check_text("market", "M") == "M"
    for bad in [
        lambda: one_mode(), lambda: one_mode(True, True), lambda: one_basis(), lambda: one_basis(True, True),
        lambda: check_mode("partial"), lambda: check_basis("close"), lambda: check_text("market", " "),
        lambda: check_text("task", None),
    ]:
        with pytest.raises(ValueError):
            bad()
