"""Commits: who comes second, what readers see, what is removed; and runs that overlap, in whatever order."""

import os
import time
from contextlib import contextmanager
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators.pivots import monthly_overview
from barloom.plans import audit, staging, warehouse as plan
from barloom.plans.load import clean_to_staging, load_landing, load_staging
from barloom.plans.refresh import overview, refresh
from barloom.plans.warehouse import init_tables
from barloom.sinks import versions
from barloom.sinks.versions import Change, DataFile, Overtaken, VersionLog
from conftest import rows_of, ts


@pytest.fixture
def drivers(spark, tmp_path):
    """Two logs of one root that share nothing but files."""

    def other(log):
        versions._latest.pop(log.root, None)
        return VersionLog(spark, log.root)

    return VersionLog(spark, str(tmp_path / "root")), other


def change(table, *paths, removed=(), read=()):
    out = Change(read={table: set(read)})
    out.put(table, [DataFile(p, tuple(p.split("/")[2:-1]), 1) for p in paths], [DataFile(p, tuple(p.split("/")[2:-1]), 1) for p in removed])
    return out


def test_the_second_commit_takes_the_next_number_or_is_overtaken(drivers):
    log, other = drivers
    seen = log.state()
    log.commit(change("t", "t/w=1/A/f", read={("A",)}), seen)
    second = other(log)
    assert second.commit(change("t", "t/w=2/B/f", read={("B",)}), seen).version == 2
    with pytest.raises(Overtaken):
        log.commit(change("t", "t/w=3/A/f", read={("A",)}), seen)
    with pytest.raises(Overtaken):
        log.commit(change("t", "t/w=3/C/f", read={()}), seen)
    state = log.commit(change("t", "t/w=4/A/f", removed=["t/w=1/A/f"], read={("A",)}), log.state())
    assert sorted(state.tables["t"]) == ["t/w=2/B/f", "t/w=4/A/f"]
    with pytest.raises(Overtaken):  # the file is gone, though no slice was read
        second.commit(change("t", removed=["t/w=1/A/f"]), second.state(2))
    assert other(log).state() == state
    assert sorted(log.state(2).tables["t"]) == ["t/w=1/A/f", "t/w=2/B/f"]
    assert [f.path for f in state.files("t", [("B",)])] == ["t/w=2/B/f"]
    assert len(state.files("t", [()])) == len(state.files("t")) == 2 and state.files("t", []) == []


def test_a_number_is_created_once_and_whole(drivers):
    log, other = drivers
    assert log.files.create("x", "first") and not other(log).files.create("x", "second")
    assert log.files.read("x") == "first" and log.files.names() == ["x"]


def test_whole_lists_are_written_now_and_then_and_old_versions_go(drivers, monkeypatch):
    log, other = drivers
    monkeypatch.setattr(versions, "STATE_EVERY", 3)
    folder = log.files.local.removesuffix("/_versions")
    for i in range(7):
        path = f"t/w={i}/A/f"
        os.makedirs(f"{folder}/t/w={i}/A")
        open(f"{folder}/{path}", "w").close()
        log.commit(change("t", path, removed=[f"t/w={i - 1}/A/f"] if i else []), log.state())
    os.makedirs(f"{folder}/t/w=failed/A")
    assert other(log).state().tables == {"t": {"t/w=6/A/f": DataFile("t/w=6/A/f", ("A",), 1)}}
    assert versions.expire(log, 3600.0) == 0 and os.path.exists(f"{folder}/t/w=0/A/f")
    time.sleep(0.01)
    assert versions.expire(log, 0.0) > 0
    # Versions from the last whole list on are left, with their files.
    assert sorted(os.listdir(f"{folder}/t")) == ["w=5", "w=6"]
    assert other(log).state().version == 7 and log.state(6).version == 6
    with pytest.raises(ValueError):
        log.state(2)


@contextmanager
def during(monkeypatch, function, layer, status=audit.OK):
    """Calls a function once, just before a run of a layer commits its rows."""
    finish = audit.audit_finish
    calls = []

    def first(wh, at, run_id, time, given=audit.OK, *rest, **options):
        if at == layer and given == status and not calls:
            calls.append(run_id)
            function()
        return finish(wh, at, run_id, time, given, *rest, **options)

    with monkeypatch.context() as patched:
        patched.setattr(audit, "audit_finish", first)
        yield
    assert calls


def elsewhere(wh):
    """The same installation as another driver sees it: another session, nothing remembered."""
    versions._latest.pop(wh.log.root, None)
    return init_tables(wh.spark.newSession(), wh.database, wh.root)


def bars_of(wh):
    return rows_of(wh.table("staging"), "market", "time", "close", "load_id")


def held(wh, table):
    return sorted((r.market, int(r.year)) for r in wh.table(table).where(F.col("year").cast("string") != "total").select("market", "year").distinct().collect())


def first_last(spark, wh, market="A"):
    bars = wh.table("staging").select("market", "time", "open", "close")
    columns = [c for c in overview(wh).columns if c != "updated_at"]
    found = [tuple(map(str, r)) for r in overview(wh, market).select(*columns).collect()]
    return sorted(found) == sorted(tuple(map(str, r)) for r in monthly_overview(bars, market=None).where(F.col("market") == market).select(*columns).collect())


ONE, TWO = ("2013-03-01 00:00:00", 1.0, 2.0), ("2013-05-01 00:00:00", 3.0, 4.0)


def test_a_clean_of_all_markets_keeps_a_load_that_ends_meanwhile(warehouse, tmp_path, bar_file, monkeypatch):
    wh = warehouse()
    bar_file(tmp_path / "landed" / "a.csv", [ONE])
    bar_file(tmp_path / "direct" / "b.csv", [TWO])
    load_landing(wh, str(tmp_path / "landed"), "A", "incremental")
    with during(monkeypatch, lambda: load_staging(elsewhere(wh), str(tmp_path / "direct"), "A", "incremental"), audit.STAGING):
        clean_to_staging(wh, "incremental")
    assert [r[1] for r in bars_of(wh)] == [ts(ONE[0]), ts(TWO[0])]


def test_a_load_keeps_a_clean_of_all_markets_that_ends_meanwhile(warehouse, tmp_path, bar_file, monkeypatch):
    wh = warehouse()
    bar_file(tmp_path / "landed" / "a.csv", [ONE])
    bar_file(tmp_path / "direct" / "b.csv", [TWO])
    load_landing(wh, str(tmp_path / "landed"), "A", "incremental")
    with during(monkeypatch, lambda: clean_to_staging(elsewhere(wh), "incremental"), audit.STAGING):
        load_staging(wh, str(tmp_path / "direct"), "A", "incremental")
    assert [r[1] for r in bars_of(wh)] == [ts(ONE[0]), ts(TWO[0])]


@pytest.mark.parametrize("mode", ["incremental", "full"])
def test_a_refresh_of_all_markets_keeps_what_other_refreshes_did_meanwhile(spark, warehouse, tmp_path, bar_file, monkeypatch, mode):
    """One market gets another year, and a market that was not there is loaded and refreshed."""
    wh = warehouse()
    bar_file(tmp_path / "a" / "1.csv", [ONE, TWO])
    bar_file(tmp_path / "b" / "1.csv", [ONE, ("2014-01-01 00:00:00", 5.0, 6.0)])
    load_staging(wh, str(tmp_path / "a"), "A", "incremental")
    bar_file(tmp_path / "a" / "2.csv", [("2014-02-01 00:00:00", 7.0, 8.0)])

    def others():
        there = elsewhere(wh)
        for market in "AB":
            load_staging(there, str(tmp_path / market.lower()), market, "incremental")
            refresh(there, "incremental", market)

    with during(monkeypatch, others, audit.OVERVIEW):
        # The incremental one, overtaken, finds that the others did all there was to do.
        assert refresh(wh, mode) is (mode == "full")
    want = [("A", 2013), ("A", 2014), ("B", 2013), ("B", 2014)]
    assert held(wh, "overview") == held(wh, "changes") == held(wh, "prices") == want
    assert first_last(spark, wh, "A") and first_last(spark, wh, "B")
    assert refresh(wh, "incremental") is False


def test_a_refresh_of_one_market_keeps_a_refresh_of_all_meanwhile(spark, warehouse, tmp_path, bar_file, monkeypatch):
    wh = warehouse()
    bar_file(tmp_path / "a" / "1.csv", [ONE])
    bar_file(tmp_path / "b" / "1.csv", [TWO])
    load_staging(wh, str(tmp_path / "a"), "A", "incremental")
    load_staging(wh, str(tmp_path / "b"), "B", "incremental")
    with during(monkeypatch, lambda: refresh(elsewhere(wh), "incremental"), audit.OVERVIEW):
        refresh(wh, "incremental", "A")
    assert held(wh, "overview") == [("A", 2013), ("B", 2013)] and first_last(spark, wh, "A")


def test_a_full_load_replaces_a_load_that_ends_meanwhile(warehouse, tmp_path, bar_file, monkeypatch):
    """As if it came after it: the other file's bars are gone and its content is unknown again."""
    wh = warehouse()
    bar_file(tmp_path / "all" / "a.csv", [ONE])
    bar_file(tmp_path / "more" / "b.csv", [TWO])
    with during(monkeypatch, lambda: load_staging(elsewhere(wh), str(tmp_path / "more"), "A", "incremental"), audit.STAGING):
        load_staging(wh, str(tmp_path / "all"), "A", "full")
    assert [r[1] for r in bars_of(wh)] == [ts(ONE[0])]
    assert load_staging(wh, str(tmp_path / "more"), "A", "incremental").rows_read == 1
    assert len(bars_of(wh)) == 2


def test_a_reader_keeps_the_version_it_began_with(warehouse, tmp_path, bar_file):
    wh = warehouse()
    bar_file(tmp_path / "in" / "a.csv", [ONE])
    load_staging(wh, str(tmp_path / "in"), "A", "incremental")
    refresh(wh, "incremental")
    old = wh.log.state()
    reading, wide = wh.table("staging"), overview(wh)
    before = sorted(map(str, wide.collect()))
    bar_file(tmp_path / "in" / "b.csv", [(ONE[0], 9.0, 9.5), ("2015-01-01 00:00:00", 1.0, 1.0)])
    load_staging(wh, str(tmp_path / "in"), "A", "incremental")
    refresh(wh, "incremental")
    assert reading.count() == 1 and wh.table("staging").count() == 2
    assert sorted(map(str, wide.collect())) == before == sorted(map(str, wh.table("overview", old).collect()))
    wh.as_views("now_")
    assert wh.spark.sql("SELECT count(*) AS n FROM now_staging").first()["n"] == 2
    assert plan.expire(wh, timedelta(days=1)) == 0


def test_one_bar_rewrites_one_file(spark, warehouse, tmp_path, bar_file, monkeypatch):
    monkeypatch.setattr(staging, "ROWS_PER_FILE", 10)
    wh = warehouse()
    days = [f"2013-{1 + i // 20:02}-{1 + i % 20:02} 00:00:00" for i in range(200)]
    bar_file(tmp_path / "in" / "a.csv", [(d, 1.0, 2.0) for d in days])
    load_staging(wh, str(tmp_path / "in"), "M", "incremental")
    before = {f.path: f for f in wh.log.state().files("staging")}
    assert len(before) >= 20 and sum(f.rows for f in before.values()) == 200
    bar_file(tmp_path / "in" / "b.csv", [(days[77], 5.0, 6.0)])
    load_staging(wh, str(tmp_path / "in"), "M", "incremental")
    after = {f.path: f for f in wh.log.state().files("staging")}
    gone = [before[p] for p in before.keys() - after.keys()]
    assert len(gone) == 1
    new = [after[p] for p in after.keys() - before.keys()]
    assert sum(f.rows for f in new) == gone[0].rows
    paths = {r.p for r in wh.table("staging").select(F.col("_metadata.file_path").alias("p")).distinct().collect()}
    assert len(paths) == len(after)
    closes = {str(r.time): float(r.close) for r in wh.table("staging").collect()}
    assert len(closes) == 200 and closes[days[77]] == 6.0 and sum(closes.values()) == 404.0
    # A later bar outside every range meets no file.
    bar_file(tmp_path / "in" / "c.csv", [("2013-12-31 00:00:00", 1.0, 1.0)])
    load_staging(wh, str(tmp_path / "in"), "M", "incremental")
    last = {f.path for f in wh.log.state().files("staging")}
    assert after.keys() < last and len(last) == len(after) + 1


def test_years_that_a_full_load_took_away_leave_the_results(warehouse, tmp_path, bar_file):
    for carry in (False, True):
        wh = warehouse(carry=carry)
        path = bar_file(tmp_path / f"in{carry}" / "a.csv", [ONE, ("2014-01-01 00:00:00", 5.0, 6.0), ("2015-01-01 00:00:00", 5.0, 7.0)])
        load_staging(wh, str(path.parent), "A", "full")
        refresh(wh, "incremental")
        os.remove(path)
        bar_file(path.parent / "b.csv", [ONE, ("2015-01-01 00:00:00", 5.0, 7.0)])
        load_staging(wh, str(path.parent), "A", "full")
        refresh(wh, "incremental")
        assert held(wh, "overview") == held(wh, "prices") == [("A", 2013), ("A", 2015)]


def test_folding_the_log_changes_no_answer(spark, warehouse, monkeypatch):
    """Finished, failed and open runs, loads taken up, and a reset that comes after the folding."""
    wh = warehouse()
    monkeypatch.setattr(audit, "FOLD_AT", 10**9)

    def files(*names):
        rows = [("file:/in/" + n, n, "sum-" + n, 10, ts("2020-01-01")) for n in names]
        return spark.createDataFrame(rows, "uri string, file string, checksum string, file_size bigint, file_time timestamp")

    def load(run, market, *names, status=audit.OK, **more):
        audit.audit_start(wh, audit.STAGING, run, ts("2030-01-01"), "t", files(*names), market)
        if status:
            audit.audit_finish(wh, audit.STAGING, run, ts("2030-01-02"), status, **more)

    def answers():
        return [
            rows_of(audit.audit_runs(wh, audit.STAGING), "run_id", "market", "file", "status", "is_stored", "start_time"),
            rows_of(audit.audit_runs(wh, audit.STAGING, "A"), "run_id", "file", "is_stored"),
            rows_of(audit.seen_checksums(wh, audit.STAGING, "A"), "checksum"),
            rows_of(audit.successful_loads(wh, audit.STAGING), "market", "load_id"),
            rows_of(audit.taken(wh, audit.OVERVIEW), "market", "load_id"),
            rows_of(audit.new_loads(wh, audit.STAGING, audit.OVERVIEW), "market", "load_id"),
            rows_of(audit.last_start(wh, audit.OVERVIEW), "market", "last_start"),
        ]

    load("r1", "A", "a", "b")
    load("r2", "B", "c")
    load("bad", "A", "d", status=audit.FAILED)
    load("open", "A", "e", status=None)
    market = audit.one_market(spark, "A")
    audit.audit_start(wh, audit.OVERVIEW, "o1", ts("2030-01-03"), "t", market)
    audit.audit_finish(wh, audit.OVERVIEW, "o1", ts("2030-01-03"), took=spark.createDataFrame([("A", "r1")], "market string, load_id string"))
    before, events = answers(), wh.table("audit").count()
    assert audit.fold_log(wh) is True
    assert answers() == before and wh.table("audit").count() == events
    assert len(wh.log.state().files("pending")) == 1 and wh.table("pending").count() == 1
    assert audit.fold_log(wh) is False
    audit.audit_finish(wh, audit.STAGING, "open", ts("2030-01-04"))
    assert ("A", "open") in rows_of(audit.successful_loads(wh, audit.STAGING), "market", "load_id")
    load("r3", "A", "f", reset=audit.resets(wh, audit.STAGING, market))
    # A reset of a refresh gives back what it took up.
    audit.audit_start(wh, audit.OVERVIEW, "o2", ts("2030-01-05"), "t", market)
    audit.audit_finish(wh, audit.OVERVIEW, "o2", ts("2030-01-05"), reset=audit.resets(wh, audit.OVERVIEW, market))
    after = answers()
    assert after[3] == [("A", "r3"), ("B", "r2")] and after[4] == []
    assert audit.fold_log(wh) is True and answers() == after


def test_open_runs_are_folded_by_many_tasks(spark, warehouse):
    """What stays pending is written by as many tasks as its size asks for, and counts as one write."""
    wh = warehouse()
    files = spark.range(20_000).select(
        *(F.concat(F.lit(p), F.sha2(F.col("id").cast("string"), 256)).alias(n) for n, p in (("uri", "file:/in/"), ("file", ""), ("checksum", ""))),
        F.lit(1).cast("bigint").alias("file_size"), F.lit("2020-01-01").cast("timestamp").alias("file_time"),
    )
    audit.audit_start(wh, audit.STAGING, "open", ts("2030-01-01"), "t", files, "A")
    audit.audit_start(wh, audit.STAGING, "done", ts("2030-01-01"), "t", files.limit(1), "B")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "100k")
    try:
        audit.audit_finish(wh, audit.STAGING, "done", ts("2030-01-02"))
        assert audit.fold_log(wh) is True
    finally:
        spark.conf.set(size, before)
    pending = wh.log.state().files("pending")
    assert len(pending) > 1 and len({f.path.rsplit("/", 1)[0] for f in pending}) == 1
    assert wh.table("pending").count() == 20_000


def test_work_on_the_log_does_not_grow_with_it(spark, warehouse):
    """After folding, one market's loads are read from its own files."""
    wh = warehouse()
    events = spark.range(4000).selectExpr(
        "'landing' AS layer", "cast(id AS string) AS run_id", "concat('m', id % 4) AS market",
        "explode(array('start', 'finish')) AS event", "timestamp_seconds(id) AS event_time", "'ok' AS status", "cast(id AS string) AS checksum",
    )
    missing = [f"cast(null AS {f.dataType.simpleString()}) AS {f.name}" for f in wh.table("audit").schema if f.name not in events.columns]
    audit.record(wh, events.selectExpr("*", *missing))
    audit.fold_log(wh)
    seen = audit.seen_checksums(wh, audit.LANDING, "m1")
    assert seen.count() == 1000
    assert all("market=m1" in f for f in seen.inputFiles() if "/runs/" in f)
    assert wh.table("pending").isEmpty()
