import os

from pyspark.sql import functions as F

from barloom.plans.audit import one_per_checksum, unseen_files
from barloom.sources.clean import clean_bars, parse_bars, rejected_bars, tag_load
from barloom.sources.files import file_manifest, list_files, read_bars
from conftest import HEADER, rows_of, ts


def test_sub_directories_are_skipped(spark, tmp_path, bar_file):
    bar_file(tmp_path / "d" / "a.csv", [("2012-01-01 00:00:00", 1, 2)])
    bar_file(tmp_path / "d" / "sub" / "b.csv", [("2012-01-02 00:00:00", 1, 2)])
    assert rows_of(list_files(spark, str(tmp_path / "d")), "file") == [("a.csv",)]


def fingerprints(spark, folder):
    return dict(rows_of(file_manifest(spark, str(folder)), "file", "checksum"))


def test_checksum_is_of_lines_and_their_order(spark, tmp_path, bar_file):
    rows = [(f"2012-01-01 00:00:{s:02d}", s, s + 1) for s in range(30)]
    for name, content in {"a b[1].csv": rows, "b.csv": rows, "c.csv": rows[::-1], "d.csv": rows[:29],
                          "e.csv": [*rows[:28], rows[29], rows[28]], "f.csv": [*rows, rows[0]]}.items():
        bar_file(tmp_path / name, content)
    found = fingerprints(spark, tmp_path)
    assert found["a b[1].csv"] == found["b.csv"]
    assert len(set(found.values())) == 5 and {len(v) for v in found.values()} == {64}


def test_checksum_does_not_depend_on_splits(spark, tmp_path, bar_file):
    bar_file(tmp_path / "a.csv", [(f"2012-01-01 00:{s // 60:02d}:{s % 60:02d}", s, s + 1) for s in range(600)])
    whole = fingerprints(spark, tmp_path)
    keys = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        assert fingerprints(spark, tmp_path) == whole
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_known_files_are_not_read_again(spark, tmp_path, bar_file):
    bar_file(tmp_path / "a.csv", [("2012-01-01 00:00:00", 1, 2)])
    known = file_manifest(spark, str(tmp_path)).withColumn("checksum", F.lit("kept"))
    known = spark.createDataFrame(known.collect(), known.schema)
    bar_file(tmp_path / "b.csv", [("2012-01-02 00:00:00", 1, 2)])
    manifest = dict(rows_of(file_manifest(spark, str(tmp_path), known), "file", "checksum"))
    assert manifest["a.csv"] == "kept" and len(manifest["b.csv"]) == 64


def test_a_changed_file_is_read_again(spark, tmp_path, bar_file):
    path = bar_file(tmp_path / "a.csv", [("2012-01-01 00:00:00", 1, 2)])
    old = file_manifest(spark, str(tmp_path))
    known = spark.createDataFrame(old.collect(), old.schema)
    bar_file(path, [("2012-01-01 00:00:00", 1, 3)])
    os.utime(path, (1_000_000_000, 1_000_000_000))
    new = file_manifest(spark, str(tmp_path), known)
    assert rows_of(new, "checksum") != rows_of(known, "checksum")


def test_unseen_files_by_content(spark):
    files = spark.createDataFrame(
        [("a", "1"), ("b", "1"), ("c", "2"), ("d", "3")], "file string, checksum string"
    )
    seen = spark.createDataFrame([("3",)], "checksum string")
    assert rows_of(unseen_files(files, seen), "file") == [("a",), ("c",)]
    assert rows_of(one_per_checksum(files), "file") == [("a",), ("c",), ("d",)]


def test_quoted_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\n"2012-01-01 00:00:00";"1,5";"2";"1";"1,75";"0"')
    row = read_bars(spark, str(tmp_path)).first()
    assert (row.time, row.open, row.close, row.source_file) == ("2012-01-01 00:00:00", "1,5", "1,75", "a.csv")


BAD = {
    "Time (UTC);Open;High;Low;Close;Volume": "time",
    "2012-01-01 00:00:01;1;1;1;1": "field count",
    "2012-01-01 00:00:02;1;1;1;1;1;1": "field count",
    "2012-01-01 00:00:03;one;1;1;1;1": "open",
    "2012-01-01 00:00:04;1;1;1;0;1": "close",
    "2012-01-01 00:00:05;0;1;1;1;1": "open",
    ";1;1;1;1;1": "time",
    "2012-01-01 00:00:06;10000;1;1;1;1": "open",
    "2012-01-01 00:00:07;1;1;1;;1": "close",
}


def test_bad_rows_are_told_apart(spark, tmp_path, bar_file):
    bar_file(tmp_path / "a.csv", [("2012-01-01 00:00:00", 1, 2), *BAD, ("2012-01-01 00:01:00", 2, 3)])
    raw = tag_load(read_bars(spark, str(tmp_path)), "X", "run", ts("2030-01-01"))
    good = clean_bars(raw)
    assert rows_of(good, "time") == [(ts("2012-01-01 00:00:00"),), (ts("2012-01-01 00:01:00"),)]
    reasons = [r.reject_reason for r in rejected_bars(parse_bars(raw)).orderBy("row_no").collect()]
    assert reasons == list(BAD.values())


def test_bad_rows_stay_bad_in_a_narrow_selection(spark, tmp_path, bar_file):
    """Column pruning must not hide a wrong field count."""
    bar_file(tmp_path / "a.csv", [("2012-01-01 00:00:00", 1, 2), *BAD])
    raw = tag_load(read_bars(spark, str(tmp_path)), "X", "run", ts("2030-01-01"))
    assert clean_bars(raw).select("open").count() == 1
    assert clean_bars(raw).count() == 1


def test_missing_market_or_load_time_is_rejected(spark):
    raw = spark.createDataFrame(
        [("2012-01-01 00:00:00", "1", "1", None, ts("2030-01-01")), ("2012-01-01 00:00:00", "1", "1", "X", None)],
        "time string, open string, close string, market string, load_time timestamp",
    )
    assert rows_of(parse_bars(raw), "reject_reason") == [("load time",), ("market",)]
