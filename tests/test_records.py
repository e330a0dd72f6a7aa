"""Quoted fields that hold line breaks, in files that are read by splits; and the two identities of a file."""

import csv
import io
import random

import pytest

from barloom.plans.load import load_landing, load_staging
from barloom.sources import records
from barloom.sources.files import BYTES, LINES, file_manifest, files_with_breaks, list_files, read_files, with_checksums
from conftest import HEADER, rows_of, ts


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def read(spark, folder):
    return read_files(file_manifest(spark, str(folder)))


def fields(df):
    columns = ["time", "open", "high", "low", "close", "volume"]
    ordered = df.where("bad_line is null").orderBy("source_file", "block_start", "row_no")
    return [tuple(r) for r in ordered.select(*columns).collect()]


def made_file(path, n, seed):
    """Writes rows with quotes, separators and line breaks in some fields; gives what a reader of csv finds."""
    draw = random.Random(seed)
    pieces = ["a", ";", "\n", '"', "\n\n", "é", " x", ";\n;", "1,5"]
    rows = [[f"t{i}", *("".join(draw.choices(pieces, k=draw.choice([1, 1, 1, 3, 9]))) for _ in range(4)), str(i)] for i in range(n)]

    def quoted(field):
        escaped = field.replace('"', '\\"')
        return f'"{escaped}"' if set(field) & set(';\n"') or draw.random() < 0.2 else field

    path.write_text("\n".join([HEADER, *(";".join(map(quoted, row)) for row in rows)]) + "\n")
    found = csv.reader(io.StringIO(path.read_text(), newline=""), delimiter=";", doublequote=False, escapechar="\\")
    return [tuple(row) for row in found][1:]


def test_breaks_in_quoted_fields_equal_a_reader_of_csv(spark, tmp_path):
    expected = made_file(tmp_path / "a.csv", 60, 1) + made_file(tmp_path / "b.csv", 40, 2)
    assert fields(read(spark, tmp_path)) == expected


def test_records_do_not_depend_on_splits(spark, tmp_path, small_splits):
    expected = made_file(tmp_path / "a.csv", 200, 3)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    found = read(spark, tmp_path)
    assert fields(found) == expected
    assert found.select("block_start").distinct().count() > 8


def test_records_within_a_split_are_not_shuffled(spark, tmp_path, small_splits):
    """Only lines of records that reach over the edge of a split are rows of their own, to be brought together."""
    (tmp_path / "a.csv").write_text(HEADER + "\n" + "".join(f'{i};"a;\nb\n{i}";1;1;1;0\n' for i in range(100)))

    def parts():
        lines = records._lines(spark, [str(tmp_path)], ";")
        rows = records._records(lines.join(records._splits(lines), records.SPLIT))
        return rows.where("part").count(), rows.select("block").distinct().count()

    found, splits = parts()
    assert splits > 3 and found <= 3 * splits
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.set(f"spark.sql.files.{key}", "1g")
    assert parts() == (0, 1)


def test_a_record_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(500))
    (tmp_path / "a.csv").write_text(f'{HEADER}\nt1;1;1;1;1;1\nt2;"{long}";1;1;1;1\nt3;1;1;1;1;1\n')
    assert [r[:2] for r in fields(read(spark, tmp_path))] == [("t1", "1"), ("t2", long), ("t3", "1")]


def test_a_field_that_is_never_closed_costs_its_line_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MAX_LINES", 50)
    lines = [f"t{i};1;1;1;1;1" for i in range(200)]
    lines[20] = 't20;"1;1;1;1;1'
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *lines]))
    found = read(spark, tmp_path)
    assert found.count() == 200
    assert [r[0] for r in fields(found)] == [f"t{i}" for i in range(200) if i != 20]


def test_a_stray_quote_within_a_field_opens_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\nt1;3" long;1;1;1;1\nt2;1;1;1;1;1\n"t3";"1\n";1;1;1;1')
    assert [r[:2] for r in fields(read(spark, tmp_path))] == [("t1", '3" long'), ("t2", "1"), ("t3", "1\n")]


def test_files_without_breaks_are_read_by_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\n"t1";"a;b";"x""y";"";1;1\n')
    manifest = file_manifest(spark, str(tmp_path))
    assert rows_of(manifest, "breaks") == [(False,)]
    assert "Window" not in read_files(manifest)._jdf.queryExecution().executedPlan().toString()


def test_known_files_are_looked_at_when_they_are_read(spark, tmp_path):
    expected = made_file(tmp_path / "a b[1].csv", 20, 5)
    (tmp_path / "plain.csv").write_text(f"{HEADER}\nu;1;1;1;1;1")
    listed = list_files(spark, str(tmp_path))
    known = file_manifest(spark, str(tmp_path))
    again = with_checksums(listed, spark.createDataFrame(known.collect(), known.schema))
    assert rows_of(again, "breaks") == [(None,), (None,)]
    assert len(files_with_breaks(spark, [r.path for r in listed.collect()])) == 1
    assert fields(read_files(again)) == [*expected, ("u", "1", "1", "1", "1", "1")]


def test_short_and_long_records_are_bad(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\nt1;"1\n2";3\n\nt2;"1\n";1;1;1;1;1;1\nt3;"1\n";1;1;1;1')
    found = read(spark, tmp_path)
    assert rows_of(found.where("bad_line is not null"), "bad_line") == sorted([('t1;"1\n2";3',), ('t2;"1\n";1;1;1;1;1;1',)], key=repr)
    assert [r[0] for r in fields(found)] == ["t3"]


BROKEN = f'{HEADER}\n"2012-01-01 00:00:00";"1,5";"2";"1";"1,75";"0\n"\n2012-01-02 00:00:00;2;2;2;2;0\n'


def test_a_bar_with_a_line_break_is_loaded(spark, warehouse, tmp_path, clock):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(BROKEN)
    direct, landed = warehouse(), warehouse()
    report = load_staging(direct, str(tmp_path / "in"), "X", "incremental", clock())
    assert (report.rows_read, report.rows_rejected) == (2, 0)
    assert rows_of(direct.table("staging"), "time") == [(ts("2012-01-01 00:00:00"),), (ts("2012-01-02 00:00:00"),)]
    assert load_landing(landed, str(tmp_path / "in"), "X", "full", clock()).rows_read == 2
    # The file is known now, so nothing hashes it before it is read again.
    assert load_landing(landed, str(tmp_path / "in"), "X", "full", clock()).rows_read == 2


def test_identity_of_lines_and_of_bytes(spark, tmp_path):
    lines = [HEADER, "t1;1;1;1;1;1", "t2;1;1;1;1;1"]
    contents = {"a": "\n".join(lines), "b": "\r\n".join(lines), "c": "\n".join(lines) + "\n", "d": "\n".join(lines)}
    for name, content in contents.items():
        (tmp_path / f"{name}.csv").write_bytes(content.encode())
    (tmp_path / "e.csv").write_bytes("\n".join(lines).encode() + b"\xff")
    (tmp_path / "f.csv").write_bytes("\n".join(lines).encode() + b"\xfe")
    by_lines = dict(rows_of(file_manifest(spark, str(tmp_path), identity=LINES), "file", "checksum"))
    by_bytes = dict(rows_of(file_manifest(spark, str(tmp_path), identity=BYTES), "file", "checksum"))
    assert len({by_lines[f"{n}.csv"] for n in "abcd"}) == 1 and len(set(by_lines.values())) == 3
    assert by_bytes["a.csv"] == by_bytes["d.csv"] and len(set(by_bytes.values())) == 5
    with pytest.raises(ValueError):
        file_manifest(spark, str(tmp_path), identity="name")


def test_bytes_do_not_depend_on_splits(spark, tmp_path, small_splits):
    made_file(tmp_path / "a.csv", 100, 7)
    found = rows_of(file_manifest(spark, str(tmp_path), identity=BYTES), "checksum")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    assert rows_of(file_manifest(spark, str(tmp_path), identity=BYTES), "checksum") == found


def test_an_installation_of_bytes_loads_other_line_ends(warehouse, tmp_path, clock):
    (tmp_path / "in").mkdir()
    text = f"{HEADER}\n2012-01-01 00:00:00;1;1;1;1;0\n"
    for name, end in (("a", "\n"), ("b", "\r\n")):
        (tmp_path / "in" / f"{name}.csv").write_bytes(text.replace("\n", end).encode())
    assert load_landing(warehouse(), str(tmp_path / "in"), "X", "incremental", clock()).files == 1
    assert load_landing(warehouse(identity=BYTES), str(tmp_path / "in"), "X", "incremental", clock()).files == 2


def test_the_identity_of_an_installation_stays(spark, tmp_path):
    from barloom.plans.warehouse import init_tables

    init_tables(spark, "wh_identity", str(tmp_path / "wh"), identity=BYTES)
    assert init_tables(spark, "wh_identity", str(tmp_path / "wh"), identity=BYTES).identity == BYTES
    with pytest.raises(ValueError):
        init_tables(spark, "wh_identity", str(tmp_path / "wh"))
