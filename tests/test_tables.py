import os

import pytest
from pyspark.sql import functions as F

from barloom.operators.merge import upsert
from barloom.schemas import struct
from barloom.session import scratch_path, shared_dir
from barloom.sinks import exports
from barloom.sinks import tables as sink
from barloom.sources.tables import literal_rows, read_table, table_or_empty
from conftest import rows_of

SCHEMA = struct(time="bigint", price="decimal(7,3)", market="string", year="int")


@pytest.fixture
def table(spark, tmp_path):
    made = []

    def make(by=None):
        name = f"db_{os.urandom(6).hex()}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / name}'")
        sink.create_table(spark, f"{name}.t", SCHEMA, f"{tmp_path}/{name}/t/v-0", by)
        made.append(name)
        return f"{name}.t"

    return make


def prices(spark, rows):
    return spark.createDataFrame(rows, "time bigint, price double, market string, year int")


def test_append_goes_by_name(spark, table):
    name = table()
    df = prices(spark, [(1, 2.5, "A", 2020)])
    sink.append(df.select("year", "market", "price", "time"), name)
    sink.append(df, name)
    assert [tuple(map(str, r)) for r in read_table(spark, name).collect()] == [("1", "2.500", "A", "2020")] * 2


def test_replace_all(spark, table):
    name = table()
    sink.append(prices(spark, [(1, 1.0, "A", 2020)]), name)
    sink.replace_all(prices(spark, [(2, 1.0, "A", 2020)]), name)
    assert rows_of(spark.table(name), "time") == [(2,)]


def test_swap_write_reads_what_it_replaces(spark, table):
    name = table()
    sink.append(prices(spark, [(1, 1.0, "A", 2020), (2, 1.0, "A", 2020)]), name)
    for value in (3.0, 4.0, 5.0):
        new = prices(spark, [(2, value, "A", 2020), (3, value, "A", 2020)])
        new = new.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA])
        sink.swap_write(upsert(spark.table(name), new, ["market", "time"]), name)
    assert [(r.time, int(r.price)) for r in spark.table(name).orderBy("time").collect()] == [(1, 1), (2, 5), (3, 5)]


def test_a_failed_swap_leaves_the_old_rows(spark, table):
    name = table()
    sink.append(prices(spark, [(1, 1.0, "A", 2020)]), name)
    broken = spark.table(name).withColumn("year", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        sink.swap_write(broken, name)
    assert rows_of(spark.table(name), "time", "year") == [(1, 2020)]


def test_swap_keeps_one_version_back(spark, table):
    name = table()
    for value in range(4):
        sink.swap_write(prices(spark, [(value, 1.0, "A", 2020)]), name)
    folder = os.path.dirname(sink.location(spark, name).removeprefix("file:"))
    assert len(os.listdir(folder)) == 2
    assert rows_of(spark.table(name), "time") == [(3,)]


def test_compact(spark, table):
    name = table()
    for value in range(5):
        sink.append(prices(spark, [(value, 1.0, "A", 2020)]), name)
    sink.compact(spark, name)
    assert rows_of(spark.table(name), "time") == [(i,) for i in range(5)]
    assert len(spark.table(name).inputFiles()) < 5


def test_slices_leave_others_alone(spark, table):
    name = table(["market", "year"])
    keys = ["market", "year"]
    sink.overwrite_slices(prices(spark, [(1, 1.0, "A", 2020), (2, 1.0, "A", 2021), (3, 1.0, "B", 2020)]), name, keys)
    sink.overwrite_slices(prices(spark, [(4, 1.0, "A", 2021)]), name, keys)
    assert rows_of(spark.table(name), "time") == [(1,), (3,), (4,)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_slices_may_read_their_own_table(spark, table):
    name = table(["market", "year"])
    keys = ["market", "year"]
    sink.overwrite_slices(prices(spark, [(1, 1.0, "A", 2020), (2, 1.0, "A", 2021)]), name, keys)
    more = prices(spark, [(9, 1.0, "A", 2020)])
    more = more.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA])
    sink.overwrite_slices(spark.table(name).where("year = 2020").unionByName(more), name, keys)
    assert rows_of(spark.table(name), "time", "year") == [(1, 2020), (2, 2021), (9, 2020)]


def test_delete_where_takes_market_and_year_as_a_pair(spark, table):
    name = table(["market", "year"])
    rows = [(1, 1.0, "A/1 =", 2020), (2, 1.0, "A/1 =", 2021), (3, 1.0, "B", 2020), (4, 1.0, "B", 2021)]
    sink.overwrite_slices(prices(spark, rows), name, ["market", "year"])
    assert {p["market"] for p in sink.partitions(spark, name)} == {"A/1 =", "B"}
    sink.delete_where(spark, name, "A/1 =", [2020])
    assert rows_of(spark.table(name), "time") == [(2,), (3,), (4,)]
    sink.delete_where(spark, name, "B")
    assert rows_of(spark.table(name), "time") == [(2,)]


def test_catalog_lists(spark, table):
    name = table()
    database = name.split(".")[0]
    assert database in sink.databases(spark)
    assert sink.tables(spark, database) == ["t"]
    sink.drop_table(spark, name)
    assert sink.tables(spark, database) == []
    sink.drop_table(spark, name)


def test_missing_table_is_empty(spark, table):
    name = table()
    assert table_or_empty(spark, name + "_not", SCHEMA).schema == SCHEMA
    assert table_or_empty(spark, name + "_not", SCHEMA).isEmpty()
    sink.append(prices(spark, [(1, 1.0, "A", 2020)]), name)
    assert table_or_empty(spark, name, SCHEMA).count() == 1


def test_literal_rows(spark):
    df = literal_rows(spark, [("a", 1)], struct(name="string", n="bigint"))
    assert rows_of(df, "name", "n") == [("a", 1)]


def test_counts_come_with_the_write(spark, table):
    name = table()
    df, seen = sink.counted(prices(spark, [(1, 1.0, "A", 2020), (2, 0.0, "A", 2020)]), n=F.count(F.lit(1)),
                            zero=F.count_if(F.col("price") == 0))
    sink.append(df.where("price <> 0"), name)
    assert seen.get == {"n": 2, "zero": 1}


def test_exports(spark, tmp_path):
    df = prices(spark, [(1, 1.5, "A", 2020), (2, 2.5, "B", 2020), (3, None, "B", 2020)])
    assert [r.value for r in exports.joined_text(df).collect()] == ["1;1.5;A;2020", "2;2.5;B;2020", "3;;B;2020"]
    exports.export_csv(df, str(tmp_path / "all"))
    assert spark.read.csv(str(tmp_path / "all"), sep=";", header=True).count() == 3
    exports.export_by_key(df, str(tmp_path / "by"), ["market"])
    assert {p.name for p in (tmp_path / "by").iterdir() if p.is_dir()} == {"market=A", "market=B"}


def test_shared_folder_is_the_one_named_by_the_cluster(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == root
    assert scratch_path(spark, "x").startswith(root + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_working_copy_keeps_schema_and_rows(spark):
    df = prices(spark, [(1, 1.5, "001", 2020)])
    copy = sink.working_copy(df, scratch_path(spark, "copy"))
    assert copy.schema.simpleString() == df.schema.simpleString()
    assert copy.collect() == df.collect()
    empty = sink.working_copy(df.limit(0), scratch_path(spark, "copy"))
    assert empty.isEmpty() and empty.columns == df.columns


def test_a_file_in_order_is_strung_from_sorted_parts(spark, tmp_path):
    """One file under a header, though its rows were sorted by many tasks, none of which had all of them."""
    rows = spark.range(3000).select(((F.col("id") * 7919) % 3000).alias("id")).repartition(6)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    before, tasks = spark.conf.get(merging), []

    def as_text(df):
        tasks.append(df.rdd.getNumPartitions())
        return df.select("id", F.lit("a;\u00e4").alias("text"))

    spark.conf.set(merging, "false")
    try:
        exports.export_in_order(rows, str(tmp_path / "out"), ["id"], as_text)
    finally:
        spark.conf.set(merging, before)
    files = list((tmp_path / "out").glob("part-*"))
    assert len(files) == 1 and tasks[0] > 1
    assert files[0].read_text(encoding="utf-8").split("\n") == ["id;text", *(f'{i};"a;\u00e4"' for i in range(3000)), ""]
