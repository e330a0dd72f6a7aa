"""Writing tables of the catalog: append, replace, slices, swaps, and table maintenance.

A partitioned table changes by whole partitions: new files get a folder of their own, and then the partitions
are pointed to them, one by one. An unpartitioned table is rewritten next to the old version and then
switched over by moving its location. A failed write leaves the old content. Tables that several runs
change at a time, or of which several change together, are kept by ``versions`` instead.
"""

from __future__ import annotations

import threading
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import remove_path


def quote(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def text_literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


# Two appends to one folder at a time would clear each other's unfinished files.
_appends = threading.Lock()
_claims: dict[tuple[str, str], threading.RLock] = defaultdict(threading.RLock)


@contextmanager
def claim(database: str, market: str | None) -> Iterator[None]:
    """Spares runs of one market in one driver the same work at a time; nothing more rests on it.

    Runs on other markets, on all of them (None) and on other drivers go side by side: what they commit is
    compared with what they read (``versions``).
    """
    with _claims[(database, market or "")]:
        yield


def aligned(df: DataFrame, table: str) -> DataFrame:
    """The columns of the table, in its order and types: inserts go by position."""
    schema = df.sparkSession.table(table).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def counted(df: DataFrame, **measures) -> tuple[DataFrame, Observation]:
    """Row counts taken while the rows pass by, instead of by a second scan."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in measures.items()]), seen


def append(df: DataFrame, table: str) -> None:
    rows = aligned(df, table)
    with _appends:
        rows.write.insertInto(table)


def replace_all(df: DataFrame, table: str) -> None:
    """New content for the whole table. ``df`` must not read the table; see ``swap_write`` for that."""
    aligned(df, table).write.insertInto(table, overwrite=True)


def rebalanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Group rows by table partition before writing, so files are few and large.

    The rebalance hint lets Spark split a partition that holds much of the data over several tasks,
    where a plain repartition would send it all to one.
    """
    names = ", ".join(f"`{k}`" for k in keys)
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({names}) */ * FROM {{df}}", df=df)


@dataclass
class SliceSwap:
    """Partitions of a table that point to new folders, and where they pointed before."""

    spark: SparkSession
    table: str
    slices: list[dict[str, str]]
    before: list[tuple[dict[str, str], str | None]]

    def undo(self) -> None:
        """Everything points to where it did."""
        for spec, folder in self.before:
            if folder is None:
                drop_partitions(self.spark, self.table, [spec])
            else:
                _add(self.spark, self.table, [(spec, folder)])
                _point(self.spark, self.table, spec, folder)
        self.spark.catalog.refreshTable(self.table)

    def clear(self) -> None:
        """Removes what the partitions held before."""
        for _, folder in self.before:
            if folder is not None:
                remove_path(self.spark, folder)


def _spec(spec: dict[str, str]) -> str:
    return ", ".join(f"`{k}`={text_literal(str(v))}" for k, v in spec.items())


def _add(spark: SparkSession, table: str, folders: list[tuple[dict[str, str], str]]) -> None:
    """New partitions, all in one statement."""
    if folders:
        listed = " ".join(f"PARTITION ({_spec(s)}) LOCATION {text_literal(f)}" for s, f in folders)
        spark.sql(f"ALTER TABLE {quote(table)} ADD IF NOT EXISTS {listed}")


def _point(spark: SparkSession, table: str, spec: dict[str, str], folder: str) -> None:
    spark.sql(f"ALTER TABLE {quote(table)} PARTITION ({_spec(spec)}) SET LOCATION {text_literal(folder)}")


def partition_location(spark: SparkSession, table: str, spec: dict[str, str]) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote(table)} PARTITION ({_spec(spec)})")
    return rows.where("col_name = 'Location'").first()["data_type"]


def swap_slices(df: DataFrame, table: str, keys: list[str]) -> SliceSwap:
    """Replace the table partitions that occur in ``df``; others are left alone.

    ``df`` may read the same table. New files get a folder of their own. When all of them are written,
    the partitions are pointed to them; should that fail half-way, they are pointed back. The caller
    keeps the old files until its run is known to be good (``clear``) or goes back to them (``undo``).
    """
    spark = df.sparkSession
    folder = f"{location(spark, table).rstrip('/')}/w-{uuid.uuid4().hex}"
    name = F.sha2(F.concat_ws("/", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)), 256)
    rebalanced(aligned(df, table), keys).withColumn("_slice", name).write.partitionBy("_slice").parquet(folder)
    files = spark.read.schema(df.sparkSession.table(table).schema.add("_slice", "string")).parquet(folder)
    written = files.select(*keys, "_slice").distinct().collect()
    existing = {tuple(p[k] for k in keys) for p in partitions(spark, table)}
    swap = SliceSwap(spark, table, [{k: str(r[k]) for k in keys} for r in written], [])
    targets = [(s, f"{folder}/_slice={r['_slice']}") for s, r in zip(swap.slices, written, strict=True)]
    new = [(s, t) for s, t in targets if tuple(s.values()) not in existing]
    try:
        swap.before += [(s, None) for s, _ in new]
        _add(spark, table, new)
        for spec, target in targets:
            if tuple(spec.values()) in existing:
                swap.before.append((spec, partition_location(spark, table, spec)))
                _point(spark, table, spec, target)
    except BaseException:
        swap.undo()
        raise
    spark.catalog.refreshTable(table)
    return swap


def overwrite_slices(df: DataFrame, table: str, keys: list[str]) -> None:
    """``swap_slices`` for callers to whom the written slices are all that has to succeed."""
    swap_slices(df, table, keys).clear()


def partitions(spark: SparkSession, table: str, **fixed: str) -> list[dict[str, str]]:
    """Names of the table partitions, optionally of those with some fixed values."""
    spec = ", ".join(f"{k}={text_literal(v)}" for k, v in fixed.items())
    where = f" PARTITION ({spec})" if spec else ""
    rows = spark.sql(f"SHOW PARTITIONS {quote(table)}{where}")
    found = []
    for row in rows.collect():
        fields = (field.split("=", 1) for field in row["partition"].split("/"))
        found.append({k: unquote(v) for k, v in fields})
    return found


def drop_partitions(spark: SparkSession, table: str, specs: list[dict[str, str]]) -> None:
    """Take whole partitions out of the table, in one statement; reads no data."""
    if specs:
        listed = ", ".join(f"PARTITION ({_spec(s)})" for s in specs)
        spark.sql(f"ALTER TABLE {quote(table)} DROP IF EXISTS {listed}")


def delete_where(spark: SparkSession, table: str, market: str, years: list[int] | None = None) -> None:
    """Delete a market, or some years of it, from a table partitioned by market and year."""
    wanted = None if years is None else {str(y) for y in years}
    found = partitions(spark, table, market=market)
    drop_partitions(spark, table, [p for p in found if wanted is None or p["year"] in wanted])


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote(table)}")
    return rows.where("col_name = 'Location'").first()["data_type"]


def swap_write(df: DataFrame, table: str) -> None:
    """Replace an unpartitioned table by rows that may be computed from it.

    The new version gets a folder of its own beside the old one. Switching the location is the last and
    only visible step. The version before the current one is kept for readers that still run.
    """
    spark = df.sparkSession
    old = location(spark, table)
    new = f"{old.rsplit('/', 1)[0]}/v-{uuid.uuid4().hex}"
    aligned(df, table).write.parquet(new)
    previous = spark.sql(f"SHOW TBLPROPERTIES {quote(table)}").where("key = 'previous.version'").first()
    spark.sql(f"ALTER TABLE {quote(table)} SET LOCATION {text_literal(new)}")
    spark.sql(f"ALTER TABLE {quote(table)} SET TBLPROPERTIES ('previous.version' = {text_literal(old)})")
    spark.catalog.refreshTable(table)
    if previous is not None:
        remove_path(spark, previous["value"])


def compact(spark: SparkSession, table: str) -> None:
    """Fewer, larger files for an unpartitioned table that grew by many small appends."""
    hinted = spark.sql("SELECT /*+ REBALANCE */ * FROM {df}", df=spark.table(table))
    with _appends:  # an append between the listing of the files and the switch would be lost
        swap_write(hinted, table)


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, folder: str, partitioned_by: list[str] | None = None
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quote(table)} ({columns}) USING parquet {by} LOCATION {text_literal(folder)}"
    )


def drop_table(spark: SparkSession, table: str) -> None:
    """Remove the table and its files."""
    if spark.catalog.tableExists(table):
        folder = location(spark, table)
        spark.sql(f"DROP TABLE {quote(table)}")
        remove_path(spark, folder)


def databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def working_copy(df: DataFrame, path: str, spark: SparkSession | None = None) -> DataFrame:
    """Write an intermediate that several later steps read, and read it back.

    The copy lies in a folder all executors reach, so losing an executor costs no recomputation of
    what led to it. ``spark`` reads it back if not the session of ``df`` should: a micro-batch has a
    session of its own, whose view of a table does not follow what others write.
    """
    df.write.parquet(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)
