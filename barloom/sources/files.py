"""Files of a load directory: listing, checksums, and the delimited scan."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.parsing import base_name
from barloom.schemas import BAD_LINE, RAW, struct
from barloom.sources.records import ends_inside, read_bar_records

# The schema Spark gives to files read as whole values.
BINARY_FILE = struct(path="string", modificationTime="timestamp", length="bigint", content="binary")


def literal_path(path: str) -> str:
    """A listed path for use in a reader, where some characters would mean a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """(uri, path, file, file_size, file_time) of the files of a directory, sub-directories left out.

    ``content`` is not selected, so no file is opened.
    """
    return described(spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(directory))


def described(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("_metadata.file_path").alias("uri"),
        "path",
        base_name(F.col("path")).alias("file"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("file_time"),
    )


# What makes two files one content.
LINES, BYTES = "lines", "bytes"


def checksums(spark: SparkSession, paths: list[str], identity: str = LINES) -> DataFrame:
    """(uri, checksum, breaks): a fingerprint of each file, and whether quoted fields may hold line breaks.

    The identity ``lines`` is of a file's lines and their order, whatever ends a line; ``bytes`` is of all
    its bytes: lines are cut at line feeds only, and the file's length tells of the last one.

    Every line has two hashes of 31 bits; a file is known by its line count, the sums of the hashes and
    the sums of hash times place. A split is summed where it lies, with places counted from its first
    line, and moved to its place in the file afterwards, so neither the size of a file nor the way it is
    split matters, and no file is one value.
    """
    check_identity(identity)
    reader = spark.read.option("lineSep", "\n") if identity == BYTES else spark.read
    lines = reader.text([literal_path(p) for p in paths])
    wide = "decimal(38,0)"
    hashes = {f"h{i}": F.shiftrightunsigned(F.xxhash64("value", F.lit(i)), 33).cast("decimal(10,0)") for i in (0, 1)}
    lines = lines.select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        # Rows of a task are numbered on; the low bits are the number within it.
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
        F.col("_metadata.file_size").alias("size"),
        ends_inside(F.col("value")).alias("open"),
        *(h.alias(n) for n, h in hashes.items()),
    )
    split = lines.groupBy("uri", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("place").alias("first"),
        F.max("size").alias("size"),
        F.max("open").alias("open"),
        *(F.sum(h).cast(wide).alias(f"s_{h}") for h in hashes),
        *(F.sum(F.col(h) * F.col("place").cast("decimal(10,0)")).cast(wide).alias(f"t_{h}") for h in hashes),
    )
    before = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    placed = split.withColumn("shift", shift.cast("decimal(15,0)"))
    folded = placed.groupBy("uri").agg(
        F.sum("n").alias("n"),
        F.max("size").alias("size"),
        F.max("open").alias("breaks"),
        *(F.sum(f"s_{h}").alias(f"s_{h}") for h in hashes),
        *(F.sum(F.expr(f"t_{h} + cast(shift * cast(s_{h} as decimal(22,0)) as {wide})")).alias(f"t_{h}") for h in hashes),
    )
    parts = ["n", *(f"{k}_{h}" for h in hashes for k in "st"), *["size"] * (identity == BYTES)]
    checksum = F.sha2(F.concat_ws(":", *(F.col(c).cast("string") for c in parts)), 256)
    return folded.select("uri", checksum.alias("checksum"), "breaks")


def check_identity(identity: str) -> None:
    if identity not in (LINES, BYTES):
        raise ValueError(f"identity must be {LINES} or {BYTES}, not {identity!r}")


def with_checksums(files: DataFrame, known: DataFrame | None = None, identity: str = LINES) -> DataFrame:
    """Add ``checksum`` and ``breaks`` to listed files; a file without lines has the checksum of none.

    ``known`` (uri, file_size, file_time, checksum) are files hashed before: a file of the same full
    path, size and time keeps its checksum and is not read again, so a run over a directory that only
    grows reads just the new files; its ``breaks`` are null, not known. Without it every file is read.

    The list of paths passes the driver, as it does in every file scan of Spark; contents never do.
    """
    spark = files.sparkSession
    stat = ["uri", "file_size", "file_time"]
    columns = ["uri", "path", "file", "file_size", "file_time", "checksum", "breaks"]
    kept = None
    if known is not None:
        seen = known.groupBy(*stat).agg(F.max("checksum").alias("checksum"))
        seen = seen.withColumn("breaks", F.lit(None).cast("boolean"))
        kept = files.join(seen, stat, "inner").select(*columns)
        files = files.join(seen, stat, "left_anti")
    paths = [r.path for r in files.select("path").collect()]
    none = F.sha2(F.lit("0"), 256)
    if paths:
        hashed = files.join(checksums(spark, paths, identity), "uri", "left")
        hashed = hashed.withColumns({"checksum": F.coalesce("checksum", none), "breaks": F.coalesce("breaks", F.lit(False))})
    else:
        hashed = files.withColumns({"checksum": none, "breaks": F.lit(False)})
    hashed = hashed.select(*columns)
    return hashed if kept is None else hashed.unionByName(kept)


def file_manifest(
    spark: SparkSession, directory: str, known: DataFrame | None = None, identity: str = LINES
) -> DataFrame:
    """(uri, path, file, file_size, file_time, checksum, breaks) of a directory."""
    return with_checksums(list_files(spark, directory), known, identity)


def files_with_breaks(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of some paths, as listed, whose quoted fields may hold line breaks. Reads the files' lines once."""
    if not paths:
        return []
    lines = spark.read.text([literal_path(p) for p in paths]).where(ends_inside(F.col("value")))
    found = {r.uri for r in lines.select(F.col("_metadata.file_path").alias("uri")).distinct().collect()}
    files = described(spark.read.format("binaryFile").load([literal_path(p) for p in paths]))
    return [r.path for r in files.select("uri", "path").collect() if r.uri in found] if found else []


def read_files(files: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """``read_bars`` of the files of a manifest, by lines or by records as their ``breaks`` ask for.

    ``spark`` reads them if not the session of ``files`` should, as for a micro-batch.
    """
    spark = spark or files.sparkSession
    listed = files.select("path", "breaks").collect()
    broken = [r.path for r in listed if r.breaks] + files_with_breaks(spark, [r.path for r in listed if r.breaks is None])
    return read_bars(spark, [r.path for r in listed], broken=broken)


def read_bars(
    spark: SparkSession, paths: str | list[str], separator: str = ";", broken: list[str] | None = None
) -> DataFrame:
    """Delimited bar files as text columns, with where each row came from.

    A header line and quoted fields are taken care of by the scan. A row with too few or too many
    fields is kept, with its text in ``bad_line``. Rows have an order: by time of the file, then by
    position in the file. Of two files of one time a number made of the name decides.

    ``broken`` names those of a list of paths whose quoted fields hold line breaks. They are read by
    records, the others by lines, where a line break always ends a row.
    """
    if broken:
        rest = [p for p in paths if p not in set(broken)]
        records = read_bar_records(spark, [literal_path(p) for p in broken], separator)
        return records.unionByName(read_bars(spark, rest, separator)) if rest else records
    raw = (
        spark.read.schema(RAW)
        .option("sep", separator)
        .option("header", True)
        .option("quote", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        # A pruned scan counts only the fields it keeps and would miss rows that are short or long.
        .option("columnPruning", False)
        .csv([literal_path(p) for p in paths] if isinstance(paths, list) else paths)
    )
    return raw.select(
        *RAW.fieldNames(),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_no"),
    )


def file_key(name: Column) -> Column:
    """A file name as a number: rows carry it through shuffles in place of the name."""
    return F.xxhash64(name)


# Order of two rows of one key within a load.
ROW_ORDER = ["file_time", "file_key", "block_start", "row_no"]
