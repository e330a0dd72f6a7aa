"""Records of delimited files whose quoted fields hold line breaks, read by splits.

A line either begins inside a quoted field or outside of one, and what it does to that is all that
matters of it: a quote that begins a field turns one into the other, any other quote ends the field it
is in. So a line (and a split, and any run of lines) is two values, whether it *resets* the state to
outside and whether it then *flips* it. Splits are summed up by these where they lie; the state each
begins in follows from the splits before it, one row each; and with it the lines that begin a record.
Each task puts together the records that lie within a split, in the order it reads the lines. No file is read by
one task, and only lines of records that reach over the edge of a split, or are too long, are shuffled.

A doubled quote and a quote after a backslash are part of a field (the doubled one stays two, as in a scan by lines). A field that is opened and not
closed within ``MAX_LINES`` lines is a mistake: its lines are records of their own, so one stray quote
costs no more rows than it does in a scan by lines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.schemas import BAD_LINE, RAW

# Lines of the longest record; it bounds what is brought together for one row.
MAX_LINES = 1000

SPLIT = ["uri", "block"]
FIRST = ["uri", "first_block", "first_place"]


def quote_marks(line: Column, separator: str = ";") -> Column:
    """The quotes of a line that open or close a field: ``a`` where a field begins, ``b`` elsewhere."""
    own = re.sub(r"([\W_])", r"\\\1", separator)
    marks = F.regexp_replace(line, r'\\.|""', "")
    for pattern, new in ((f'[^"{own}]+', "x"), (f'(?<=^|[{own}])"', "a"), ('"', "b"), ("[^ab]", "")):
        marks = F.regexp_replace(marks, pattern, new)
    # Few lines hold a quote; the others skip this.
    return F.when(F.contains(line, F.lit('"')), marks).otherwise(F.lit(""))


def ends_inside(line: Column, separator: str = ";") -> Column:
    """Whether a line that begins outside of a quoted field ends inside of one."""
    return F.length(F.regexp_replace(quote_marks(line, separator), "^.*b", "")) % 2 == 1


def _with_states(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds what rows up to each one do: ``flips`` and ``base`` (before it), ``flips_to`` and ``base_to`` (with it).

    The state is that of ``_state``: flips since the last reset, or since the start if there was none.
    """
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("flips_to", F.sum("flip").over(upto))
    at_reset = F.when(F.col("reset"), F.col("flips_to") - F.col("flip"))
    return rows.withColumns({
        "flips": F.col("flips_to") - F.col("flip"),
        "base": F.last(at_reset, ignorenulls=True).over(before),
        "base_to": F.last(at_reset, ignorenulls=True).over(upto),
    })


def _state(enter: Column, flips: str, base: str) -> Column:
    """1 inside of a quoted field, 0 outside, for rows whose run was entered in a state."""
    return F.pmod(F.coalesce(F.col(flips) - F.col(base), enter + F.col(flips)), F.lit(2))


def _lines(spark: SparkSession, paths: list[str], separator: str) -> DataFrame:
    """Lines, in the order of their split, and what they do to the state."""
    text = spark.read.text(paths)
    marks = quote_marks(F.col("value"), separator)
    return text.select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_name").alias("source_file"),
        F.unix_micros(F.col("_metadata.file_modification_time")).alias("file_time"),
        "value", marks.alias("marks"),
    ).select(
        *SPLIT, "source_file", "file_time", F.col("value").cast("binary").alias("value"),
        (F.trim("value") == "").alias("is_blank"),
        F.contains("marks", F.lit("b")).alias("reset"),
        (F.length(F.regexp_replace("marks", "^.*b", "")) % 2).alias("flip"),
    )


def _task_helpers():
    """What the tasks run, as functions of no module: workers need not have the package."""
    import numpy as np

    def states(reset, flip, enter):
        """The state before and after each of some lines."""
        flips = np.cumsum(flip)
        at = np.maximum.accumulate(np.where(reset, np.arange(len(flip)), -1))
        after = np.where(at >= 0, flips - (flips - flip)[at], flips + enter) % 2
        return np.concatenate([[enter], after[:-1]]), after

    def pieces(batch):
        """Runs of lines of one split: (first, end)."""
        uri, block = batch["uri"].to_numpy(), batch["block"].to_numpy()
        edges = np.flatnonzero((uri[1:] != uri[:-1]) | (block[1:] != block[:-1])) + 1
        return zip([0, *edges.tolist()], [*edges.tolist(), len(batch)], strict=True)

    return states, pieces


def _ends(lines: DataFrame) -> DataFrame:
    """For each split and the two states it may be entered in: the last line that begins a record, and the state it ends in."""
    states, pieces = _task_helpers()

    def summed(batches):
        import numpy as np
        import pandas as pd

        key, place, last, state = None, 0, [None, None], [0, 1]

        def row():
            return pd.DataFrame({
                "uri": [key[0]], "block": [key[1]], "last0": pd.array([last[0]], dtype="Int64"),
                "last1": pd.array([last[1]], dtype="Int64"), "exit0": [state[0]], "exit1": [state[1]],
            })

        for batch in batches:
            if not len(batch):
                continue
            reset, flip = batch["reset"].to_numpy(dtype=bool), batch["flip"].to_numpy(dtype=np.int64)
            for first, end in pieces(batch):
                found = batch["uri"].iat[first], int(batch["block"].iat[first])
                if found != key:
                    if key is not None:
                        yield row()
                    key, place, last, state = found, 0, [None, None], [0, 1]
                for enter in (0, 1):
                    before, after = states(reset[first:end], flip[first:end], state[enter])
                    begins = np.flatnonzero(before == 0)
                    if len(begins):
                        last[enter] = place + int(begins[-1])
                    state[enter] = int(after[-1])
                place += end - first
        if key is not None:
            yield row()

    slim = lines.select(*SPLIT, "reset", "flip")
    return slim.mapInPandas(summed, "uri string, block bigint, last0 bigint, last1 bigint, exit0 int, exit1 int")


def _splits(lines: DataFrame) -> DataFrame:
    """(uri, block, enter, from_block, from_place): the state a split begins in, and its open record's first line."""
    ends = _ends(lines)
    ends = ends.select(*SPLIT, "last0", "last1", (F.col("exit0") == F.col("exit1")).alias("reset"), F.col("exit0").alias("flip"))
    entered = _with_states(ends, ["uri"], "block").withColumn("enter", _state(F.lit(0), "flips", "base"))
    last = F.when(F.col("enter") == 0, F.col("last0")).otherwise(F.col("last1"))
    start = F.when(last.isNotNull(), F.struct(F.col("block"), last.alias("place")))
    before = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = entered.withColumn("start", F.last(start, ignorenulls=True).over(before))
    return opened.select(*SPLIT, "enter", F.col("start.block").alias("from_block"), F.col("start.place").alias("from_place"))


RECORDS = (
    "value binary, uri string, source_file string, file_time bigint, block bigint, place bigint, header boolean, is_blank boolean, "
    "part boolean, first_block bigint, first_place bigint"
)


def _records(lines: DataFrame) -> DataFrame:
    """Whole records of lines that know their split's ``enter``, ``from_block`` and ``from_place``.

    The lines of a record that begins or ends in another split, or that is too long, are rows of their own (``part``).
    """
    states, pieces = _task_helpers()
    longest = MAX_LINES
    columns = [c.split()[0] for c in RECORDS.split(", ")]

    def strung(batches):
        import numpy as np
        import pandas as pd

        key, place, state, filled = None, 0, 0, False
        # Where the record began that the next lines may belong to, its lines so far, and whether they stay parts.
        begun, held, apart = None, [], True
        fixed: tuple = ()
        out: list[tuple] = []

        def parted():
            for value, at, header, blank in held:
                out.append((value, *fixed, at, header, blank, True, *begun))
            held.clear()

        def finished():
            """The record that ``held`` has all lines of."""
            if held and not apart:
                value = b"\n".join(line[0] for line in held)
                out.append((value, *fixed, begun[1], any(line[2] for line in held), len(held) == 1 and held[0][3], False, *begun))
                held.clear()
            elif held:
                parted()

        def left():
            """At the end of a split: a record that is still open goes on in the next one."""
            finished() if state == 0 else parted()

        def table():
            frame = pd.DataFrame(out, columns=columns)
            out.clear()
            return frame

        for batch in batches:
            if not len(batch):
                continue
            reset, flip = batch["reset"].to_numpy(dtype=bool), batch["flip"].to_numpy(dtype=np.int64)
            values, blanks = batch["value"].tolist(), batch["is_blank"].tolist()
            for first, end in pieces(batch):
                row = batch.iloc[first]
                found = row["uri"], int(row["block"])
                if found != key:
                    if key is not None:
                        left()
                    key, place, state, filled = found, 0, int(row["enter"]), False
                    fixed = (row["uri"], row["source_file"], int(row["file_time"]), found[1])
                    begun, apart = (None, None), True
                    if state:
                        begun = int(row["from_block"]), int(row["from_place"])
                before, after = states(reset[first:end], flip[first:end], state)
                for i, enter in zip(range(first, end), before.tolist(), strict=True):
                    if enter == 0:
                        finished()
                        begun, apart = (found[1], place), False
                    header = found[1] == 0 and not blanks[i] and not filled
                    filled = filled or not blanks[i]
                    held.append((values[i], place, header, blanks[i]))
                    place += 1
                    if len(held) > longest:
                        apart = True
                    if apart:
                        parted()
                state = int(after[-1])
            yield table()
        if key is not None:
            left()
        if out:
            yield table()

    return lines.mapInPandas(strung, RECORDS)


def read_records(spark: SparkSession, paths: list[str], separator: str = ";") -> DataFrame:
    """(value, source_file, file_time, block_start, row_no) of every record but each file's first and blank ones.

    ``block_start`` and ``row_no`` tell where its first line stands. Line ends within a record are line feeds.
    """
    lines = _lines(spark, paths, separator)
    # One row for each split, so it is small beside the lines.
    rows = _records(lines.join(F.broadcast(_splits(lines)), SPLIT))
    own = ["value", "source_file", "file_time", F.col("block").alias("block_start"), F.col("place").alias("row_no"), "header", "is_blank"]
    parts = rows.where("part")
    endless = parts.groupBy(*FIRST).count().where(F.col("count") > MAX_LINES).select(*FIRST)
    joined = parts.join(endless, FIRST, "left_anti").groupBy(*FIRST).agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "value")))["value"].alias("values"),
        F.first("source_file").alias("source_file"), F.first("file_time").alias("file_time"),
        F.max("header").alias("header"), F.lit(False).alias("is_blank"),
    )
    joined = joined.select(
        F.array_join(F.transform("values", lambda v: v.cast("string")), "\n").cast("binary").alias("value"),
        "source_file", "file_time", F.col("first_block").alias("block_start"), F.col("first_place").alias("row_no"),
        "header", "is_blank",
    )
    alone = rows.where("not part").select(*own).unionByName(parts.join(endless, FIRST, "left_semi").select(*own))
    found = alone.unionByName(joined).where(~F.col("header") & ~F.col("is_blank")).drop("header", "is_blank")
    return found.withColumns({"value": F.col("value").cast("string"), "file_time": F.timestamp_micros("file_time")})


def read_bar_records(spark: SparkSession, paths: list[str], separator: str = ";") -> DataFrame:
    """The columns of ``files.read_bars`` for files whose quoted fields hold line breaks."""
    options = {
        "sep": separator, "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "multiLine": "true",
    }
    fields = F.from_csv("value", ", ".join(f"`{f}` string" for f in RAW.fieldNames()), options)
    rows = read_records(spark, paths, separator).withColumn("fields", fields)
    return rows.select("fields.*", "source_file", "file_time", "block_start", "row_no")
