"""Text files for other tools."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.parsing import comma_text, time_text
from barloom.session import scratch_folder
from barloom.sources.files import list_files


def joined_text(df: DataFrame, separator: str = ";") -> DataFrame:
    """Each row as one line of text; nulls are empty fields."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(separator, *fields).alias("value"))


def export_csv(df: DataFrame, path: str, separator: str = ";", header: bool = True) -> None:
    df.write.option("sep", separator).option("header", header).csv(path)


def export_by_key(df: DataFrame, path: str, keys: list[str], separator: str = ";") -> None:
    """One folder of files per key value. A large key is written by many tasks."""
    df.write.partitionBy(*keys).option("sep", separator).option("header", True).csv(path)


def export_in_order(
    df: DataFrame, path: str, order: list[str], as_text: Callable[[DataFrame], DataFrame], separator: str = ";"
) -> None:
    """One text file of all rows, in order, under a header; ``as_text`` makes the fields of the sorted rows.

    Ranges are sorted side by side and written as parts. One task then strings the parts together, some lines
    at a time, so its memory does not grow with the file.
    """
    spark = df.sparkSession
    text = as_text(df.repartitionByRange(*order).sortWithinPartitions(*order))
    header = separator.join(text.columns)

    def strung(batches):
        import io

        import pandas as pd
        from pyarrow import fs

        yield pd.DataFrame({"value": [header]})
        for batch in batches:
            for uri in batch["uri"]:
                files, place = fs.FileSystem.from_uri(uri)
                with io.TextIOWrapper(files.open_input_file(place), encoding="utf-8", newline="\n") as lines:
                    while some := lines.readlines(1 << 20):
                        yield pd.DataFrame({"value": [line.removesuffix("\n") for line in some]})

    with scratch_folder(spark, "parts") as folder:
        export_csv(text, folder, separator, header=False)
        number = F.regexp_extract("file", "^part-([0-9]+)", 1).cast("int")
        parts = list_files(spark, folder).select("uri", number.alias("number")).coalesce(1).sortWithinPartitions("number")
        parts.select("uri").mapInPandas(strung, "value string").write.text(path)


def as_bar_text(bars: DataFrame, price_type: str) -> DataFrame:
    """Bars in the text form of a bar file: decimal commas, high and low spanning open and close."""
    open_price, close_price = F.col("open").cast(price_type), F.col("close").cast(price_type)
    return bars.select(
        time_text(F.col("time")).alias("time"),
        comma_text(open_price).alias("open"),
        comma_text(F.greatest(open_price, close_price)).alias("high"),
        comma_text(F.least(open_price, close_price)).alias("low"),
        comma_text(close_price).alias("close"),
        F.lit("0").alias("volume"),
    )
