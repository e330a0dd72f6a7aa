"""New files of a directory as a stream: each is picked up once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.plans.arguments import INCREMENTAL, check_text
from barloom.plans.load import load_listed
from barloom.plans.refresh import refresh
from barloom.plans.warehouse import Warehouse
from barloom.session import scratch_folder
from barloom.sinks.tables import working_copy
from barloom.sources.files import BINARY_FILE, described


def ingest_stream(
    wh: Warehouse,
    directory: str,
    market: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    then_refresh: bool = False,
    task: str = "stream to staging",
) -> None:
    """Load the files that came since the last call, then stop.

    The stream carries names, sizes and times only. Its checkpoint remembers paths; the audit log
    remembers content, so a copy under another name is left out and a batch that is run again after
    a failure changes nothing. Late bars need no watermark: a refresh recomputes the years they fall in.
    """
    check_text("market", market), check_text("task", task)
    # By default files a week older than the newest one seen are passed over without a word.
    reader = wh.spark.readStream.format("binaryFile").schema(BINARY_FILE).option("maxFileAge", "36500d")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    listed = described(reader.load(directory))

    def take(batch: DataFrame, _batch_id: int) -> None:
        with scratch_folder(wh.spark, "stream") as folder:
            files = working_copy(batch, f"{folder}/listed", wh.spark)
            load_listed(wh, files, market, INCREMENTAL, None, task)
        if then_refresh:
            refresh(wh, INCREMENTAL, market)

    query = (
        listed.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
