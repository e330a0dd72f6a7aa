"""The whole way from a directory of files to the year by month table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from barloom.plans.arguments import check_basis, check_mode, check_text
from barloom.plans.load import clean_to_staging, load_landing, load_staging
from barloom.plans.refresh import overview, refresh
from barloom.plans.warehouse import Warehouse


def run(
    wh: Warehouse,
    directory: str,
    market: str,
    mode: str,
    basis: str = "both",
    through_landing: bool = True,
    run_ts: datetime | None = None,
    task: str = "monthly overview",
) -> DataFrame:
    """Load a directory for a market, refresh the results, and return the market's overview."""
    check_text("directory", directory), check_text("market", market), check_text("task", task)
    check_mode(mode), check_basis(basis)
    if through_landing:
        load_landing(wh, directory, market, mode, run_ts, task)
        clean_to_staging(wh, mode, market, run_ts, task)
    else:
        load_staging(wh, directory, market, mode, run_ts, task)
    refresh(wh, mode, market, run_ts, task)
    return overview(wh, market, basis)
