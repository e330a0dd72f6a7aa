"""The set of tables one installation works on."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schemas
from barloom.functions.calendar import MONTH_NAMES
from barloom.session import pin_session, remove_path
from barloom.sinks import tables as sink
from barloom.sinks import versions
from barloom.sinks.versions import Change, DataFile, State, VersionLog
from barloom.sources.files import LINES, check_identity

# Number of a file within its slice, as a folder name.
PART = "part"
PENDING = "pending"


@dataclass(frozen=True)
class Warehouse:
    """Landing, staging and result tables below one root, with their audit log.

    All tables change by commits: a run's rows, what they replace and its audit events come at once.
    ``carry`` and ``missing`` shape the stored result, and ``identity`` says which files count as loaded before
    (``sources.files.checksums``), so they belong to the installation and not to a single run.
    """

    spark: SparkSession
    database: str
    root: str
    price_type: str = schemas.DEFAULT_PRICE_TYPE
    carry: bool = False
    missing: str = "null"
    identity: str = LINES

    @property
    def log(self) -> VersionLog:
        return versions.log_of(self.spark, self.root)

    def table(self, table: str, state: State | None = None, within: Iterable[tuple[str, ...]] | None = None) -> DataFrame:
        """A table as of a state, by default the newest; optionally only slices that begin like some values.

        The rows stay those of that state, whatever is committed later.
        """
        log = self.log
        state = state or log.state()
        return self.rows(table, state.files(table, within))

    def rows(self, table: str, files: Iterable[DataFile]) -> DataFrame:
        schema, by = _definitions(self.price_type)[table]
        return versions.read_files(self.log, files, _folder(table), schema, by)

    def write(self, table: str, rows: DataFrame) -> list[DataFile]:
        """Files of new rows, in the table's columns and types; they count once they are committed."""
        schema, by = _definitions(self.price_type)[table]
        kept = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        part = F.col(PART) if PART in rows.columns else F.lit(0).alias(PART)
        time = "time" if table == "staging" else None
        return versions.write_files(self.log, rows.select(*kept, *[part] * (PART in by)), _folder(table), by, time)

    def append(self, table: str, rows: DataFrame) -> None:
        """Adds rows to a table by a commit of their own."""
        change = Change()
        change.put(table, self.write(table, rows))
        self.log.commit(change, self.log.state())

    def as_views(self, prefix: str = "", state: State | None = None) -> None:
        """The tables as temporary views for SQL, all of one version."""
        state = state or self.log.state()
        for name in _definitions(self.price_type):
            self.table(name, state).createOrReplaceTempView(f"{prefix}{name}")


def _definitions(price_type: str) -> dict[str, tuple]:
    percent = schemas.PERCENT_TYPE
    return {
        "landing": (schemas.landing_schema(), ["market", "load_id"]),
        "staging": (schemas.staging_schema(price_type), ["market", "year", PART]),
        "slices": (schemas.slices_schema(), []),
        "prices": (schemas.prices_schema(price_type), ["market"]),
        "changes": (schemas.changes_schema(percent), ["market"]),
        "overview": (schemas.overview_schema(MONTH_NAMES, percent), ["market"]),
        "audit": (schemas.AUDIT, []),
        # Files of the audit table whose events are not folded into runs yet.
        PENDING: (schemas.AUDIT, []),
        "runs": (schemas.RUNS, ["layer", "market"]),
        "taken": (schemas.TAKEN, ["layer", "market"]),
    }


def _folder(table: str) -> str:
    return "audit" if table == PENDING else table


def init_tables(
    spark: SparkSession,
    database: str,
    root: str,
    price_type: str = schemas.DEFAULT_PRICE_TYPE,
    drop: bool = False,
    carry: bool = False,
    missing: str = "null",
    identity: str = LINES,
) -> Warehouse:
    """Create the database and its tables below ``root``, first dropping old ones if asked to.

    An installation keeps the options it was made with; opening it with others is an error. Its root is that
    of the database in the catalog.
    """
    pin_session(spark)
    check_identity(identity)
    options = {"price_type": price_type.replace(" ", ""), "carry": str(carry).lower(), "missing": missing}
    if identity != LINES:  # an installation that names none has this one
        options["identity"] = identity
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {sink.quote(database)} LOCATION {sink.text_literal(root)}")
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    log = versions.log_of(spark, root)
    if drop:
        for folder in {*map(_folder, _definitions(price_type)), versions.FOLDER}:
            remove_path(spark, f"{log.root}/{folder}")
        versions.forget(log)
    kept = log.state().options
    asked, had = ({"identity": LINES} | o for o in (options, kept))
    wrong = [k for k, v in asked.items() if k in had and had[k] != v] if kept else []
    if wrong:
        raise ValueError(", ".join(f"{k} is {had[k]}, not {asked[k]}" for k in wrong))
    if not kept:
        log.commit(Change(), log.state(), options=options)
    return Warehouse(spark, database, log.root, price_type, carry, missing, identity)


def compact_logs(wh: Warehouse) -> None:
    """Fewer, larger files for the tables that grow by a small append per run."""
    for table in ("audit", "slices"):
        compact(wh, table)


def compact(wh: Warehouse, table: str, within: list[tuple[str, ...]] | None = None) -> None:
    """Rewrites a table, or some slices of it, in as few files as their size asks for.

    Appends that are committed meanwhile stay; a run that removes some of the files makes this one start anew.
    """
    while True:
        state = wh.log.state()
        old = state.files(table, within)
        if len(old) < 2:
            return
        change = Change()
        change.put(table, wh.write(table, wh.spark.sql("SELECT /*+ REBALANCE */ * FROM {df}", df=wh.rows(table, old))), old)
        try:
            wh.log.commit(change, state)
            return
        except versions.Overtaken:
            continue


def expire(wh: Warehouse, older_than: timedelta) -> int:
    """Removes versions and replaced files of an age at which no reader needs them; gives the number of files."""
    return versions.expire(wh.log, older_than.total_seconds())
