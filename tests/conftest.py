import tempfile
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

from barloom.plans.warehouse import init_tables
from barloom.session import pin_session


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("barloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barloom-tests-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="barloom-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield pin_session(session)
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    """Makes empty warehouses."""

    def make(**options):
        name = f"wh_{uuid.uuid4().hex}"
        return init_tables(spark, name, str(tmp_path / name), **options)

    return make


HEADER = "Time (UTC);Open;High;Low;Close;Volume"


def bar_line(time, open_price, close_price):
    """A line of a bar file, with decimal commas."""
    o, c = (f"{p:.3f}".replace(".", ",") for p in (open_price, close_price))
    return f"{time};{o};{o};{c};{c};0,001"


@pytest.fixture
def bar_file():
    """Writes a bar file from (time, open, close) rows or ready lines."""

    def write(path, rows):
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = [r if isinstance(r, str) else bar_line(*r) for r in rows]
        path.write_text("\n".join([HEADER, *lines]))
        return path

    return write


def ts(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def clock():
    """Run times a day apart, the first in 2030."""

    def ticks():
        now = datetime(2030, 1, 1)
        while True:
            yield now
            now += timedelta(days=1)

    source = ticks()
    return lambda: next(source)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
