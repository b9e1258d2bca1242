import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldbook.session import build_session  # noqa: E402
from fieldbook.sources.schemas import struct  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.log.level": "ERROR", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.ui.showConsoleProgress": "false",
    })
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table("id:l name:s", [(1, "a")])``"""
    return lambda spec, rows: spark.createDataFrame(rows, struct(spec))


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def tuples(df, *columns, key=repr):
    return sorted([tuple(row) for row in df.select(*(columns or df.columns)).collect()], key=key)
