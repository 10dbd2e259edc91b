import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL text to a DataFrame over several partitions."""

    def make(rows, ddl, partitions=3):
        return spark.createDataFrame(rows, ddl).repartition(partitions)

    return make


def rows(df, *order):
    names = order or df.columns
    return sorted(tuple(r) for r in df.select(*names).collect())
