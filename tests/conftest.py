import os

import pytest

from lakemill import build_session

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RUN_TS = "2025-06-01 00:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """All rows as tuples, sorted."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
