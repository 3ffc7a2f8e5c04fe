import os

import pytest

from kerbside.session import build_session

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.default.parallelism": "8",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def check_dir():
    """Large enough for every query to find rows."""
    return f"{TESTDATA}/sf0.01"
