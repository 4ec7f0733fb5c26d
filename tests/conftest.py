from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lanemart.session import build_session  # noqa: E402

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
    }
    session = build_session("lanemart-tests", master="local[4]", conf=conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def root():
    if not Path(ROOT).exists():
        pytest.skip("driver tables are not here")
    return ROOT


@pytest.fixture
def values(spark):
    """Evaluate an expression over a list of input values of one type."""

    def run(kind: str, inputs, expression):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}").coalesce(1)
        return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]

    return run
