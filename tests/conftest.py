from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from firmweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate an expression for each of some values: one(fn, values) -> results."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [r[0] for r in rows.orderBy("i").select(fn(F.col("v"))).collect()]

    return run
