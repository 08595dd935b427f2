from __future__ import annotations

import glob
import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierstone.contracts import CONTRACTS  # noqa: E402
from tierstone.session import build_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tierstone-tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def shop(spark):
    return ShopFrames(spark)


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{TINY}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


T0 = datetime(2024, 1, 30, 12)


class ShopFrames:
    """Tiny bronze tables from literal rows."""

    def __init__(self, spark):
        self.spark = spark

    def _frame(self, name, rows):
        return self.spark.createDataFrame(rows, CONTRACTS[name].schema)

    def users(self, *rows):
        """Rows (id, first, last, email)."""
        return self._frame("bronze.users", [(*r, T0, T0) for r in rows])

    def items(self, *rows):
        """Rows (id, name, category, price)."""
        return self._frame("bronze.items", [(*r[:3], _dec(r[3]), 1, T0, T0) for r in rows])

    def purchases(self, *rows):
        """Rows (id, user, item, quantity, unit price[, time])."""
        return self._frame(
            "bronze.purchases",
            [(*r[:4], _dec(r[4]), r[5] if len(r) > 5 else T0, T0) for r in rows],
        )

    def pageviews(self, *rows):
        """Rows (user, url, channel[, time])."""
        return self._frame(
            "bronze.pageviews", [(*r[:3], r[3] if len(r) > 3 else T0) for r in rows]
        )


def _dec(text):
    return None if text is None else Decimal(text)


def final_plan(df) -> str:
    """Physical plan after adaptive execution."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("\n+- == Initial Plan ==")[0]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
