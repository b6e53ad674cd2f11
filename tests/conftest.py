from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harborline.operators.skew import HOT_ROWS_CONF, HOT_SAMPLE_CONF  # noqa: E402
from harborline.schemas import RAW_COLUMNS, text_schema  # noqa: E402
from harborline.session import RUNTIME_CONF  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]").appName("harborline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def every_group_is_hot(spark):
    """Send all groups with two or more rows down the large-group path."""
    spark.conf.set(HOT_ROWS_CONF, "2")
    spark.conf.set(HOT_SAMPLE_CONF, "1.0")
    yield
    spark.conf.unset(HOT_ROWS_CONF)
    spark.conf.unset(HOT_SAMPLE_CONF)


@pytest.fixture
def raw(spark):
    """Build a landing table from tuples in contract order."""
    def make(table: str, rows: list[tuple], source: str = "file.csv", ingested: str = "2026-07-01 00:00:00"):
        df = spark.createDataFrame(rows, text_schema(RAW_COLUMNS[table]))
        return df.selectExpr("*", f"'{source}' AS _source_file", f"TIMESTAMP '{ingested}' AS _ingested_at")

    return make
