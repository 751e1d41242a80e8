import os
import sys

import pytest
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from fleethealth import schema as S  # noqa: E402
from fleethealth.operators.skew import HOT_ROWS_CONF  # noqa: E402
from fleethealth.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Make every key above a few rows count as heavy."""
    spark.conf.set(HOT_ROWS_CONF, "8")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


@pytest.fixture
def frame(spark):
    """frame({"a": [..], ...}): a DataFrame typed by column name."""
    def make(columns: dict, **types):
        schema = T.StructType([T.StructField(n, types.get(n, S.column_type(n))) for n in columns])
        return spark.createDataFrame(list(zip(*columns.values())), schema)

    return make
