from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sousflow.session import ADAPTIVE_DEFAULTS, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[4]").appName("sousflow-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # a non-UTC zone: results must not depend on the session timezone
               .config("spark.sql.session.timeZone", "America/New_York"))
    for k, v in ADAPTIVE_DEFAULTS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if ensure_checkpoint_dir(session) is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sousflow-test-ckpt-"))
    yield session


@pytest.fixture(scope="session")
def tables(spark):
    from tests.fixtures import spark_tables

    return spark_tables(spark)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from tests.fixtures import register_duckdb

    con = duckdb.connect()
    register_duckdb(con)
    return con
