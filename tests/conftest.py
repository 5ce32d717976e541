from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (str(ROOT), os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def tiny() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(tiny):
    import duckdb

    held = duckdb.connect()
    held.execute("set timezone = 'UTC'")
    for p in sorted(Path(tiny).glob("*.parquet")):
        held.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return held
