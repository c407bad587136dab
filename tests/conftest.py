import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[8]").appName("carelint-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.maxMetadataStringLength", "10000")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def make(spark):
    """Context over small tables given as {name: (schema, rows)}."""
    from carelint import Context, TableSource

    def build(tables, refs=None, prev=None, **kw):
        def source(spec):
            return TableSource.from_frames(spark, {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in spec.items()})

        return Context(source=source(tables), refs=source(refs or {}), prev=source(prev) if prev is not None else None, **kw)

    return build
