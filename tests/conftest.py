from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from scanyard.session import tune  # noqa: E402
from scanyard.sources.roles import normalise  # noqa: E402
from scanyard.sources.schemas import ROLE_SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("scanyard-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Frame from rows of plain values; texts become times or dates as the schema says."""
    def build(schema: str, rows: list[tuple]):
        target = spark.createDataFrame([], schema).schema
        raw = ", ".join(
            f"`{f.name}` " + ("string" if f.dataType.typeName() in ("timestamp_ntz", "date")
                              else f.dataType.simpleString()) for f in target)
        df = spark.createDataFrame(rows, raw)
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target])
    return build


@pytest.fixture(scope="session")
def tables(frame):
    """All role tables: given rows where there are some, empty otherwise."""
    def build(**rows):
        return {role: normalise(frame(schema, rows.get(role, [])))
                for role, schema in ROLE_SCHEMAS.items()}
    return build


@pytest.fixture(scope="session")
def values():
    """Rows of a frame as sorted tuples."""
    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return collect


AS_OF = datetime(2001, 6, 15, 10)
