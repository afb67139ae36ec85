from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfscan import schemas, spark_session  # noqa: E402
from shelfscan.sources import health_claims  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("session")
    session = spark_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoint"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def claims(spark):
    return health_claims(spark)


def _row(schema, defaults, values):
    return tuple({**defaults, **values}.get(name) for name in schema.names)


@pytest.fixture
def source_rows(spark):
    """Source rows from keyword values; the rest is an ordinary product."""

    def make(*rows: dict):
        ordinary = {
            "code": "7890000000001",
            "product_name": [("pt", "Leite")],
            "nova_group": 1,
            "labels_tags": [],
            "categories_tags": [],
            "additives_tags": [],
            "created_t": 1600000000,
            "last_modified_t": 1700000000,
        }
        data = [_row(schemas.SOURCE, ordinary, r) for r in rows]
        return spark.createDataFrame(data, schemas.SOURCE)

    return make


@pytest.fixture
def raw_rows(spark):
    """Raw rows from keyword values; the rest is an ordinary product."""

    def make(*rows: dict):
        ordinary = {
            "code": "7890000000001",
            "product_name": "Leite",
            "nova_group": 1,
            "labels_tags": [],
            "categories_tags": [],
            "additives_tags": [],
            "created_t": 1600000000,
            "last_modified_t": 1700000000,
        }
        return spark.createDataFrame([_row(schemas.RAW, ordinary, r) for r in rows], schemas.RAW)

    return make


@pytest.fixture
def plan_of():
    """The executed plan of a DataFrame as text."""

    def text(df, run: bool = False) -> str:
        execution = df._jdf.queryExecution()
        if run:
            df.collect()
        return execution.executedPlan().toString()

    return text
