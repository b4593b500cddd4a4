from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from schoolmetrics.schemas import ENTITIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("schoolmetrics-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Build entity tables from short rows: `make(users=[dict(id="u1", role="student")], ...)`."""

    def frame(entity: str, rows: list[dict]) -> DataFrame:
        start = datetime(2024, 9, 1)
        defaults = {"created_at": start, "updated_at": start, "is_active": True, "metadata": "{}"}
        names = ENTITIES[entity].names
        filled = [
            tuple({**defaults, "id": f"{entity}-{i}", **row}.get(n) for n in names) for i, row in enumerate(rows)
        ]
        relaxed = ENTITIES[entity].jsonValue()
        for field in relaxed["fields"]:
            field["nullable"] = True
        return spark.createDataFrame(filled, type(ENTITIES[entity]).fromJson(relaxed))

    return lambda **tables: {name: frame(name, tables.get(name, [])) for name in ENTITIES}


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def rows():
    return rows_of
