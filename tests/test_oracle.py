"""Every registered query that has SQL gives the rows DuckDB gives."""

from __future__ import annotations

import math
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as driver
import duckdb_oracle

ORACLE = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_duckdb(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    wanted = sorted((tuple(map(plain, r)) for r in result.fetchall()), key=repr)
    got = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    assert got == wanted
    assert got


def test_only_models_lack_sql():
    assert set(ORACLE) <= set(driver.queries())
    without = set(driver.queries()) - set(ORACLE) - set(driver._training_data_queries())
    assert without == {"M1", "M3", "M4", "M5", "M6", "C5", "C6", "C7", "C8", "C9"}


def test_entry(spark):
    assert driver.entry(spark).count() == 25


def test_the_rest_works_without_training_data(tmp_path):
    """A copy without the subpackage and its tests, with and without the pipeline, still registers every other query."""
    root = Path(driver.__file__).parent
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(root, tmp_path / "copy", ignore=left_out)
    script = "import __spark_entry__ as d; print(len(d.queries()), len(d.oracle_sql()))"
    known = len(driver.queries()) - len(driver._training_data_queries())
    for _ in range(2):
        run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
        assert run.stdout.split() == [str(known), str(len(duckdb_oracle.oracle_sql()))]
        (tmp_path / "copy" / "corpus_pipeline.py").unlink(missing_ok=True)
    collected = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=tmp_path / "copy", capture_output=True, text=True
    )
    assert collected.returncode == 0, collected.stdout
