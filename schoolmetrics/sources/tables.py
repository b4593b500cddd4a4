"""Reading, checking and writing the entity and result tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from schoolmetrics.schemas import ENTITIES


class LazyTables(Mapping[str, DataFrame]):
    """Named tables, each built on first use."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Use df under this name from now on."""
        self._built[name] = df

    def __contains__(self, name: object) -> bool:
        return name in self._builders

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the schema's columns and types; the job fails on a NULL in a required column."""
    return df.select(*[_checked(field) for field in schema.fields])


def _checked(field: StructField) -> Column:
    value = F.col(field.name).cast(field.dataType)
    if not field.nullable:
        value = F.coalesce(value, F.raise_error(F.lit(f"NULL in required column {field.name}")))
    return value.alias(field.name)


def violations(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows `conform` would fail on: some required column is NULL, or becomes NULL when cast."""
    required = [F.col(f.name).try_cast(f.dataType).isNull() for f in schema.fields if not f.nullable]
    return df.where(reduce(or_, required, F.lit(False)))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan a table by path; with a schema given no file is opened to infer one."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> str:
    """Replace the table at path, optionally partitioned; returns the path."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store it lies."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of written files, if it is there, in whatever store it lies."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def ingest(df: DataFrame, entity: str, path: str) -> str:
    """Check rows against an entity's schema and replace its table."""
    return write_table(conform(df, ENTITIES[entity]), path)


def read_entities(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The seven entity tables below a root folder."""
    return {name: read_table(spark, f"{root}/{name}", schema) for name, schema in ENTITIES.items()}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make each table available to SQL under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def literal_table(spark: SparkSession, rows: Iterable[tuple[Any, ...]], schema: StructType | str) -> DataFrame:
    """A small table of values known to the caller."""
    return spark.createDataFrame(list(rows), schema)
