"""Logical role → physical table, read lazily.

Roles are plain names (``calendar``, ``weekly_base``, ``line_speed`` …) mapped
to paths or catalog tables. Nothing is staged: every read is a lazy scan, so
filters and column pruning reach the Parquet reader.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass
class Catalog:
    spark: SparkSession
    paths: dict[str, str]
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def table(self, role: str, schema: StructType | None = None) -> DataFrame:
        where = self.paths[role]
        if "/" not in where and "." in where and self.spark.catalog.tableExists(where):
            return self.spark.table(where)
        reader = self.spark.read.format(self.fmt).options(**self.options)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(where)

    def exists(self, role: str) -> bool:
        """The role's data is present (table in the catalog or a path)."""
        where = self.paths.get(role)
        if where is None:
            return False
        if "/" not in where and "." in where:
            return self.spark.catalog.tableExists(where)
        return path_exists(self.spark, where)


def path_exists(spark: SparkSession, path: str) -> bool:
    """The path has a file or folder, as Spark's own readers see it."""
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def star_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    names = [
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
    ]
    return Catalog(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})


def read_json(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Newline-delimited JSON, explicit schema when given, else inferred."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) pairs of a table."""
    return list(df.dtypes)


def has_rows(df: DataFrame) -> bool:
    """Emptiness check for reporting; never needed before a left join."""
    return not df.isEmpty()
