"""CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_table(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None
) -> DataFrame:
    """A CSV table with a header row.

    Types are inferred, which reads the files once more. Give a schema for
    large tables to skip that pass.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)
