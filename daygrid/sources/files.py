"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table as its splits lie; ``spark.sql.files`` settings size these. A given
    ``schema`` saves the job that reads it from the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
