"""Registering and writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame

MONTH_KEYS = ("calendar_id", "year", "month")


def register(frame: DataFrame, name: str) -> None:
    frame.createOrReplaceTempView(name)


def replace_table(frame: DataFrame, name: str, path: str | None = None) -> None:
    """Writes a table, dropping an earlier one; safe to run again. With ``path`` its files
    lie there, else in the warehouse."""
    writer = frame.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_months(grid: DataFrame, path: str, file_format: str = "parquet") -> None:
    """One folder per calendar month. Rewrites the months of ``grid`` and leaves others.

    The rebalance hint gathers each month into few files and lets adaptive
    execution split a month that is too large for one task.
    """
    (
        grid.hint("rebalance", *MONTH_KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", "true")
        .partitionBy(*MONTH_KEYS)
        .format(file_format)
        .save(path)
    )
