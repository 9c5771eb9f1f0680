"""Checks of inputs against configuration."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.operators.wording import argb_of, color_name


def unknown_colors(items: DataFrame, palette: Mapping[str, str]) -> DataFrame:
    """Colour names that items use and the palette lacks, with how often."""
    return (
        items.where(argb_of(F.col("color"), palette).isNull())
        .groupBy(color_name(F.col("color")).alias("color"))
        .agg(F.count("*").alias("n_items"))
    )


def presiding_count(presiding: DataFrame) -> int:
    """Length of the presiding list, which must not be empty."""
    count = presiding.count()
    if count < 1:
        raise ValueError("the list of presiding officers is empty")
    return count
