"""Dimension rows: officers, match rules, special dates, phrases and colours."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from daygrid.functions.dates import rows_of_year
from daygrid.functions.text import Abbreviation

OFFICER_SCHEMA = "name string, officer_code string, color string, seq int"
SPECIAL_SCHEMA = (
    "calendar_id string, name string, date date, begin_date date, end_date date, "
    "color string, display_order int"
)


RULE_SCHEMA = "pattern_name string, template string, display_order int"


class Rule(NamedTuple):
    """Maps descriptions that match ``pattern_name`` to a banner text."""

    pattern_name: str | None
    template: str | None
    display_order: int | None


def _local_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Configuration rows as a local relation of the plan: Arrow data needs no Python
    worker, and Catalyst knows its size."""
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    arrow = pa.table(
        [pa.array(values, to_arrow_type(f.dataType)) for values, f in zip(columns, fields)],
        names=fields.names,
    )
    return spark.createDataFrame(arrow, fields)


def officers(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return _local_table(spark, rows, OFFICER_SCHEMA)


def read_officers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OFFICER_SCHEMA).json(path)


def all_officers(presiding: DataFrame, others: DataFrame) -> DataFrame:
    """Both officer lists as one; an officer code listed twice fans its sessions out."""
    return presiding.unionByName(others)


def rules(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Match rules as a table; `rules_of` has them as a list of the job's configuration."""
    return _local_table(spark, rows, RULE_SCHEMA)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RULE_SCHEMA).json(path)


def specials(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return _local_table(spark, rows, SPECIAL_SCHEMA)


def read_specials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SPECIAL_SCHEMA).json(path)


def special_days(entries: DataFrame, year: int | None = None) -> DataFrame:
    """One row per day of each entry: its single date, or every day of its range.

    A range without an end is its first day. One that ends before it begins has
    no days (``sequence`` alone would count down). With ``year``, entries outside
    it are left out before their days are made.
    """
    first = F.coalesce("date", "begin_date")
    last = F.coalesce("date", "end_date", "begin_date")
    held = entries.where(last >= first)
    if year is not None:
        held = held.where((F.year(first) <= year) & (F.year(last) >= year))
    days = held.select(
        "calendar_id",
        F.explode(F.sequence(first, last)).alias("session_date"),
        "name",
        "color",
        "display_order",
    )
    return rows_of_year(days, year)


def rules_of(rows: Iterable[Mapping]) -> list[Rule]:
    return [Rule(row["pattern_name"], row["template"], row["display_order"]) for row in rows]


def abbreviations_of(rows: Iterable[Mapping]) -> list[Abbreviation]:
    """Phrase list in order; a repeated phrase keeps its first place and takes its last value."""
    merged: dict[str, Abbreviation] = {}
    for row in rows:
        merged[row["phrase"]] = Abbreviation(
            row["phrase"], row["abbrev"], bool(row.get("skip", False))
        )
    return list(merged.values())


def palette_of(rows: Sequence[tuple[str, str]]) -> dict[str, str]:
    return dict(rows)
