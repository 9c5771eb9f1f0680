"""Session facts from JDBC, CSV or Parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_COLUMNS = (
    "calendar_id",
    "session_date",
    "start_time",
    "description",
    "room_code",
    "officer_code",
)

# Column order of the headerless extract.
CSV_SCHEMA = (
    "session_date string, start_time string, description string, calendar_name string, "
    "officer_code string, officer_name string"
)


def _csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an extract with their fields, ``line`` for those with other than six, and the
    ``reason`` why a line is no session: its ``fields`` or its ``date``; null for sessions."""
    lines = spark.read.option("columnPruning", "false").csv(
        path,
        schema=f"{CSV_SCHEMA}, line string",
        header=False,
        quote='"',
        escape='"',
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="line",
    )
    day = F.to_date(F.try_to_timestamp("session_date"))
    return lines.withColumn("day", day).withColumn(
        "reason",
        F.when(F.col("line").isNotNull(), "fields").when(F.col("day").isNull(), "date"),
    )


def read_sessions_csv(spark: SparkSession, path: str, calendar_id: str | None = None) -> DataFrame:
    """Headerless quoted extract. It has no room code; without ``calendar_id`` the
    calendar name of each line is its calendar. An empty field is null. Lines with missing or
    further fields and those without a readable date are left out: `read_csv_rejects` has them."""
    lines = _csv_lines(spark, path).where("reason is null")
    return lines.select(
        (F.lit(calendar_id) if calendar_id else F.col("calendar_name")).alias("calendar_id"),
        F.col("day").alias("session_date"),
        "start_time",
        "description",
        F.lit(None).cast("string").alias("room_code"),
        "officer_code",
    )


def read_csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(reason, line, fields) of the lines that `read_sessions_csv` leaves out: the line as it is
    where its number of fields is wrong, its fields where its date can't be read."""
    lines = _csv_lines(spark, path).where("reason is not null")
    names = [part.split()[0] for part in CSV_SCHEMA.split(", ")]
    return lines.select("reason", "line", F.struct(*names).alias("fields"))


def read_sessions_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        *[F.to_date(c).alias(c) if c == "session_date" else F.col(c) for c in SESSION_COLUMNS]
    )


def jdbc_options(
    url: str,
    table: str,
    year: int,
    partitions: int,
    date_column: str = "SessionDate",
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for one year of a session table, split by date into parallel reads.

    The bounds only place the splits: rows outside them still arrive, so the year
    itself is a filter inside the subselect.
    """
    first, last = f"{year}-01-01", f"{year + 1}-01-01"
    return {
        **(properties or {}),
        "url": url,
        "dbtable": (
            f"(SELECT * FROM {table} WHERE {date_column} >= '{first}' "
            f"AND {date_column} < '{last}') year_sessions"
        ),
        "partitionColumn": date_column,
        "lowerBound": first,
        "upperBound": last,
        "numPartitions": str(partitions),
    }


def read_sessions_jdbc(
    spark: SparkSession, calendar_id: str, columns: Mapping[str, str], **options
) -> DataFrame:
    """``columns`` maps our column names to the table's; ``options`` go to `jdbc_options`."""
    rows = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    return rows.select(
        F.lit(calendar_id).alias("calendar_id"),
        F.to_date(columns["session_date"]).alias("session_date"),
        *[F.col(columns[c]).cast("string").alias(c) for c in SESSION_COLUMNS[2:]],
    )
