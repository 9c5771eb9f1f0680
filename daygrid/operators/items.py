"""Sessions and special days as calendar items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.functions.dates import sunday_week
from daygrid.functions.labels import fill_template, matches_rule, timed_label
from daygrid.sources.dimensions import Rule

ITEM_COLUMNS = (
    "calendar_id",
    "session_date",
    "start_time",
    "description",
    "color",
    "officer_code",
    "display_order",
)
# Fixed value: order of items that no rule places.
DEFAULT_ORDER = 3


def with_officers(sessions: DataFrame, officers: DataFrame) -> DataFrame:
    """Left join that adds the officer's colour. The officer list is a dimension that
    Catalyst broadcasts while it is below ``spark.sql.autoBroadcastJoinThreshold``."""
    return sessions.join(officers.select("officer_code", "color"), "officer_code", "left")


def _matches(description: Column, rules: Sequence[Rule]) -> Column:
    """The rules that match a description, as an array of (template, rule_order)."""
    none = F.array().cast("array<struct<template:string,rule_order:int>>")
    return F.concat(
        none,
        *[
            F.when(
                matches_rule(description, rule.pattern_name),
                F.array(
                    F.struct(
                        F.lit(rule.template).cast("string").alias("template"),
                        F.lit(rule.display_order).cast("int").alias("rule_order"),
                    )
                ),
            ).otherwise(none)
            for rule in rules
        ],
    )


def match_rules(sessions: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per session and matching rule, or one with nulls when none matches.

    The rule list is job configuration, so its patterns are literals of the
    plan: sessions are matched where they are scanned, with no join.
    """
    return (
        sessions.withColumn("_matches", _matches(F.col("description"), rules))
        .select("*", F.explode_outer("_matches").alias("_rule"))
        .select("*", "_rule.template", "_rule.rule_order")
        .drop("_matches", "_rule")
    )


def label_items(matched: DataFrame) -> DataFrame:
    """Item columns of matched sessions: banners (mapped) have no start time."""
    mapped = F.col("template").isNotNull()
    return matched.select(
        "calendar_id",
        "session_date",
        F.when(mapped, F.lit("")).otherwise(F.col("start_time")).alias("start_time"),
        F.when(mapped, fill_template(F.col("template"), F.col("room_code"), F.col("officer_code")))
        .otherwise(timed_label(F.col("start_time"), F.col("description"), F.col("officer_code")))
        .alias("description"),
        "color",
        "officer_code",
        F.coalesce("rule_order", F.lit(DEFAULT_ORDER)).alias("display_order"),
    )


def special_items(days: DataFrame) -> DataFrame:
    """Special days as banners."""
    return days.select(
        "calendar_id",
        "session_date",
        F.lit("").alias("start_time"),
        F.col("name").alias("description"),
        "color",
        F.lit("").alias("officer_code"),
        "display_order",
    )


def with_week(dated: DataFrame) -> DataFrame:
    return dated.withColumns(
        {"year": F.year("session_date"), "week": sunday_week(F.col("session_date"))}
    )


def calendar_items(
    sessions: DataFrame, officers: DataFrame, rules: Sequence[Rule], days: DataFrame
) -> DataFrame:
    """Distinct items of all sessions and special days, with year and week.

    Duplicates go in the partial aggregation before the shuffle, so a text that
    repeats in very many rows does not travel.
    """
    from_sessions = label_items(match_rules(with_officers(sessions, officers), rules))
    return with_week(from_sessions.unionByName(special_items(days)).distinct())
