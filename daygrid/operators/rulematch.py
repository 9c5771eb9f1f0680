"""Matching descriptions against a table of rules of any length, by an index of the rules.

A rule matches where its words follow one another, also inside longer words, so whole words
can't find it. Each rule is posted under one gram of its words, up to three letters, which
every description that matches must hold: the one that the fewest descriptions have. Rules
meet the descriptions with their gram, and only these pairs are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.functions.labels import matches_pattern, rule_pattern_of
from daygrid.operators.ranking import null_safe_join

#: Letters of the longest grams; shorter words are found by shorter ones.
GRAM = 3


def _pieces(text: Column, size: Column | int) -> Column:
    """All substrings of ``size`` letters; none if the text is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - size + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(text, i, size))


def rule_grams(rules: DataFrame) -> DataFrame:
    """``rules`` with an id, their LIKE pattern and every gram that they can be posted under.

    Grams come from the stretches between wildcards. Rules without any are found under the
    empty gram, which every description has.
    """
    pattern = rule_pattern_of(F.col("pattern_name"))
    stretches = F.filter(F.split(F.lower(F.col("pattern")), "[%_]"), lambda s: s != "")
    size = F.least(F.lit(GRAM), F.coalesce(F.array_max(F.transform("stretches", F.length)), F.lit(0)))
    grams = F.flatten(F.transform("stretches", lambda s: _pieces(s, F.col("size"))))
    return (
        rules.select("template", F.col("display_order").alias("rule_order"), pattern.alias("pattern"))
        .withColumn("stretches", stretches)
        .withColumn("size", size)
        .withColumn("grams", F.when(F.col("size") == 0, F.array(F.lit(""))).otherwise(F.array_distinct(grams)))
        .drop("stretches", "size")
    )


def description_grams(descriptions: DataFrame) -> DataFrame:
    """Every description with each of its different grams; null ones match nothing."""
    low = F.lower("description")
    grams = F.concat(F.array(F.lit("")), *[_pieces(low, n) for n in range(1, GRAM + 1)])
    return descriptions.where("description is not null").select(
        "description", F.explode(F.array_distinct(grams)).alias("gram")
    )


def rule_matches(descriptions: DataFrame, rules: DataFrame) -> DataFrame:
    """(description, template, rule_order) of every rule that matches a distinct description.

    A gram that no description has counts as the rarest, so its rules meet nothing.
    """
    posted = rule_grams(rules)
    held = description_grams(descriptions)
    wanted = posted.select(F.explode("grams").alias("gram")).distinct()
    counts = held.join(wanted, "gram").groupBy("gram").agg(F.count("*").alias("n"))
    patterns = posted.select("pattern", "grams").distinct()
    entries = (
        patterns.select("pattern", F.explode("grams").alias("gram"))
        .join(counts, "gram", "left")
        .groupBy("pattern")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest"))
        .select("pattern", "rarest.gram")
    )
    met = held.join(entries, "gram").where(
        matches_pattern(F.col("description"), F.col("pattern"))
    )
    return met.join(posted.drop("grams"), "pattern").select("description", "template", "rule_order")


def match_rule_table(sessions: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per session and matching rule, or one with nulls when none matches, as
    `items.match_rules` gives for a list of rules.

    Distinct descriptions are matched, so a text that repeats in very many sessions is
    compared once.
    """
    matches = rule_matches(sessions.select("description").distinct(), rules)
    return null_safe_join(sessions, matches, ["description"], "left")
