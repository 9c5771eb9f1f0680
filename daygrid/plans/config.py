"""A calendar from one configuration document, such as a JSON file."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from daygrid.operators.months import TITLE_TEMPLATES
from daygrid.plans.calendar import Calendar
from daygrid.sources import dimensions


def calendar_from_config(
    sessions: DataFrame, config: Mapping[str, Any], year: int | None = None, **options
) -> Calendar:
    """Lists of records under ``officers``, ``rules``, ``specials``, ``abbreviations`` and
    ``colors``, and where month titles are wanted, the officers who preside under
    ``presiding`` and templates under ``titles``. A ``calendar_year`` in the document,
    unless null, overrides ``year``."""
    spark = sessions.sparkSession

    def officers(records: Sequence[Mapping[str, Any]]) -> DataFrame:
        names = "name officer_code color seq"
        return dimensions.officers(spark, [_fields(record, names) for record in records])

    others, presiding = officers(config["officers"]), None
    if config.get("presiding"):
        presiding = officers(config["presiding"])
        others = dimensions.all_officers(presiding, others)
    named_year = config.get("calendar_year")
    return Calendar(
        sessions,
        others,
        dimensions.rules_of(config["rules"]),
        dimensions.specials(
            spark,
            [
                (
                    *_fields(s, "calendar_id name"),
                    *map(_date, _fields(s, "date begin_date end_date")),
                    *_fields(s, "color display_order"),
                )
                for s in config["specials"]
            ],
        ),
        dimensions.abbreviations_of(config["abbreviations"]),
        dimensions.palette_of([_fields(c, "color_name argb") for c in config["colors"]]),
        year=year if named_year is None else named_year,
        presiding=presiding,
        templates={**TITLE_TEMPLATES, **(config.get("titles") or {})},
        **options,
    )


def _fields(record: Mapping[str, Any], names: str) -> tuple:
    return tuple(record.get(name) for name in names.split())


def _date(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None
