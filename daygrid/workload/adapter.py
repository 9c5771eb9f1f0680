"""The engine's inputs, made from the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.text import Abbreviation
from daygrid.plans.calendar import Calendar
from daygrid.plans.staging import drop_staged
from daygrid.sources import dimensions
from daygrid.sources.dimensions import Rule
from daygrid.sources.files import read_table

# A hyphen, a blank, overlapping rules with equal texts, a template cut before its
# last placeholder character, a rule without order and one without template.
RULES = [
    Rule("pur-chase", "PURCHASE DESK (${JudicialOfficer}$-$CourtRoom}$)", 0),
    Rule("cli ck", "CLICK DESK (${JudicialOfficer}$-$CourtRoom}", 1),
    Rule("view", "VIEW DESK (${JudicialOfficer}$-$CourtRoom}$)", 1),
    Rule("view -", "VIEW DESK (${JudicialOfficer}$-$CourtRoom}$)", 2),
    Rule("view - 1", "SHORT VIEW (${JudicialOfficer}$)", None),
    Rule("error - 9", None, 4),
]

# The second 'error' phrase never fires, the lone symbol changes nothing, and one
# replacement holds a character that regex replacement texts treat specially.
ABBREVIATIONS = [
    Abbreviation("Error", "ERR"),
    Abbreviation("error - 1", "E1"),
    Abbreviation("SIGN", "$1GN"),
    Abbreviation("-", "~"),
    Abbreviation("gnup - 7", "GN7"),
]

DOCUMENT_ABBREVIATIONS = [
    Abbreviation("that", "TT"),
    Abbreviation("the", "TH"),
    Abbreviation("there", "TR"),
    Abbreviation("tion", "TN"),
    Abbreviation("and", "$AND"),
    Abbreviation("ou", "U"),
    Abbreviation("que", "Q"),
    Abbreviation("ich", "IC"),
]

PALETTE = {
    "Black": "FF000000",
    "Red": "FFFF0000",
    "Blue": "FF0000FF",
    "Green": "FF008000",
    "Purple": "FF800080",
    "Orange": "FFFFA500",
    "Teal": "FF008080",
    "White": "FFFFFFFF",
}
PARTIAL_PALETTE = {name: argb for name, argb in PALETTE.items() if name != "Teal"}

REGION_COLORS = {
    "AFRICA": "Green",
    "AMERICA": "Purple",
    "EUROPE": "Orange",
    "MIDDLE EAST": "Teal",
}

# The officers of this region preside; their numbers have gaps.
PRESIDING_REGION = "AMERICA"
UNREADABLE_TIME = "0 AM"

# Ranges, single dates, a duplicate, a weekend, null colours, a range that ends
# before it begins, and one name with two orders in a week.
_D = dt.date
SPECIAL_ROWS = [
    ("C0", "WINTER BREAK", None, _D(2024, 1, 2), _D(2024, 1, 5), "Black", 2),
    ("C0", "NEW YEAR", _D(2024, 1, 1), None, None, "White", 3),
    ("C0", "CONFERENCE", None, _D(2024, 1, 10), _D(2024, 1, 17), None, 2),
    ("C1", "NEW YEAR", _D(2024, 1, 1), None, None, "White", 3),
    ("C1", "NEW YEAR", _D(2024, 1, 1), None, None, "White", 3),
    ("C1", "WEEKEND FAIR", None, _D(2024, 1, 13), _D(2024, 1, 14), "Red", 2),
    ("C1", "PANEL-R", _D(2024, 1, 15), None, None, "Red", 2),
    ("C1", "PANEL-R", _D(2024, 1, 17), None, None, "Blue", 3),
    ("C2", "BACKWARDS", None, _D(2024, 1, 20), _D(2024, 1, 18), "Red", 2),
    ("C2", "4TH FLOOR CLOSED", None, _D(2024, 1, 22), _D(2024, 1, 24), None, 1),
    ("C3", "NEW YEAR", _D(2024, 1, 1), None, None, None, 3),
    ("C3", "AUDIT", None, _D(2024, 1, 29), _D(2024, 2, 2), "", 0),
]


# The columns that the queries read, as the tables declare them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "documents": "doc_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of the events. Some have no start time, an empty one or one that can't be
    read; those of the last kind have equal texts, so that neighbours of a week may merge."""
    user = F.col("user_id")
    room = user % 7
    odd = F.col("event_id") % 40
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("C"), user % 4).alias("calendar_id"),
        F.to_date("ts").alias("session_date"),
        F.when(odd == 1, F.lit(None))
        .when(odd == 2, "")
        .when(odd.isin(3, 4), UNREADABLE_TIME)
        .otherwise(
            F.concat_ws(
                ":",
                F.lpad(F.hour("ts").cast("string"), 2, "0"),
                F.lpad(F.minute("ts").cast("string"), 2, "0"),
            )
        )
        .alias("start_time"),
        F.when(odd.isin(3, 4), "STANDBY")
        .otherwise(
            F.concat(
                F.when(F.col("event_id") % 2 == 0, "(ABC) ").otherwise("(ABC-X) "),
                F.col("event_type"),
                F.lit(" - "),
                F.regexp_extract("props", "[0-9]+", 0),
            )
        )
        .alias("description"),
        F.when(room != 6, room.cast("string")).alias("room_code"),
        F.concat(F.lit("N"), F.lpad((user % 30).cast("string"), 2, "0")).alias("officer_code"),
    )


def extract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a headerless extract of the events, of which some are broken."""
    kind = F.col("event_id") % 50
    day = F.when(kind == 1, "").when(kind == 2, "tomorrow").otherwise(F.to_date("ts").cast("string"))
    name = F.concat(F.lit('"'), F.col("event_type"), F.lit(', ""quoted"""'))
    whole = F.concat_ws(",", day, F.lit("09:00"), name, F.lit("C1"), F.lit("N01"), F.lit("Officer"))
    short, long = F.concat_ws(",", day, F.lit("09:00"), name), F.concat(whole, F.lit(",more,and more"))
    return table(spark, sf_dir, "events").select(
        F.when(kind == 3, short).when(kind == 4, long).otherwise(whole).alias("value")
    )


def rules(spark: SparkSession) -> DataFrame:
    return dimensions.rules(spark, RULES)


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    color = F.col("r_name")
    cases = F.lit(None).cast("string")
    for region, name in REGION_COLORS.items():
        cases = F.when(color == region, name).otherwise(cases)
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_name").alias("name"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(
            "officer_code"
        ),
        cases.alias("color"),
        F.col("n_nationkey").alias("seq"),
        (color == PRESIDING_REGION).alias("presides"),
    )


def presiding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nations(spark, sf_dir).where("presides").drop("presides")


def officers(spark: SparkSession, sf_dir: str) -> DataFrame:
    others = _nations(spark, sf_dir).where("NOT presides").drop("presides")
    return dimensions.all_officers(presiding(spark, sf_dir), others)


def order_specials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Special dates of several years: single dates and ranges from the orders."""
    day = F.to_date("o_orderdate")
    single = F.col("o_orderkey") % 10 == 0
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey") % 4).alias("calendar_id"),
        F.concat(F.lit("PRIORITY "), F.substring("o_orderpriority", 3, 20)).alias("name"),
        F.when(single, day).alias("date"),
        F.when(~single, day).alias("begin_date"),
        F.when(~single, F.date_add(day, (F.col("o_orderkey") % 9 - 1).cast("int"))).alias(
            "end_date"
        ),
        F.when(F.col("o_orderstatus") == "F", "Red")
        .when(F.col("o_orderstatus") == "O", "Blue")
        .alias("color"),
        (F.col("o_orderkey") % 2 + 2).cast("int").alias("display_order"),
    )


def specials(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge_rows = dimensions.specials(spark, SPECIAL_ROWS)
    return edge_rows.unionByName(order_specials(spark, sf_dir))


_open: list[Calendar] = []


def close_calendars(spark: SparkSession) -> None:
    """Deletes what the registered queries staged; call it once their results are written."""
    while _open:
        _open.pop().close()
    drop_staged(spark)


def calendar(spark: SparkSession, sf_dir: str, **options) -> Calendar:
    made = Calendar(
        sessions(spark, sf_dir),
        officers(spark, sf_dir),
        RULES,
        specials(spark, sf_dir),
        ABBREVIATIONS,
        PALETTE,
        presiding=presiding(spark, sf_dir),
        **options,
    )
    _open.append(made)
    return made
