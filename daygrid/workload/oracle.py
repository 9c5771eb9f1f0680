"""DuckDB statements with the results that the registered queries must have.

Each statement is one WITH chain over the driver's tables; the chain of a query
holds the parts it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from daygrid.functions.text import Abbreviation, active_abbreviations
from daygrid.workload import adapter


def _text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def _values(rows: Sequence[tuple]) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in rows)


def _abbreviated(text: str, abbreviations: Sequence[Abbreviation]) -> str:
    for entry in active_abbreviations(abbreviations):
        text = f"regexp_replace({text}, {_text(entry.phrase)}, {_text(entry.abbrev)}, 'gi')"
    return text


def _argb(color: str, palette: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {_text(name)} THEN {_text(argb)}" for name, argb in palette.items())
    return f"CASE coalesce(nullif({color}, ''), 'Black') {cases} END"


_REGION_CASES = " ".join(
    f"WHEN {_text(region)} THEN {_text(color)}" for region, color in adapter.REGION_COLORS.items()
)
_DAYS = ("mon", "tue", "wed", "thu", "fri")
_ITEM = (
    "calendar_id, session_date, start_time, description, color, officer_code, display_order"
)

# A rule matches where its words follow one another: each must be in what is left of the text
# after the one before it.
_IN_ORDER = """
          list_reduce(list_prepend(lower(s.description), r.words), lambda rest, word:
            CASE WHEN contains(rest, word)
                 THEN substr(rest, strpos(rest, word) + length(word)) END) IS NOT NULL"""

PARTS: dict[str, str] = {
    "sessions": """
        SELECT 'C' || (user_id % 4) AS calendar_id,
               CAST(ts AS DATE) AS session_date,
               CASE event_id % 40 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN '0 AM'
                    WHEN 4 THEN '0 AM' ELSE strftime(ts, '%H:%M') END AS start_time,
               CASE WHEN event_id % 40 IN (3, 4) THEN 'STANDBY'
                    ELSE CASE WHEN event_id % 2 = 0 THEN '(ABC) ' ELSE '(ABC-X) ' END
                      || event_type || ' - ' || regexp_extract(props, '([0-9]+)', 1)
               END AS description,
               CASE WHEN user_id % 7 <> 6 THEN CAST(user_id % 7 AS VARCHAR) END AS room_code,
               'N' || lpad(CAST(user_id % 30 AS VARCHAR), 2, '0') AS officer_code
        FROM events""",
    "officers": f"""
        SELECT n_name AS name, r_name, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS officer_code,
               CASE r_name {_REGION_CASES} END AS color, n_nationkey AS seq
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "rules": f"""
        SELECT * FROM ({_values(adapter.RULES)}) r(pattern_name, template, rule_order)""",
    "entries": f"""
        SELECT calendar_id, name, CAST(date AS DATE) AS date, CAST(b AS DATE) AS begin_date,
               CAST(e AS DATE) AS end_date, color, display_order
        FROM ({_values(adapter.SPECIAL_ROWS)}) s(calendar_id, name, date, b, e, color, display_order)
        UNION ALL
        SELECT 'C' || (o_custkey % 4), 'PRIORITY ' || substr(o_orderpriority, 3),
               CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_orderdate AS DATE) END,
               CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END,
               CASE WHEN o_orderkey % 10 <> 0
                    THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 - 1 AS INTEGER) END,
               CASE o_orderstatus WHEN 'F' THEN 'Red' WHEN 'O' THEN 'Blue' END,
               2 + o_orderkey % 2
        FROM orders""",
    "special_days": """
        SELECT calendar_id, CAST(d AS DATE) AS session_date, '' AS start_time,
               name AS description, color, '' AS officer_code,
               CAST(display_order AS INTEGER) AS display_order
        FROM (SELECT *, unnest(generate_series(
                CAST(coalesce(date, begin_date) AS TIMESTAMP),
                CAST(coalesce(date, end_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
              FROM entries)""",
    "officer_join": """
        SELECT s.*, o.color FROM sessions s LEFT JOIN officers o USING (officer_code)""",
    "rule_words": """
        SELECT template, rule_order, list_filter(
                 string_split(lower(translate(pattern_name, '-', '')), ' '),
                 lambda word: word <> '') AS words
        FROM rules""",
    "matched": f"""
        SELECT s.*, r.template, CAST(r.rule_order AS INTEGER) AS rule_order
        FROM officer_join s LEFT JOIN rule_words r ON {_IN_ORDER}""",
    "clock": """
        SELECT *, CASE WHEN regexp_full_match(start_time, '([01]?\\d|2[0-3]):[0-5]\\d(:[0-5]\\d)?')
                       THEN string_split(start_time, ':') END AS hands
        FROM matched""",
    "labels": """
        SELECT calendar_id, session_date, if(template IS NULL, start_time, '') AS start_time,
               if(template IS NULL,
                  array_to_string(
                    [(CAST(hands[1] AS INTEGER) + 11) % 12 + 1 || ':' || hands[2] || ' ',
                     regexp_replace(description, '\\([A-Z]{3}\\) ', ''),
                     format(' ({})', right(officer_code, 1))], ''),
                  if(room_code IS NULL OR officer_code IS NULL, NULL,
                     list_reduce(string_split(
                       list_reduce(string_split(template, '$CourtRoom}$'),
                                   lambda head, tail: head || room_code || tail),
                       '${JudicialOfficer}$'),
                     lambda head, tail: head || officer_code || tail))) AS description,
               color, officer_code, ifnull(rule_order, 3) AS display_order
        FROM clock""",
    "items": f"""
        SELECT *, CAST(year(session_date) AS INTEGER) AS year,
               CAST(strftime(session_date, '%U') AS INTEGER) AS week
        FROM (SELECT {_ITEM} FROM labels UNION SELECT {_ITEM} FROM special_days)""",
    "slots": """
        SELECT *, CAST(row_number() OVER (PARTITION BY calendar_id, year
                    ORDER BY week, display_order, description) AS INTEGER) AS row_num
        FROM (SELECT DISTINCT calendar_id, year, week, display_order, description
              FROM items WHERE start_time = '')""",
    "spine": """
        SELECT calendar_id, CAST(d AS DATE) AS session_date,
               CAST(year(d) AS INTEGER) AS year, CAST(strftime(d, '%U') AS INTEGER) AS week
        FROM (SELECT calendar_id, year, unnest(generate_series(
                CAST(min(session_date) AS TIMESTAMP), CAST(max(session_date) AS TIMESTAMP),
                INTERVAL 1 DAY)) AS d
              FROM items GROUP BY calendar_id, year)
        WHERE isodow(d) <= 5""",
    "banners": """
        SELECT *, row_number() OVER (PARTITION BY calendar_id, session_date, description
                    ORDER BY display_order, color, officer_code) AS nth
        FROM items WHERE start_time = ''""",
    "aligned": """
        SELECT p.calendar_id, p.session_date, '' AS start_time,
               CASE WHEN b.nth IS NULL THEN '' ELSE b.description END AS description,
               CASE WHEN b.nth IS NULL THEN '' ELSE b.color END AS color,
               CASE WHEN b.nth IS NULL THEN '' ELSE b.officer_code END AS officer_code,
               CASE WHEN b.nth IS NULL THEN 999 ELSE b.display_order END AS display_order,
               p.year, p.week, s.row_num
        FROM spine p
        JOIN slots s ON s.calendar_id = p.calendar_id AND s.year = p.year AND s.week = p.week
        LEFT JOIN (SELECT * FROM banners WHERE nth = 1) b
          ON b.calendar_id = p.calendar_id AND b.session_date = p.session_date
         AND b.description IS NOT DISTINCT FROM s.description""",
    "slotted": f"""
        SELECT {_ITEM}, year, week, row_num, 0 AS kind FROM aligned
        UNION ALL
        SELECT {_ITEM}, year, week, 9999, 1 FROM items WHERE start_time IS DISTINCT FROM ''""",
    "positions": """
        SELECT *, CAST(row_number() OVER (PARTITION BY calendar_id, session_date
                    ORDER BY kind, row_num, display_order, start_time, description, color,
                             officer_code) AS INTEGER) AS pos
        FROM slotted WHERE isodow(session_date) <= 5""",
    "years": """
        SELECT DISTINCT calendar_id, year FROM items""",
    "month_list": """
        SELECT calendar_id, year, m.month,
               make_date(year, m.month, 1) AS month_start,
               last_day(make_date(year, m.month, 1)) AS month_end
        FROM years, (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month) m""",
    "workdays": """
        SELECT *, CAST(dense_rank() OVER (PARTITION BY calendar_id, year, month
                    ORDER BY week) AS INTEGER) AS week_block
        FROM (SELECT calendar_id, year, month, CAST(d AS DATE) AS session_date,
                     CAST(strftime(d, '%U') AS INTEGER) AS week,
                     CAST(isodow(d) AS INTEGER) AS dow,
                     CAST(day(d) AS VARCHAR) AS day_text
              FROM (SELECT *, unnest(generate_series(CAST(month_start AS TIMESTAMP),
                      CAST(month_end AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM month_list))
        WHERE dow <= 5""",
    "day_grid": "SELECT calendar_id, year, month, week, week_block, "
    + ", ".join(
        f"coalesce(max(CASE WHEN dow = {n} THEN day_text END), 'Empty') AS {name}"
        for n, name in enumerate(_DAYS, start=1)
    )
    + " FROM workdays GROUP BY calendar_id, year, month, week, week_block",
    "worded": f"""
        SELECT calendar_id, session_date, year, week, pos,
               CAST(month(session_date) AS INTEGER) AS month,
               CAST(isodow(session_date) AS INTEGER) AS dow,
               CASE WHEN coalesce(short, '') = '' THEN short
                    ELSE short || '-[' || {_argb("color", adapter.PALETTE)} || ']' END AS tagged
        FROM (SELECT *, CASE WHEN coalesce(start_time, '') <> ''
                             THEN {_abbreviated("description", adapter.ABBREVIATIONS)}
                             ELSE description END AS short
              FROM positions)""",
    "item_grid": "SELECT calendar_id, year, month, week, pos, "
    + ", ".join(
        f"max(CASE WHEN dow = {n} THEN tagged END) AS {name}"
        for n, name in enumerate(_DAYS, start=1)
    )
    + " FROM worded GROUP BY calendar_id, year, month, week, pos",
    "kept": """
        SELECT calendar_id, year, month, week, session_date, dow, tagged,
               CAST(dense_rank() OVER (PARTITION BY calendar_id, year, month, week
                      ORDER BY pos) AS INTEGER) AS pos
        FROM worded WHERE coalesce(tagged, '') <> ''""",
    "starts": """
        SELECT *, tagged = 'Empty' OR regexp_matches(tagged, '^[0-9]') AS loose,
               CASE WHEN lag(tagged) OVER r = tagged AND lag(dow) OVER r = dow - 1
                    THEN 0 ELSE 1 END AS opens
        FROM kept
        WINDOW r AS (PARTITION BY calendar_id, year, month, week, pos ORDER BY dow)""",
    "runs": """
        SELECT *, sum(opens) OVER (PARTITION BY calendar_id, year, month, week, pos
                                   ORDER BY dow) AS run
        FROM starts""",
    "spans": """
        SELECT *, CASE WHEN NOT loose AND n >= 2 THEN lo END AS span_first,
               CASE WHEN NOT loose AND n >= 2 THEN CAST(n AS INTEGER) END AS span_days
        FROM (SELECT *, min(dow) OVER g AS lo, count(*) OVER g AS n FROM runs
              WINDOW g AS (PARTITION BY calendar_id, year, month, week, pos, run))""",
    "decoded": """
        SELECT calendar_id, year, month, week, session_date, dow, pos, span_first, span_days,
               CASE WHEN argb IS NULL THEN tagged
                    ELSE regexp_replace(tagged, '-\\[.*?\\]', '', 'g') END AS text,
               argb,
               CASE WHEN argb IS NULL THEN NULL
                    WHEN regexp_matches(tagged, '^[0-9]') THEN 'timed' ELSE 'banner' END AS role
        FROM (SELECT *, nullif(regexp_extract(tagged, '-\\[([^\\]]+)\\]', 1), '') AS argb
              FROM spans)""",
    "segments": """
        SELECT *, count(span_days) OVER day AS segment,
               coalesce(max(CASE WHEN span_days IS NOT NULL THEN pos END) OVER day, 0) AS wall
        FROM decoded WHERE span_days IS NOT NULL OR text <> ''
        WINDOW day AS (PARTITION BY calendar_id, session_date ORDER BY pos
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "compacted": """
        SELECT *, CAST(CASE WHEN span_days IS NOT NULL THEN pos
                       ELSE wall + row_number() OVER (
                         PARTITION BY calendar_id, session_date, segment, span_days IS NULL
                         ORDER BY pos) END AS INTEGER) AS new_pos
        FROM segments""",
    "shown": """
        SELECT *, span_days IS NULL OR dow = span_first AS visible FROM compacted""",
    "body": "SELECT calendar_id, year, month, week, new_pos AS pos, 'items' AS kind, "
    + ", ".join(
        f"max(CASE WHEN dow = {n} AND visible THEN {value} END) AS {name}{suffix}"
        for n, name in enumerate(_DAYS, start=1)
        for value, suffix in (
            ("text", ""),
            ("argb", "_argb"),
            ("role", "_role"),
            ("coalesce(span_days, 1)", "_span"),
        )
    )
    + " FROM shown GROUP BY calendar_id, year, month, week, new_pos",
    "heads": "SELECT calendar_id, year, month, week, 0 AS pos, 'days' AS kind, "
    + ", ".join(
        f"{name}, CAST(NULL AS VARCHAR) AS {name}_argb, CAST(NULL AS VARCHAR) AS {name}_role, "
        f"1 AS {name}_span"
        for name in _DAYS
    )
    + " FROM day_grid",
    "sheet": """
        SELECT * EXCLUDE (pos), CAST(row_number() OVER (PARTITION BY calendar_id, year, month
                                   ORDER BY week, pos) AS INTEGER) AS grid_row
        FROM (SELECT * FROM heads UNION ALL BY NAME SELECT * FROM body)""",
    "titles": f"""
        SELECT calendar_id, year, month, monthname(month_start) AS month_name,
               CAST(day(month_end) AS INTEGER) AS days_in_month, name AS presiding,
               monthname(month_start) || ' ' || year AS sheet_name,
               monthname(month_start) || ' ' || year || ' Master Calendar' AS title,
               'Presiding: ' || name AS subtitle
        FROM month_list JOIN (
          SELECT name, row_number() OVER (ORDER BY seq) - 1 AS turn, count(*) OVER () AS turns
          FROM officers WHERE r_name = {_text(adapter.PRESIDING_REGION)}) o
          ON (month - 1) % turns = turn""",
}

# Which parts each part reads, in the order above.
_READS = {
    name: [other for other in PARTS if other != name and f" {other} " in f" {body} ".replace(
        "\n", " ").replace(")", " ").replace(",", " ")]
    for name, body in PARTS.items()
}


def _needed(names: Sequence[str]) -> list[str]:
    wanted, queue = set(), list(names)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += [n for n in _READS[name] if list(PARTS).index(n) < list(PARTS).index(name)]
    return [name for name in PARTS if name in wanted]


def statement(select: str, *parts: str) -> str:
    chain = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name]})" for name in _needed(parts))
    return f"WITH {chain}\n{select}" if chain else select


_PAINT = f"""
    SELECT calendar_id, session_date, tagged,
           CASE WHEN argb IS NULL THEN tagged
                ELSE regexp_replace(tagged, '-\\[.*?\\]', '', 'g') END AS text,
           role, CASE WHEN role = 'banner' THEN argb END AS fill_argb,
           CASE WHEN role = 'timed' THEN argb END AS font_argb
    FROM (SELECT *, CASE WHEN argb IS NULL THEN NULL
                         WHEN regexp_matches(tagged, '^[0-9]') THEN 'timed'
                         ELSE 'banner' END AS role
          FROM (SELECT *, nullif(regexp_extract(tagged, '-\\[([^\\]]+)\\]', 1), '') AS argb
                FROM (SELECT *, CASE WHEN coalesce(short, '') = '' THEN short
                                     ELSE short || '-[' || {_argb("color", adapter.PALETTE)} || ']'
                                END AS tagged
                      FROM (SELECT *, CASE WHEN coalesce(start_time, '') <> ''
                              THEN {_abbreviated("description", adapter.ABBREVIATIONS)}
                              ELSE description END AS short FROM items))))"""

_MATCHED = f"""
    SELECT s.*, r.template, CAST(r.rule_order AS INTEGER) AS rule_order
    FROM sessions s LEFT JOIN rule_words r ON {_IN_ORDER}"""

ORACLE: dict[str, str] = {
    "items_officer_join": statement("SELECT * FROM officer_join", "officer_join"),
    "items_rule_match": statement(_MATCHED, "sessions", "rule_words"),
    "items_rule_match_distinct": statement(_MATCHED, "sessions", "rule_words"),
    "item_labels": statement("SELECT * FROM labels", "labels"),
    "special_days": statement("SELECT * FROM special_days", "special_days"),
    "calendar_items": statement("SELECT * FROM items", "items"),
    "calendar_items_one_year": statement("SELECT * FROM items WHERE year = 2024", "items"),
    "week_slots": statement("SELECT * FROM slots", "slots"),
    "date_spine": statement("SELECT * FROM spine", "spine"),
    "slot_aligned": statement("SELECT * FROM aligned", "aligned"),
    "slotted_all": statement("SELECT * FROM slotted", "slotted"),
    "week_of_year_orders": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
               CAST(strftime(o_orderdate, '%U') AS INTEGER) AS week,
               CAST(isodow(o_orderdate) AS INTEGER) AS weekday
        FROM orders""",
    "abbreviate_text": statement(
        f"""SELECT * REPLACE (CASE WHEN coalesce(start_time, '') <> ''
              THEN {_abbreviated("description", adapter.ABBREVIATIONS)}
              ELSE description END AS description) FROM items""",
        "items",
    ),
    "abbreviate_documents": (
        f"SELECT doc_id, {_abbreviated('text', adapter.DOCUMENT_ABBREVIATIONS)} AS text "
        "FROM documents"
    ),
    "item_colors": statement(_PAINT, "items"),
    "unknown_colors": statement(
        """SELECT color, count(*) AS n_items
           FROM (SELECT coalesce(nullif(color, ''), 'Black') AS color FROM items)
           WHERE color NOT IN ("""
        + ", ".join(map(_text, adapter.PARTIAL_PALETTE))
        + ") GROUP BY color",
        "items",
    ),
    "month_titles": statement("SELECT * FROM titles", "titles"),
    "month_day_grid": statement("SELECT * FROM day_grid", "day_grid"),
    "day_positions": statement(
        """SELECT w.calendar_id, w.year, w.session_date, w.month, w.week, w.dow, w.week_block,
                  p.start_time, p.description, p.color, p.officer_code, p.display_order,
                  p.row_num, p.pos, p.kind
           FROM workdays w LEFT JOIN positions p USING (calendar_id, session_date)""",
        "workdays",
        "positions",
    ),
    "month_item_grid": statement("SELECT * FROM item_grid", "item_grid"),
    "span_runs": statement(
        """SELECT calendar_id, year, month, week, pos, span_first AS first_dow,
                  span_first + span_days - 1 AS last_dow, span_days AS n_days, tagged
           FROM spans WHERE dow = span_first""",
        "spans",
    ),
    "compacted_cells": statement(
        """SELECT calendar_id, year, month, week, dow, new_pos, text, argb, role,
                  span_first, span_days FROM compacted""",
        "compacted",
    ),
    "final_grid": statement("SELECT * FROM sheet", "sheet"),
    "month_files_roundtrip": statement("SELECT * FROM sheet", "sheet"),
    "month_sheets": statement(
        """SELECT s.*, t.sheet_name, t.title, t.subtitle
           FROM sheet s JOIN titles t USING (calendar_id, year, month)""",
        "sheet",
        "titles",
    ),
    "replaced_table_roundtrip": statement("SELECT * FROM slots", "slots"),
    "csv_rejects": """
        SELECT CASE WHEN event_id % 50 IN (3, 4) THEN 'fields' WHEN event_id % 50 IN (1, 2) THEN 'date'
                    ELSE 'accepted' END AS reason, count(*) AS n_lines
        FROM events GROUP BY reason""",
    "csv_sessions": statement(
        """SELECT calendar_id, session_date, nullif(start_time, '') AS start_time, description,
                  CAST(NULL AS VARCHAR) AS room_code, officer_code FROM sessions""",
        "sessions",
    ),
}
