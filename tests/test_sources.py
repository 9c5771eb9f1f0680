import datetime as dt
import json

from pyspark.sql import functions as F

from daygrid.functions.dates import rows_of_year
from daygrid.plans import staging
from daygrid.sinks import tables
from daygrid.sources import dimensions, sessions
from daygrid.sources.dimensions import Rule
from daygrid.sources.files import read_table


def test_csv_extract(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(
        '﻿2025-09-02,08:30,(ABC) one,Civil (Day),ABC,"DOE, JO"\n'
        '2025-09-03,,"(ABC) two, ""three""",Civil (Day),ABC,"DOE, JO"\n',
        encoding="utf-8",
    )
    rows = sessions.read_sessions_csv(spark, str(path), "X").orderBy("session_date").collect()
    assert [tuple(r) for r in rows] == [
        ("X", dt.date(2025, 9, 2), "08:30", "(ABC) one", None, "ABC"),
        ("X", dt.date(2025, 9, 3), None, '(ABC) two, "three"', None, "ABC"),
    ]
    assert sessions.read_sessions_csv(spark, str(path)).first().calendar_id == "Civil (Day)"


def test_parquet_sessions_and_year(spark, tmp_path):
    path = str(tmp_path / "sessions")
    frame = spark.createDataFrame(
        [("X", dt.datetime(y, 1, 1, 9), "09:00", "d", "1", "A") for y in (2024, 2025)],
        "calendar_id string, session_date timestamp, start_time string, description string, "
        "room_code string, officer_code string",
    )
    frame.write.parquet(path)
    rows = sessions.read_sessions_parquet(spark, path)
    one = rows_of_year(rows, 2025)
    assert [r.session_date for r in one.collect()] == [dt.date(2025, 1, 1)]
    assert rows_of_year(rows, None).count() == 2


def test_jdbc_options():
    options = sessions.jdbc_options(
        "jdbc:x:y", "dbo.Sessions", 2025, 16, properties={"user": "u", "fetchsize": "5000"}
    )
    assert options == {
        "url": "jdbc:x:y",
        "dbtable": (
            "(SELECT * FROM dbo.Sessions WHERE SessionDate >= '2025-01-01' "
            "AND SessionDate < '2026-01-01') year_sessions"
        ),
        "partitionColumn": "SessionDate",
        "lowerBound": "2025-01-01",
        "upperBound": "2026-01-01",
        "numPartitions": "16",
        "user": "u",
        "fetchsize": "5000",
    }


def test_dimensions_from_json(spark, tmp_path):
    officers = tmp_path / "officers.json"
    officers.write_text(json.dumps({"name": "a", "officer_code": "A", "color": None, "seq": 0}))
    specials = tmp_path / "specials.json"
    specials.write_text(json.dumps({"calendar_id": "X", "name": "d", "date": "2025-01-01"}))
    assert dimensions.read_officers(spark, str(officers)).first().officer_code == "A"
    assert dimensions.read_specials(spark, str(specials)).first().date == dt.date(2025, 1, 1)
    assert dimensions.rules_of([{"pattern_name": "p", "template": "t", "display_order": 1}]) == [
        Rule("p", "t", 1)
    ]
    merged = dimensions.abbreviations_of(
        [{"phrase": "a", "abbrev": "1"}, {"phrase": "b", "abbrev": "2"}, {"phrase": "a", "abbrev": "3"}]
    )
    assert [(m.phrase, m.abbrev) for m in merged] == [("a", "3"), ("b", "2")]
    assert dimensions.palette_of([("Red", "FFFF0000")]) == {"Red": "FFFF0000"}


def test_configuration_rows_are_a_local_relation(spark):
    plan = dimensions.officers(spark, [("a", "A", None, 0)])._jdf.queryExecution().toString()
    assert "LocalTableScan" in plan


def test_tables_are_read_as_they_lie(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(100).coalesce(1).write.parquet(path)
    for rows in (read_table(spark, path), read_table(spark, path, "id bigint")):
        assert "Exchange" not in rows._jdf.queryExecution().toString()
        assert rows.count() == 100


def test_staged_tables_live_in_the_named_folder(spark, tmp_path):
    staged = staging.stage(spark.range(5), "numbers")
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
    assert staged.count() == 5


def test_tables_can_be_replaced(spark):
    for n in (3, 4):
        tables.replace_table(spark.range(n), "numbers")
        assert spark.table("numbers").count() == n
    tables.register(spark.range(6), "seen")
    assert spark.sql("SELECT count(*) FROM seen").first()[0] == 6


def test_months_are_folders_and_rewritten_alone(spark, tmp_path):
    grid = spark.range(24).select(
        F.lit("X").alias("calendar_id"),
        F.lit(2025).alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
        F.col("id").alias("grid_row"),
    )
    for kind in ("parquet", "csv"):
        path = str(tmp_path / kind)
        tables.write_months(grid, path, kind)
        assert (tmp_path / kind / "calendar_id=X" / "year=2025" / "month=12").is_dir()
        tables.write_months(grid.where("month = 3 AND grid_row < 12"), path, kind)
        back = spark.read.option("header", "true").format(kind).load(path)
        assert back.count() == 23


def test_staged_tables_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(staging, "_staged", [])
    path = staging.new_scratch_path(spark, "dropped")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    staging.drop_staged(spark)
    assert staging._staged == []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
