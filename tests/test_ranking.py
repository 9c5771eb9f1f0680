import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrid.operators import layout, ranking


@pytest.fixture(scope="module")
def rows(spark):
    """Distinct rows of which a third share one key; keys and order columns hold nulls."""
    rng = random.Random(3)
    made = {
        ("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]),
         rng.choice([1, 2, None]), rng.choice([None, *range(400)]))
        for _ in range(3000)
    }
    return spark.createDataFrame(list(made), "k string, a int, b int").cache()


def test_row_numbers(rows):
    order = [F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last()]
    expected = rows.withColumns(
        {
            "n": F.row_number().over(W.partitionBy("k").orderBy(*order)),
            "m": F.row_number().over(W.partitionBy("k", "a").orderBy(*order)),
        }
    )
    pieces = ["a", "floor(b / 50)"]
    found = ranking.row_numbers(rows, {"n": ["k"], "m": ["k", "a"]}, ["a", "b"], pieces)
    assert found.columns == expected.columns
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_no_window_sorts_a_whole_group(rows):
    found = ranking.row_numbers(rows, {"n": ["k"]}, ["a", "b"], ["a"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Window" in line and "sum(1)" in line]
    assert sorts and all("[_piece" in line for line in sorts)


def test_running_state(rows):
    order = [F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last()]
    number, top = F.coalesce(F.col("b") % 3, F.lit(1)), F.col("b") % 7 == 0
    through = W.partitionBy("k").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    expected = rows.withColumn("s", F.sum(number).over(through)).withColumn(
        "t", F.max(F.when(top, F.col("s"))).over(through)
    )
    pieces = ["a", "floor(b / 50)"]
    sums = {"s": (["k"], "coalesce(b % 3, 1)")}
    found = ranking.running_state(rows, ["a", "b"], pieces, sums, {"t": ("s", "b % 7 = 0")})
    assert found.columns == expected.columns
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_a_hot_piece_is_divided(spark):
    """One day, order and time hold 80 % of the rows; numbers are those of one plain window."""
    rng = random.Random(5)
    word = lambda: rng.choice([None, "".join(rng.choice("abc") for _ in range(9))])
    day, other = dt.date(2025, 1, 6), dt.date(2025, 1, 7)
    made = set()
    for _ in range(6000):
        hot = rng.random() < 0.8
        made.add((
            "X", day if hot else rng.choice([day, other]), None if hot else rng.choice([1, 2, None]),
            "0 AM" if hot else rng.choice(["0 AM", None, "09:00"]), word(), word(), word(),
        ))
    schema = (
        "calendar_id string, session_date date, display_order int, start_time string, description string, "
        "color string, officer_code string"
    )
    timed = spark.createDataFrame(list(made), schema).cache()
    order = [F.col(c).asc_nulls_last() for c in layout.TIMED_ORDER]
    expected = timed.withColumn("timed_pos", F.row_number().over(W.partitionBy(*layout.DAY_KEYS).orderBy(*order)))
    cuts = layout.timed_cuts(timed, 8).cache()
    assert cuts.count() == 1
    found = layout.timed_positions(timed, cuts)
    assert found.exceptAll(expected).count() == 0 and found.count() == expected.count()
    shared = ranking.with_share(timed, cuts, layout.TIMED_PIECE, layout.TIMED_ORDER)
    sizes = shared.groupBy(*layout.TIMED_PIECE, "share").count().agg(F.max("count")).first()[0]
    assert sizes < 2 * len(made) / 8


def test_null_keys_match(spark):
    left = spark.createDataFrame([(1, None), (2, "x")], "n int, k string")
    right = spark.createDataFrame([(None, "null"), ("x", "x")], "k string, v string")
    joined = ranking.null_safe_join(left, right, ["k"]).collect()
    assert sorted((r.n, r.k, r.v) for r in joined) == [(1, None, "null"), (2, "x", "x")]
