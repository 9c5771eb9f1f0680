import pytest
from compare import differences, duckdb_views

import __spark_entry__ as entry_module
from daygrid.workload.adapter import close_calendars
from daygrid.workload.oracle import ORACLE
from daygrid.workload.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return duckdb_views(SF_DIR)


def test_every_query_has_a_statement():
    assert set(REGISTRY) == set(ORACLE) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_oracle(spark, oracle, name):
    frame = entry_module.queries()[name](spark, SF_DIR)
    assert differences(frame, oracle, entry_module.oracle_sql()[name]) == []


def test_closing_deletes_what_queries_staged(spark, tmp_path, monkeypatch):
    close_calendars(spark)
    monkeypatch.setattr("daygrid.plans.staging.scratch_dir", lambda _: str(tmp_path))
    for name in ("week_slots", "csv_rejects"):
        REGISTRY[name](spark, SF_DIR).collect()
    assert len(list((tmp_path / "daygrid").iterdir())) == 2
    close_calendars(spark)
    assert not list((tmp_path / "daygrid").iterdir())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
