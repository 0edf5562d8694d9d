"""Every registered query against its DuckDB oracle on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    query = contract.queries()[name]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert query(spark, SF_DIR).count() > 0
    else:
        assert differences(spark, duck, SF_DIR, name, query, sql) == []


def test_jobs_end_with_a_status(spark, tmp_path, capsys):
    from convoy.__main__ import load, main, quality

    assert main([]) == 2
    lake = str(tmp_path / "lake")
    assert quality(spark, lake) == 1
    assert load(spark, lake, str(tmp_path / "raw")) == 0
    folder = tmp_path / "lake/events/order/event_date=2026-01-01/event_type=order"
    folder.mkdir(parents=True)
    (folder / "broken.parquet").write_text("no parquet")
    assert load(spark, lake, str(tmp_path / "raw")) == 1
