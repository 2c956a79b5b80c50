"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate),
and the smoke entry point runs on sf0.001."""

import os

import pytest

import __spark_entry__ as entry_mod
from tests.oracle import compare, core, duck

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")

EXPECTED_ROWS = {  # FIXTURES.md section 3
    "active_reports": 9020, "north": 2292, "trains_last_stop": 150, "top5_delayed": 5,
    "top5_delayed_current": 5, "top5_delayed_window": 5948, "top5_delayed_window_1d": 150,
    "avg_delay_1m": 8161, "avg_delay_3m": 6719, "avg_report_gap": 9020,
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert core(entry_mod.queries()) == core(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", core(entry_mod.queries()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name], SF, con)
    assert ok, msg
    if name in EXPECTED_ROWS:
        assert msg.startswith(f"{EXPECTED_ROWS[name]} rows")


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 5
    assert df.columns == ["id", "linename", "delay", "lastupdate"]
