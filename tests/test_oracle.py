"""Every registered query against its DuckDB SQL at sf0.01 (the driver's gate),
plus the smoke entry at sf0.001."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as E  # noqa: E402
from pitchlake.plans.catalog import QUERIES as CORE  # noqa: E402
from conftest import SF01  # noqa: E402
from oracle_check import compare, duck  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_sql():
    assert set(CORE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert r["ok"], r.get("why")
    assert r["types_ok"], r.get("why")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["l_returnflag", "l_linestatus", "n_lines", "usage_pct", "avg_qty", "avg_price", "avg_disc", "avg_tax"]
