"""The text queries that SQL can express against that SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from oracle_check import _rows, duck  # noqa: E402
from pitchlake.llm.queries import ORACLE, QUERIES  # noqa: E402

from .data import SF01  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    df, rel = QUERIES[name](spark, SF01), duck(SF01).sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(rel.columns, rel.fetchall())
    assert got == want and got
