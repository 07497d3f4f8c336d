"""Registered queries against their SQL at the smallest scale.

A part of them by default; set BARLINE_ALL_QUERIES=1 for all (minutes).
"""

from __future__ import annotations

import os

import duckdb
import pytest

from suite import oracle_sql, queries
from suite.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SOME = ["T3_", "J3_", "A7_diff_stats_nonzero_lines", "W5_rank_first_lines", "W10_calibration_lines", "W13_hourly", "W20_",
        "M6_", "P4_", "C13_compare", "S2_", "R1_"]
ALL = os.environ.get("BARLINE_ALL_QUERIES") == "1"
NAMES = [n for n in queries() if ALL or any(n.startswith(p) for p in SOME)]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(oracle_sql()[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
