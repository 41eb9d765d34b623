"""Every registered advertising query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from adlake.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(df, columns):
    def cell(v):
        if not isinstance(v, str) and pd.isna(v):
            return "null"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(cell, r)) for r in df[columns].astype(object).itertuples(index=False))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("bi_")] + ["bi_realtime_daily", "bi_creative_kpi_latest_roas", "bi_attribution_share_gmv", "bi_creative_detail", "bi_retention_daily"])
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)
