"""Driver contract and plan shape."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from dimloom.constants import ALL_OPTION
from dimloom.operators import portal
from dimloom.plans.queries import QUERIES
from dimloom.schemas import MART_COLUMNS
from scripts.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == MART_COLUMNS
    rows = df.select("org_name", "ngrn").collect()
    assert rows and len(set(rows)) == len(rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["mart_build", "mart_upsert", "dim_ngrns", "keep_first",
                                  "watermark_prior", "portal_options", "check_not_null"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_portal_filter_reaches_parquet_scan(spark, workdir):
    mart = QUERIES["mart_join_left"](spark, SF)
    path = os.path.join(workdir, "mart")
    mart.write.parquet(path)
    sel = portal.portal_filter(spark.read.parquet(path),
                               {"status": "F", "org_type": ALL_OPTION}, "1998-01-01", "2001-01-01")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(status,F)" in pushed and "GreaterThanOrEqual(date" in pushed
