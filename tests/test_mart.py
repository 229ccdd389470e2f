"""build_mart / window_keys / conflicting_keys against a brute-force join.

Random staging tables where one key holds about a third of every side; the
oracle is the literal statement (full left joins, OR window, one row per
(org_name, ngrn) by the survivor order) run in DuckDB.
"""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dimloom.plans import mart as mart_plan
from dimloom.plans.standins import joined_sql, mart_sql

HOT = 7


def _rows(rng, n, keys, make):
    out = []
    for _ in range(n):
        k = HOT if rng.random() < 0.34 else rng.choice(keys)
        out.append(make(k))
    return out


def _data(seed):
    rng = random.Random(seed)
    day = lambda: dt.datetime(2023, 1, 1) + dt.timedelta(days=rng.randrange(40))
    pick = lambda xs: rng.choice(xs)
    short = pd.DataFrame(_rows(rng, 120, list(range(20)), lambda k: {
        "ngrn": k, "dfrom": day(), "org_name": pick(["A", "B", "Нет"]),
        "status": pick(["x", "y", ""]), "org_type": pick(["ИП", "ЮЛ"])}))
    okved = pd.DataFrame(_rows(rng, 90, list(range(0, 30, 2)), lambda k: {
        "ngrn": k, "dfrom": day(), "okved_code": pick(["1", "2"]),
        "okved_text": pick(["a, b", "c"])}))
    address = pd.DataFrame(_rows(rng, 90, list(range(0, 30, 3)), lambda k: {
        "ngrn": k, "dfrom": day(), "vregion": pick(["r1", None]), "vdistrict": pick(["d", None]),
        "vnp": pick(["n1", "n2"]), "location": pick(["L1", "L2", None]),
        "vemail": pick(["e", None]), "vtels": pick(["1", "2"])}))
    return short, okved, address


def _spark(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None))


@pytest.mark.parametrize("seed,priors", [
    (1, ("2023-01-20", "2023-01-30", "2023-01-10")),
    (2, ("2023-02-05", None, "2023-01-25")),      # NULL prior: side never fresh
    (3, ("2023-01-01", "2023-01-01", "2023-01-01")),
    (4, ("2023-03-01", "2023-03-01", "2023-01-15")),
])
def test_mart_matches_brute_force(spark, seed, priors):
    short, okved, address = _data(seed)
    con = duckdb.connect()
    for name, df in (("s_t", short), ("o_t", okved), ("a_t", address)):
        con.register(name, df)

    def lit(p):
        return "NULL" if p is None else f"TIMESTAMP '{p} 00:00:00'"

    kw = dict(short="s_t", okved="o_t", address="a_t",
              ps=lit(priors[0]), po=lit(priors[1]), pa=lit(priors[2]))
    expect = con.execute(mart_sql(**kw)).fetchall()
    cols = [d[0] for d in con.description]
    s_df, o_df, a_df = _spark(spark, short), _spark(spark, okved), _spark(spark, address)
    pcols = [F.lit(None).cast("timestamp") if p is None else F.lit(p).cast("timestamp")
             for p in priors]
    for prune in (False, True):
        got = mart_plan.build_mart(s_df, o_df, a_df, *pcols, prune=prune)
        got_rows = [tuple(r[c] for c in cols) for r in got.collect()]
        assert sorted(map(repr, got_rows)) == sorted(map(repr, expect)), prune

    # window keys = groups with at least one joined row in the window
    wk = {(r["org_name"], r["ngrn"]) for r in
          mart_plan.window_keys(s_df, o_df, a_df, *pcols).collect()}
    assert wk == {(r[0], r[1]) for r in expect}

    # conflicting keys = groups with more than one (status, location) pair
    conf = con.execute(f"""
        SELECT org_name, ngrn FROM ({joined_sql(**kw)}) j GROUP BY ALL
        HAVING count(DISTINCT coalesce(status, '<n>') || '|' || coalesce(location, '<n>')) > 1
    """).fetchall()
    got = {(r["org_name"], r["ngrn"]) for r in
           mart_plan.conflicting_keys(s_df, o_df, a_df, *pcols).collect()}
    assert got == set(conf)


def test_hot_key_is_one_row_per_task_before_shuffle(spark):
    """The per-side aggregates are partial before the exchange (skew-safe)."""
    short, okved, address = _data(5)
    s_df, o_df, a_df = _spark(spark, short), _spark(spark, okved), _spark(spark, address)
    p = F.lit("2023-01-20").cast("timestamp")
    plan = mart_plan.build_mart(s_df, o_df, a_df, p, p, p)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "partial_max" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
