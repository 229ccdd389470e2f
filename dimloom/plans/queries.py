"""Registered queries: one per operator, over the whole driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and, where SQL can express
it, ``ORACLE[name]``: the DuckDB SQL of the same result (brute force where
ours is clever, e.g. the mart). Names of computed columns are identical on
both sides.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.constants import ALL_OPTION, FEED_KINDS, MART_KEYS, MART_UPDATE_COLS, NONE_TEXT
from dimloom.functions.columns import (fill_default, json_field, nested_field, org_name,
                                       org_type, period_text)
from dimloom.operators import checks, dedup, portal
from dimloom.operators import watermark as wmk
from dimloom.operators.ids import materialize, with_dense_ids
from dimloom.operators.upsert import changing, insert_ignore, new_members, upsert
from dimloom.plans import mart as mart_plan
from dimloom.plans.shape import SHAPERS
from dimloom.plans.standins import (FEED_ORDER, SEED_SQL, SQL_BASE, STG_COLS_SQL,
                                    Standins, feed_schema_ntz, joined_sql, mart_sql)
from dimloom.schemas import DIMENSIONS, MART_COLUMNS, MART_FOREIGN_KEYS, STG_COLUMNS
from dimloom.session import scratch_dir
from dimloom.sources.feeds import read_feed, write_empty_feed, write_feed
from dimloom.sources.sinks import append

Q = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Q] = {}
ORACLE: dict[str, str] = {}
N = NONE_TEXT
TABLES = ("short", "address", "okved")
KIND_OF = {"short": "short_info", "address": "contact_info", "okved": "okved_info"}
PRIOR_SQL = {"short": "(SELECT ps FROM p)", "address": "(SELECT pa FROM p)",
             "okved": "(SELECT po FROM p)"}
AS_OF = _dt.date(2025, 1, 1)  # "today" of period_bounds: an argument, never current_date()


def query(name: str, sql: str | None = None):
    def deco(fn: Q) -> Q:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _stg(spark, sf) -> Standins:
    return Standins(spark, sf)


def _union_all(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------
# Projection and shaping
# --------------------------------------------------------------------------
@query("project", SQL_BASE + """
SELECT o_custkey AS ngrn, o_orderdate AS dfrom, nullif(o_orderstatus, 'P') AS vfio,
       o_orderpriority AS vnaim, o_orderstatus AS status
FROM orders""")
def q_project(spark, sf):
    raw = _stg(spark, sf).raw_short()
    return (raw.select("ngrn", "dfrom", "vfio", "vnaim", "nsi00219")
               .withColumn("status", F.col("nsi00219.vnsostk"))
               .drop("nsi00219"))


@query("fill_default", SQL_BASE + f"SELECT {STG_COLS_SQL['address']} FROM stg_address")
def q_fill_default(spark, sf):
    return _stg(spark, sf).stg_address()


@query("org_name", SQL_BASE + "SELECT ngrn, dfrom, org_name FROM stg_short")
def q_org_name(spark, sf):
    return _stg(spark, sf).stg_short().select("ngrn", "dfrom", "org_name")


@query("org_type", SQL_BASE + "SELECT ngrn, dfrom, org_type FROM stg_short")
def q_org_type(spark, sf):
    return _stg(spark, sf).stg_short().select("ngrn", "dfrom", "org_type")


@query("extract_field", """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS location FROM events""")
def q_extract_field(spark, sf):
    e = _stg(spark, sf).table("events")
    return e.select("event_id", json_field("props", "k").alias("location"))


@query("extract_nested", SQL_BASE + "SELECT ngrn, dfrom, okved_code, okved_text FROM stg_okved")
def q_extract_nested(spark, sf):
    return _stg(spark, sf).stg_okved()


@query("period_bounds", SQL_BASE + f"""
SELECT source, strftime((SELECT max(max_dfrom) FROM wm_short), '%d.%m.%Y') AS start_text,
       strftime(own, '%d.%m.%Y') AS own_start_text,
       strftime(DATE '{AS_OF.isoformat()}', '%d.%m.%Y') AS end_text
FROM (SELECT 'short_info' AS source, (SELECT max(max_dfrom) FROM wm_short) AS own
      UNION ALL SELECT 'contact_info', (SELECT max(max_dfrom) FROM wm_address)
      UNION ALL SELECT 'okved_info', (SELECT max(max_dfrom) FROM wm_okved)) t""")
def q_period_bounds(spark, sf):
    s = _stg(spark, sf)
    start = wmk.current(s.wm("short")).scalar()  # one start for all feeds (short's mark)
    parts = [wmk.current(s.wm(t)).select(F.lit(KIND_OF[t]).alias("source"),
                                         period_text(start).alias("start_text"),
                                         period_text(wmk.COL).alias("own_start_text"),
                                         period_text(F.lit(AS_OF)).alias("end_text"))
             for t in TABLES]
    return _union_all(parts)


# --------------------------------------------------------------------------
# Dedup (D1, D2, D5, D6, W2, F7)
# --------------------------------------------------------------------------
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("keep_first", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
    {', '.join(c + ' ASC NULLS FIRST' for c in LINE_ORDER)}) AS rn FROM lineitem) t
WHERE rn = 1""")
def q_keep_first(spark, sf):
    return dedup.keep_first(_stg(spark, sf).table("lineitem"), ["l_orderkey"], LINE_ORDER)


@query("dedup_row_number", SQL_BASE + """
SELECT id, ngrn, dfrom, org_name, status, org_type FROM (
  SELECT o_orderkey AS id, *, row_number() OVER (PARTITION BY ngrn, dfrom, org_name, status
                                                 ORDER BY o_orderkey) AS rnum
  FROM stg_short) t
WHERE rnum = 1""")
def q_dedup_row_number(spark, sf):
    raw = _stg(spark, sf).raw_short()
    rows = fill_default(raw.select(
        F.col("o_orderkey").alias("id"), "ngrn", "dfrom",
        org_name("vfio", "vnaim").alias("org_name"),
        nested_field("nsi00219", "vnsostk").alias("status"),
        org_type("vfio").alias("org_type")))
    return (dedup.number_within(rows, ["ngrn", "dfrom", "org_name", "status"], ["id"])
                 .filter(F.col("rnum") == 1).drop("rnum"))


@query("dedup_address", SQL_BASE + """
SELECT id, ngrn, location FROM (
  SELECT event_id AS id, ngrn, location, row_number() OVER (PARTITION BY ngrn, location ORDER BY event_id) AS rnum
  FROM stg_address) t
WHERE rnum = 1""")
def q_dedup_address(spark, sf):
    raw = _stg(spark, sf).raw_address()
    rows = fill_default(raw.select(F.col("event_id").alias("id"), "ngrn", nested_field("nsi00202", "vnsfull").alias("location")))
    return dedup.number_within(rows, ["ngrn", "location"], ["id"]).filter(F.col("rnum") == 1).drop("rnum")


@query("dedup_okved", SQL_BASE + """
SELECT l_orderkey, l_linenumber, okved_code, okved_text FROM (
  SELECT l_orderkey, l_linenumber, okved_code, okved_text,
         row_number() OVER (PARTITION BY okved_code, okved_text ORDER BY l_orderkey, l_linenumber) AS rnum
  FROM stg_okved) t
WHERE rnum = 1""")
def q_dedup_okved(spark, sf):
    raw = _stg(spark, sf).raw_okved()
    rows = fill_default(raw.select("l_orderkey", "l_linenumber", nested_field("nsi00114", "vkvdn").alias("okved_code"),
                                   nested_field("nsi00114", "vnvdnp").alias("okved_text")))
    return (dedup.number_within(rows, ["okved_code", "okved_text"], ["l_orderkey", "l_linenumber"])
                 .filter(F.col("rnum") == 1).drop("rnum"))


@query("stg_distinct", "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem) t")
def q_stg_distinct(spark, sf):
    li = _stg(spark, sf).table("lineitem")
    return dedup.distinct_rows(li.unionByName(li))


@query("distinct_on", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM orders) t
WHERE rn = 1""")
def q_distinct_on(spark, sf):
    o = _stg(spark, sf).table("orders")
    return dedup.distinct_on(o, ["o_custkey"],
                             [F.col("o_orderdate").desc_nulls_last(),
                              F.col("o_orderkey").desc_nulls_last()])


# --------------------------------------------------------------------------
# Watermarks
# --------------------------------------------------------------------------
def _per_source(fn, col_sql: str, name: str):
    sql = SQL_BASE + "\n" + " UNION ALL ".join(
        f"SELECT '{KIND_OF[t]}' AS source, {col_sql.format(t=t, p=PRIOR_SQL[t])} AS {name}"
        for t in TABLES)
    return sql


@query("watermark_current", _per_source(None, "(SELECT max(max_dfrom) FROM wm_{t})", "max_dfrom"))
def q_watermark_current(spark, sf):
    s = _stg(spark, sf)
    return _union_all([wmk.current(s.wm(t)).select(F.lit(KIND_OF[t]).alias("source"), wmk.COL)
                       for t in TABLES])


@query("watermark_prior", _per_source(None, "{p}", "prior"))
def q_watermark_prior(spark, sf):
    s = _stg(spark, sf)
    return _union_all([wmk.prior(s.wm(t)).select(F.lit(KIND_OF[t]).alias("source"), "prior")
                       for t in TABLES])


@query("watermark_next", _per_source(None, "(SELECT max(dfrom) FROM stg_{t})", "max_dfrom"))
def q_watermark_next(spark, sf):
    s = _stg(spark, sf)
    return _union_all([wmk.next_mark(s.stg(t)).select(F.lit(KIND_OF[t]).alias("source"), wmk.COL)
                       for t in TABLES])


def _wm_advance_sql() -> str:
    parts = []
    for t in TABLES:
        before = (f"SELECT {SEED_SQL} AS max_dfrom UNION SELECT max(dfrom) FROM stg_{t} "
                  f"WHERE date_trunc('month', dfrom) < (SELECT max(date_trunc('month', dfrom)) FROM stg_{t}) "
                  f"GROUP BY date_trunc('month', dfrom)")
        parts.append(f"SELECT '{KIND_OF[t]}' AS source, max_dfrom FROM ({before} UNION "
                     f"SELECT max(dfrom) FROM stg_{t} HAVING max(dfrom) IS NOT NULL) w{t}")
    return SQL_BASE + "\n" + " UNION ALL ".join(parts)


@query("watermark_advance", _wm_advance_sql())
def q_watermark_advance(spark, sf):
    s = _stg(spark, sf)
    return _union_all([wmk.advance(s.wm(t, exclude_last_month=True), s.stg(t))
                       .select(F.lit(KIND_OF[t]).alias("source"), wmk.COL) for t in TABLES])


def _marks_sql(t: str) -> str:
    return f"(SELECT max(max_dfrom) FROM wm_{t}) AS mark, {PRIOR_SQL[t]} AS prior"


@query("watermark_step", SQL_BASE + "\n" + " UNION ALL ".join(f"SELECT '{KIND_OF[t]}' AS source, {_marks_sql(t)}" for t in TABLES))
def q_watermark_step(spark, sf):
    """The two largest marks after the last month, carried on from the month before by that month's maximum alone."""
    s, rows = _stg(spark, sf), []
    for t in TABLES:
        before = s.wm(t, exclude_last_month=True).select(F.unix_micros(F.col(wmk.COL).cast("timestamp")).alias("m"))
        marks = [r["m"] for r in before.orderBy(F.col("m").desc()).limit(2).collect()]  # two numbers of the last manifest
        last = s.stg(t).agg(F.max(F.trunc("dfrom", "month"))).scalar()
        delta = s.stg(t).where(F.trunc("dfrom", "month") == last)
        seen = delta.agg(F.unix_micros(F.max("dfrom").cast("timestamp"))).first()[0]
        marks, _, _ = wmk.step(marks, marks[0] if len(marks) > 1 else None, seen)
        rows.append((KIND_OF[t], *[*marks, None][:2]))
    found = spark.createDataFrame(rows, "source string, mark long, prior long")  # three rows
    return found.select("source", *[F.timestamp_micros(c).cast("timestamp_ntz").alias(c) for c in ("mark", "prior")])


@query("stage_since", SQL_BASE + f"""
SELECT {STG_COLS_SQL['short']} FROM stg_short WHERE dfrom >= (SELECT ps FROM p)""")
def q_stage_since(spark, sf):
    """The fresh rows out of a store's staging: only the slots since the prior mark are listed."""
    from dimloom.sources.state import StateStore, slot

    s = _stg(spark, sf)
    store = StateStore(spark, scratch_dir(spark, "stage-since"))
    cycle = store.begin(store.initialize())
    rows = s.stg_short().withColumn("dfrom", F.col("dfrom").cast("timestamp"))
    store.append("stg_short", rows, cycle, slot(F.unix_micros("dfrom")), ["ngrn"])
    store.publish(cycle)
    prior = wmk.prior(s.wm("short")).select(F.unix_micros(F.col("prior").cast("timestamp"))).first()[0]
    return store.read_since("stg_short", cycle, prior).withColumn("dfrom", F.col("dfrom").cast("timestamp_ntz"))


@query("incremental_filter", SQL_BASE + f"""
SELECT {STG_COLS_SQL['short']} FROM stg_short WHERE dfrom >= (SELECT ps FROM p)""")
def q_incremental_filter(spark, sf):
    s = _stg(spark, sf)
    return wmk.fresh(s.stg_short(), s.prior("short"))


@query("late_rows", SQL_BASE + f"""
SELECT {STG_COLS_SQL['okved']} FROM stg_okved WHERE dfrom < (SELECT po FROM p)""")
def q_late_rows(spark, sf):
    s = _stg(spark, sf)
    return wmk.late(s.stg_okved(), s.prior("okved"))


# --------------------------------------------------------------------------
# Mart (J1, J2, J3, F2, X3, D5, U3, U4, J6)
# --------------------------------------------------------------------------
@query("semi_fresh_keys", SQL_BASE + """
SELECT ngrn FROM stg_short WHERE dfrom >= (SELECT ps FROM p)
UNION SELECT ngrn FROM stg_okved WHERE dfrom >= (SELECT po FROM p)
UNION SELECT ngrn FROM stg_address WHERE dfrom >= (SELECT pa FROM p)""")
def q_semi_fresh_keys(spark, sf):
    s = _stg(spark, sf)
    return mart_plan.changed_keys(s.stg_short(), s.stg_okved(), s.stg_address(), *s.priors())


def _mart_inputs(s: Standins):
    return s.stg_short(), s.stg_okved(), s.stg_address()


@query("mart_build", SQL_BASE + mart_sql())
def q_mart_build(spark, sf):
    s = _stg(spark, sf)
    return mart_plan.build_mart(*_mart_inputs(s), *s.priors())


@query("mart_build_pruned", SQL_BASE + mart_sql())
def q_mart_build_pruned(spark, sf):
    s = _stg(spark, sf)
    return mart_plan.build_mart(*_mart_inputs(s), *s.priors(), prune=True)


@query("mart_incremental", SQL_BASE + mart_sql())
def q_mart_incremental(spark, sf):
    """The mart from kept per-key maxima: those of the history before the priors, into which the fresh rows are merged month by month."""
    s = _stg(spark, sf)
    priors = dict(zip(("short", "okved", "address"), s.priors()))
    kept, fresh = {}, {}
    for t, prior in priors.items():
        rows = s.stg(t)
        fresh[t] = materialize(wmk.fresh(rows, prior), "fresh")
        first = fresh[t].agg(F.min(F.trunc("dfrom", "month"))).scalar()
        kept[t] = mart_plan.tops(wmk.late(rows, prior), t)
        for delta in (fresh[t].where(F.trunc("dfrom", "month") == first), fresh[t].where(F.trunc("dfrom", "month") > first)):
            kept[t] = materialize(mart_plan.merged_tops(kept[t], delta, t), "tops")
    keys = materialize(_union_all([f.select("ngrn") for f in fresh.values()]).distinct(), "changed-keys")
    return mart_plan.mart_from_tops(kept, fresh, keys)


@query("mart_join_left", SQL_BASE + mart_sql(ps=SEED_SQL, po=SEED_SQL, pa=SEED_SQL))
def q_mart_join_left(spark, sf):
    s = _stg(spark, sf)
    return mart_plan.build_mart(*_mart_inputs(s), *s.seeds())


@query("mart_window", SQL_BASE + """,
sk AS (SELECT org_name, ngrn, bool_or(dfrom >= (SELECT ps FROM p)) AS fs FROM stg_short GROUP BY ALL),
ok AS (SELECT ngrn, bool_or(dfrom >= (SELECT po FROM p)) AS fo FROM stg_okved GROUP BY ALL),
ak AS (SELECT ngrn, bool_or(dfrom >= (SELECT pa FROM p)) AS fa FROM stg_address GROUP BY ALL)
SELECT sk.org_name, sk.ngrn, coalesce(fs, false) AS fresh_short,
       coalesce(fa, false) AS fresh_address, coalesce(fo, false) AS fresh_okved
FROM sk LEFT JOIN ok ON sk.ngrn = ok.ngrn LEFT JOIN ak ON sk.ngrn = ak.ngrn
WHERE coalesce(fs, false) OR coalesce(fa, false) OR coalesce(fo, false)""")
def q_mart_window(spark, sf):
    s = _stg(spark, sf)
    return mart_plan.window_keys(*_mart_inputs(s), *s.priors())


@query("mart_latest", SQL_BASE + f""",
j AS ({joined_sql()}),
conflict AS (
  SELECT org_name, ngrn FROM j GROUP BY org_name, ngrn
  HAVING count(DISTINCT coalesce(status, '<null>') || '|' || coalesce(location, '<null>')) > 1),
m AS ({mart_sql()})
SELECT m.org_name, m.ngrn, m.date, m.status, m.location
FROM m JOIN conflict c ON m.org_name = c.org_name AND m.ngrn = c.ngrn""")
def q_mart_latest(spark, sf):
    s = _stg(spark, sf)
    return mart_plan.conflicting_keys(*_mart_inputs(s), *s.priors())


def _upsert_sql() -> str:
    cut = {t: f"(SELECT * FROM stg_{t} WHERE dfrom < {PRIOR_SQL[t]})" for t in TABLES}
    first = mart_sql(short=cut["short"], okved=cut["okved"], address=cut["address"],
                     ps=SEED_SQL, po=SEED_SQL, pa=SEED_SQL)
    upd = {c: f"CASE WHEN s.ngrn IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in MART_UPDATE_COLS}
    cols = ", ".join(upd.get(c, f"t.{c}") for c in MART_COLUMNS)
    return SQL_BASE + f""",
target AS (SELECT row_number() OVER (ORDER BY org_name, ngrn) AS id, * FROM ({first}) f),
source AS ({mart_sql()})
SELECT t.id, {cols}
FROM target t LEFT JOIN source s ON t.org_name = s.org_name AND t.ngrn = s.ngrn
UNION ALL
SELECT (SELECT coalesce(max(id), 0) FROM target) + row_number() OVER (ORDER BY s.org_name, s.ngrn) AS id,
       {', '.join('s.' + c for c in MART_COLUMNS)}
FROM source s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.org_name = s.org_name AND t.ngrn = s.ngrn)"""


@query("mart_upsert", _upsert_sql())
def q_mart_upsert(spark, sf):
    s = _stg(spark, sf)
    ps, po, pa = s.priors()
    short, okved, address = _mart_inputs(s)
    first, source = mart_plan.mart_steps(short, okved, address, ps, po, pa)
    target = with_dense_ids(first, list(MART_KEYS))
    return upsert(target, source, MART_KEYS, MART_UPDATE_COLS).select("id", *MART_COLUMNS)


def _changes_sql() -> str:
    cut = {t: f"(SELECT * FROM stg_{t} WHERE dfrom < {PRIOR_SQL[t]})" for t in TABLES}
    first = mart_sql(short=cut["short"], okved=cut["okved"], address=cut["address"], ps=SEED_SQL, po=SEED_SQL, pa=SEED_SQL)
    same = " AND ".join([f"t.{c} = s.{c}" for c in MART_KEYS] + [f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in MART_UPDATE_COLS])
    return SQL_BASE + f""",
target AS ({first}), source AS ({mart_sql()})
SELECT {', '.join(MART_COLUMNS)} FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {same})"""


@query("mart_changes", _changes_sql())
def q_mart_changes(spark, sf):
    """The window's rows that an upsert would not find as they are: what decides which buckets are written anew."""
    s = _stg(spark, sf)
    target, source = mart_plan.mart_steps(*_mart_inputs(s), *s.priors())
    return changing(target, source, MART_KEYS, MART_UPDATE_COLS).select(*MART_COLUMNS)


# --------------------------------------------------------------------------
# Dimensions (U2 x10, J4, C5)
# --------------------------------------------------------------------------
def _dim_frames(s: Standins, name: str):
    src, cols = DIMENSIONS[name]
    keys = [d for _, d in cols]
    stg = s.stg(src)
    p = s.prior(src)
    proj = [F.col(c).alias(d) for c, d in cols]
    before = with_dense_ids(wmk.late(stg, p).select(*proj).distinct(), keys).select("id", *keys)
    return before, wmk.fresh(stg, p).select(*proj), keys


def _dim_sql(name: str, only_new: bool = False) -> str:
    src, cols = DIMENSIONS[name]
    keys = [d for _, d in cols]
    k = ", ".join(keys)
    nn = " AND ".join(f"{d} IS NOT NULL" for d in keys)
    sel = ", ".join(f"{c} AS {d}" for c, d in cols)
    p = PRIOR_SQL[src]
    body = SQL_BASE + f""",
src AS (SELECT {sel}, dfrom AS _d FROM stg_{src}),
old AS (SELECT row_number() OVER (ORDER BY {k}) AS id, {k}
        FROM (SELECT DISTINCT {k} FROM src WHERE _d < {p} AND {nn}) q),
new AS (SELECT DISTINCT {k} FROM src WHERE _d >= {p} AND {nn} EXCEPT SELECT {k} FROM old),
added AS (SELECT (SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY {k}) AS id, {k}
          FROM new)
"""
    return body + ("SELECT id, " + k + " FROM added" if only_new
                   else f"SELECT id, {k} FROM old UNION ALL SELECT id, {k} FROM added")


def _register_dim(name: str):
    def fn(spark, sf):
        before, fresh, keys = _dim_frames(_stg(spark, sf), name)
        return insert_ignore(before, fresh, keys)
    fn.__name__ = f"q_dim_{name}"
    query(f"dim_{name}", _dim_sql(name))(fn)


for _name in DIMENSIONS:
    _register_dim(_name)


@query("dim_insert_new", _dim_sql("dates", only_new=True))
def q_dim_insert_new(spark, sf):
    before, fresh, keys = _dim_frames(_stg(spark, sf), "dates")
    return new_members(before, fresh, keys)


@query("surrogate_ids", """
SELECT row_number() OVER (ORDER BY l_partkey, l_suppkey) AS id, l_partkey, l_suppkey
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) t""")
def q_surrogate_ids(spark, sf):
    li = _stg(spark, sf).table("lineitem").select("l_partkey", "l_suppkey").distinct()
    return with_dense_ids(li, ["l_partkey", "l_suppkey"]).select("id", "l_partkey", "l_suppkey")


# --------------------------------------------------------------------------
# Checks (C1-C4, J5)
# --------------------------------------------------------------------------
FK_RELATIONS = [
    # activities of a key without a short row: the one relation here that has orphans
    ("lineitem.l_partkey->orders.o_custkey", "lineitem", "orders", ["l_partkey"], ["o_custkey"]),
    ("orders.o_custkey->customer", "orders", "customer", ["o_custkey"], ["c_custkey"]),
    ("lineitem.l_orderkey->orders", "lineitem", "orders", ["l_orderkey"], ["o_orderkey"]),
    ("lineitem.l_partkey->part", "lineitem", "part", ["l_partkey"], ["p_partkey"]),
    ("lineitem.l_suppkey->supplier", "lineitem", "supplier", ["l_suppkey"], ["s_suppkey"]),
    ("customer.c_nationkey->nation", "customer", "nation", ["c_nationkey"], ["n_nationkey"]),
    ("nation.n_regionkey->region", "nation", "region", ["n_regionkey"], ["r_regionkey"]),
]


@query("fk_orphans", " UNION ALL ".join(
    f"SELECT '{n}' AS relation, count(*) AS orphans FROM {c} WHERE {cc[0]} IS NOT NULL "
    f"AND {cc[0]} NOT IN (SELECT {pc[0]} FROM {p} WHERE {pc[0]} IS NOT NULL)"
    for n, c, p, cc, pc in FK_RELATIONS))
def q_fk_orphans(spark, sf):
    s = _stg(spark, sf)
    frames = {n: s.table(n) for r in FK_RELATIONS for n in r[1:3]}  # one scan for each child
    return checks.fk_orphan_counts([(n, frames[c], frames[p], cc, pc) for n, c, p, cc, pc in FK_RELATIONS])


MART_FK_SQL = " UNION ALL ".join(
    f"SELECT 'mart.{c}->dim_{d}' AS relation, count(*) AS orphans FROM mart WHERE {c} IS NOT NULL AND {c} NOT IN "
    f"(SELECT {src} FROM stg_short WHERE dfrom >= (SELECT ps FROM p) AND {src} IS NOT NULL)"
    for (c, (d, _)), src in zip(MART_FOREIGN_KEYS.items(), ("ngrn", "org_type", "dfrom", "status")))


@query("mart_fk_orphans", SQL_BASE + f", mart AS ({mart_sql()}) " + MART_FK_SQL)
def q_mart_fk_orphans(spark, sf):
    """The mart's keys against dimensions of the fresh rows only: an old short
    row made fresh by its address or activity has its keys in no dimension."""
    s = _stg(spark, sf)
    rows = mart_plan.build_mart(*_mart_inputs(s), *s.priors())
    fresh = wmk.fresh(s.stg_short(), s.prior("short"))
    dims = {d: fresh.select(*[F.col(a).alias(b) for a, b in DIMENSIONS[d][1]]).distinct() for d, _ in MART_FOREIGN_KEYS.values()}
    return checks.fk_orphan_counts([(f"mart.{c}->dim_{d}", rows, dims[d], [c], [p]) for c, (d, p) in MART_FOREIGN_KEYS.items()])


@query("check_not_null", """
SELECT event_id, user_id AS ngrn, 'ngrn' AS violation FROM events WHERE user_id IS NULL
UNION ALL SELECT event_id, user_id, 'dfrom' FROM events WHERE ts IS NULL
UNION ALL SELECT event_id, user_id, 'vdistrict' FROM events WHERE nullif(event_type, 'view') IS NULL
UNION ALL SELECT event_id, user_id, 'vnp' FROM events WHERE nullif(event_type, 'click') IS NULL""")
def q_check_not_null(spark, sf):
    raw = _stg(spark, sf).raw_address()
    return checks.check_not_null(raw, ["ngrn", "dfrom", "vdistrict", "vnp"], keep=["event_id", "ngrn"])


@query("check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_check_unique(spark, sf):
    return checks.check_unique(_stg(spark, sf).table("lineitem"), ["l_orderkey", "l_linenumber"])


LENGTHS = {"o_orderpriority": 10, "o_orderstatus": 1}


@query("check_length", " UNION ALL ".join(
    f"SELECT o_orderkey, '{c}' AS violation FROM orders WHERE length({c}) > {n}"
    for c, n in LENGTHS.items()))
def q_check_length(spark, sf):
    return checks.check_length(_stg(spark, sf).table("orders"), LENGTHS, keep=["o_orderkey"])


# --------------------------------------------------------------------------
# Portal (F3, F4, F5, T2, D7, P4, X9-X11, S10-S12)
# --------------------------------------------------------------------------
OPTION_FIELDS = [("ngrn", "short", "ngrn"), ("org_name", "short", "org_name"),
                 ("status", "short", "status"), ("org_type", "short", "org_type"),
                 ("region", "address", "vregion")]


@query("portal_options", SQL_BASE + "\n" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, 0 AS ord, '{ALL_OPTION}' AS value UNION ALL "
    f"SELECT '{f}', 1, CAST({c} AS VARCHAR) FROM (SELECT DISTINCT {c} FROM stg_{t}) d{f}"
    for f, t, c in OPTION_FIELDS))
def q_portal_options(spark, sf):
    s = _stg(spark, sf)
    return _union_all([portal.options(s.stg(t).select(F.col(c).alias(f)), f) for f, t, c in OPTION_FIELDS])


DM_SQL = SQL_BASE + f""",
dm AS (SELECT row_number() OVER (ORDER BY org_name, ngrn) AS id, *
       FROM ({mart_sql(ps=SEED_SQL, po=SEED_SQL, pa=SEED_SQL)}) m)"""
PORTAL_OUT_SQL = ("id, org_name, CAST(ngrn AS VARCHAR) AS ngrn, org_type, date, status, okved_code, "
                  "okved_text, region, district, settlement, location, email, phone")


def _dm(s: Standins) -> DataFrame:
    rows = mart_plan.build_mart(*_mart_inputs(s), *s.seeds())
    return with_dense_ids(rows, list(MART_KEYS)).select("id", *MART_COLUMNS)


FILTER_PARAMS = {"ngrn": ALL_OPTION, "org_name": ALL_OPTION, "status": "F", "org_type": "ИП",
                 "region": ALL_OPTION}


@query("portal_filter", DM_SQL + f"""
SELECT {PORTAL_OUT_SQL} FROM dm
WHERE status = 'F' AND org_type = 'ИП'
  AND date >= TIMESTAMP '1998-01-01 00:00:00' AND date < TIMESTAMP '2001-01-01 00:00:00'""")
def q_portal_filter(spark, sf):
    return portal.portal_filter(_dm(_stg(spark, sf)), FILTER_PARAMS, "1998-01-01", "2001-01-01")


@query("portal_date_range", DM_SQL + f"""
SELECT {PORTAL_OUT_SQL} FROM dm
WHERE date >= TIMESTAMP '1999-01-01 00:00:00' AND date < TIMESTAMP '2000-01-01 00:00:00'""")
def q_portal_date_range(spark, sf):
    params = dict.fromkeys(FILTER_PARAMS, ALL_OPTION)
    return portal.portal_filter(_dm(_stg(spark, sf)), params, "1999-01-01", "2000-01-01")


@query("portal_all_sentinel", DM_SQL + f"""
SELECT {PORTAL_OUT_SQL} FROM dm
WHERE date >= TIMESTAMP '1900-01-01 00:00:00' AND date < TIMESTAMP '2100-01-01 00:00:00'""")
def q_portal_all_sentinel(spark, sf):
    params = dict.fromkeys(FILTER_PARAMS, ALL_OPTION)
    return portal.portal_filter(_dm(_stg(spark, sf)), params, "1900-01-01", "2100-01-01")


@query("portal_export", ORACLE["portal_filter"])
def q_portal_export(spark, sf):
    sel = q_portal_filter(spark, sf)
    path = scratch_dir(spark, "export")
    portal.export(sel, path, "csv")
    return spark.read.schema(sel.schema).option("header", True).csv(path)


# --------------------------------------------------------------------------
# Feeds and staging sinks (S1-S3, S6, S7, S9, X12, D1 in feed order)
# --------------------------------------------------------------------------
RAW = {"short_info": "raw_short", "contact_info": "raw_address", "okved_info": "raw_okved"}
TABLE_OF = {v: k for k, v in KIND_OF.items()}


_LANDED: dict[tuple[str, str, str], str] = {}


def land_feed(s: Standins, kind: str, root: str) -> None:
    """Write a stand-in feed as day-partitioned, gzipped JSON lines that hold the feed's fields.

    Plain lines with the tables' order columns take 15 times the tables' disk.
    """
    write_feed(getattr(s, RAW[kind])(), root, kind, FEED_ORDER[kind], columns=feed_schema_ntz(kind).names, compression="gzip")


def landed(s: Standins, kind: str) -> str:
    """The root below which a stand-in feed lies as day-partitioned JSON lines.

    Landing is the register's side of a pull, not the query's: it is done once for
    a session and folder.
    """
    key = (s.spark.sparkContext.applicationId, s.sf_dir, kind)
    if key not in _LANDED:
        root = scratch_dir(s.spark, "feeds")
        land_feed(s, kind, root)
        _LANDED[key] = root
    return _LANDED[key]


def land_feeds(s: Standins, root: str) -> None:
    """Write the three stand-in feeds as day-partitioned JSON-lines files."""
    for kind in FEED_KINDS:
        land_feed(s, kind, root)


def _feed_period(s: Standins, table: str):
    row = s.stg(table).agg(F.to_date(F.max("dfrom")).alias("hi")).first()
    lo = s.wm(table).transform(wmk.prior).select(F.to_date("prior").alias("lo")).first()
    return lo["lo"], row["hi"]


def _feed_query(kind: str):
    t = TABLE_OF[kind]

    def fn(spark, sf):
        s = _stg(spark, sf)
        lo, hi = _feed_period(s, t)
        feed = read_feed(spark, kind, landed(s, kind), lo, hi, layout="lines", schema=feed_schema_ntz(kind))
        return SHAPERS[kind](feed)

    order = ", ".join(FEED_ORDER[kind][1:])
    sql = SQL_BASE + f"""
SELECT {STG_COLS_SQL[t]} FROM (
  SELECT *, row_number() OVER (PARTITION BY ngrn ORDER BY {order}) AS rn FROM stg_{t}
  WHERE CAST(dfrom AS DATE) >= CAST({PRIOR_SQL[t]} AS DATE)
    AND CAST(dfrom AS DATE) <= (SELECT CAST(max(dfrom) AS DATE) FROM stg_{t})) f
WHERE rn = 1"""
    fn.__name__ = f"q_feed_{t}"
    return fn, sql


for _kind, _key in (("short_info", "feed_short"), ("contact_info", "feed_address"),
                    ("okved_info", "feed_okved")):
    _fn, _sql = _feed_query(_kind)
    query(_key, _sql)(_fn)


@query("stg_append", SQL_BASE + f"SELECT {STG_COLS_SQL['short']} FROM stg_short")
def q_stg_append(spark, sf):
    s = _stg(spark, sf)
    path = scratch_dir(spark, "stg")
    p = s.prior("short")
    append(wmk.late(s.stg_short(), p), path)   # earlier cycles
    append(wmk.fresh(s.stg_short(), p), path)  # this cycle
    return spark.read.parquet(path)


# --------------------------------------------------------------------------
# Cycles: batch and stream
# --------------------------------------------------------------------------
def _two_pulls(spark, sf):
    """Feeds from the tables, split into two pulls at the short prior mark."""
    from dimloom.streaming.cycle_stream import write_pull

    s = _stg(spark, sf)
    root = scratch_dir(spark, "cycle")
    land_feeds(s, f"{root}/feeds")
    cut, _ = _feed_period(s, "short")
    day_before = cut - _dt.timedelta(days=1)
    for kind in FEED_KINDS:  # a pull without a row of some kind is an empty answer, not an absent one
        for day in (day_before, cut):
            write_empty_feed(spark, f"{root}/feeds", kind, day)
    write_pull(spark, f"{root}/pulls", 1, f"{root}/feeds", "1900-01-01", day_before, "lines")
    write_pull(spark, f"{root}/pulls", 2, f"{root}/feeds", cut, "2100-12-31", "lines")
    return root, cut


def _ntz_schemas():
    return {k: feed_schema_ntz(k) for k in FEED_KINDS}


def _streamed(spark, sf):
    """(root, cut, store) after both pulls went through the stream."""
    from dimloom.sources.state import StateStore
    from dimloom.streaming.cycle_stream import start_cycle_stream

    root, cut = _two_pulls(spark, sf)
    q = start_cycle_stream(spark, f"{root}/pulls", f"{root}/state", f"{root}/chk",
                           feed_schemas=_ntz_schemas())
    q.awaitTermination()
    return root, cut, StateStore(spark, f"{root}/state")


def _pull_sql(n: int, t: str) -> str:
    """Staging rows of one pull: the first row of each key in feed order."""
    side = "<" if n == 1 else ">="
    order = ", ".join(FEED_ORDER[KIND_OF[t]][1:])
    return f"""pull{n}_{t} AS (
  SELECT {STG_COLS_SQL[t]} FROM (
    SELECT *, row_number() OVER (PARTITION BY ngrn ORDER BY {order}) AS rn FROM stg_{t}
    WHERE CAST(dfrom AS DATE) {side} CAST((SELECT ps FROM p) AS DATE)) f
  WHERE rn = 1)"""


KINDS_SQL = ("short", "okved", "address")
CYCLE_SQL = SQL_BASE + "," + ",\n".join(
    [_pull_sql(n, t) for n in (1, 2) for t in KINDS_SQL]
    + [f"all_{t} AS (SELECT * FROM pull1_{t} UNION SELECT * FROM pull2_{t})" for t in KINDS_SQL]
    + [f"mark_{t} AS (SELECT {SEED_SQL} AS m UNION SELECT max(dfrom) FROM pull1_{t} UNION SELECT max(dfrom) FROM all_{t})"
       for t in KINDS_SQL]
    + [f"prior_{t} AS (SELECT max(m) AS m FROM mark_{t} WHERE m < (SELECT max(m) FROM mark_{t}))" for t in KINDS_SQL]
    + ["mart1 AS (SELECT row_number() OVER (ORDER BY org_name, ngrn) AS id, * FROM ("
       + mart_sql(short="pull1_short", okved="pull1_okved", address="pull1_address", ps=SEED_SQL, po=SEED_SQL, pa=SEED_SQL) + ") a)",
       "rows2 AS (" + mart_sql(short="all_short", okved="all_okved", address="all_address",
                               **{f"p{t[0]}": f"(SELECT m FROM prior_{t})" for t in KINDS_SQL}) + ")",
       """mart2 AS (
  SELECT a.id, a.org_name, a.ngrn, a.org_type, """ + ", ".join(
           f"CASE WHEN b.ngrn IS NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in ("date", "status", "okved_code", "okved_text"))
       + """, a.region, a.district, a.settlement, a.location, a.email, a.phone
  FROM mart1 a LEFT JOIN rows2 b ON a.org_name = b.org_name AND a.ngrn = b.ngrn
  UNION ALL
  SELECT (SELECT coalesce(max(id), 0) FROM mart1) + row_number() OVER (ORDER BY org_name, ngrn), *
  FROM rows2 b WHERE NOT EXISTS (SELECT 1 FROM mart1 a WHERE a.org_name = b.org_name AND a.ngrn = b.ngrn))"""])


@query("cycle_stream", CYCLE_SQL + " SELECT " + PORTAL_OUT_SQL.replace("CAST(ngrn AS VARCHAR) AS ngrn", "ngrn") + " FROM mart2")
def q_cycle_stream(spark, sf):
    _, _, store = _streamed(spark, sf)
    return store.read("mart", store.latest()[0])


@query("cycle_log", CYCLE_SQL + " " + " UNION ALL ".join(
    f"SELECT CAST({n} AS BIGINT) AS version, 'stg_{t}' AS table_name, (SELECT count(*) FROM pull1_{t}) AS rows" if n == 1 else
    f"SELECT CAST(2 AS BIGINT), 'stg_{t}', (SELECT count(*) FROM all_{t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM pull1_{t}) x)"
    for n in (1, 2) for t in KINDS_SQL))
def q_cycle_log(spark, sf):
    """What the manifests say that each pull added to staging, as observed by the passes that wrote it."""
    _, _, store = _streamed(spark, sf)
    counts = store.manifests().select("version", F.explode("counts").alias("name", "rows"))
    return (counts.where(F.col("name").isin([f"stg_{t}.rows" for t in TABLES]))
                  .select("version", F.regexp_replace("name", r"\.rows$", "").alias("table_name"), "rows"))


def _counted_sql(name: str, body: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS changed FROM ({body}) t"


RERUN_SQL = CYCLE_SQL + " " + " UNION ALL ".join(
    [_counted_sql(f"stg_{t}", f"SELECT * FROM all_{t}") for t in KINDS_SQL]
    + [_counted_sql(f"wm_{t}", f"SELECT DISTINCT m FROM mark_{t} WHERE m IS NOT NULL") for t in KINDS_SQL]
    + [_counted_sql(f"dim_{d}", f"SELECT DISTINCT {', '.join(a for a, _ in cols)} FROM all_{src} WHERE "
                    + " AND ".join(f"{a} IS NOT NULL" for a, _ in cols)) for d, (src, cols) in DIMENSIONS.items()]
    + [_counted_sql("mart", "SELECT * FROM mart2")])


@query("cycle_rerun", RERUN_SQL)
def q_cycle_rerun(spark, sf):
    """Per table its rows before and after the last pull is run again, and how many rows changed."""
    from dimloom.plans.cycle import run_cycle

    root, cut, store = _streamed(spark, sf)
    before = store.latest()[0]
    feeds = {k: read_feed(spark, k, f"{root}/feeds", cut, "2100-12-31", layout="lines",
                          schema=feed_schema_ntz(k)) for k in FEED_KINDS}
    after = run_cycle(store, feeds)
    parts = [store.read(name, version).select(F.lit(name).alias("table_name"), F.xxhash64(*[f.name for f in schema.fields]).alias("h"),
                                              F.lit(sign).alias("sign"))
             for name, schema in store.schemas.items() for version, sign in ((before, -1), (after, 1))]
    rows = _union_all(parts).groupBy("table_name", "h").agg(
        F.count(F.when(F.col("sign") < 0, 1)).alias("b"), F.count(F.when(F.col("sign") > 0, 1)).alias("a"))
    return rows.groupBy("table_name").agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"),
                                          F.sum(F.abs(F.col("a") - F.col("b"))).alias("changed"))
