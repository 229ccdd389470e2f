"""Unit tests of the single operators (small hand-made frames)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.constants import ALL_OPTION
from dimloom.functions import fill_default, json_field, nested_field, org_name, org_type
from dimloom.operators import checks, dedup, portal
from dimloom.operators import watermark as wmk
from dimloom.operators.ids import with_dense_ids
from dimloom.operators.upsert import changing, insert_ignore, upsert
from dimloom.plans import queries
from dimloom.plans.shape import shape_short
from dimloom.plans.standins import Standins
from dimloom.session import check_shared
from dimloom.sources import feeds
from dimloom.sources.feeds import POSITION, read_feed


def ts(s):
    return dt.datetime.fromisoformat(s)


# -- dedup -------------------------------------------------------------------
def test_keep_first_uses_order_not_arrival(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")],
                               "k long, pos long, v string")
    got = sorted(tuple(r) for r in dedup.keep_first(df, ["k"], ["pos"]).collect())
    assert got == [(1, 1, "a"), (2, 5, "z")]
    with pytest.raises(ValueError):
        dedup.keep_first(df, ["k"], [])


def test_distinct_rows_and_number_within(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k long, v string")
    assert dedup.distinct_rows(df).count() == 2
    n = dedup.number_within(df, ["k"], ["v"]).filter("rnum > 1").count()
    assert n == 2


# -- dense ids ---------------------------------------------------------------
def test_dense_ids_equal_global_row_number(spark):
    names = [f"ООО Company {i % 37:03d} branch {i}" for i in range(500)]
    df = spark.createDataFrame([(n, i % 3) for i, n in enumerate(names)], "name string, g int")
    got = with_dense_ids(df, ["name", "g"], buckets=7, base=10)
    ref = df.withColumn("rid", F.row_number().over(Window.orderBy("name", "g")) + 10)
    bad = got.join(ref, ["name", "g"]).filter(F.col("id") != F.col("rid")).count()
    assert got.count() == 500 and bad == 0
    assert got.agg(F.min("id"), F.max("id")).first() == (11, 510)


# -- insert-ignore and upsert -------------------------------------------------
def test_insert_ignore_first_load_and_stable_ids(spark):
    empty = spark.createDataFrame([], "id long, ngrn long")
    src1 = spark.createDataFrame([(102,), (100,), (101,), (100,), (None,)], "ngrn long")
    d1 = insert_ignore(empty, src1, ["ngrn"])
    assert sorted(tuple(r) for r in d1.collect()) == [(1, 100), (2, 101), (3, 102)]
    src2 = spark.createDataFrame([(101,), (99,), (103,)], "ngrn long")
    d2 = insert_ignore(d1, src2, ["ngrn"])
    assert sorted(tuple(r) for r in d2.collect()) == [(1, 100), (2, 101), (3, 102), (4, 99), (5, 103)]
    # again: nothing changes
    assert sorted(tuple(r) for r in insert_ignore(d2, src2, ["ngrn"]).collect()) == \
        sorted(tuple(r) for r in d2.collect())


def test_upsert_updates_only_chosen_columns(spark):
    tgt = spark.createDataFrame([(1, "a", 1, "s1", "loc1"), (2, "b", 2, "s2", "loc2")],
                                "id long, org_name string, ngrn long, status string, location string")
    src = spark.createDataFrame([("a", 1, None, "NEW"), ("c", 3, "s3", "loc3")],
                                "org_name string, ngrn long, status string, location string")
    out = {(r["org_name"], r["ngrn"]): r.asDict()
           for r in upsert(tgt, src, ["org_name", "ngrn"], ["status"]).collect()}
    assert out[("a", 1)] == {"id": 1, "org_name": "a", "ngrn": 1, "status": None, "location": "loc1"}
    assert out[("b", 2)]["status"] == "s2"
    assert out[("c", 3)] == {"id": 3, "org_name": "c", "ngrn": 3, "status": "s3", "location": "loc3"}


# -- watermarks ---------------------------------------------------------------
def test_watermark_prior_and_advance(spark):
    seed = wmk.seed(spark)
    assert seed.transform(wmk.prior).first()["prior"] is None       # one row -> NULL
    stg = spark.createDataFrame([(1, ts("2023-01-02 00:00:00")), (2, ts("2023-01-05 00:00:00"))],
                                "ngrn long, dfrom timestamp")
    assert wmk.fresh(stg, wmk.prior_value(seed)).count() == 0      # NULL prior keeps nothing
    w1 = wmk.advance(seed, stg)
    assert w1.count() == 2 and wmk.advance(w1, stg).count() == 2   # no duplicate mark
    assert wmk.fresh(stg, wmk.prior_value(w1)).count() == 2        # prior = seed
    empty = stg.limit(0)
    assert wmk.advance(w1, empty).count() == 2                      # empty stage: unchanged
    assert wmk.current(w1).first()[0] == ts("2023-01-05 00:00:00")
    assert wmk.late(stg, F.lit(ts("2023-01-03 00:00:00"))).count() == 1


# -- functions ------------------------------------------------------------------
def test_shaping_functions(spark):
    schema = T.StructType([T.StructField("vfio", T.StringType()), T.StructField("vnaim", T.StringType()),
                           T.StructField("o", T.StructType([T.StructField("k", T.StringType())])),
                           T.StructField("j", T.StringType())])
    df = spark.createDataFrame([("", "n", None, '{"k": 5}'), (None, "n", ("v",), None),
                                (None, None, (None,), '{"z": 1}')], schema)
    rows = df.select(org_name().alias("n"), org_type().alias("t"), nested_field("o", "k").alias("x"),
                     json_field("j", "k").alias("y")).collect()
    assert [tuple(r) for r in rows] == [("", "ИП", "", "5"), ("n", "ЮЛ", "v", ""),
                                        (None, "ЮЛ", "", "")]
    filled = fill_default(df.select(org_name().alias("n"), F.lit(None).cast("long").alias("k")))
    assert [tuple(r) for r in filled.collect()] == [("", None), ("n", None), ("Нет", None)]


# -- checks -------------------------------------------------------------------
def test_checks(spark):
    df = spark.createDataFrame([(1, None, "ИПX"), (1, "x", "ЮЛ"), (2, None, None)],
                               "ngrn long, status string, org_type string")
    nn = sorted(tuple(r) for r in checks.check_not_null(df, ["status", "org_type"], keep=["ngrn"]).collect())
    assert nn == [(1, "status"), (2, "org_type"), (2, "status")]
    assert [tuple(r) for r in checks.check_unique(df, ["ngrn"]).collect()] == [(1, 2)]
    ln = [tuple(r) for r in checks.check_length(df, keep=["ngrn"]).collect()]
    assert ln == [(1, "org_type")]
    parent = spark.createDataFrame([(1,)], "ngrn long")
    assert checks.check_fk(df, parent, ["ngrn"]).count() == 1


# -- portal -------------------------------------------------------------------
def _mart(spark):
    return spark.createDataFrame([
        (1, "О'Нил А.", 100, "ИП", ts("2023-01-05 00:00:00"), "Закрыт", "62010", "t", "Минск"),
        (2, "Новая", 103, "ЮЛ", ts("2023-01-05 00:00:00"), "Действующий", "Нет", "Нет", None),
    ], "id long, org_name string, ngrn long, org_type string, date timestamp, status string, "
       "okved_code string, okved_text string, region string")


def test_portal_filter(spark):
    m = _mart(spark)
    params = {"ngrn": ALL_OPTION, "org_name": "О'Нил А.", "status": ALL_OPTION,
              "org_type": ALL_OPTION, "region": ALL_OPTION}
    got = portal.portal_filter(m, params, "2023-01-01", "2023-01-06").collect()
    assert [r["ngrn"] for r in got] == ["100"]                      # apostrophe is data
    assert portal.portal_filter(m, params, "2023-01-05", "2023-01-05").count() == 0   # start = end
    allp = dict.fromkeys(params, ALL_OPTION)
    assert portal.portal_filter(m, allp, dt.date(2023, 1, 1), dt.date(2023, 2, 1)).count() == 2
    assert portal.portal_filter(m, {**allp, "ngrn": 103}, "2023-01-01", "2023-02-01").count() == 1
    with pytest.raises(ValueError):
        portal.portal_filter(m, {"nope": 1}, "2023-01-01", "2023-02-01")
    opts = [tuple(r) for r in portal.options(m, "region").collect()]
    assert ("region", 0, ALL_OPTION) in opts and len(opts) == 3
    assert [o for o in opts if o[1] == 0] == [("region", 0, ALL_OPTION)]


def test_export_roundtrip(spark, workdir):
    sel = portal.portal_filter(_mart(spark), {}, "2023-01-01", "2023-02-01")
    path = os.path.join(workdir, "out")
    portal.export(sel, path, "csv")
    back = spark.read.schema(sel.schema).option("header", True).csv(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sel.collect()))


# -- feeds ----------------------------------------------------------------------
def test_feed_reader(spark, workdir):
    d = os.path.join(workdir, "short_info", "load_date=2023-01-02")
    os.makedirs(d)
    rows = [{"ngrn": 5, "dfrom": "2023-01-02T00:00:00+03:00", "vnaim": "b"},
            {"ngrn": 5, "dfrom": "2023-01-01T00:00:00+03:00", "vnaim": "a", "extra": 1}]
    with open(os.path.join(d, "f.json"), "w") as f:
        json.dump(rows, f)
    e = os.path.join(workdir, "short_info", "load_date=2023-01-03")
    os.makedirs(e)
    with open(os.path.join(e, "f.json"), "w") as f:
        f.write("[]")
    got = read_feed(spark, "short_info", workdir).orderBy("_pos").collect()
    assert [(r["vnaim"], r["_pos"]) for r in got] == [("b", 0), ("a", 1)]
    assert read_feed(spark, "short_info", workdir, "2023-01-03", "2023-01-03").count() == 0
    assert got[0]["dfrom"] == ts("2023-01-01 21:00:00")            # +03:00 offset parsed
    with pytest.raises(ValueError):
        read_feed(spark, "bogus", workdir)


def _feed_file(root, day, name, text):
    d = os.path.join(root, "short_info", f"load_date={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


@pytest.mark.parametrize("text", ['[{"ngrn": 1, "dfrom": "2023-01-02T00:00:00+03:00"}, {"ngrn": 2, ', "<html>error</html>"])
@pytest.mark.parametrize("layout", ["array", "lines"])
def test_malformed_feed_fails(spark, workdir, text, layout):
    _feed_file(workdir, "2023-01-02", "f.json", text)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_feed(spark, "short_info", workdir, layout=layout).collect()


def test_absent_feed_fails(spark, workdir):
    _feed_file(workdir, "2023-01-02", "f.json", "[]")
    assert read_feed(spark, "short_info", workdir, "2023-01-01", "2023-01-03").count() == 0
    with pytest.raises(FileNotFoundError):
        read_feed(spark, "short_info", workdir, "2023-01-03", "2023-01-03")
    with pytest.raises(FileNotFoundError, match="2023-01-03"):
        read_feed(spark, "short_info", workdir, "2023-01-02", "2023-01-03", every_day=True)
    _feed_file(workdir, "2023-01-04", "f.json", "")
    with pytest.raises(FileNotFoundError):
        read_feed(spark, "short_info", workdir, "2023-01-04", "2023-01-04")


def test_feed_order_holds_past_a_thousand_files_and_over_splits(spark, workdir):
    for k in range(998, 1003):
        _feed_file(workdir, "2023-01-02", f"part-00000-c{k:03d}.json", "".join(
            json.dumps({"ngrn": 7, "dfrom": "2023-01-02T00:00:00+03:00", "vnaim": f"{k}-{i}"}) + "\n" for i in range(2000)))
    _feed_file(workdir, "2023-01-02", "part-00000-c997.json", "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        feed = read_feed(spark, "short_info", workdir, layout="lines")
        assert feed.select("_block").distinct().count() > 5
        rows = [r["vnaim"] for r in feed.orderBy(*POSITION).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == [f"{k}-{i}" for k in range(998, 1003) for i in range(2000)]
    with pytest.raises(ValueError, match="position"):
        shape_short(feed.drop("_block"))
    assert [r["org_name"] for r in shape_short(feed).collect()] == ["998-0"]


def test_fk_counts_and_pushed_null_check(spark, workdir):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (3, "c")], "k long, c string")
    one, two = spark.createDataFrame([(1,), (1,)], "k long"), spark.createDataFrame([("a",), ("b",)], "c string")
    got = checks.fk_orphan_counts([("k", child, one, ["k"], ["k"]), ("c", child, two, ["c"], ["c"])])
    assert {tuple(r) for r in got.collect()} == {("k", 2), ("c", 1)}
    child.write.parquet(os.path.join(workdir, "c"))
    plan = checks.check_not_null(spark.read.parquet(os.path.join(workdir, "c")), ["c"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(c)" in plan[plan.index("PushedFilters"):]


def test_non_local_master_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        check_shared("spark://host:7077", None)
    check_shared("spark://host:7077", "hdfs:///shared")
    check_shared("local[4]", None)


def test_changing_never_broadcasts_the_target(spark):
    rows = [("a", 1, "x"), ("b", 2, None), ("c", 3, "z"), (None, 4, "n")]
    target = spark.createDataFrame(rows, "k string, n long, v string")
    source = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "y"), (None, 4, "n"), ("d", 5, "z")], target.schema)
    got = changing(target, source, ["k", "n"], ["v"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([("c", 3, "y"), (None, 4, "n"), ("d", 5, "z")], key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_landing_tasks_grow_with_the_rows(spark, workdir, monkeypatch):
    rows = spark.range(400).select(F.col("id").alias("ngrn"), F.expr("timestamp'2023-01-02 03:00:00'").alias("dfrom"), F.col("id").cast("string").alias("vnaim"))
    files = {}
    for size in (1_000, 20):  # the session has 4 shuffle partitions
        monkeypatch.setattr(feeds, "ROWS_PER_TASK", size)
        feeds.write_feed(rows.orderBy(F.rand(1)), f"{workdir}/{size}", "short_info", ["ngrn"])
        files[size] = len([f for f in os.listdir(f"{workdir}/{size}/short_info/load_date=2023-01-02") if f.endswith(".json")])
        found = read_feed(spark, "short_info", f"{workdir}/{size}", layout="lines").orderBy(*POSITION).collect()
        assert [r["ngrn"] for r in found] == list(range(400))
    assert files[1_000] <= 4 and files[20] > 10


def test_feed_rows_carry_a_number_of_their_file(spark, workdir):
    """The paths are put in order once a file, not padded once a row."""
    for day, name, n in (("2023-01-03", "c9.json", 1), ("2023-01-02", "c10.json", 2), ("2023-01-02", "c9 a%20.json", 3), ("2023-01-02", "c9.json", 4), ("2022-12-31", "c1.json", 5)):
        _feed_file(workdir, day, name, f'{{"ngrn": {n}}}\n{{"ngrn": {n + 10}}}\n')
    feed = read_feed(spark, "short_info", workdir, "2023-01-01", layout="lines")
    assert dict(feed.dtypes)["_file"] == "bigint"
    assert [r["ngrn"] for r in feed.orderBy(*POSITION).collect()] == [3, 13, 4, 14, 2, 12, 1, 11]
    assert [r["_file"] for r in feed.select("_file").distinct().orderBy("_file").collect()] == [1, 2, 3, 4]


def test_a_landed_feed_is_packed_and_its_shuffle_is_freed(spark, workdir, monkeypatch):
    days = [f"2023-01-{2 + k % 3:02d}" for k in range(3000)]
    rows = spark.createDataFrame([(k % 500, d, f"name {k % 7}", 10**9 + (k * 7919) % 3001) for k, d in enumerate(days)], "ngrn long, d string, vnaim string, place long")
    rows = rows.select("ngrn", F.to_timestamp_ntz("d").alias("dfrom"), "vnaim", "place")
    schema = T.StructType([T.StructField("ngrn", T.LongType()), T.StructField("dfrom", T.TimestampNTZType()), T.StructField("vnaim", T.StringType())])
    found, size, freed = {}, {}, []
    monkeypatch.setattr(feeds, "free_shuffles", freed.append)
    for name, own in (("plain", {}), ("packed", {"columns": schema.names, "compression": "gzip"})):
        feeds.write_feed(rows, f"{workdir}/{name}", "short_info", ["ngrn", "dfrom", "place"], max_records=100, **own)
        found[name] = [tuple(r) for r in read_feed(spark, "short_info", f"{workdir}/{name}", layout="lines", schema=schema).orderBy(*POSITION).select(*schema.names).collect()]
        size[name] = sum(os.path.getsize(os.path.join(d, x)) for d, _, names in os.walk(f"{workdir}/{name}") for x in names if x.startswith("part-"))
    wanted = rows.orderBy(F.to_date("dfrom"), "ngrn", "dfrom", "place").select(*schema.names).collect()
    assert found["packed"] == found["plain"] == [tuple(r) for r in wanted]
    assert size["packed"] * 4 < size["plain"]
    assert freed == [spark, spark]


def test_cycle_queries_land_little(spark, workdir):
    sf = "/root/testdata/sf0.001"
    queries.land_feeds(Standins(spark, sf), f"{workdir}/feeds")
    names = [os.path.join(d, x) for d, _, names in os.walk(f"{workdir}/feeds") for x in names if x.startswith("part-")]
    assert names and all(x.endswith(".json.gz") for x in names)
    assert "l_orderkey" not in spark.read.json(f"{workdir}/feeds/okved_info").columns
