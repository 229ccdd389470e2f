"""Golden three-pull cycle (FIXTURES.md §3) in batch and as a stream."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dimloom.constants import FEED_KINDS
from dimloom.plans.cycle import ConstraintViolation, current_tables, run_cycle
from dimloom.sources.feeds import read_feed
from dimloom.sources.state import StateStore
from dimloom.streaming.cycle_stream import start_cycle_stream, write_pull
from tests.fixtures import PULL1, PULL2, land


def local_day(c):
    return F.date_format(F.from_utc_timestamp(c, "+03:00"), "yyyy-MM-dd")


def feeds_of(spark, root):
    return {k: read_feed(spark, k, root) for k in FEED_KINDS}


def mart_rows(tables):
    m = tables["mart"].withColumn("date", local_day("date"))
    return {(r["org_name"], r["ngrn"]): r.asDict() for r in m.collect()}


def marks(tables, t):
    return sorted(r[0] for r in tables[f"wm_{t}"].select(local_day("max_dfrom")).collect())


@pytest.fixture()
def pulls(workdir):
    return (land(os.path.join(workdir, "p1"), PULL1, "2023-01-02"),
            land(os.path.join(workdir, "p2"), PULL2, "2023-01-05"))


def test_three_pulls(spark, workdir, pulls):
    store = StateStore(spark, os.path.join(workdir, "state"))
    p1, p2 = pulls

    assert run_cycle(store, feeds_of(spark, p1)) == 1
    t = current_tables(store)
    stg = {r["ngrn"]: r.asDict() for r in t["stg_short"].collect()}
    assert sorted(stg) == [100, 101, 102]            # 100's second row dropped (keep-first)
    assert stg[100]["org_name"] == "О'Нил А." and stg[100]["org_type"] == "ИП"
    assert stg[101]["status"] == "" and stg[101]["org_type"] == "ЮЛ"   # absent object -> ''
    assert stg[102]["org_name"] == "Нет"
    okv = t["stg_okved"].collect()
    assert [(r["okved_code"], r["okved_text"]) for r in okv] == [("62010", "Торговля, прочая")]
    assert marks(t, "short") == ["1991-01-01", "2023-01-02"]
    assert marks(t, "address") == ["1991-01-01", "2023-01-01"]
    m = mart_rows(t)
    assert len(m) == 3
    a = m[("О'Нил А.", 100)]
    assert (a["date"], a["status"], a["okved_code"], a["okved_text"], a["region"], a["district"],
            a["location"], a["email"], a["phone"]) == (
        "2023-01-01", "Действующий", "62010", "Торговля, прочая", "Минск", "Нет",
        "ул. Мира, 5", "Нет", "1")
    b = m[('ООО "А, Б"', 101)]
    assert (b["status"], b["okved_code"], b["region"], b["location"], b["email"], b["phone"]) == (
        "", "Нет", "Нет", "Брест", "a@b", "Нет")
    c = m[("Нет", 102)]
    assert c["okved_code"] == "Нет" and c["region"] is None and c["location"] is None
    ids1 = {k: v["id"] for k, v in m.items()}
    dims1 = {n: sorted(tuple(r) for r in t[f"dim_{n}"].collect())
             for n in ("ngrns", "statuses", "dates", "contacts", "regions")}
    assert dims1["ngrns"] == [(1, 100), (2, 101), (3, 102)]

    assert run_cycle(store, feeds_of(spark, p2)) == 2
    t = current_tables(store)
    assert marks(t, "short") == ["1991-01-01", "2023-01-02", "2023-01-05"]
    assert marks(t, "okved") == ["1991-01-01", "2023-01-01"]
    m = mart_rows(t)
    a = m[("О'Нил А.", 100)]
    assert (a["date"], a["status"]) == ("2023-01-05", "Закрыт")
    assert a["location"] == "ул. Мира, 5"             # insert-only column keeps first value
    assert ("Новая", 103) in m and m[("Новая", 103)]["region"] is None
    assert all(m[k]["id"] == v for k, v in ids1.items())  # ids never change
    assert m[("Новая", 103)]["id"] == 4
    ng = sorted(tuple(r) for r in t["dim_ngrns"].collect())
    assert ng == [(1, 100), (2, 101), (3, 102), (4, 103)]
    assert sorted(r["status"] for r in t["dim_statuses"].collect()) == sorted(
        ["Действующий", "", "Закрыт"])
    assert t["dim_contacts"].count() == len(dims1["contacts"]) + 1
    assert sorted(tuple(r) for r in t["dim_regions"].collect()) == dims1["regions"]
    snapshot = {n: sorted(tuple(r) for r in df.collect()) for n, df in t.items()}

    # pull 3 = pull 2 again: nothing changes
    assert run_cycle(store, feeds_of(spark, p2)) == 3
    t3 = current_tables(store)
    assert {n: sorted(tuple(r) for r in df.collect()) for n, df in t3.items()} == snapshot


def test_conflicting_key_kept_latest(spark, workdir, pulls):
    """Key 100 has several (status, location) rows in the window: one row kept."""
    from dimloom.plans.mart import conflicting_keys
    from dimloom.operators import watermark as wmk

    store = StateStore(spark, os.path.join(workdir, "state"))
    p1, p2 = pulls
    run_cycle(store, feeds_of(spark, p1))
    run_cycle(store, feeds_of(spark, p2))
    t = current_tables(store)
    pri = [wmk.prior_value(t[f"wm_{x}"]) for x in ("short", "okved", "address")]
    rows = conflicting_keys(t["stg_short"], t["stg_okved"], t["stg_address"], *pri).collect()
    assert [(r["org_name"], r["ngrn"], r["status"], r["location"]) for r in rows] == [
        ("О'Нил А.", 100, "Закрыт", "Новый адрес")]


def test_stream_equals_batch(spark, workdir, pulls):
    p1, p2 = pulls
    pulls_dir = os.path.join(workdir, "pulls")
    write_pull(spark, pulls_dir, 1, p1, "1991-01-01", "2023-01-02")
    write_pull(spark, pulls_dir, 2, p2, "2023-01-02", "2023-01-05")
    q = start_cycle_stream(spark, pulls_dir, os.path.join(workdir, "sstate"),
                           os.path.join(workdir, "chk"))
    q.awaitTermination()
    s_store = StateStore(spark, os.path.join(workdir, "sstate"))
    assert s_store.latest() == (2, 1)            # two batches, ids 0 and 1
    b_store = StateStore(spark, os.path.join(workdir, "bstate"))
    run_cycle(b_store, feeds_of(spark, p1))
    run_cycle(b_store, feeds_of(spark, p2))
    s, b = current_tables(s_store), current_tables(b_store)
    for name in s:
        assert sorted(tuple(r) for r in s[name].collect()) == sorted(tuple(r) for r in b[name].collect()), name
    # restart on the same checkpoint: no new batch, nothing republished
    q = start_cycle_stream(spark, pulls_dir, os.path.join(workdir, "sstate"),
                           os.path.join(workdir, "chk"))
    q.awaitTermination()
    assert s_store.latest() == (2, 1)


def changed(pull, kind, k, **values):
    """A copy of a pull with one row's values changed."""
    return {name: [({**r, **values} if (name, i) == (kind, k) else r) for i, r in enumerate(rows)] for name, rows in pull.items()}


@pytest.mark.parametrize("pull,error", [
    (changed(PULL1, "short_info", 2, ngrn=None), "null ngrn"),
    (changed(PULL1, "contact_info", 0, vregion="x" * 60), "too long: vregion"),
    (changed(PULL1, "okved_info", 0, nsi00114={"vkvdn": "9" * 40, "vnvdnp": "t"}), "too long: okved_code"),
])
def test_violations_are_not_published(spark, workdir, pull, error):
    store = StateStore(spark, os.path.join(workdir, "state"))
    root = land(os.path.join(workdir, "p"), pull, "2023-01-02")
    with pytest.raises(ConstraintViolation, match=error):
        run_cycle(store, feeds_of(spark, root))
    assert store.latest()[0] == 0
    t = current_tables(store)
    assert all(t[n].count() == (n.startswith("wm_")) for n in t)


def test_bad_or_absent_feeds_leave_the_version(spark, workdir, pulls):
    store = StateStore(spark, os.path.join(workdir, "state"))
    p1, p2 = pulls
    run_cycle(store, feeds_of(spark, p1))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        feeds_of(spark, os.path.join(workdir, "nowhere"))
    with open(os.path.join(p2, "contact_info", "load_date=2023-01-05", "feed.json"), "w") as f:
        f.write("<html>busy</html>")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|Malformed"):
        run_cycle(store, feeds_of(spark, p2))
    assert store.latest()[0] == 1 and marks(current_tables(store), "short") == ["1991-01-01", "2023-01-02"]


def test_orphans_of_late_rows_are_refused(spark, workdir):
    """An old short row that its fresh address brings into the mart has its keys in no dimension."""
    old = "2022-06-01T00:00:00+03:00"
    store = StateStore(spark, os.path.join(workdir, "state"))
    run_cycle(store, feeds_of(spark, land(os.path.join(workdir, "p1"), PULL1, "2023-01-02")))
    run_cycle(store, feeds_of(spark, land(os.path.join(workdir, "p2"), PULL2, "2023-01-05")))
    late = {"short_info": [{"ngrn": 900, "dfrom": old, "vnaim": "Старая", "nsi00219": {"vnsostk": "Иной"}}],
            "contact_info": [{**PULL2["contact_info"][0], "ngrn": 900, "dfrom": "2023-02-01T00:00:00+03:00"}], "okved_info": []}
    with pytest.raises(ConstraintViolation, match="is not in dim_"):
        run_cycle(store, feeds_of(spark, land(os.path.join(workdir, "p3"), late, "2023-02-01")))
    assert store.latest()[0] == 2


def test_new_checkpoint_loses_no_pull_and_repeats_none(spark, workdir, pulls):
    p1, p2 = pulls
    d = {n: os.path.join(workdir, n) for n in ("pulls", "state", "chk1", "chk2")}
    write_pull(spark, d["pulls"], 1, p1, "1991-01-01", "2023-01-02")
    start_cycle_stream(spark, d["pulls"], d["state"], d["chk1"]).awaitTermination()
    store = StateStore(spark, d["state"])
    assert store.latest()[0] == 1
    write_pull(spark, d["pulls"], 2, p2, "2023-01-02", "2023-01-05")
    start_cycle_stream(spark, d["pulls"], d["state"], d["chk2"]).awaitTermination()
    assert store.latest()[0] == 2
    assert 103 in {r["ngrn"] for r in current_tables(store)["mart"].collect()}


def test_crash_retry_double_publish_lost_folder_and_reset(spark, workdir, pulls, monkeypatch):
    store = StateStore(spark, os.path.join(workdir, "state"))
    p1, p2 = pulls
    monkeypatch.setattr(store, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("crash")) if a[0] == 1 else StateStore.publish(store, *a, **k))
    with pytest.raises(OSError, match="crash"):
        run_cycle(store, feeds_of(spark, p1))
    assert store.latest()[0] == 0 and current_tables(store)["mart"].count() == 0
    monkeypatch.undo()
    assert run_cycle(store, feeds_of(spark, p1)) == 1
    rows = mart_rows(current_tables(store))
    assert len(rows) == 3
    with pytest.raises(AnalysisException, match="ALREADY_EXISTS"):
        store.publish(1)
    assert store.reset() == 2
    t = current_tables(store)
    assert all(t[n].count() == (n.startswith("wm_")) for n in t)
    assert run_cycle(store, feeds_of(spark, p1)) == 3
    assert mart_rows(current_tables(store)) == rows
    os.rename(os.path.join(workdir, "state", "mart"), os.path.join(workdir, "state", "lost"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        run_cycle(store, feeds_of(spark, p2))
