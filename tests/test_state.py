"""Pieces, manifests and what a cycle reads: the store's own promises."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dimloom.operators import watermark as wmk
from dimloom.plans import mart as mart_plan
from dimloom.plans.cycle import current_tables, run_cycle
from dimloom.plans.period import bounds_text, local_day, next_period
from dimloom.sources import state
from dimloom.sources.state import StateStore, VersionConflict
from tests.fixtures import PULL1, PULL2, land
from tests.test_cycle import feeds_of


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(store, name, version):
    """part -> (file, size, time of change) of a table's pieces."""
    out = {}
    for p in store.version(version).of(name):
        top = os.path.join(store.root, p.path)
        out.setdefault(p.part, []).extend(sorted((p.path, f, os.stat(os.path.join(top, f)).st_mtime_ns) for f in os.listdir(top)))
    return out


def scanned(df):
    """The files that a frame's scans would open."""
    return [f.split("/state/")[-1] for f in df.inputFiles()]


@pytest.fixture()
def three(spark, workdir):
    """A store after three pulls: the third brings one new row, of key 101, a month later."""
    late = {"short_info": [{"ngrn": 101, "dfrom": "2023-03-05T00:00:00+03:00", "vnaim": 'ООО "А, Б"', "nsi00219": {"vnsostk": "Закрыт"}}], "contact_info": [], "okved_info": []}
    store = StateStore(spark, os.path.join(workdir, "state"), buckets=8)
    for k, (pull, day) in enumerate(((PULL1, "2023-01-02"), (PULL2, "2023-01-05"), (late, "2023-03-05"))):
        run_cycle(store, feeds_of(spark, land(os.path.join(workdir, f"p{k}"), pull, day)), period=(day, day))
    return store


def test_three_pulls_of_the_store(spark, three):
    """One store, looked at from all sides (a cycle is many small jobs)."""
    store = three
    # buckets that the third pull did not touch keep their very files
    touched = {r[0] for r in spark.createDataFrame([(101,)], "ngrn long").select(state.bucket(8)).collect()}
    for name in ("mart", "top_short", "top_okved", "top_address"):
        before, after = files(store, name, 2), files(store, name, 3)
        assert {p for p in after if before.get(p) != after[p]} == (touched if name in ("mart", "top_short") else set()), name
    assert store.version(3).counts["mart.rewritten"] < store.read("mart", 3).count()
    # the kept maxima give what the whole history gives
    tables = current_tables(store)
    stg = {t: tables[f"stg_{t}"] for t in ("short", "okved", "address")}
    priors = [wmk.prior_literal(tables[f"wm_{t}"]) for t in ("short", "okved", "address")]
    whole = mart_plan.build_mart(stg["short"], stg["okved"], stg["address"], *priors)
    fresh = {t: store.read_since(f"stg_{t}", 3, store.version(3).marks[t][1]) for t in stg}
    keys = fresh["short"].select("ngrn").union(fresh["okved"].select("ngrn")).union(fresh["address"].select("ngrn")).distinct()
    kept = mart_plan.mart_from_tops({t: store.read(f"top_{t}", 3) for t in stg}, fresh, keys)
    assert rows_of(kept.select(*whole.columns)) == rows_of(whole)
    for t, df in stg.items():
        assert rows_of(store.read(f"top_{t}", 3)) == rows_of(mart_plan.tops(df, t))
    # and read only the slots since the marks
    slots = sorted(p.part for p in store.version(3).of("stg_short"))
    assert len(set(slots)) == 2 and {p.part for p in store.version(3).of("stg_short", since=slots[-1])} == {slots[-1]}
    since = store.read_since("stg_short", 3, store.version(3).marks["short"][0])
    assert len(scanned(since)) == 1 and len(scanned(stg["short"])) == len(slots) and since.count() == 1
    assert "stg_" in " ".join(scanned(kept)) and len([f for f in scanned(kept) if f.startswith("stg_short")]) < len(slots) + 1
    # the marks of the manifest are those of the tables
    for t, df in stg.items():
        marks = sorted((r[0] for r in tables[f"wm_{t}"].select(F.unix_micros("max_dfrom")).collect()), reverse=True)
        assert store.version(3).marks[t] == marks[:2]
        assert store.version(3).largest[t] == df.agg(F.unix_micros(F.max("dfrom"))).first()[0]
    # an empty delta adds no piece
    assert not [p for p in store.version(3).of("stg_okved") if "cycle=3-" in p.path]
    # the log: the period, and counts from the writing passes
    log = {r["version"]: r for r in store.manifests().collect()}
    assert (log[3]["period_start"], log[3]["period_end"]) == ("2023-03-05", "2023-03-05") and log[0]["period_start"] is None
    assert log[3]["counts"]["stg_short.rows"] == 1 and log[3]["counts"]["stg_short.late"] == 0
    # the next pull starts at the mark's day in the asked zone
    asked = dt.datetime(2023, 3, 7, 22, 30, tzinfo=dt.timezone.utc)
    assert next_period(store, asked, "Europe/Minsk") == (dt.date(2023, 3, 5), dt.date(2023, 3, 8))
    assert next_period(store, asked, "UTC") == (dt.date(2023, 3, 4), dt.date(2023, 3, 7))
    assert next_period(store, dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc), "UTC") == (dt.date(2023, 1, 1), dt.date(2023, 1, 1))


def test_the_loser_of_two_cycles_changes_nothing(spark, workdir):
    """Both start from version 0 and write all they have; only the first to publish is ever read."""
    root = os.path.join(workdir, "state")
    a, b = StateStore(spark, root), StateStore(spark, root)
    a.initialize()
    one, other = ([("Org", 1, "s1")], [("Org", 1, "s2"), ("Org2", 2, "s2")])

    def write(store, rows):
        cycle = store.begin(0)
        df = spark.createDataFrame(rows, "org_name string, ngrn long, status string").select("ngrn", F.timestamp_micros(F.lit(10 ** 15)).alias("dfrom"), "org_name", "status", F.lit("ЮЛ").alias("org_type"))
        store.append("stg_short", df, cycle, state.slot(F.unix_micros("dfrom")), ["ngrn"])
        store.rewrite("top_short", mart_plan.tops(df, "short"), cycle, range(16))
        return cycle

    write(a, one), write(b, other)
    a.publish(1, pull="a")
    want = rows_of(a.read("stg_short", 1)), rows_of(a.read("top_short", 1))
    with pytest.raises(VersionConflict, match="ALREADY_EXISTS"):
        b.publish(1, pull="b")
    new = StateStore(spark, root)
    assert new.latest() == (1, None) and new.published("a") and not new.published("b")
    assert (rows_of(new.read("stg_short", 1)), rows_of(new.read("top_short", 1))) == want
    # the loser starts again from what was published
    cycle = b.begin(b.latest()[0])
    b.append("stg_short", spark.createDataFrame([], b.schemas["stg_short"]), cycle)
    b.publish(cycle)
    assert rows_of(StateStore(spark, root).read("stg_short", 2)) == want[0]


def test_many_small_pieces_are_folded(spark, workdir, monkeypatch):
    monkeypatch.setattr(state, "FOLD", 3)
    store = StateStore(spark, os.path.join(workdir, "state"))
    version = store.initialize()
    day = 86_400_000_000
    for k in range(9):
        cycle = store.begin(version)
        df = spark.range(k, k + 2).select(F.col("id").alias("ngrn"), F.timestamp_micros(F.lit((k % 2) * 40 * day)).alias("dfrom"), F.lit("n").alias("org_name"), F.lit("s").alias("status"), F.lit("ЮЛ").alias("org_type"))
        store.append("stg_short", df, cycle, state.slot(F.unix_micros("dfrom")), ["ngrn"])
        store.fold(cycle)
        store.publish(cycle)
        version = cycle
    pieces = store.version(version).of("stg_short")
    assert sorted((p.part, p.level) for p in pieces) == [(0, 0), (0, 0), (0, 1), (1, 0), (1, 1)]
    assert sorted(r["ngrn"] for r in StateStore(spark, store.root).read("stg_short", version).collect()) == sorted(x for k in range(9) for x in (k, k + 1))
    assert store.read("stg_short", 4).count() == 8  # an older version reads what it named


@pytest.mark.parametrize("marks,largest,seen,want", [
    ([5], None, None, ([5], None, None)), ([5], None, 9, ([9, 5], 9, 9)), ([9, 5], 9, 7, ([9, 5], 9, None)), ([9, 5], 9, 9, ([9, 5], 9, None)),
    ([9, 5], 9, 12, ([12, 9], 12, 12)), ([5], None, 5, ([5], 5, None)), ([5], None, 3, ([5, 3], 3, 3)), ([5, 3], 3, 4, ([5, 4], 4, 4)), ([5, 4], 4, 5, ([5, 4], 5, None))])
def test_mark_step(marks, largest, seen, want):
    assert wmk.step(marks, largest, seen) == want


def test_days_of_zones():
    late = dt.datetime(2023, 12, 31, 21, 30, tzinfo=dt.timezone.utc)
    assert local_day(late, "Europe/Minsk") == dt.date(2024, 1, 1) and local_day(late, "America/New_York") == dt.date(2023, 12, 31)
    assert local_day(0, "UTC") == dt.date(1970, 1, 1) and local_day(-1, "UTC") == dt.date(1969, 12, 31)
    assert bounds_text(dt.date(2023, 1, 2), dt.date(2024, 1, 1)) == ("02.01.2023", "01.01.2024")
    with pytest.raises(ValueError, match="no zone"):
        local_day(dt.datetime(2023, 1, 1), "UTC")
