"""Feeds that Spark fetches by the day, their incremental cutting, and the loop over periods."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from dimloom.constants import FEED_KINDS
from dimloom.plans.cycle import current_tables, run_cycle
from dimloom.sources.feeds import read_feed
from dimloom.sources.fetch import array_items, fetch_feed, land_arrays, land_period
from dimloom.sources.state import StateStore
from dimloom.streaming.period_stream import start_period_stream
from tests.fixtures import PULL1, PULL2, land


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_objects_of_an_array_in_any_chunks():
    rng = random.Random(1)
    items = [{"a": "}],[{", "b": "\\\"é漢", "c": {"d": [1, {"e": None}]}, "n": k} for k in range(30)] + [{}]
    for indent in (None, 2):
        whole = json.dumps(items, ensure_ascii=False, indent=indent).encode()
        for _ in range(30):
            cuts = sorted(rng.sample(range(len(whole)), rng.randint(0, 40)))
            chunks = [whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)])]
            found = list(array_items(chunks))
            assert [json.loads(x) for x in found] == items and not any("\n" in x for x in found)
    assert list(array_items(["[", " ]\n"])) == [] and list(array_items(["﻿[{}]"])) == ["{}"]


@pytest.mark.parametrize("bad", ["", " ", "<html>busy</html>", "[", '[{"a":1}', '[{"a":1},', '[{"a":1} {"b":2}]', '[{"a":1}]x', '{"a":1}', "[1]", '[{"a":}]', '[,{"a":1}]', '[{"a":1},]'])
def test_no_array_raises(bad):
    with pytest.raises(ValueError):
        list(array_items(list(bad)))
    with pytest.raises(ValueError):
        list(array_items([bad], longest=4))


def test_memory_of_a_long_answer_is_one_object():
    """200 MB that are never held: the chunks are made as they are asked for."""
    import tracemalloc

    item = json.dumps({"ngrn": 1, "text": "x" * 1000}) + ","
    tracemalloc.start()
    n = sum(1 for _ in array_items(c for part in (["["], (item * 50 for _ in range(4000)), [item[:-1], "]"]) for c in part))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200_001 and peak < 2_000_000


def by_day(pulls):
    """fetch over rows that are kept per kind and local day; days without rows answer ``[]``."""
    kept = {}
    for pull in pulls:
        for kind, rows in pull.items():
            for r in rows:
                kept.setdefault((kind, r["dfrom"][:10]), []).append(r)
    answers = {k: json.dumps(v, ensure_ascii=False, indent=1) for k, v in kept.items()}

    def fetch(kind, day):
        text = answers.get((kind, str(day)), "[]").encode()
        return [text[k:k + 7] for k in range(0, len(text), 7)]
    return fetch


def test_fetched_landed_and_recut_feeds_are_the_same(spark, workdir):
    first, last = dt.date(2022, 12, 31), dt.date(2023, 1, 6)
    fetch = by_day([PULL1, PULL2])
    land_period(spark, fetch, f"{workdir}/lines", first, last)
    for day in range(7):
        d = first + dt.timedelta(day)
        for kind in FEED_KINDS:
            os.makedirs(f"{workdir}/arrays/{kind}/load_date={d}", exist_ok=True)
            for k in (1, 2, 10):  # the second file of a day is empty, the tenth comes after it
                with open(f"{workdir}/arrays/{kind}/load_date={d}/c{k}.json", "wb") as f:
                    f.write(b"".join(fetch(kind, d)) if k != 2 else b"[]")
    land_arrays(spark, f"{workdir}/arrays", f"{workdir}/recut")
    for kind in FEED_KINDS:
        landed = read_feed(spark, kind, f"{workdir}/lines", first, last, layout="lines", every_day=True)
        cols = [c for c in landed.columns if not c.startswith("_")]
        direct = fetch_feed(spark, fetch, kind, first, last)
        assert rows_of(direct.select(*cols)) == rows_of(landed.select(*cols)) and direct.columns == landed.columns
        arrays = read_feed(spark, kind, f"{workdir}/arrays", first, last)
        recut = read_feed(spark, kind, f"{workdir}/recut", first, last, layout="lines", every_day=True)
        assert rows_of(recut.select(*cols)) == rows_of(arrays.select(*cols))
        order = ["load_date", "_file", "_block", "_pos"]
        assert [tuple(r) for r in recut.orderBy(*order).select(*cols).collect()] == [tuple(r) for r in arrays.orderBy(*order).select(*cols).collect()]
    with pytest.raises(ValueError, match="unknown feed kind"):
        fetch_feed(spark, fetch, "nope", first, last)


def test_a_large_array_file_is_cut_in_splits(spark, workdir):
    folder = f"{workdir}/a/short_info/load_date=2023-01-01"
    os.makedirs(folder)
    with open(f"{folder}/x.json", "w") as f:
        f.write("[" + ",".join(json.dumps({"ngrn": k, "vnaim": "}," * (k % 5), "nsi00219": {"vnsostk": f"s{k}"}}) for k in range(60_000)) + "]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        land_arrays(spark, f"{workdir}/a", f"{workdir}/b", ["short_info"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    found = read_feed(spark, "short_info", f"{workdir}/b", layout="lines")
    got = found.agg(F.count("ngrn"), F.sum("ngrn"), F.count_if(F.concat(F.lit("s"), F.col("ngrn").cast("string")) == F.col("nsi00219.vnsostk")),
                    F.count_if(F.length("vnaim") == 2 * (F.col("ngrn") % 5))).first()
    assert tuple(got) == (60_000, 60_000 * 59_999 // 2, 60_000, 60_000)


def test_periods_from_the_clock(spark, workdir):
    """Two triggers without a hand-written pull give what the two pulls give; a failed fetch publishes nothing."""
    moment = f"{workdir}/now"

    def clock():
        with open(moment) as f:
            return dt.datetime.fromisoformat(f.read())

    rows = by_day([{k: [r for r in v if r["ngrn"] != 100 or r["dfrom"] < "2023-01-02"] for k, v in PULL1.items()}, PULL2])
    broken = f"{workdir}/broken"

    def fetch(kind, day):
        if day < dt.date(2023, 1, 1):
            return ["[]"]
        if os.path.exists(broken) and kind == "contact_info":
            raise OSError("the register is down")
        return rows(kind, day)

    def trigger(at):
        with open(moment, "w") as f:
            f.write(at)
        start_period_stream(spark, fetch, f"{workdir}/state", f"{workdir}/landing", f"{workdir}/chk", "Europe/Minsk", clock, available_now=True).awaitTermination()

    store = StateStore(spark, f"{workdir}/state")
    store.initialize()
    cycle = store.begin(0)  # the register begins in 2022: no need to ask for 30 years by the day
    for t in store.version(cycle).marks:
        store.version(cycle).marks[t] = [1672498800000000]
    store.publish(cycle)
    trigger("2023-01-02T20:00:00+00:00")
    assert store.latest() == (2, 0)
    open(broken, "w").close()
    with pytest.raises(Exception, match="register is down|PYTHON"):
        trigger("2023-01-05T12:00:00+00:00")
    assert store.latest() == (2, 0)
    os.rename(broken, broken + ".was")
    trigger("2023-01-05T12:00:00+00:00")  # the batch of the failed trigger is run again
    log = {r["version"]: (r["period_start"], r["period_end"], r["pull"]) for r in StateStore(spark, store.root).manifests().collect()}
    assert log[2][:2] == ("31.12.2022", "02.01.2023") and log[3] == ("02.01.2023", "05.01.2023", "as_of=2023-01-05T12:00:00+00:00")
    mart = {(r["org_name"], r["ngrn"]): (r["status"], r["location"]) for r in current_tables(store)["mart"].collect()}
    assert mart[("О'Нил А.", 100)] == ("Закрыт", "ул. Мира, 5") and set(k for _, k in mart) == {100, 101, 102, 103}
