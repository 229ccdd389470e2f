"""One load cycle: feeds -> stg -> watermarks -> dds -> dm, then publish.

Order and semantics of a cycle:

1. shape each feed (projection, nested fields, keep-first per ngrn within
   the pull, fill);
2. staging: append only rows not already present (business columns,
   NULL-safe) — the intended whole-row dedup, applied once;
3. watermarks: add ``MAX(dfrom)`` of each staging table unless present;
4. dimensions: insert-ignore the fresh rows (``dfrom >= prior mark`` of
   their source) with new dense ids; existing ids never change;
5. mart: build the windowed rows and upsert them (update date, status,
   okved_code, okved_text; keep the rest);
6. constraints: NOT NULL, lengths, unique keys and foreign keys of the
   cycle's own rows; any violation ends the cycle unpublished;
7. publish the version (manifest written last).

What a cycle reads grows with its pull and its window, not with the history: the
marks follow from the delta's maximum and the last manifest, fresh rows come from
the staging slots since the prior mark, the maxima over all rows are kept per key
and only the buckets that the pull touches are merged, and the mart is written
anew in the buckets where a row changes. (The dimensions, which are read whole,
hold each value once.)

Counts and checks ride along with the pass that writes the rows
(``DataFrame.observe``): a clean pull is not scanned again to be checked.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dimloom.constants import LENGTH_LIMITS, MART_KEYS, MART_UPDATE_COLS
from dimloom.operators import watermark as wmk
from dimloom.operators.checks import check_fk, check_length, check_not_null, check_unique
from dimloom.operators.dedup import distinct_rows
from dimloom.operators.ids import materialize
from dimloom.operators.upsert import changing, new_members_of_all, upsert
from dimloom.plans.mart import mart_from_tops, merged_tops
from dimloom.plans.shape import SHAPERS
from dimloom.schemas import (DIMENSIONS, KIND_TO_STG, MART_FOREIGN_KEYS, MART_SCHEMA, STG_COLUMNS,
                             STG_SCHEMAS)
from dimloom.session import free_shuffles
from dimloom.sources.state import StateStore, bucket, slot

log = logging.getLogger("dimloom.cycle")


def new_stage_rows(shaped: DataFrame, stg: DataFrame, table: str) -> DataFrame:
    """Shaped rows not yet in staging (whole business row, NULL-safe).

    Equal rows have equal ``dfrom``: the history that matters lies inside the
    pull's ``dfrom`` range, and ``stg`` need hold no more. That history first
    meets the pull's rows by a semi-join: a pull that Spark measures as small is
    broadcast, so the history is scanned and not shuffled; only the rows that
    both hold go on to the anti-join.
    """
    cols = STG_COLUMNS[table]

    def same(a: str, b: str) -> list[Column]:
        return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]

    pull = distinct_rows(shaped, cols)
    held = stg.select(*cols).alias("o").join(pull.alias("p"), same("o", "p"), "left_semi")
    return pull.alias("n").join(held.alias("h"), same("n", "h"), "left_anti").select(*[F.col(f"n.{c}") for c in cols])


class ConstraintViolation(ValueError):
    """Rows of a cycle break a table constraint; nothing was published."""


def _required(schema) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def _refuse(where: str, found: list[DataFrame]) -> None:
    """Raise if any of these (relation, key) frames has a row; a few examples reach the driver."""
    rows = reduce(DataFrame.unionByName, found).limit(5).collect()
    if rows:
        raise ConstraintViolation(f"{where}: " + "; ".join(f"{r['violation']} ({r['example']})" for r in rows))


def _example(df: DataFrame, violation, columns) -> DataFrame:
    return df.select(violation.alias("violation"), F.to_json(F.struct(*[F.col(c) for c in columns])).alias("example"))


def pull_facts(table: str) -> dict[str, Column]:
    """What the pass that writes a shaped pull observes: its ``dfrom`` range, and its violations by kind."""
    facts = {"first": F.unix_micros(F.min("dfrom")), "last": F.unix_micros(F.max("dfrom"))}
    facts |= {f"null {c}": F.count_if(F.col(c).isNull()) for c in _required(STG_SCHEMAS[table])}
    return facts | {f"too long: {c}": F.count_if(F.char_length(c) > n) for c, n in LENGTH_LIMITS.items() if c in STG_COLUMNS[table]}


def check_pull(shaped: DataFrame, table: str) -> None:
    """NOT NULL and lengths of one feed's shaped rows; raises with examples."""
    required = [f for f in _required(STG_SCHEMAS[table]) if f in shaped.columns]
    _refuse(f"feed {table}", [_example(check_not_null(shaped, required, ["ngrn"]), F.concat(F.lit("null "), "violation"), ["ngrn"]),
                              _example(check_length(shaped, keep=["ngrn"]), F.concat(F.lit("too long: "), "violation"), ["ngrn"])])


def check_mart(rows: DataFrame, dims: Mapping[str, DataFrame]) -> None:
    """NOT NULL, lengths, unique keys and foreign keys of the rows that a cycle brings to the mart."""
    required = [c for c in _required(MART_SCHEMA) if c in rows.columns]
    keys = list(MART_KEYS)
    found = [_example(check_not_null(rows, required, keys), F.concat(F.lit("null "), "violation"), keys),
             _example(check_length(rows, keep=keys), F.concat(F.lit("too long: "), "violation"), keys),
             _example(check_unique(rows, keys), F.lit("key occurs twice"), keys)]
    for column, (dim, parent) in MART_FOREIGN_KEYS.items():
        found.append(_example(check_fk(rows, dims[dim], [column], [parent]), F.lit(f"{column} is not in dim_{dim}"), [*keys, *({column} - {*keys})]))
    _refuse("mart", found)


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in STG_SCHEMAS[table].fields])


def _observed(df: DataFrame, facts: Mapping[str, Column], label: str) -> tuple[DataFrame, dict]:
    """``df`` written once, and aggregates that the writing pass saw."""
    seen = Observation()
    written = materialize(df.observe(seen, *[c.alias(k) for k, c in facts.items()]), label)
    return written, seen.get


def _stage(store: StateStore, feeds: Mapping[str, DataFrame], prev: int, cyc: int, strict: bool) -> dict[str, set[int]]:
    """Steps 1 to 3; returns the buckets of the keys that got new rows, per staging table."""
    v, touched = store.version(cyc), {}
    for kind, table in KIND_TO_STG.items():
        # the feed's files are read once
        shaped, seen = _observed(_typed(SHAPERS[kind](feeds[kind]), table), pull_facts(table), "pull")
        if strict and any(n for k, n in seen.items() if k not in ("first", "last")):
            check_pull(shaped, table)
        known = store.read_since(f"stg_{table}", prev, seen["first"], seen["last"])
        before = v.marks[table]  # the window will open at one of these: rows before it are late
        got = store.append(f"stg_{table}", new_stage_rows(shaped, known, table), cyc, slot(F.unix_micros("dfrom")), ["ngrn"], {
            "largest": F.unix_micros(F.max("dfrom")), **{f"before {m}": F.count_if(F.unix_micros("dfrom") < m) for m in before},
            "buckets": F.array_join(F.collect_set(bucket(v.buckets)), ",")})
        touched[table] = {int(b) for b in filter(None, (got["buckets"] or "").split(","))}
        marks, largest, new = wmk.step(before, v.largest.get(table), got["largest"])
        v.marks[table] = marks
        v.counts[f"stg_{table}.late"] = got.get(f"before {marks[-1]}", 0) if len(marks) > 1 else 0
        if largest is not None:
            v.largest[table] = largest
        if new is not None:
            mark = store.spark.range(1).select(F.timestamp_micros(F.lit(new)).alias(wmk.COL))
            store.append(f"wm_{table}", mark, cyc)
        free_shuffles(store.spark)  # the pull's shuffle is as large as the feed
    return touched


def run_cycle(store: StateStore, feeds: Mapping[str, DataFrame], batch_id: int | None = None,
              strict: bool = True, pull: str | None = None, period: tuple[str, str] | None = None) -> int:
    """Run one cycle over ``feeds`` (kind -> raw feed rows); returns the version.

    ``strict=False`` leaves the constraints unchecked. ``pull`` and ``period``
    name the pull and its bounds in the manifest, which is the log of the cycles.
    """
    missing = [k for k in SHAPERS if k not in feeds]
    if missing:
        raise ValueError(f"feeds missing for {missing}; a cycle needs all three")
    prev, _ = store.latest()
    if prev < 0:
        prev = store.initialize()
    cyc = store.begin(prev)
    v = store.version(cyc)

    # 1-3. staging deltas and watermarks
    touched = _stage(store, feeds, prev, cyc, strict)
    priors = {t: v.marks[t][1] if len(v.marks[t]) > 1 else None for t in STG_SCHEMAS}
    fresh = {t: store.read_since(f"stg_{t}", cyc, priors[t]) for t in STG_SCHEMAS}

    # 4. dimensions (insert-only)
    members = new_members_of_all({
        name: (store.read(f"dim_{name}", prev), fresh[src].select(*[F.col(s).alias(d) for s, d in cols]), [d for _, d in cols])
        for name, (src, cols) in DIMENSIONS.items()})
    for name, rows in members.items():
        store.append(f"dim_{name}", rows, cyc)

    # 5. mart: maxima of the touched buckets, the changed keys' rows, and the buckets where one differs
    for t, own in touched.items():
        if own:
            store.rewrite(f"top_{t}", merged_tops(store.read(f"top_{t}", prev, own), store.added(f"stg_{t}", cyc), t), cyc, own)
    keys = reduce(DataFrame.unionByName, [df.select("ngrn") for df in fresh.values()]).distinct()
    spread = {"buckets": F.array_join(F.collect_set(bucket(v.buckets)), ",")}
    keys, seen = _observed(keys, spread, "changed-keys")
    own = [int(b) for b in filter(None, (seen["buckets"] or "").split(","))]
    rows = materialize(mart_from_tops({t: store.read(f"top_{t}", cyc, own) for t in STG_SCHEMAS}, fresh, keys), "mart-rows")
    # 6. constraints
    if strict:
        check_mart(rows, {d: store.read(f"dim_{d}", cyc) for d, _ in MART_FOREIGN_KEYS.values()})
    rows, seen = _observed(changing(store.read("mart", prev, own), rows, MART_KEYS, MART_UPDATE_COLS), spread, "mart-changes")
    own = [int(b) for b in filter(None, (seen["buckets"] or "").split(","))]
    if own:
        merged = upsert(store.read("mart", prev, own), rows, MART_KEYS, MART_UPDATE_COLS, written=True, base=v.top_id)
        v.top_id = max(v.top_id, store.rewrite("mart", merged, cyc, own, {"top": F.max("id")})["top"] or 0)

    # 7. publish
    store.fold(cyc)
    store.publish(cyc, batch_id, pull, period)
    log.info("published version %s of period %s: %s", cyc, period, v.counts)
    return cyc


def current_tables(store: StateStore) -> dict[str, DataFrame]:
    """All tables of the published version."""
    v, _ = store.latest()
    return {name: store.read(name, v) for name in store.schemas}
