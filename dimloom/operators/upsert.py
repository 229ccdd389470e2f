"""Keyed writes as pure DataFrame functions returning the next snapshot.

Plain Parquet has no MERGE, identity or unique constraint, so both the
insert-ignore of the dimensions and the partial-column upsert of the mart
are expressed with joins; the caller writes the result as a new version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.operators.ids import materialize, with_dense_ids


def _base_id(target: DataFrame, id_col: str):
    # First load: max(id) of an empty table is NULL -> start at 0.
    return F.coalesce(target.agg(F.max(id_col)).scalar(), F.lit(0)).cast("long")


def missing_members(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-null source keys absent from the target.

    The anti-join is planned by AQE (broadcast of the target when its measured
    size allows, sort-merge otherwise).
    """
    keys = list(keys)
    cand = source.select(*keys).where(
        F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))).distinct()
    return cand.join(target.select(*keys), keys, "left_anti")


def new_members(target: DataFrame, source: DataFrame, keys: Sequence[str],
                id_col: str = "id") -> DataFrame:
    """``missing_members`` with new dense ids.

    Ids continue after ``max(target.id)`` in key order; existing ids are
    never touched.
    """
    keys = list(keys)
    out = with_dense_ids(missing_members(target, source, keys), keys, id_col, base=_base_id(target, id_col))
    return out.select(id_col, *keys)


#: Typed slots that hold any table's key: one numbering pass serves keys of different tables.
_SLOTS = {"bigint": ["n1"], "timestamp": ["t1"], "string": ["s1", "s2", "s3"]}


def new_members_of_all(tables: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]],
                       id_col: str = "id") -> dict[str, DataFrame]:
    """``new_members`` of several tables (name -> target, source, keys) in one numbering pass.

    All new keys are ordered by table, then key, and numbered together; each
    table's ids then start after its own maximum. A table without a new key is
    not in the result.
    """
    slots = [(s, t) for t, names in _SLOTS.items() for s in names]
    parts, places = [], {}
    for name, (target, source, keys) in tables.items():
        free = {t: list(names) for t, names in _SLOTS.items()}
        places[name] = [(k, free[target.schema[k].dataType.simpleString()].pop(0)) for k in keys]
        at = {slot: F.col(k) for k, slot in places[name]}
        parts.append(missing_members(target, source, keys).select(
            F.lit(name).alias("table"), *[at.get(s, F.lit(None)).cast(t).alias(s) for s, t in slots]))
    numbered = with_dense_ids(reduce(DataFrame.unionByName, parts), ["table", *[s for s, _ in slots]], "place")
    first = {r["table"]: r["first"] for r in numbered.groupBy("table").agg(F.min("place").alias("first")).collect()}  # one row per table
    return {name: numbered.where(F.col("table") == name).select(
        (F.col("place") - F.lit(first[name]) + 1 + _base_id(tables[name][0], id_col)).alias(id_col),
        *[F.col(slot).alias(k) for k, slot in places[name]]) for name in first}


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  id_col: str = "id") -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING`` for an insert-only dimension."""
    return target.select(id_col, *keys).unionByName(new_members(target, source, keys, id_col))


def changing(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """The source rows that an upsert would not find in the target as they are (NULL-safe).

    A merge join: the target is a mart, whose files say little of how large its
    rows are in memory, and a broadcast of it would lie whole in every executor.
    """
    cols = [*keys, *update_cols]
    s, t = source.alias("s"), target.select(*cols).alias("t")
    same = [F.col(f"s.{c}") == F.col(f"t.{c}") for c in keys] + [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in update_cols]
    return s.join(t.hint("merge"), same, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], id_col: str = "id", written: bool = False,
           base: int | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols = EXCLUDED.*``.

    * key only in target: row unchanged;
    * key in both: ``update_cols`` from the source, every other column and
      the id keep the target's (first-inserted) value;
    * key only in source: inserted with a new dense id.

    The source must hold one row per key; it is written to the shared folder
    first unless ``written`` says that it is read from a table. New ids start after
    ``base``, or after the target's largest (give it where ``target`` is only a
    part of the table). The matched side is chosen by a match flag, not ``coalesce``, so a NULL source value still overwrites.
    Shape at scale: the target is left-joined to the (usually small) delta,
    which AQE broadcasts when its measured size allows, so the large target
    keeps its partitioning; only the target's key columns are shuffled for
    the anti-join that finds new keys.
    """
    keys = list(keys)
    update_cols = list(update_cols)
    cols = [c for c in target.columns if c != id_col]
    if not written:
        source = materialize(source)  # read twice below; compute the delta once
    s = source.select(*keys, *update_cols).withColumn("_hit", F.lit(True))
    s = s.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in update_cols], "_hit")
    merged = target.join(s, keys, "left")
    kept = merged.select(
        id_col,
        *[(F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
           if c in update_cols else F.col(c)) for c in cols])
    matched = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    new_rows = source.join(matched, keys, "left_anti")
    inserted = with_dense_ids(new_rows, keys, id_col, base=_base_id(target, id_col) if base is None else base)
    return kept.unionByName(inserted.select(id_col, *cols))
