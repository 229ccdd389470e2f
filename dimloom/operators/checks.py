"""Table constraints as data checks; each returns the violating rows.

Parquet does not enforce NOT NULL, UNIQUE or FOREIGN KEY, so a cycle runs
these on its delta and refuses to publish when any returns rows. All are
single-pass and distributed: the row checks filter before they expand (IS
NULL reaches the scan), the unique check aggregates partially before its
shuffle, and the foreign-key counts aggregate the child per key before the
anti-join, so a hot key is one row of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.constants import LENGTH_LIMITS


def _violations(df: DataFrame, flags: Mapping[str, object], keep: Sequence[str]) -> DataFrame:
    found = reduce(lambda a, b: a | b, flags.values())
    names = F.array(*[F.when(cond, F.lit(name)) for name, cond in flags.items()])
    return (df.where(found).select(*keep, F.filter(names, lambda x: x.isNotNull()).alias("_v"))
              .select(*keep, F.explode("_v").alias("violation")))


def check_not_null(df: DataFrame, columns: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """One output row per (row, NULL column) in one scan."""
    keep = list(keep) if keep else list(df.columns)
    return _violations(df, {c: F.col(c).isNull() for c in columns}, keep)


def check_length(df: DataFrame, limits: Mapping[str, int] | None = None,
                 keep: Sequence[str] | None = None) -> DataFrame:
    """Rows whose text exceeds its ``varchar(n)`` limit (characters)."""
    limits = {c: n for c, n in (limits or LENGTH_LIMITS).items() if c in df.columns}
    keep = list(keep) if keep else list(df.columns)
    return _violations(df, {c: F.char_length(c) > n for c, n in limits.items()}, keep)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def check_fk(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
             parent_cols: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    parent_cols = list(parent_cols or child_cols)
    p = parent.select(*[F.col(pc).alias(cc) for pc, cc in zip(parent_cols, child_cols)])
    nn = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in child_cols))
    return child.where(nn).join(p, list(child_cols), "left_anti")


def fk_orphan_counts(relations: Sequence[tuple[str, DataFrame, DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """``(relation, orphans)`` for several foreign keys at once.

    Relations of one child frame share one scan of it: its rows are counted
    per (relation, key) first, and those counts meet the parents' keys.
    """
    def key(columns):
        return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)]))

    children: dict[int, tuple[DataFrame, list]] = {}
    for r in relations:
        children.setdefault(id(r[1]), (r[1], []))[1].append(r)
    counts, parents = [], []
    for child, own in children.values():
        refs = [F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cc]),
                       F.struct(F.lit(name).alias("relation"), key(cc).alias("key"))) for name, _, _, cc, _ in own]
        counts.append(child.select(F.explode(F.array(*refs)).alias("r")).where("r is not null")
                           .groupBy("r.relation", "r.key").agg(F.count(F.lit(1)).alias("n")))
    for name, _, parent, _, pc in relations:
        parents.append(parent.select(F.lit(name).alias("relation"), key(pc).alias("key")))
    orphans = (reduce(DataFrame.unionByName, counts).join(reduce(DataFrame.unionByName, parents), ["relation", "key"], "left_anti")
               .groupBy("relation").agg(F.sum("n").alias("orphans")))
    spark = relations[0][1].sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(r[0]) for r in relations])).alias("relation"))
    return names.join(orphans, "relation", "left").select("relation", F.coalesce("orphans", F.lit(0)).cast("long").alias("orphans"))
