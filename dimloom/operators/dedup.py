"""Deterministic deduplication.

``keep_first`` / ``distinct_on`` use ``row_number() == 1`` over a window
partitioned by the key. Catalyst plans that as a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it, so each
map task ships at most one row per key: a key holding a third of all rows
costs one row per task on the wire, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order`` (make the order total).

    Unlike ``dropDuplicates`` the survivor is fixed by ``order`` (e.g. feed
    position), never by task scheduling.
    """
    if not order:
        raise ValueError("keep_first needs an order; use distinct_rows for whole-row dedup")
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order`` with a total order."""
    return keep_first(df, keys, order)


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  name: str = "rnum") -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` as a bigint column."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-row dedup on the business columns (surrogate ids excluded).

    All listed columns are equal within a group, so the survivor is not
    arbitrary. Aggregation is partial (map-side) before the shuffle.
    """
    cols = list(columns) if columns else df.columns
    return df.select(*cols).distinct()
