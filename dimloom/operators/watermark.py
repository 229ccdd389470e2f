"""Per-source watermarks.

A watermark table is a one-column DataFrame ``max_dfrom`` holding every
maximum a load cycle has seen (plus the seed). The *current* mark is its
maximum and starts the next pull; the *prior* mark (second largest) opens the
freshness window ``dfrom >= prior``.

All reads return 1-row DataFrames; ``.scalar()`` turns one into a scalar
subquery that Catalyst evaluates once and pushes into the Parquet scan as a
runtime filter. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.constants import WATERMARK_SEED
from dimloom.schemas import WATERMARK_SCHEMA

COL = "max_dfrom"


def seed(spark: SparkSession) -> DataFrame:
    """Initial table: the single seed row."""
    return spark.createDataFrame([], WATERMARK_SCHEMA).unionByName(
        spark.range(1).select(F.lit(WATERMARK_SEED).cast("timestamp").alias(COL)))


def current(wm: DataFrame) -> DataFrame:
    """Largest mark (start of the next pull)."""
    return wm.agg(F.max(COL).alias(COL))


def prior(wm: DataFrame) -> DataFrame:
    """Second-largest mark, NULL with fewer than two rows.

    Written as ``max(d) where d < max(d)``: two partial aggregates, no
    single-partition sort. Marks are unique, so this equals
    ``row_number() over (order by d desc) = 2``.
    """
    top = current(wm).scalar()
    return wm.filter(F.col(COL) < top).agg(F.max(COL).alias("prior"))


def next_mark(stg: DataFrame, col: str = "dfrom") -> DataFrame:
    """``MAX(dfrom)`` of the staging table (NULL when it is empty)."""
    return stg.agg(F.max(col).alias(COL))


def advance(wm: DataFrame, stg: DataFrame, col: str = "dfrom") -> DataFrame:
    """Insert the staging maximum unless present; an empty stage changes nothing."""
    new = next_mark(stg, col).filter(F.col(COL).isNotNull())
    return wm.unionByName(new.join(wm, COL, "left_anti"))


def added_mark(wm: DataFrame, stg: DataFrame, col: str = "dfrom") -> DataFrame:
    """Only the row ``advance`` would add (0 or 1 row): what a cycle appends."""
    return next_mark(stg, col).filter(F.col(COL).isNotNull()).join(wm, COL, "left_anti")


def step(marks: Sequence[int], largest: int | None, seen: int | None) -> tuple[list[int], int | None, int | None]:
    """``advance`` without a look at the history: two numbers carried from cycle to cycle.

    ``marks`` are the two largest marks (microseconds, largest first), ``largest``
    is the maximum of all staged rows and ``seen`` that of the new ones. Returns the
    marks and the maximum afterwards, and the mark to insert, if any. The maximum
    never falls, so a mark is new exactly if the maximum rose (and is not the seed).
    """
    now = max((x for x in (largest, seen) if x is not None), default=None)
    if now is None or now == largest or now in marks:
        return list(marks), now, None
    return sorted({*marks, now}, reverse=True)[:2], now, now


def prior_value(wm: DataFrame) -> Column:
    """The prior mark as a scalar-subquery column."""
    return prior(wm).scalar()


def prior_literal(wm: DataFrame) -> Column:
    """The prior mark read once (a one-cell job) and inlined as a typed literal.

    Use when the mark feeds several jobs: a literal is a static pushed filter
    (row-group pruning) and is not re-evaluated per job, as a subquery is.
    """
    dtype = wm.schema[COL].dataType
    return typed_literal(prior(wm).first()[0], dtype)


def typed_literal(value, dtype) -> Column:
    """A collected timestamp back as a literal of ``dtype``.

    Zone-less values go through ISO text (no Python-side zone conversion);
    instants round-trip through the same local zone PySpark collected them in.
    """
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def fresh(df: DataFrame, prior_mark: Column, col: str = "dfrom") -> DataFrame:
    """Rows inside the freshness window. A NULL prior keeps nothing."""
    return df.filter(F.col(col) >= prior_mark)


def late(df: DataFrame, prior_mark: Column, col: str = "dfrom") -> DataFrame:
    """Rows older than the window: they stay in stg and never reach dds."""
    return df.filter(F.col(col) < prior_mark)
