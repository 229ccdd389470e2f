"""Sinks: append to a staging table and export a selection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dimloom.operators.portal import export  # noqa: F401  (re-exported sink)


def append(df: DataFrame, path: str) -> None:
    """Append rows to a Parquet table (no index column). Call once per pull."""
    df.write.mode("append").parquet(path)
