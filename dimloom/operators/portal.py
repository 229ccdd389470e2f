"""The filter page as DataFrame functions.

* ``options``: option list of one dimension with the "all" option first;
* ``portal_filter``: AND of equality predicates for the active parameters
  plus the half-open date range, always as literals (a quote in a value is
  data, never SQL); the equalities reach the Parquet scan as pushed filters;
* ``export``: the selected rows to CSV/Parquet.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.constants import ALL_OPTION

FILTER_PARAMS = ("ngrn", "org_name", "status", "org_type", "region")


def options(dim: DataFrame, column: str, all_value: str = ALL_OPTION,
            field: str | None = None) -> DataFrame:
    """``(field, ord, value)``: the sentinel (ord 0) then the distinct values (ord 1)."""
    name = field or column
    vals = dim.select(F.col(column).cast("string").alias("value")).distinct()
    sentinel = dim.sparkSession.range(1).select(F.lit(all_value).alias("value"))
    return (sentinel.select(F.lit(name).alias("field"), F.lit(0).alias("ord"), "value")
            .unionByName(vals.select(F.lit(name).alias("field"), F.lit(1).alias("ord"), "value")))


def active_params(params: Mapping[str, object], all_value: str = ALL_OPTION) -> dict[str, object]:
    """Parameters that are not the sentinel."""
    return {k: v for k, v in params.items() if v is not None and v != all_value}


def _ts_text(v) -> str:
    if isinstance(v, _dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, _dt.date):
        return v.strftime("%Y-%m-%d 00:00:00")
    return str(v)


def date_range(df: DataFrame, start, end, column: str = "date") -> DataFrame:
    """``start <= date < end``; start == end selects nothing.

    Bounds are cast from text to the column's own type (instant or local),
    so no Python-side zone conversion happens.
    """
    dtype = df.schema[column].dataType
    lo, hi = F.lit(_ts_text(start)).cast(dtype), F.lit(_ts_text(end)).cast(dtype)
    c = F.col(column)
    return df.filter((c >= lo) & (c < hi))


def portal_filter(mart: DataFrame, params: Mapping[str, object], start, end,
                  all_value: str = ALL_OPTION, output_casts: bool = True) -> DataFrame:
    """Rows of the mart matching every active parameter and the date range."""
    out = mart
    for name, value in active_params(params, all_value).items():
        if name not in FILTER_PARAMS:
            raise ValueError(f"unknown filter parameter {name!r}")
        out = out.filter(F.col(name) == F.lit(value).cast(mart.schema[name].dataType))
    out = date_range(out, start, end)
    if output_casts:
        out = out.withColumns({
            "ngrn": F.col("ngrn").cast("string"),
            "okved_code": F.col("okved_code").cast("string"),
            "date": F.col("date").cast("timestamp_ntz"),
        })
    return out


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the selection with a header (CSV) or as Parquet; no index column."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported export format {fmt!r}")
