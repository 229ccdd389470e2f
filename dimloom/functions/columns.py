"""Column expressions of the shaping step (all builtin, JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.constants import NONE_TEXT, PERIOD_FORMAT, TYPE_COMPANY, TYPE_PERSON


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def org_name(vfio="vfio", vnaim="vnaim") -> Column:
    """Personal name if present, else the organisation name."""
    return F.coalesce(_c(vfio), _c(vnaim))


def org_type(vfio="vfio") -> Column:
    """Individual when a personal name is present (an empty text counts)."""
    return F.when(_c(vfio).isNotNull(), F.lit(TYPE_PERSON)).otherwise(F.lit(TYPE_COMPANY))


def nested_field(struct_col: str, field: str) -> Column:
    """Field of a nested feed object; absent object or field -> ''."""
    return F.coalesce(F.col(f"{struct_col}.{field}"), F.lit(""))


def json_field(text, key: str) -> Column:
    """Same rule for an object still held as JSON text: ``$.key`` or ''."""
    return F.coalesce(F.get_json_object(_c(text), f"$.{key}"), F.lit(""))


def fill_default(df: DataFrame, columns: list[str] | None = None,
                 value: str = NONE_TEXT) -> DataFrame:
    """Replace NULL in text columns with the fill value ('' stays '').

    Only string columns are touched; a NULL key or date stays NULL and is a
    check failure (``check_not_null``), not a fill.
    """
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    subset = [c for c in (columns or text_cols) if c in text_cols]
    return df.na.fill(value, subset=subset) if subset else df


def period_text(d) -> Column:
    """Date -> ``dd.MM.yyyy`` as used in the feed URL."""
    return F.date_format(_c(d), PERIOD_FORMAT)
