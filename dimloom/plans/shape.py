"""Shaping of the three feeds into staging rows.

Per feed: project the used columns, derive the text fields from the nested
object, keep the first row per ``ngrn`` in feed order (within this pull
only), then fill missing text with the fill value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from dimloom.functions.columns import fill_default, nested_field, org_name, org_type
from dimloom.operators.dedup import keep_first
from dimloom.schemas import STG_COLUMNS
from dimloom.sources.feeds import POSITION


def _finish(df: DataFrame, table: str, history: bool) -> DataFrame:
    """Keep-first in feed order, then fill. ``history`` says that the rows are no
    pull but many, already one per pull and key: nothing is dropped then."""
    if history:
        return fill_default(df.select(*STG_COLUMNS[table]))
    missing = [c for c in POSITION if c not in df.columns]
    if missing:
        raise ValueError(f"feed rows have no position ({', '.join(missing)}): keep-first needs the feed's order")
    df = df.select(*STG_COLUMNS[table], *POSITION)
    return fill_default(keep_first(df, ["ngrn"], POSITION).drop(*POSITION))


def shape_short(feed: DataFrame, history: bool = False) -> DataFrame:
    """ngrn, dfrom, org_name, status, org_type."""
    df = feed.withColumns({
        "org_name": org_name("vfio", "vnaim"),
        "status": nested_field("nsi00219", "vnsostk"),
        "org_type": org_type("vfio"),
    })
    return _finish(df, "short", history)


def shape_address(feed: DataFrame, history: bool = False) -> DataFrame:
    """ngrn, dfrom, vregion, vdistrict, vnp, vulitsa, vdom, vpom, vemail, vtels, location."""
    return _finish(feed.withColumn("location", nested_field("nsi00202", "vnsfull")), "address", history)


def shape_okved(feed: DataFrame, history: bool = False) -> DataFrame:
    """ngrn, dfrom, okved_code, okved_text."""
    df = feed.withColumns({
        "okved_code": nested_field("nsi00114", "vkvdn"),
        "okved_text": nested_field("nsi00114", "vnvdnp"),
    })
    return _finish(df, "okved", history)


SHAPERS = {"short_info": shape_short, "contact_info": shape_address, "okved_info": shape_okved}
