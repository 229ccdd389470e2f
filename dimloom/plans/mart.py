"""The denormalised mart: short ⟕ activity ⟕ address, OR freshness window,
one row per (org_name, ngrn).

Semantics (the statement being reproduced): left-join every short row to
every activity row and every address row of the same ``ngrn``; keep joined
rows where *any* side is fresh (``side.dfrom >= side's prior mark``; a
missing side is unknown, not true); then keep one row per (org_name, ngrn).
The survivor is the largest joined row under the order

    short.dfrom, address.dfrom, activity.dfrom, status, location,
    okved_code, okved_text, org_type, region, district, settlement,
    email, phone                       (all descending, NULLs last)

i.e. the latest data, ties broken by value.

How it runs without materialising the join. Each key position of that order
belongs to exactly one side, so over a *product* of side row sets the
maximum is the tuple of per-side maxima. The window is the union of three
products, one per side that is fresh:

    P1 = fresh short  × all activity × all address
    P2 = all short    × all activity × fresh address
    P3 = all short    × fresh activity × all address

so the answer is ``greatest`` of three candidates built from per-key
``max(struct)`` aggregates (all rows, fresh rows). Every aggregate is
partial before its shuffle, the joins are one-to-one on the key, and no
group of rows is ever paired with another: a key holding a third of the
data costs the same as any other key. The DuckDB oracle computes the same
result by brute force (the full join), which checks this algebra.

A load cycle does not even read the history: the "all rows" maxima are kept as a
table per side (``merged_tops``), into which each cycle merges its own rows, and
the "fresh rows" maxima come from the staging slots since the prior marks
(``mart_from_tops``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.constants import NONE_TEXT
from dimloom.operators.ids import materialize
from dimloom.schemas import ADDRESS_FIELDS, MART_COLUMNS, OKVED_FIELDS, SHORT_FIELDS, TOPS

# The survivor order across sides.
ORDER = ["s_dfrom", "a_dfrom", "o_dfrom", "status", "location", "okved_code", "okved_text",
         "org_type", "region", "district", "settlement", "email", "phone"]
_SIDE_OF = {f: "s" for f, _ in SHORT_FIELDS} | {f: "o" for f, _ in OKVED_FIELDS} \
    | {f: "a" for f, _ in ADDRESS_FIELDS}


def _side_struct(fields) -> Column:
    return F.struct(*[F.col(src).alias(name) for name, src in fields])


def _side_max(df: DataFrame, keys, fields, prior: Column, tag: str,
              extra: dict[str, Column] | None = None) -> DataFrame:
    row = _side_struct(fields)
    fresh = F.col("dfrom") >= prior
    aggs = [F.max(row).alias(f"{tag}_all"), F.max(F.when(fresh, row)).alias(f"{tag}_new")]
    aggs += [v.alias(k) for k, v in (extra or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def changed_keys(short: DataFrame, okved: DataFrame, address: DataFrame,
                 prior_short: Column, prior_okved: Column, prior_address: Column) -> DataFrame:
    """Distinct ``ngrn`` with a fresh row on any side (pushed-down scans)."""
    parts = [df.filter(F.col("dfrom") >= p).select("ngrn")
             for df, p in ((short, prior_short), (okved, prior_okved), (address, prior_address))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def _pruned(short, okved, address, prior_short, prior_okved, prior_address, prune: bool):
    """Restrict all three inputs to the changed keys before aggregating.

    The keys are computed once (written to the shared folder), so Spark knows
    their size and picks each semi-join; row-level freshness is still applied
    afterwards (history rows of a changed key are not themselves fresh).
    """
    if not prune:
        return short, okved, address
    keys = materialize(changed_keys(short, okved, address, prior_short, prior_okved, prior_address), "changed-keys")
    return tuple(df.join(keys, "ngrn", "left_semi") for df in (short, okved, address))


def _side_maxima(short, okved, address, prior_short, prior_okved, prior_address,
                 short_extra=None, okved_extra=None, address_extra=None) -> DataFrame:
    s = _side_max(short, ["org_name", "ngrn"], SHORT_FIELDS, prior_short, "s", short_extra)
    o = _side_max(okved, ["ngrn"], OKVED_FIELDS, prior_okved, "o", okved_extra)
    a = _side_max(address, ["ngrn"], ADDRESS_FIELDS, prior_address, "a", address_extra)
    return s.join(o, "ngrn", "left").join(a, "ngrn", "left")


def _candidate(s: str, o: str, a: str) -> Column:
    sides = {"s": F.col(s), "o": F.col(o), "a": F.col(a)}
    return F.struct(*[sides[_SIDE_OF[f]].getField(f).alias(f) for f in ORDER])


def build_mart(short: DataFrame, okved: DataFrame, address: DataFrame,
               prior_short: Column, prior_okved: Column, prior_address: Column,
               prune: bool = False) -> DataFrame:
    """Mart rows (no id) for the (org_name, ngrn) groups inside the window.

    Inputs use the staging column names: short (ngrn, dfrom, org_name,
    status, org_type), okved (ngrn, dfrom, okved_code, okved_text), address
    (ngrn, dfrom, vregion, vdistrict, vnp, location, vemail, vtels). Priors
    are scalar columns (``watermark.prior_value``); a NULL prior makes that
    side never fresh.
    """
    short, okved, address = _pruned(short, okved, address, prior_short, prior_okved,
                                    prior_address, prune)
    return _survivors(_side_maxima(short, okved, address, prior_short, prior_okved, prior_address))


def _survivors(j: DataFrame) -> DataFrame:
    """The mart's rows from the joined maxima (``s``, ``o``, ``a``; ``_all`` and ``_new``)."""
    c1 = F.when(F.col("s_new").isNotNull(), _candidate("s_new", "o_all", "a_all"))
    c2 = F.when(F.col("a_new").isNotNull(), _candidate("s_all", "o_all", "a_new"))
    c3 = F.when(F.col("o_new").isNotNull(), _candidate("s_all", "o_new", "a_all"))
    best = j.select("org_name", "ngrn", F.greatest(c1, c2, c3).alias("b")).filter(
        F.col("b").isNotNull())
    return best.select(
        "org_name", "ngrn",
        F.col("b.org_type").alias("org_type"),
        F.col("b.s_dfrom").alias("date"),
        F.col("b.status").alias("status"),
        F.coalesce(F.col("b.okved_code"), F.lit(NONE_TEXT)).alias("okved_code"),
        F.coalesce(F.col("b.okved_text"), F.lit(NONE_TEXT)).alias("okved_text"),
        *[F.col(f"b.{c}").alias(c) for c in MART_COLUMNS[7:]],
    )


def tops(rows: DataFrame, table: str) -> DataFrame:
    """(keys, best): the largest row of each key of a staging table, in the side's own order."""
    keys, fields = TOPS[table]
    return rows.groupBy(*keys).agg(F.max(_side_struct(fields)).alias("best"))


def merged_tops(kept: DataFrame, rows: DataFrame, table: str) -> DataFrame:
    """The kept maxima brought up to date with new staging rows."""
    keys, _ = TOPS[table]
    both = kept.select(*keys, "best").unionByName(tops(rows, table))
    return both.groupBy(*keys).agg(F.max("best").alias("best"))


def mart_from_tops(all_tops: Mapping[str, DataFrame], fresh: Mapping[str, DataFrame], keys: DataFrame) -> DataFrame:
    """``build_mart`` for the changed ``keys``, from the maxima over all rows and the fresh rows themselves.

    ``all_tops`` and ``fresh`` hold the three staging tables' frames by name; ``keys`` is a written table.
    """
    sides = {}
    for table, tag in (("short", "s"), ("okved", "o"), ("address", "a")):
        by, _ = TOPS[table]
        known = all_tops[table].join(keys, "ngrn", "left_semi").select(*by, F.col("best").alias(f"{tag}_all"))
        sides[tag] = known.join(tops(fresh[table], table).withColumnRenamed("best", f"{tag}_new"), by, "left")
    return _survivors(sides["s"].join(sides["o"], "ngrn", "left").join(sides["a"], "ngrn", "left"))


def mart_steps(short: DataFrame, okved: DataFrame, address: DataFrame,
               prior_short: Column, prior_okved: Column, prior_address: Column) -> tuple[DataFrame, DataFrame]:
    """Two cycles' mart rows from one pass: of the rows before the priors alone (everything fresh), and of all rows with the priors.

    The maxima over old and over fresh rows are taken together; those over all
    rows are the larger of the two. Rows without a ``dfrom`` are in neither.
    """
    parts = {"s": (short, ["org_name", "ngrn"], SHORT_FIELDS, prior_short), "o": (okved, ["ngrn"], OKVED_FIELDS, prior_okved),
             "a": (address, ["ngrn"], ADDRESS_FIELDS, prior_address)}
    sides = {}
    for tag, (df, by, fields, prior) in parts.items():
        row, fresh = _side_struct(fields), F.col("dfrom") >= prior
        both = df.groupBy(*by).agg(F.max(F.when(~fresh, row)).alias("old"), F.max(F.when(fresh, row)).alias(f"{tag}_new"))
        sides[tag] = both.withColumns({f"{tag}_all": F.greatest("old", f"{tag}_new"), f"{tag}_old": F.col("old")}).drop("old")
    j = materialize(sides["s"].join(sides["o"], "ngrn", "left").join(sides["a"], "ngrn", "left"), "maxima")
    before = [F.col(f"{tag}_old").alias(f"{tag}_{kind}") for tag in parts for kind in ("all", "new")]
    return _survivors(j.where("s_old is not null").select("org_name", "ngrn", *before)), _survivors(j)


def window_keys(short: DataFrame, okved: DataFrame, address: DataFrame,
                prior_short: Column, prior_okved: Column, prior_address: Column) -> DataFrame:
    """(org_name, ngrn) groups inside the window and which sides made them fresh."""
    j = _side_maxima(short, okved, address, prior_short, prior_okved, prior_address)
    out = j.select("org_name", "ngrn",
                   F.col("s_new").isNotNull().alias("fresh_short"),
                   F.col("a_new").isNotNull().alias("fresh_address"),
                   F.col("o_new").isNotNull().alias("fresh_okved"))
    return out.filter(F.col("fresh_short") | F.col("fresh_address") | F.col("fresh_okved"))


def conflicting_keys(short: DataFrame, okved: DataFrame, address: DataFrame,
                     prior_short: Column, prior_okved: Column, prior_address: Column) -> DataFrame:
    """Groups for which ``DISTINCT ON (org_name, ngrn, status, location)`` keeps
    more than one row, i.e. where a plain ``ON CONFLICT DO UPDATE`` fails
    ("cannot affect row a second time"). Ours keeps the latest; this lists
    the keys where that choice was needed, with the kept row.

    Over the union of products the distinct (status, location) pairs exceed
    one exactly when the statuses or the locations that occur do, so per-key
    min/max (plus a NULL flag for the nullable location) decide it.
    """
    fs = F.col("dfrom") >= prior_short
    fa = F.col("dfrom") >= prior_address
    s_extra = {"st_min_all": F.min("status"), "st_max_all": F.max("status"),
               "st_min_new": F.min(F.when(fs, F.col("status"))),
               "st_max_new": F.max(F.when(fs, F.col("status")))}
    a_extra = {"lo_min_all": F.min("location"), "lo_max_all": F.max("location"),
               "lo_null_all": F.max(F.col("location").isNull()),
               "lo_min_new": F.min(F.when(fa, F.col("location"))),
               "lo_max_new": F.max(F.when(fa, F.col("location"))),
               "lo_null_new": F.max(F.when(fa, F.col("location").isNull()))}
    j = _side_maxima(short, okved, address, prior_short, prior_okved, prior_address,
                     short_extra=s_extra, address_extra=a_extra)
    s_new, a_new, o_new = (F.col(c).isNotNull() for c in ("s_new", "a_new", "o_new"))
    st_all_statuses = a_new | o_new
    st_min = F.when(st_all_statuses, F.col("st_min_all")).otherwise(F.col("st_min_new"))
    st_max = F.when(st_all_statuses, F.col("st_max_all")).otherwise(F.col("st_max_new"))
    lo_all = s_new | o_new
    lo_min = F.when(lo_all, F.col("lo_min_all")).otherwise(F.col("lo_min_new"))
    lo_max = F.when(lo_all, F.col("lo_max_all")).otherwise(F.col("lo_max_new"))
    lo_null = F.when(lo_all, F.coalesce(F.col("lo_null_all"), F.lit(True))) \
        .otherwise(F.col("lo_null_new"))
    many_status = st_min < st_max
    many_location = (lo_min < lo_max) | (lo_null & lo_min.isNotNull())
    c1 = F.when(s_new, _candidate("s_new", "o_all", "a_all"))
    c2 = F.when(a_new, _candidate("s_all", "o_all", "a_new"))
    c3 = F.when(o_new, _candidate("s_all", "o_new", "a_all"))
    return (j.filter(s_new | a_new | o_new)
             .filter(F.coalesce(many_status, F.lit(False)) | F.coalesce(many_location, F.lit(False)))
             .select("org_name", "ngrn", F.greatest(c1, c2, c3).alias("b"))
             .select("org_name", "ngrn", F.col("b.s_dfrom").alias("date"),
                     F.col("b.status").alias("status"), F.col("b.location").alias("location")))
