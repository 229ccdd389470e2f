"""Explicit schemas of the feeds and of the three warehouse layers.

Feeds are never schema-inferred. Nested-object fields are declared
``string``: the JSON reader then keeps a number such as ``62010`` as the text
``"62010"``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# --- feeds (only the fields that are read) -----------------------------------
FEED_SCHEMAS: dict[str, T.StructType] = {
    "short_info": T.StructType([
        _f("ngrn", T.LongType()), _f("dfrom", TS), _f("vfio", S), _f("vnaim", S),
        _f("nsi00219", T.StructType([_f("vnsostk", S)])),
    ]),
    "contact_info": T.StructType([
        _f("ngrn", T.LongType()), _f("dfrom", TS), _f("vregion", S), _f("vdistrict", S),
        _f("vnp", S), _f("vulitsa", S), _f("vdom", S), _f("vpom", S),
        _f("nsi00202", T.StructType([_f("vnsfull", S)])), _f("vemail", S), _f("vtels", S),
    ]),
    "okved_info": T.StructType([
        _f("ngrn", T.LongType()), _f("dfrom", TS),
        _f("nsi00114", T.StructType([_f("vkvdn", S), _f("vnvdnp", S)])),
    ]),
}

# --- stg (raw layer, business columns; ids are not stable there) ------------
STG_COLUMNS: dict[str, list[str]] = {
    "short": ["ngrn", "dfrom", "org_name", "status", "org_type"],
    "address": ["ngrn", "dfrom", "vregion", "vdistrict", "vnp", "vulitsa", "vdom", "vpom",
                "vemail", "vtels", "location"],
    "okved": ["ngrn", "dfrom", "okved_code", "okved_text"],
}
STG_SCHEMAS: dict[str, T.StructType] = {
    "short": T.StructType([_f("ngrn", T.LongType(), False), _f("dfrom", TS, False),
                           _f("org_name", S, False), _f("status", S, False),
                           _f("org_type", S, False)]),
    "address": T.StructType([_f("ngrn", T.LongType(), False), _f("dfrom", TS, False)]
                            + [_f(c, S) for c in STG_COLUMNS["address"][2:]]),
    "okved": T.StructType([_f("ngrn", T.LongType(), False), _f("dfrom", TS, False),
                           _f("okved_code", S, False), _f("okved_text", S, False)]),
}
# Feed kind -> stg table.
KIND_TO_STG = {"short_info": "short", "contact_info": "address", "okved_info": "okved"}

WATERMARK_SCHEMA = T.StructType([_f("max_dfrom", TS, False)])

# --- dds (insert-only dimensions) -------------------------------------------
# name -> (stg source table, [(source column, dimension column), ...])
DIMENSIONS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "ngrns": ("short", [("ngrn", "ngrn")]),
    "org_names": ("short", [("org_name", "org_name")]),
    "okveds": ("okved", [("okved_code", "okved_code"), ("okved_text", "okved_text")]),
    "statuses": ("short", [("status", "status")]),
    "org_types": ("short", [("org_type", "org_type")]),
    "regions": ("address", [("vregion", "region")]),
    "districts": ("address", [("vdistrict", "district")]),
    "settlements": ("address", [("vnp", "settlement")]),
    "contacts": ("address", [("location", "location"), ("vemail", "email"), ("vtels", "phone")]),
    "dates": ("short", [("dfrom", "date")]),
}


def dimension_schema(name: str) -> T.StructType:
    src, cols = DIMENSIONS[name]
    stg = {f.name: f.dataType for f in STG_SCHEMAS[src].fields}
    return T.StructType([_f("id", T.LongType(), False)]
                        + [_f(dst, stg[s], False) for s, dst in cols])


# --- dm (the mart) ----------------------------------------------------------
MART_COLUMNS = ["org_name", "ngrn", "org_type", "date", "status", "okved_code", "okved_text",
                "region", "district", "settlement", "location", "email", "phone"]
MART_SCHEMA = T.StructType(
    [_f("id", T.LongType(), False), _f("org_name", S, False), _f("ngrn", T.LongType(), False),
     _f("org_type", S, False), _f("date", TS, False), _f("status", S, False),
     _f("okved_code", S, False), _f("okved_text", S, False)]
    + [_f(c, S) for c in MART_COLUMNS[7:]])
# Foreign keys of the mart, by natural value: mart column -> (dimension, column).
MART_FOREIGN_KEYS = {
    "ngrn": ("ngrns", "ngrn"),
    "org_type": ("org_types", "org_type"),
    "date": ("dates", "date"),
    "status": ("statuses", "status"),
}

# --- per-key maxima the mart is built from -----------------------------------
# Side -> (struct field, source column) in the side's own order.
SHORT_FIELDS = [("s_dfrom", "dfrom"), ("status", "status"), ("org_type", "org_type")]
OKVED_FIELDS = [("o_dfrom", "dfrom"), ("okved_code", "okved_code"), ("okved_text", "okved_text")]
ADDRESS_FIELDS = [("a_dfrom", "dfrom"), ("location", "location"), ("region", "vregion"),
                  ("district", "vdistrict"), ("settlement", "vnp"), ("email", "vemail"),
                  ("phone", "vtels")]
# staging table -> (key columns, struct fields)
TOPS = {"short": (["org_name", "ngrn"], SHORT_FIELDS), "okved": (["ngrn"], OKVED_FIELDS),
        "address": (["ngrn"], ADDRESS_FIELDS)}


def _top_schema(table: str) -> T.StructType:
    keys, fields = TOPS[table]
    stg = {f.name: f.dataType for f in STG_SCHEMAS[table].fields}
    return T.StructType([_f(k, stg[k]) for k in keys]
                        + [_f("best", T.StructType([_f(n, stg[src]) for n, src in fields]))])


TOP_SCHEMAS = {t: _top_schema(t) for t in TOPS}
