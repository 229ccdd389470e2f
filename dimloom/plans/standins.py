"""Register roles played by the driver's TPC-H-style tables.

The register feeds are not available as data, so the operators run on the
given tables under these roles (every operator takes DataFrames and column
names, so nothing here is special-cased):

=============  ==========  =========  ============  ====================================
role           table       ngrn       dfrom         other
=============  ==========  =========  ============  ====================================
short_info     orders      o_custkey  o_orderdate   vfio = nullif(o_orderstatus,'P'),
                                                    vnaim = o_orderpriority,
                                                    nested status = o_orderstatus
contact_info   events      user_id    ts            vregion = event_type, vdistrict /
                                                    vnp = event_type minus one value,
                                                    e-mail from user_id, nested
                                                    location = props $.k
okved_info     lineitem    l_partkey  l_shipdate    nested code = l_returnflag,
                                                    text = "<flag>, <status>"
=============  ==========  =========  ============  ====================================

Keys repeat (10 orders per customer, ~30 lines per part, ~70 events per
user), so staging holds history and the mart join is many-to-many — the
real shape. Watermark tables are what a monthly cycle would have recorded:
the seed plus the largest ``dfrom`` of each month.

Each frame here has a SQL twin (``SQL_*``) used as the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.constants import NONE_TEXT, WATERMARK_SEED
from dimloom.functions.columns import fill_default, json_field
from dimloom.operators import watermark as wmk
from dimloom.plans.shape import shape_address, shape_okved, shape_short
from dimloom.schemas import FEED_SCHEMAS

SEED_SQL = f"TIMESTAMP '{WATERMARK_SEED}'"


def _null_text() -> Column:
    return F.lit(None).cast("string")


def feed_schema_ntz(kind: str) -> T.StructType:
    """Feed schema with a zone-less ``dfrom`` (the driver tables' type)."""
    return T.StructType([T.StructField(f.name, T.TimestampNTZType() if f.name == "dfrom"
                                       else f.dataType, True) for f in FEED_SCHEMAS[kind].fields])


class Standins:
    """Lazy stand-in frames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- raw feeds (feed column names, nested objects, plus order columns) ---
    def raw_short(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.col("o_custkey").alias("ngrn"), F.col("o_orderdate").alias("dfrom"),
            F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("vfio"),
            F.col("o_orderpriority").alias("vnaim"),
            F.struct(F.col("o_orderstatus").alias("vnsostk")).alias("nsi00219"),
            "o_orderkey")

    def raw_address(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            F.col("user_id").alias("ngrn"), F.col("ts").alias("dfrom"),
            F.col("event_type").alias("vregion"),
            F.nullif(F.col("event_type"), F.lit("view")).alias("vdistrict"),
            F.nullif(F.col("event_type"), F.lit("click")).alias("vnp"),
            _null_text().alias("vulitsa"), _null_text().alias("vdom"), _null_text().alias("vpom"),
            F.struct(F.get_json_object("props", "$.k").alias("vnsfull")).alias("nsi00202"),
            F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.org"))
             .alias("vemail"),
            _null_text().alias("vtels"),
            "event_id")

    def raw_okved(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_partkey").alias("ngrn"), F.col("l_shipdate").alias("dfrom"),
            F.struct(F.col("l_returnflag").alias("vkvdn"),
                     F.concat(F.col("l_returnflag"), F.lit(", "), F.col("l_linestatus"))
                      .alias("vnvdnp")).alias("nsi00114"),
            *OKVED_ORDER_EXTRA)

    # -- staging (shaped; no keep-first: staging is the whole history) -------
    def stg_short(self) -> DataFrame:
        return shape_short(self.raw_short(), history=True)

    def stg_address(self) -> DataFrame:
        return shape_address(self.raw_address(), history=True)

    def stg_okved(self) -> DataFrame:
        return shape_okved(self.raw_okved(), history=True)

    def stg(self, table: str) -> DataFrame:
        return {"short": self.stg_short, "address": self.stg_address, "okved": self.stg_okved}[table]()

    # -- watermarks ------------------------------------------------------------
    def seed_mark(self, table: str) -> Column:
        return F.lit(WATERMARK_SEED).cast(self.stg(table).schema["dfrom"].dataType)

    def wm(self, table: str, exclude_last_month: bool = False) -> DataFrame:
        """Seed + monthly maxima (optionally without the latest month)."""
        s = self.stg(table)
        monthly = s.groupBy(F.trunc("dfrom", "month").alias("_m")).agg(F.max("dfrom").alias(wmk.COL))
        if exclude_last_month:
            last = s.agg(F.max(F.trunc("dfrom", "month"))).scalar()
            monthly = monthly.filter(F.col("_m") < last)
        seed = self.spark.range(1).select(self.seed_mark(table).alias(wmk.COL))
        return seed.unionByName(monthly.select(wmk.COL)).distinct()

    def prior(self, table: str) -> Column:
        return wmk.prior_value(self.wm(table))

    def priors(self, literal: bool = True) -> tuple[Column, Column, Column]:
        """(short, okved, address) prior marks: read once as literals, or as
        scalar subqueries (``literal=False``).

        The literal form derives all three watermark tables in one job: one
        scan per table grouped by month, then per source the second-largest
        mark (three rows reach the driver).
        """
        names = ("short", "okved", "address")
        if not literal:
            return tuple(self.prior(t) for t in names)
        types = {t: self.stg(t).schema["dfrom"].dataType for t in names}
        marks = None
        for t in names:
            part = (self.stg(t).groupBy(F.trunc("dfrom", "month").alias("_m"))
                        .agg(F.max("dfrom").cast("timestamp_ntz").alias(wmk.COL))
                        .select(F.lit(t).alias("src"), wmk.COL)
                        .unionByName(self.spark.range(1).select(
                            F.lit(t).alias("src"),
                            F.lit(WATERMARK_SEED).cast("timestamp_ntz").alias(wmk.COL))))
            marks = part if marks is None else marks.unionByName(part)
        # one row per month and source: the watermark table itself, bounded by
        # the number of cycles, not by the data volume
        second = F.element_at(F.sort_array(F.collect_set(wmk.COL), asc=False), 2)
        got = {r["src"]: r["prior"]
               for r in marks.groupBy("src").agg(second.alias("prior")).collect()}
        return tuple(wmk.typed_literal(got.get(t), T.TimestampNTZType()).cast(types[t])
                     for t in names)

    def seeds(self) -> tuple[Column, Column, Column]:
        return self.seed_mark("short"), self.seed_mark("okved"), self.seed_mark("address")


OKVED_ORDER_EXTRA = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
# Feed order within a day for each stand-in feed (ngrn first so a key's rows sit together).
FEED_ORDER = {
    "short_info": ["ngrn", "dfrom", "o_orderkey"],
    "contact_info": ["ngrn", "dfrom", "event_id"],
    "okved_info": ["ngrn", "dfrom"] + OKVED_ORDER_EXTRA,
}

# --------------------------------------------------------------------------
# SQL twins (DuckDB), as CTEs
# --------------------------------------------------------------------------
N = NONE_TEXT
SQL_STG = f"""
stg_short AS (
  SELECT o_custkey AS ngrn, o_orderdate AS dfrom,
         coalesce(coalesce(nullif(o_orderstatus, 'P'), o_orderpriority), '{N}') AS org_name,
         coalesce(coalesce(o_orderstatus, ''), '{N}') AS status,
         CASE WHEN nullif(o_orderstatus, 'P') IS NOT NULL THEN 'ИП' ELSE 'ЮЛ' END AS org_type,
         o_orderkey
  FROM orders),
stg_address AS (
  SELECT user_id AS ngrn, ts AS dfrom,
         coalesce(event_type, '{N}') AS vregion,
         coalesce(nullif(event_type, 'view'), '{N}') AS vdistrict,
         coalesce(nullif(event_type, 'click'), '{N}') AS vnp,
         '{N}' AS vulitsa, '{N}' AS vdom, '{N}' AS vpom,
         coalesce('user' || CAST(user_id AS VARCHAR) || '@example.org', '{N}') AS vemail,
         '{N}' AS vtels,
         coalesce(coalesce(json_extract_string(props, '$.k'), ''), '{N}') AS location,
         event_id
  FROM events),
stg_okved AS (
  SELECT l_partkey AS ngrn, l_shipdate AS dfrom,
         coalesce(coalesce(l_returnflag, ''), '{N}') AS okved_code,
         coalesce(coalesce(l_returnflag || ', ' || l_linestatus, ''), '{N}') AS okved_text,
         l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem)"""

STG_COLS_SQL = {
    "short": "ngrn, dfrom, org_name, status, org_type",
    "address": "ngrn, dfrom, vregion, vdistrict, vnp, vulitsa, vdom, vpom, vemail, vtels, location",
    "okved": "ngrn, dfrom, okved_code, okved_text",
}


def _wm_sql(t: str) -> str:
    return (f"wm_{t} AS (SELECT {SEED_SQL} AS max_dfrom UNION "
            f"SELECT max(dfrom) FROM stg_{t} GROUP BY date_trunc('month', dfrom))")


def _prior_sql(t: str) -> str:
    return (f"(SELECT max(max_dfrom) FROM wm_{t} "
            f"WHERE max_dfrom < (SELECT max(max_dfrom) FROM wm_{t}))")


SQL_BASE = ("WITH " + SQL_STG + ",\n" + ",\n".join(_wm_sql(t) for t in ("short", "address", "okved"))
            + ",\np AS (SELECT " + _prior_sql("short") + " AS ps, " + _prior_sql("address")
            + " AS pa, " + _prior_sql("okved") + " AS po)")

MART_ORDER_SQL = ", ".join(f"{c} DESC NULLS LAST" for c in [
    "s_dfrom", "a_dfrom", "o_dfrom", "status", "location", "okved_code", "okved_text",
    "org_type", "region", "district", "settlement", "email", "phone"])


def joined_sql(short="stg_short", okved="stg_okved", address="stg_address",
               ps="(SELECT ps FROM p)", po="(SELECT po FROM p)", pa="(SELECT pa FROM p)") -> str:
    """Brute force: every joined row inside the OR window."""
    return f"""
      SELECT s.org_name, s.ngrn, s.org_type, s.dfrom AS s_dfrom, s.status,
             o.dfrom AS o_dfrom, o.okved_code, o.okved_text,
             a.dfrom AS a_dfrom, a.location, a.vregion AS region, a.vdistrict AS district,
             a.vnp AS settlement, a.vemail AS email, a.vtels AS phone
      FROM {short} s LEFT JOIN {okved} o ON s.ngrn = o.ngrn
                     LEFT JOIN {address} a ON s.ngrn = a.ngrn
      WHERE s.dfrom >= {ps} OR a.dfrom >= {pa} OR o.dfrom >= {po}"""


def mart_sql(**kw) -> str:
    return f"""
    SELECT org_name, ngrn, org_type, s_dfrom AS date, status,
           coalesce(okved_code, '{N}') AS okved_code, coalesce(okved_text, '{N}') AS okved_text,
           region, district, settlement, location, email, phone
    FROM (SELECT *, row_number() OVER (PARTITION BY org_name, ngrn ORDER BY {MART_ORDER_SQL}) AS rn
          FROM ({joined_sql(**kw)}) j) r
    WHERE rn = 1"""
