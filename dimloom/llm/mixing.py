"""Mixing sources to target weights along a low-discrepancy schedule.

Targets: sources take shares of the whole size by weight (1, 2, 3, repeating
by code point of the name, null last), none above ``CAP`` times its own size;
the excess is shared again by weight.

Schedule: slot ``n`` draws the golden-ratio point ``frac(n * phi)``, mapped
through the cumulative targets to a source; slots are ranked within their
source. Each source's texts stand in a seeded random order on a line that is
cut into blocks of ``BLOCK`` words, and the slot of rank r takes the block
``r mod blocks`` of the line. A source stops at its target: later slots are
dropped, missing ones appended, and the last is cut to the words still due.

Hot sources: lines and ranks are prefix sums over bounded chunks (``PIECES``
per source), so no source is one task's work.

Defined results: a null text has no words; a null source is a source of its
own, and stands last; without any words all targets are 0; an empty table
gives an empty result; rows that repeat an id are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.llm.own import Own
from dimloom.operators.ids import materialize, with_dense_ids

#: No source's target is above this many times its size.
CAP = 3
BLOCK = 4096
#: Parts of a source's line, and of the schedule, whose sums are added up one after the other.
PIECES = 1024
PHI = 0.6180339887498949
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(place, source, source_size, target) from (source, source_size).

    The level L of "target = least(weight * L, CAP * size)" rises until the
    targets add up to the whole size; each step is one sum over the sources.
    """
    marked = sizes.select("source", "source_size", F.col("source").isNull().alias("last"), F.encode(F.coalesce("source", F.lit("")), "UTF-8").alias("code"))
    ranked = materialize(with_dense_ids(marked, ["last", "code"], "place").select("place", "source", "source_size", (F.pmod(F.col("place") - 1, F.lit(3)) + 1).alias("weight")), "mix-sources")
    cap = CAP * F.col("source_size")
    whole = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        below = F.col("weight") * F.lit(level) >= cap
        at_cap, free, n = ranked.agg(F.sum(F.when(below, cap).otherwise(0)), F.sum(F.when(below, 0).otherwise(F.col("weight"))), F.count(F.when(below, 1))).first()
        if not whole or not free or n == full:
            break
        full, level = n, (whole - at_cap) / free
    return ranked.select("place", "source", "source_size", F.least(F.col("weight") * F.lit(float(level)), cap.cast("double")).alias("target"))


def prefix_sum(df: DataFrame, group: list[str], piece: str, order: list[str], amount: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over the earlier rows of a group, by (piece, order), piece by piece."""
    sums = df.groupBy(*group, piece).agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in [*group, piece]], F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = [df[c].eqNullSafe(sums[f"_{c}"]) for c in group] + [df[piece] == sums[f"_{piece}"]]
    joined = df.join(sums, on)
    return joined.withColumn(name, F.col("_base") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).select(*df.columns, name)


def schedule(goals: DataFrame, words: int) -> DataFrame:
    """(source, r, words due from the slot's block on): the slots of every source, ranked, cut at its target."""
    spark = goals.sparkSession
    due = F.floor(F.col("target") + 0.5).cast("long")
    per_pass = F.ceil(F.col("source_size") / BLOCK).cast("long")
    rest = due - (due / F.col("source_size")).cast("long") * F.col("source_size")
    quota = goals.where("source_size > 0").select("place", "source", "source_size", due.alias("due"), per_pass.alias("per_pass"),
                                                   ((due / F.col("source_size")).cast("long") * per_pass + F.ceil(rest / BLOCK)).alias("quota"))
    slots = max(1, -(-words // BLOCK))
    # cumulative shares; the intervals [low, high) of all sources tile [0, 1)
    total = quota.agg(F.sum("due")).first()[0] or 1
    line = quota.withColumn("all", F.lit(0)).withColumn("piece", F.floor(F.col("place") / PIECES))
    shares = (prefix_sum(line, ["all"], "piece", ["place"], "due", "before")
              .select("source", (F.col("before") / total).alias("low"), ((F.col("before") + F.col("due")) / total).alias("high")))
    # points meet intervals by cell of [0, 1): an interval lies in the cells that it touches
    cells = 1024
    touch = shares.select("source", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))).alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("n"), (F.col("id") * F.lit(PHI) - F.floor(F.col("id") * F.lit(PHI))).alias("x"))
    drawn = points.withColumn("cell", F.floor(F.col("x") * cells)).join(touch, "cell").where("x >= low and x < high").select("source", "n", F.floor(F.col("n") * PIECES / slots).alias("piece"), F.lit(1).alias("one"))
    ranked = prefix_sum(drawn, ["source"], "piece", ["n"], "one", "r").select("source", "r")
    counts = ranked.groupBy("source").agg(F.count(F.lit(1)).alias("drawn")).withColumnRenamed("source", "_source")
    missing = (quota.join(counts, quota["source"].eqNullSafe(counts["_source"]), "left")
               .select("source", F.coalesce("drawn", F.lit(0)).alias("drawn"), "quota").where("drawn < quota")
               .select("source", F.explode(F.sequence(F.col("drawn").cast("long"), F.col("quota") - 1)).alias("r")))
    kept = quota.select(F.col("source").alias("_source"), "source_size", "due", "per_pass", "quota")
    every = ranked.select("source", F.col("r").cast("long")).union(missing)
    every = every.join(kept, every["source"].eqNullSafe(kept["_source"])).where("r < quota")
    before = (F.col("r") / F.col("per_pass")).cast("long") * F.col("source_size") + F.pmod("r", F.col("per_pass")) * BLOCK
    return every.select("source", F.pmod("r", F.col("per_pass")).alias("block"), F.least(F.lit(BLOCK), F.col("due") - before).alias("words"))


def mix_sources(docs: DataFrame, seed: int = 17, source: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target, taken, and ``starts``: how often the row's first word is taken.

    Columns of these names in ``docs`` are replaced.
    """
    added = ["size", "source_size", "target", "taken", "starts"]
    own = Own(docs)
    rows = own.df.withColumns({"source": own[source], "size": word_count(own[text]), "key": F.xxhash64(F.lit(seed), own[doc_id], own[text])})
    sized = rows.select("source", "size", "key")
    sizes = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    goals = materialize(targets(sizes), "mix-targets")
    whole = sizes.agg(F.sum("source_size")).first()[0] or 0

    # rows alike in source, size and key are alike in everything that decides: one line entry, ``copies`` long
    entries = sized.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("copies"))
    entries = entries.withColumn("length", F.col("size") * F.col("copies")).withColumn("piece", F.pmod(F.shiftrightunsigned("key", 40), F.lit(PIECES)))
    line = materialize(prefix_sum(entries, ["source"], "piece", ["key"], "length", "begin"), "mix-lines")
    blocks = schedule(goals, whole).groupBy("source", "block").agg(F.collect_list("words").alias("slots")).select(F.col("source").alias("_source"), F.col("block").alias("_block"), "slots")
    copy = line.select("source", "key", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), (F.col("begin") + F.col("copy") * F.col("size")).alias("begin"))
    block = (F.col("begin") / BLOCK).cast("long")
    last = F.when(F.col("size") > 0, ((F.col("begin") + F.col("size") - 1) / BLOCK).cast("long")).otherwise(block)
    parts = copy.withColumn("block", F.explode(F.sequence(block, last)))
    met = parts.join(blocks, parts["source"].eqNullSafe(blocks["_source"]) & (parts["block"] == blocks["_block"]))
    low = F.greatest(F.col("begin") - F.col("block") * BLOCK, F.lit(0).cast("long"))
    high = F.col("begin") + F.col("size") - F.col("block") * BLOCK
    here = F.col("begin") >= F.col("block") * BLOCK
    used = (met.select("source", "key", "size", "copy",
                       F.aggregate("slots", F.lit(0).cast("long"), lambda s, w: s + F.greatest(F.least(high, w.cast("long")) - low, F.lit(0).cast("long"))).alias("taken"),
                       F.when(here, F.aggregate("slots", F.lit(0).cast("long"), lambda s, w: s + (w > low).cast("long"))).otherwise(0).alias("starts"))
            .groupBy("source", "key", "size", "copy").agg(F.sum("taken").alias("taken"), F.sum("starts").alias("starts")))
    # rows alike in everything are told apart by a number, whichever gets which
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("key", "source").orderBy(F.lit(1))) - 1)
    used = used.select(F.col("source").alias("_source"), F.col("key").alias("_key"), F.col("copy").alias("_copy"), "taken", "starts")
    goals = goals.select(F.col("source").alias("_goal"), "source_size", "target")
    out = rows.join(used, (rows["key"] == used["_key"]) & rows["source"].eqNullSafe(used["_source"]) & (rows["copy"] == used["_copy"]), "left")
    out = out.join(goals, out["source"].eqNullSafe(goals["_goal"]))
    none = F.lit(0).cast("long")
    return out.select(*own.back(added), "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), F.coalesce("starts", none).cast("long").alias("starts"))
