"""Dense surrogate ids without a single-partition stage.

``row_number() OVER (ORDER BY k)`` plans as ``Exchange SinglePartition``:
one task numbers every row. Instead the rows are range-partitioned on the
order (sampled bounds, so buckets are balanced and ordered), sorted inside
each bucket, and numbered as ``offset(bucket) + position``. The offsets are
the running sum of the per-bucket counts: one row per bucket, so the
broadcast is bounded by the bucket count, not by the data.

The bucketed rows are needed twice (counts, then numbering) and must be the
*same* buckets both times: two evaluations would sample range bounds
independently. So they are written once as a Parquet table in the
session's checkpoint folder (shared storage on a cluster) and read back;
that also cuts the lineage, so a lost executor never renumbers.

The result equals a global ``row_number`` over a total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.session import scratch_dir


def materialize(df: DataFrame, label: str = "mat") -> DataFrame:
    """Compute ``df`` once as a Parquet table in the shared checkpoint folder.

    Reading it back cuts the lineage (a lost executor re-reads files, it
    never recomputes — or renumbers — upstream). Parquet rather than an RDD
    checkpoint: columnar and compressed instead of serialised rows.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


ROWS_PER_BUCKET = 1_000_000


def with_dense_ids(df: DataFrame, order: Sequence[str], id_col: str = "id",
                   base: Column | int = 0, buckets: int | None = None,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``id_col`` = base + 1..n in ``order`` (which must be total).

    The bucket count follows the row count (at most ``rows_per_bucket`` rows
    per numbering task), unless ``buckets`` is given.
    """
    # cached input: the count, the range-bound sampling pass and the
    # numbering pass share it
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = src.count()
        if rows == 0:  # common in a cycle: no new members, skip sampling and writes
            schema = T.StructType(df.schema.fields + [T.StructField(id_col, T.LongType(), False)])
            return df.sparkSession.createDataFrame([], schema)
        n = buckets or max(1, -(-rows // rows_per_bucket))
        ranged = materialize(
            src.repartitionByRange(n, *order)
               .sortWithinPartitions(*order)
               .withColumn("_bucket", F.spark_partition_id())
               .withColumn("_pos", F.monotonically_increasing_id()
                           - F.shiftleft(F.col("_bucket").cast("long"), 33)), "ids")
    finally:
        src.unpersist()
    sizes = ranged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0))
                           .alias("_offset"))
    base_col = base if isinstance(base, Column) else F.lit(base)
    return (ranged.join(F.broadcast(offsets), "_bucket")
                  .withColumn(id_col, (base_col + F.col("_offset") + F.col("_pos") + 1)
                              .cast("long"))
                  .drop("_bucket", "_pos", "_offset"))
