"""Period feeds landed as JSON files.

Layout: ``<root>/<kind>/load_date=YYYY-MM-DD/*.json``, one directory per day
(the unit the period feed is requested in). Two file layouts:

* ``"array"`` – each file is one JSON array of objects (an API response);
* ``"lines"`` – one object per line.

Feed order matters (keep-first per key inside a pull), so the reader keeps
it as ``POSITION`` = (``_file``, ``_block``, ``_pos``). ``_file`` is the file's place
among the period's files by their paths with every number padded, so that ``c1000``
follows ``c999``: the paths are put in order once, a row a file, and rows carry a
number. A ``lines`` file is read in splits: ``_block`` is the split's first byte and ``_pos`` grows inside it. An
``array`` file is one JSON value and therefore one task's work (``wholetext``):
land large responses as ``lines`` (``fetch.land_period``, ``fetch.land_arrays``).

An absent feed is an error, an empty one (``[]``, or a ``lines`` file without a
line) is 0 rows: the period must hold at least one file, and with
``every_day`` each of its days must. A file that is not the expected JSON
fails the read (``FAILFAST``); nothing is skipped. The day filter prunes
directories.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.constants import FEED_KINDS
from dimloom.schemas import FEED_SCHEMAS
from dimloom.session import free_shuffles

POSITION = ["_file", "_block", "_pos"]
#: The most rows that a landing task sorts, about.
ROWS_PER_TASK = 500_000


def _day(v) -> str:
    if isinstance(v, (_dt.date, _dt.datetime)):
        return v.strftime("%Y-%m-%d")
    return str(v)


def _in_period(df: DataFrame, start, end) -> DataFrame:
    if start is not None:
        df = df.filter(F.col("load_date") >= F.lit(_day(start)).cast("date"))
    if end is not None:
        df = df.filter(F.col("load_date") <= F.lit(_day(end)).cast("date"))
    return df


def _files(spark: SparkSession, path: str, start, end) -> DataFrame:
    """(load_date, _path): the period's files (one of 0 bytes is none), listed without reading them."""
    return _in_period(spark.read.format("binaryFile").load(path).select("load_date", F.col("_metadata.file_path").alias("_path")), start, end)


def _check_present(files: DataFrame, path: str, start, end, every_day: bool) -> None:
    """Raise if the period has no file, or a wanted day is absent; what comes back is one row per day."""
    days = {_day(r["load_date"]) for r in files.select("load_date").distinct().collect()}
    if not days:
        raise FileNotFoundError(f"no feed file under {path} for {start}..{end}")
    if every_day:
        first, last = (_dt.date.fromisoformat(_day(x)) for x in (start, end))
        wanted = {str(first + _dt.timedelta(k)) for k in range((last - first).days + 1)}
        if wanted - days:
            raise FileNotFoundError(f"no feed file under {path} for {sorted(wanted - days)}")


def natural_path(path):
    """Text that sorts by the numbers in ``path`` (each padded to 20 digits)."""
    return F.regexp_replace(F.regexp_replace(path, r"(\d+)", "0" * 20 + "$1"), r"\d*(\d{20})(?!\d)", "$1")


def read_feed(spark: SparkSession, kind: str, root: str, start=None, end=None,
              layout: str = "array", schema: T.StructType | None = None,
              every_day: bool = False) -> DataFrame:
    """Rows of one feed kind for the inclusive day period ``[start, end]``."""
    if kind not in FEED_KINDS:
        raise ValueError(f"unknown feed kind {kind!r}; expected one of {FEED_KINDS}")
    if layout not in ("array", "lines"):
        raise ValueError(f"unknown feed layout {layout!r}")
    schema = schema or FEED_SCHEMAS[kind]
    path = f"{root.rstrip('/')}/{kind}"
    files = _files(spark, path, start, end)
    _check_present(files, path, start, end, every_day)
    places = F.broadcast(files.select("_path", F.row_number().over(Window.orderBy(natural_path(F.col("_path")), "_path")).cast("long").alias("_place")))
    strict = {"mode": "FAILFAST"}
    raw = _in_period(spark.read.text(path, wholetext=layout == "array"), start, end)
    file = F.col("_metadata.file_path").alias("_path")
    if layout == "array":
        rows = raw.select("load_date", file, F.lit(0).cast("long").alias("_block"),
                          F.posexplode(F.from_json("value", T.ArrayType(schema), strict)).alias("_pos", "r"))
    else:
        rows = (raw.select("load_date", file, F.col("_metadata.file_block_start").alias("_block"),
                           F.monotonically_increasing_id().alias("_pos"), "value")
                   .filter(F.length(F.trim("value")) > 0)
                   .select("load_date", "_path", "_block", "_pos", F.from_json("value", schema, strict).alias("r")))
    # a file that landed between the two listings has no place: the read fails and can be repeated
    place = F.coalesce("_place", F.raise_error(F.concat(F.lit("a feed file landed while the feed was read: "), "_path")).cast("long"))
    return rows.join(places, "_path", "left").select("load_date", place.alias("_file"), "_block", F.col("_pos").cast("long").alias("_pos"), "r.*")


def write_feed(df: DataFrame, root: str, kind: str, order: Sequence[str],
               date_col: str = "dfrom", max_records: int = 50_000,
               buckets: int | None = None, columns: Sequence[str] | None = None,
               compression: str | None = None) -> None:
    """Land rows as a ``lines`` feed, day directories, in ``order`` within a day.

    ``columns`` are the feed's own (by default all): what only orders the rows need
    not be landed. ``compression`` is a codec of Spark's JSON writer; a packed file
    is read by one task, as ``max_records`` lets it be.

    Rows are range-partitioned on (day, order) and sorted inside each task,
    so file-name order within a day directory is feed order. Files are
    capped at ``max_records`` lines, which bounds each reading task, and the
    sorting tasks grow in number with the rows, which are counted for it. The
    sort's shuffle leaves the executors' disks before the next step fills them.
    """
    n = buckets or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")), -(-df.count() // ROWS_PER_TASK))
    out = df.withColumn("load_date", F.to_date(F.col(date_col)))
    (out.repartitionByRange(n, "load_date", *order)
        .sortWithinPartitions("load_date", *order)
        .select("load_date", *(columns or df.columns))
        .write.mode("overwrite")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("maxRecordsPerFile", max_records)
        .options(**({"compression": compression} if compression else {}))
        .partitionBy("load_date")
        .json(f"{root.rstrip('/')}/{kind}"))
    free_shuffles(df.sparkSession)


def write_empty_feed(spark: SparkSession, root: str, kind: str, day) -> None:
    """Land an empty answer (a ``lines`` file without an object) for one day."""
    spark.createDataFrame([("",)], "value string").coalesce(1).write.mode("append").text(
        f"{root.rstrip('/')}/{kind}/load_date={_day(day)}")
