"""Period feeds that Spark fetches itself: a data source with one partition a day.

``fetch(kind, day)`` is the caller's: it answers with the feed's JSON array as
chunks of text or bytes (an open response, a file, a list). It runs in the tasks, a
day a task, so that the days of a long period are asked for side by side, and a
task that fails asks again. An answer that is no JSON array, a cut one included,
fails the job and with it the cycle; ``[]`` is a day without rows.

An answer is cut into its objects while it arrives: a task holds a chunk and one
object, never the answer, however long it is. ``land_period`` writes the objects as
lines, which ``read_feed`` then reads in splits; ``land_arrays`` does the same for
array files that have already been landed.
"""

from __future__ import annotations

import codecs
import datetime as _dt
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from dimloom.constants import FEED_KINDS
from dimloom.plans.period import days
from dimloom.schemas import FEED_SCHEMAS
from dimloom.sources.feeds import natural_path

Fetch = Callable[[str, _dt.date], Iterable[bytes | str]]

#: Characters of one object at most; an answer that shows no end of an object by then is no feed.
LONGEST = 1 << 24
_SPACE = " \t\r\n"
_DECODER = json.JSONDecoder()


def _text(chunks: Iterable[bytes | str]) -> Iterator[str]:
    utf8 = codecs.getincrementaldecoder("utf-8")()
    for chunk in chunks:
        yield chunk if isinstance(chunk, str) else utf8.decode(chunk)
    yield utf8.decode(b"", final=True)


def array_items(chunks: Iterable[bytes | str], longest: int = LONGEST) -> Iterator[str]:
    """The text of each object of a JSON array, in order; raises ``ValueError`` if it is none.

    Line breaks inside an object can only be white space there, and become spaces.
    """
    parts = _text(chunks)
    held, state = "", "start"   # start, first (after the bracket), item, next (after an object), end
    while True:
        held = held.lstrip(_SPACE)
        if state == "start" and held.startswith("﻿"):
            held = held[1:]
            continue
        cut = ""
        if held and state == "start":
            if held[0] != "[":
                raise ValueError(f"no JSON array: it begins with {held[:20]!r}")
            state, held = "first", held[1:]
            continue
        if held and state in ("first", "next") and held[0] == "]":
            state, held = "end", held[1:]
            continue
        if held and state == "next":
            if held[0] != ",":
                raise ValueError(f"no JSON array: {held[:20]!r} after an object")
            state, held = "item", held[1:]
            continue
        if held and state in ("first", "item"):
            if held[0] != "{":
                raise ValueError(f"no JSON array of objects: {held[:20]!r}")
            try:
                _, end = _DECODER.raw_decode(held)
                yield held[:end].replace("\r", " ").replace("\n", " ")
                state, held = "next", held[end:]
                continue
            except json.JSONDecodeError as e:
                cut = str(e)  # perhaps only because the rest has not arrived
                if len(held) > longest:
                    raise ValueError(f"no object ends within {longest} characters: {cut}") from e
        if held and state == "end":
            raise ValueError(f"no JSON array: {held[:20]!r} after its end")
        more = next(parts, None)
        if more is None:
            if state != "end":
                raise ValueError(f"the JSON array is cut off: {cut or 'no end'}")
            return
        held += more


class _Day(InputPartition):
    def __init__(self, day: _dt.date):
        super().__init__(day.isoformat())


class _Reader(DataSourceReader):
    def __init__(self, fetch: Fetch, kind: str, first: _dt.date, last: _dt.date):
        self.fetch, self.kind, self.first, self.last = fetch, kind, first, last

    def partitions(self):
        return [_Day(d) for d in days(self.first, self.last)]

    def read(self, partition):
        day = _dt.date.fromisoformat(partition.value)
        for place, item in enumerate(array_items(self.fetch(self.kind, day))):
            yield day, place, item


def feed_source(fetch: Fetch) -> type[DataSource]:
    """The data source class of a fetch, format ``period_feed``: (load_date, place, value), a row an object."""

    class PeriodFeed(DataSource):
        @classmethod
        def name(cls):
            return "period_feed"

        def schema(self):
            return "load_date date, place long, value string"

        def reader(self, schema):
            o = self.options
            return _Reader(fetch, o["kind"], _dt.date.fromisoformat(o["start"]), _dt.date.fromisoformat(o["end"]))

    return PeriodFeed


def fetched(spark: SparkSession, fetch: Fetch, kind: str, first: _dt.date, last: _dt.date) -> DataFrame:
    """(load_date, place, value): the objects of one feed's days, as they are."""
    if kind not in FEED_KINDS:
        raise ValueError(f"unknown feed kind {kind!r}; expected one of {FEED_KINDS}")
    spark.dataSource.register(feed_source(fetch))
    return spark.read.format("period_feed").options(kind=kind, start=str(first), end=str(last)).load()


def fetch_feed(spark: SparkSession, fetch: Fetch, kind: str, first: _dt.date, last: _dt.date, schema=None) -> DataFrame:
    """The rows that ``read_feed`` gives for the same days once landed, without landing them."""
    rows = fetched(spark, fetch, kind, first, last)
    return rows.select("load_date", F.date_format("load_date", "yyyy-MM-dd").alias("_file"), F.lit(0).cast("long").alias("_block"), F.col("place").alias("_pos"),
                       F.from_json("value", schema or FEED_SCHEMAS[kind], {"mode": "FAILFAST"}).alias("r")).select("load_date", "_file", "_block", "_pos", "r.*")


def land_period(spark: SparkSession, fetch: Fetch, root: str, first: _dt.date, last: _dt.date,
                kinds: Iterable[str] = FEED_KINDS) -> None:
    """Land the feeds of a period as ``lines`` below a new folder ``root``; each day is asked for once.

    A day's objects stay in order in its one file; a day without any leaves an
    empty line, so that it is there and has no rows.
    """
    for kind in kinds:
        rows = fetched(spark, fetch, kind, first, last)
        empty = spark.createDataFrame([(d,) for d in days(first, last)], "load_date date").select("load_date", F.lit("").alias("value"))
        out = f"{root.rstrip('/')}/{kind}"
        rows.select("load_date", "value").write.partitionBy("load_date").text(out)
        # one line a day more, in a file of its own: an empty answer is not an absent one
        empty.coalesce(1).write.mode("append").partitionBy("load_date").text(out)


def _closed(pieces: Iterable[str]) -> Iterator[str]:
    """Records that were split at ``}``, with it between them again."""
    for k, piece in enumerate(pieces):
        yield "}" + piece if k else piece


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted records of whole files in, the objects of each file's array out."""
    records = (r for batch in batches for r in batch.to_pylist())
    for (day, _), group in groupby(records, key=lambda r: (r["load_date"], r["file"])):
        items = array_items(_closed(r["value"] for r in group))
        while part := list(islice(items, 1000)):
            yield pa.RecordBatch.from_arrays([pa.array([day] * len(part), pa.date32()), pa.array(part, pa.string())], names=["load_date", "value"])
        yield pa.RecordBatch.from_arrays([pa.array([day], pa.date32()), pa.array([""], pa.string())], names=["load_date", "value"])


def land_arrays(spark: SparkSession, root: str, out: str, kinds: Iterable[str] = FEED_KINDS) -> None:
    """Landed array files (``<root>/<kind>/load_date=*/*``) once more as ``lines``, below a new folder ``out``.

    Spark reads a file in splits, as records that end at ``}``; a day's records are
    sorted back into feed order (which spills) and put together object by object.
    So a day is one task's work, but a file is never in a task's memory.
    """
    for kind in kinds:
        records = spark.read.option("lineSep", "}").text(f"{root.rstrip('/')}/{kind}").select(
            "load_date", natural_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"), "value")
        records = records.repartition("load_date").sortWithinPartitions("load_date", "file", "block", "place")
        (records.select("load_date", "file", "value").mapInArrow(_cut, "load_date date, value string")
                .write.partitionBy("load_date").text(f"{out.rstrip('/')}/{kind}"))
