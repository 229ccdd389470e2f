"""The polling loop without hand-written pulls: each trigger asks for the next period.

The stream's source is the clock. Its offset is the instant of asking, so a batch
is one instant, and one that is run again after a crash asks for the same period.
``foreachBatch`` derives the period from the published mark (``next_period``), has
Spark fetch and land the three feeds, and runs a cycle over them. The published
manifest names the instant: a batch that is already published is skipped.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from dimloom.constants import FEED_KINDS
from dimloom.plans.cycle import run_cycle
from dimloom.plans.period import bounds_text, next_period
from dimloom.sources.feeds import read_feed
from dimloom.sources.fetch import Fetch, land_period
from dimloom.sources.state import StateStore

Clock = Callable[[], _dt.datetime]


def utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


class _Ticks(DataSourceStreamReader):
    def __init__(self, clock: Clock):
        self.clock = clock

    def initialOffset(self):
        return {"as_of": ""}

    def latestOffset(self):
        return {"as_of": self.clock().isoformat()}

    def partitions(self, start, end):
        return [InputPartition(end["as_of"])]

    def read(self, partition):
        yield (partition.value,)

    def commit(self, end):
        pass


def tick_source(clock: Clock) -> type[DataSource]:
    """The streaming source of a clock, format ``period_ticks``: a row (as_of) a batch."""

    class PeriodTicks(DataSource):
        @classmethod
        def name(cls):
            return "period_ticks"

        def schema(self):
            return "as_of string"

        def streamReader(self, schema):
            return _Ticks(clock)

    return PeriodTicks


def run_period(store: StateStore, fetch: Fetch, landing: str, as_of: _dt.datetime, zone: str,
               batch_id: int | None = None, strict: bool = True) -> int | None:
    """One cycle over the next period; None if this instant's pull is published already."""
    pull = f"as_of={as_of.isoformat()}"
    if store.published(pull):
        return None
    first, last = next_period(store, as_of, zone)
    root = f"{landing.rstrip('/')}/{first}-{last}-{uuid.uuid4().hex[:12]}"
    land_period(store.spark, fetch, root, first, last)
    feeds = {k: read_feed(store.spark, k, root, first, last, layout="lines", every_day=True) for k in FEED_KINDS}
    return run_cycle(store, feeds, batch_id=batch_id, strict=strict, pull=pull, period=bounds_text(first, last))


def start_period_stream(spark: SparkSession, fetch: Fetch, state_root: str, landing: str, checkpoint: str, zone: str,
                        clock: Clock = utc_now, available_now: bool = False, interval: str = "600 seconds"):
    """Start the loop; returns the ``StreamingQuery``. ``available_now`` runs the one cycle that is due."""
    store = StateStore(spark, state_root)
    store.initialize()
    spark.dataSource.register(tick_source(clock))

    def handle(batch: DataFrame, batch_id: int) -> None:
        for r in batch.collect():  # one row a batch
            run_period(store, fetch, landing, _dt.datetime.fromisoformat(r["as_of"]), zone, batch_id)

    w = spark.readStream.format("period_ticks").load().writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
