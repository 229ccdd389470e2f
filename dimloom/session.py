"""Session helpers.

Library code never creates its own session on a cluster; these helpers are
for tests, the bench and local runs. The scratch location is always taken
from ``spark.checkpoint.dir`` of the running session (a shared folder on a
cluster); a default is set only when the session has none.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only below this runtime-measured size; AQE re-checks it.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                checkpoint_dir: str | None = None, app: str = "dimloom") -> SparkSession:
    """Local/test session. On a cluster use the session you are given."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    builder = builder.config("spark.driver.memory", os.environ.get("DIMLOOM_DRIVER_MEMORY", "16g"))
    if checkpoint_dir:  # static setting: only takes effect on a new session
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_FALLBACK: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local session that names none gets a folder
    here; on a cluster every executor would write its own machine's folder,
    so a missing setting is an error there. ``checkpoint()`` is pointed at the
    same place.
    """
    sc = spark.sparkContext
    cur = sc.getConf().get("spark.checkpoint.dir", None) or _FALLBACK.get("dir")
    if not cur:
        check_shared(sc.master, cur)
        cur = _FALLBACK.setdefault("dir", tempfile.mkdtemp(prefix="dimloom-checkpoints-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return cur.rstrip("/")


def check_shared(master: str, folder: str | None) -> None:
    """Raise when a non-local master has no shared checkpoint folder."""
    if not folder and not (master or "").startswith("local["):
        raise RuntimeError(
            f"spark.checkpoint.dir is not set and the master is {master!r}: intermediate tables "
            "need a folder that the driver and all executors share")


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of queries that nothing refers to any more.

    It does so whenever the driver collects its garbage, which for a driver with
    little to do may be long after the disks are full. What is still referred to stays.
    A first collection only shows the driver what is left over; the second frees it.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/dimloom/{label}-{uuid.uuid4().hex[:12]}"
