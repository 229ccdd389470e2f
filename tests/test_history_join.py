"""How a pull meets its history."""

import re

from pyspark.sql import functions as F

from dimloom.operators.ids import materialize
from dimloom.plans.cycle import new_stage_rows
from dimloom.schemas import STG_SCHEMAS


def stage(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("ngrn"), F.timestamp_seconds(F.col("id") % 100).alias("dfrom"), F.lit("n").alias("org_name"), F.lit("s").alias("status"), F.lit("ЮЛ").alias("org_type"))


def test_the_history_is_not_shuffled_for_a_small_pull(spark, workdir):
    """No Exchange lies above the history's scan: the pull, measured as small, is broadcast to it."""
    stage(spark, 0, 400_000).write.parquet(f"{workdir}/history")
    history = spark.read.schema(STG_SCHEMAS["short"]).parquet(f"{workdir}/history")
    pull = materialize(stage(spark, 399_000, 400_500).unionByName(stage(spark, 399_000, 400_500)), "pull")
    out = new_stage_rows(pull, history, "short")
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lines = plan.splitlines()
    at = next(k for k, x in enumerate(lines) if "FileScan" in x and "/history" in x)
    depth = lambda x: len(re.match(r"[\s:|+\-*]*", x).group())
    above, level = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < level:
            above.append(x)
            level = depth(x)
    nearest = [x for x in above if "Exchange" in x or "Join" in x]
    assert "BroadcastHashJoin" in nearest[0] and "LeftSemi" in nearest[0], plan
    assert sorted(r["ngrn"] for r in out.collect()) == list(range(400_000, 400_500))


def test_rows_with_nulls_meet_their_like(spark):
    schema = "ngrn long, dfrom timestamp, vregion string, vdistrict string, vnp string, vulitsa string, vdom string, vpom string, vemail string, vtels string, location string"
    one = (1, None, None, "d", *[None] * 7)
    got = new_stage_rows(spark.createDataFrame([one, one, (2, *one[1:])], schema), spark.createDataFrame([one], schema), "address").collect()
    assert [r["ngrn"] for r in got] == [2]
