"""Clustering by Orchard's search against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dimloom.llm import orchard
from tests.llm.helpers import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=16, rounds=3, length=64):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in start]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), a in zip(kept, at) if a == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, sum(e for _, e, b in found if b == j), sum(e for _, e, _ in found), marks[j]) for i, d, j in found), key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in orchard.cluster(df, **kw).collect()), key=str)


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    assert run(spark.read.parquet(f"{SF}/embeddings.parquet")) == plain(rows)


def odd():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 64)).astype(np.float32).tolist()
    rows = [(k, v) for k, v in enumerate(base)] + [(100 + k, base[3]) for k in range(60)]    # one vector many times
    rows += [(7, base[9]), (7, base[9]), (None, base[2]), (200, [0.0] * 64), (201, [-0.5 / 64] * 64)]
    rows += [(300, None), (301, []), (302, base[0][:63]), (303, base[0] + [1.0]), (304, base[0][:63] + [None]),
             (305, base[0][:63] + [float("nan")]), (306, base[0][:63] + [float("inf")]), (307, base[0][:63] + [-float("inf")])]
    return rows


@pytest.mark.parametrize("rows", [odd(), [], odd()[-8:], odd()[:3], [(None, [1.0] * 64)]])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    assert run(df) == plain(rows)
    extra = df.withColumns({c: F.lit("x") for c in ("id", "v", "cluster", "distance", "place", "n", "mark")})
    assert run(extra) == plain(rows)


def test_search_equals_brute_force_and_measures_less():
    rng = np.random.default_rng(1)
    for trial in range(30):
        k, width = int(rng.integers(1, 40)), int(rng.integers(1, 6))
        spots = rng.integers(-3, 4, size=(k, width)) * int(rng.integers(1, 50))     # many ties and equal centroids
        x = rng.integers(-200, 200, size=(500, width))
        x[:100] = spots[rng.integers(0, k, 100)]
        at, gap, measured = orchard.Lists(spots).nearest(x)
        full = ((x[:, None, :] - spots[None]) ** 2).sum(axis=2)
        assert (at == full.argmin(axis=1)).all() and (gap == full.min(axis=1)).all() and measured <= full.size
    spots = rng.integers(-10_000, 10_000, size=(64, 2))
    x = spots[rng.integers(0, 64, 2000)] + rng.integers(-50, 50, size=(2000, 2))
    assert orchard.Lists(spots).nearest(x)[2] < 2000 * 64 / 3


def test_too_wide_components_raise(spark):
    df = spark.createDataFrame([(1, [3e7] * 64, None)], SCHEMA)
    with pytest.raises(Exception, match="would not fit into a long"):
        run(df)
