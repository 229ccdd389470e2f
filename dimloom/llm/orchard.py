"""Centroid clustering in integers, each vector's nearest centroid found by Orchard's search.

Every centroid has the list of the others by distance, nearest first. A vector
starts at some centroid and walks its list; at a closer one it jumps to that
one's list; centroids seen are not measured again; and it stops once the next of
the list lies strictly beyond twice the vector's distance from where it stands,
since by the triangle inequality nothing further on is nearer. The comparison is
strict, so that every centroid at the least distance is seen and ties go to the
smaller number. Components are integers, so distances, sums and means are exact
and no order of the rows matters.

A round is one pass over the vectors in Arrow batches; a task gives its sums per
centroid, and only ``CENTROIDS`` rows of sums reach the driver. A cluster that
holds a third of all rows is a third of the rows in every task, and no group.

Edge cases: vectors that are null, of another length, or hold null or non-finite
components are left out; a null ``vec_id`` takes part, but never starts a
centroid; rows that repeat a ``vec_id`` are vectors of their own (those that start
centroids in the order of their components); with fewer vectors than centroids
there are as many centroids as vectors; of an empty table nothing comes back;
other columns are ignored. A component beyond ``WIDEST`` would not leave room for
a squared distance in a long: it raises.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.operators.ids import materialize

LENGTH = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
#: Largest size of an integer component: a squared distance, times 4, stays within a long.
WIDEST = 2 ** 26


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
                    length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """(id, v): the kept vectors with components ``floor(scale * x)``."""
    x = F.col(vector)
    clean = F.size(x) == length
    clean &= ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    whole = F.transform(x, lambda e: F.floor(e.cast("double") * F.lit(float(scale))))
    return df.where(x.isNotNull() & clean).select(F.col(id_col).alias("id"), whole.cast("array<long>").alias("v"))


class Lists:
    """Centroids (k by length, integers), their squared distances and each one's list of the others."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        self.apart = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids]) if k else np.zeros((0, 0), np.int64)
        others = np.argsort(self.apart, axis=1, kind="stable")
        self.order = np.stack([row[row != j] for j, row in enumerate(others)]) if k else others

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each row's nearest centroid, its squared distance, and how many distances were measured."""
        n, k = len(x), len(self.centroids)
        rows = np.arange(n)
        at = self._start(x)
        gap = ((x - self.centroids[at]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), bool)
        seen[rows, at] = True
        place, measured = np.zeros(n, np.int64), n
        live = rows if k > 1 else rows[:0]
        while len(live):
            there = self.order[at[live], place[live]]
            going = self.apart[at[live], there] <= 4 * gap[live]
            live, there = live[going], there[going]
            place[live] += 1
            new = ~seen[live, there]
            who, c = live[new], there[new]
            seen[who, c] = True
            measured += len(who)
            far = ((x[who] - self.centroids[c]) ** 2).sum(axis=1)
            better = (far < gap[who]) | ((far == gap[who]) & (c < at[who]))
            who, c, far = who[better], c[better], far[better]
            at[who], gap[who], place[who] = c, far, 0
            live = live[place[live] < k - 1]
        return at, gap, measured

    def _start(self, x: np.ndarray) -> np.ndarray:
        """The centroid whose length is nearest to the vector's."""
        sizes = (self.centroids.astype(np.float64) ** 2).sum(axis=1) ** 0.5
        order = np.argsort(sizes, kind="stable")
        edges = (sizes[order][1:] + sizes[order][:-1]) / 2
        return order[np.searchsorted(edges, (x.astype(np.float64) ** 2).sum(axis=1) ** 0.5)]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) and np.abs(flat).max() > WIDEST:
        raise ArithmeticError(f"a component is beyond {WIDEST} after scaling: its squared distances would not fit into a long")
    return flat.reshape(len(column), -1)


def _sums(lists: Lists):
    """Per task and centroid: the number of its vectors and the sums of their components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = lists.centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                at, _, _ = lists.nearest(x)
                count += np.bincount(at, minlength=k)
                np.add.at(total, at, x)
        some = np.flatnonzero(count)
        cells = np.repeat(some, width)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.tile(np.arange(width), len(some))), pa.array(np.repeat(count[some], width)),
                                          pa.array(total[some].ravel())], names=["cluster", "place", "n", "total"])
    return run


def _assigned(lists: Lists):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, gap = (lists.nearest(_matrix(batch.column(1)))[:2] if batch.num_rows else (np.zeros(0, np.int64),) * 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int32)), pa.array(gap)], names=["id", "cluster", "distance"])
    return run


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors of the smallest digests of ``<seed>:<id>``, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [list(r["v"]) for r in vectors.where("id is not null").select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()]


def next_centroids(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each non-empty cluster's mean, rounded down; the empty ones stay."""
    sums = vectors.select("v").mapInArrow(_sums(Lists(np.array(centroids, np.int64))), "cluster long, place long, n long, total long")
    found = sums.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()  # k times the length rows
    after = [list(c) for c in centroids]
    for r in found:
        after[r["cluster"]][r["place"]] = r["total"] // r["n"]
    return after


def cluster(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS,
            rounds: int = ROUNDS, seed: int = SEED, length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """(``id_col``, cluster, distance, cluster_inertia, inertia, centroid_sha256): a row a kept vector."""
    vectors = materialize(integer_vectors(df, id_col, vector, length, scale), "orchard")
    centroids = first_centroids(vectors, k, seed)
    kind = vectors.schema["id"].dataType
    if not centroids:
        return df.sparkSession.createDataFrame([], T.StructType([T.StructField(id_col, kind)])).selectExpr(
            f"`{id_col}`", "cast(null as int) cluster", "cast(null as long) distance", "cast(null as long) cluster_inertia",
            "cast(null as long) inertia", "cast(null as string) centroid_sha256")
    for _ in range(rounds):
        centroids = next_centroids(vectors, centroids)
    schema = T.StructType([T.StructField("id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    rows = materialize(vectors.mapInArrow(_assigned(Lists(np.array(centroids, np.int64))), schema), "orchard-rows")
    totals = {r["cluster"]: r["t"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("t")).collect()}  # k rows
    marks = [(j, totals.get(j, 0), sum(totals.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    marks = df.sparkSession.createDataFrame(marks, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(marks), "cluster").select(  # k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds_sql() -> str:
    """A round: nearest centroid of each vector by brute force, then the rounded means."""
    parts = []
    for k in range(ROUNDS + 1):
        parts.append(f"""
a{k} AS MATERIALIZED (SELECT rid, vec_id, v, c, d FROM (
  SELECT rid, vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, c{k}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d,
         row_number() OVER (PARTITION BY rid ORDER BY d, c) AS rn FROM kept, c{k}) t WHERE rn = 1)""")
        if k < ROUNDS:
            parts.append(f"""
m{k} AS (SELECT c, list(m ORDER BY place) AS v FROM (
  SELECT c, place, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (
    SELECT c, place, sum(x)::BIGINT AS s, count(*) AS n FROM (
      SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{k}) e GROUP BY c, place) g) h GROUP BY c),
c{k + 1} AS MATERIALIZED (SELECT c{k}.c, coalesce(m{k}.v, c{k}.v) AS v FROM c{k} LEFT JOIN m{k} ON c{k}.c = m{k}.c)""")
    return ",".join(parts)


ORACLE = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {LENGTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {LENGTH}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY mark, v) - 1 AS c, v FROM (
  SELECT sha256('{SEED}:' || vec_id) AS mark, v FROM kept WHERE vec_id IS NOT NULL ORDER BY mark, v LIMIT {CENTROIDS}) f),{_rounds_sql()}
SELECT vec_id, a{ROUNDS}.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{ROUNDS}.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON a{ROUNDS}.c = c{ROUNDS}.c"""
