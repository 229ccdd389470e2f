"""Near-duplicate vectors by collision-counting projections.

Each vector, scaled to length 1, is projected on many random lines. Windows
of ``WINDOW`` each way around a query's place on a line hold a vector at the
wanted similarity with a known chance, so a pair at or above the threshold
collides on nearly all lines: pairs with ``least_collisions`` or more are
verified by their cosine in double precision.

So that a query meets few strangers, vectors are sorted into cells of
``CELL`` width on the first lines: a *table* takes ``depth`` lines, and equal
cells on all of them meet. ``depth`` follows the logarithm of the number of
vectors, and the number of tables follows from the wanted recall. A pair that
meets in several tables is counted in the first.

Equal vectors form one class first. A large cell is split into blocks, each
two of which meet in a task of their own; tasks emit sums of links per class
and a spanning set of links, never the pairs.

Defined results: null, empty or zero vectors, those with null or non-finite
components, and those without a label link with nothing; vectors of
different length never link; rows that repeat an id are rows of their own;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.llm.components import connected_components
from dimloom.llm.jaccard import spanning
from dimloom.operators.ids import materialize

RECALL = 0.98
LINES = 24
CELL = 0.8
WINDOW = 0.5
#: Vectors that a cell may hold on average before the cells take one more line.
CROWD = 4_000
BLOCK_ROWS = 1_024


def line_directions(dimension: int, lines: int) -> np.ndarray:
    return np.random.default_rng([dimension, 20_000]).standard_normal((lines, dimension)).T


def spread(threshold: float) -> float:
    """Standard deviation of the difference of two vectors' projections at the threshold."""
    return math.sqrt(max(2 - 2 * threshold, 1e-12))


def least_collisions(lines: int, threshold: float) -> int:
    """The largest count that a pair at the threshold reaches with a chance of 0.999 or more."""
    p = min(math.erf(WINDOW / spread(threshold) / math.sqrt(2)), 1 - 1e-12)
    tail = 0.0
    for count in range(lines, 0, -1):  # by logarithms: the coefficients of many lines are beyond a double
        ways = math.lgamma(lines + 1) - math.lgamma(count + 1) - math.lgamma(lines - count + 1)
        tail += math.exp(ways + count * math.log(p) + (lines - count) * math.log1p(-p))
        if tail >= 0.999:
            return count
    return 1


def tables_for(depth: int, threshold: float) -> int:
    """How many tables find a pair at the threshold with a chance of ``RECALL``."""
    same = 1 - min(0.9, spread(threshold) * math.sqrt(2 / math.pi) / CELL)
    return max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - same**depth)))


def matrix_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length of each row's vector or 0 if it is not valid, flat values, starts)."""
    size = column.value_lengths().fill_null(0).to_numpy()
    at = np.concatenate([[0], np.cumsum(size)])
    values = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    good = np.isfinite(values)
    bad = np.concatenate([[0], np.cumsum(~good)])
    square = np.concatenate([[0], np.cumsum(values != 0)])
    valid = (bad[at[1:]] == bad[at[:-1]]) & (square[at[1:]] > square[at[:-1]])
    return np.where(valid, size, 0), values, at[:-1]


def unit(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max(axis=1, keepdims=True)  # no square overflows
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, node, body): body the doubles of a valid vector, node a hash of body and label; else null."""
    for batch in batches:
        size, values, at = matrix_of(batch.column("embedding"))
        label = batch.column("label")
        body = [values[a:a + n].tobytes() if n and known else None for a, n, known in zip(at, size, label.is_valid().to_pylist())]
        node = [None if b is None else int.from_bytes(hashlib.blake2b(b, digest_size=8, key=str(k).encode()).digest(), "little", signed=True) for b, k in zip(body, label.to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), label, pa.array(node, pa.int64()), pa.array(body, pa.binary())], ["vec_id", "label", "node", "body"])


def cells(depth: int, tables: int):
    """(node, copies, label, body, cells): the cell of each vector in each table."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("body").to_pylist()
            size = np.array([len(b) for b in raw], np.int64)
            found = np.zeros((len(raw), tables), np.int64)
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                places = np.floor(unit(np.frombuffer(b"".join(raw[k] for k in rows), np.float64).reshape(len(rows), -1)) @ line_directions(n // 8, depth * tables) / CELL).astype(np.int64)
                for t in range(tables):
                    key = np.full(len(rows), np.uint64(n * 1_000_003 + t))
                    for k in range(t * depth, (t + 1) * depth):
                        key = (key ^ places[:, k].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                        key ^= key >> np.uint64(29)
                    found[rows, t] = key.view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "copies", "label", "body")), pa.array(found.tolist(), pa.list_(pa.int64()))], ["node", "copies", "label", "body", "cells"])

    return task


def compare(threshold: float, lines: int):
    """Links inside a block, or between two: (u, v) spanning, and (u, null, links) sums."""
    least = least_collisions(lines, threshold)

    def task(table: pa.Table) -> pa.Table:
        empty = pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        if table.num_rows < 2:
            return empty
        raw = table["body"].to_pylist()
        n = len(raw[0])
        if any(len(b) != n for b in raw):  # two sizes share a cell's hash
            return pa.concat_tables([task(table.filter(pa.array([len(b) == m for b in raw]))) for m in sorted({*map(len, raw)})])
        vectors = unit(np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1))
        place = (vectors @ line_directions(n // 8, lines)).astype(np.float32)
        node, copies, label, t = table["node"].to_numpy(), table["copies"].to_numpy(), table["label"].to_numpy(), table["t"][0].as_py()
        block, i, j = table["block"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
        cell = np.array(table["cells"].to_pylist(), np.int64)
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        hits = np.zeros((len(a), len(b)), np.min_scalar_type(lines))  # holds a count of all lines
        for k in range(lines):  # query-centred windows on each line
            hits += np.abs(place[a, k][:, None] - place[b, k][None, :]) <= WINDOW
        able = (hits >= least) & (label[a][:, None] == label[b][None, :])
        for earlier in range(t):
            able &= cell[a, earlier][:, None] != cell[b, earlier][None, :]
        able &= (a[:, None] < b[None, :]) if i == j else True
        x, y = np.nonzero(able)
        x, y = a[x], b[y]
        same = np.zeros(len(x), bool)
        for k in range(0, len(x), 1 << 16):
            p, q = x[k:k + (1 << 16)], y[k:k + (1 << 16)]
            same[k:k + (1 << 16)] = np.einsum("ij,ij->i", vectors[p], vectors[q]) >= threshold
        x, y = x[same], y[same]
        if not len(x):
            return empty
        links = np.bincount(x, copies[y], minlength=len(node)) + np.bincount(y, copies[x], minlength=len(node))
        some, tree = np.flatnonzero(links), spanning(x, y, len(node))
        return pa.table({"u": pa.array(np.concatenate([node[some], node[x[tree]]])), "v": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[y[tree]])]),
                         "links": pa.array(np.concatenate([links[some].astype(np.int64), np.zeros(len(tree), np.int64)]))})

    return task


def near_vectors(vectors: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    group = F.col(f"`{label}`")
    if not isinstance(vectors.schema[label].dataType, T.IntegralType):  # labels of other types by their 64-bit hash
        group = F.when(group.isNotNull(), F.xxhash64(group))
    own = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding"), group.cast("long").alias("label"))
    signed = own.mapInArrow(sign, "vec_id long, label long, node long, body binary")
    classes = materialize(signed.where("node is not null").groupBy("node", "label", "body").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("rep")), "vector-classes")
    depth = max(2, math.ceil(math.log(max(1, classes.count()) / CROWD, 4)))
    tables = tables_for(depth, threshold)
    lines = max(LINES, depth * tables)

    placed = materialize(classes.select("node", "copies", "label", "body").mapInArrow(cells(depth, tables), "node long, copies long, label long, body binary, cells array<long>"), "vector-cells")
    spots = placed.select("node", "label", F.posexplode("cells").alias("t", "cell"))
    crowds = spots.groupBy("label", "t", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    met = (placed.select("*", F.posexplode("cells").alias("t", "cell")).join(materialize(crowds, "vector-crowds").select("label", "t", "cell", "blocks"), ["label", "t", "cell"])
           .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("t", "cell", "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "body", "cells"))
    found = materialize(met.groupBy("label", "t", "cell", "i", "j").applyInArrow(compare(threshold, lines), "u long, v long, links long"), "vector-links")

    parts = connected_components(found.where("v is not null").select("u", "v"))
    named = parts.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least"))
    grouped = parts.join(named, "component").select("node", "least")
    sums = found.where("v is null").groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "node")
    of = (classes.join(sums, "node", "left").join(grouped, "node", "left")
          .select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "rep").alias("component_id")))
    out = signed.select("vec_id", "node").join(of, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
