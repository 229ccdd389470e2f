import numpy as np

from dimloom.llm import near_vectors
from tests.llm.helpers import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.98):
    good = {}
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            good[k] = x / np.linalg.norm(x)
    pairs = [(a, b) for a in good for b in good if a < b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b]) and good[a] @ good[b] >= threshold]
    return pairs


def clusters(n, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        base = rng.standard_normal(32)
        for _ in range(4):
            v = base + rng.standard_normal(32) * rng.choice([0.02, 0.1, 0.14, 0.2])
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)], int(k % 3)))
    return rows


def test_links_are_exact_and_recalled(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK_ROWS", 16)
    rows = clusters(150)
    rows += [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(40)]  # copies
    got = {r.vec_id: r for r in near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    pairs = plain(rows)
    links = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    assert all(got[k].n_links <= links[k] for k in range(len(rows)))
    assert sum(r.n_links for r in got.values()) >= 0.9 * links.sum()
    want = components(range(len(rows)), pairs)
    assert np.mean([got[k].component_id == want[k] for k in want]) > 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [], 0), (7, [0.0] * 3, 0), (8, [1.0, None, 3.0], 0), (9, [1.0, float("nan"), 3.0], 0),
            (10, [2.0, 4.0, 6.0], 0), (11, [1.0, 2.0], 0), (12, [float("inf"), 2.0, 3.0], 0), (2, v, 0), (None, v, 0), (13, [1e30, 2e30, 3e30], 0)]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    alone = [(str(k), 0, str(k), True) for k in (3, 4, 5, 6, 7, 8, 9, 11, 12)]
    assert got == sorted(alone + [("1", 5, "1", True), ("2", 5, "1", False), ("2", 5, "1", False), ("10", 5, "1", False), ("None", 5, "1", False), ("13", 5, "1", False)])
    assert near_vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_least_collisions_and_tables():
    assert near_vectors.least_collisions(24, 0.98) >= 20
    assert near_vectors.tables_for(2, 0.98) < near_vectors.tables_for(4, 0.98)


def test_more_lines_than_a_byte_counts(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "LINES", 350)  # as 1.05e9 vectors have at 0.98
    rows = clusters(40)
    got = {r.vec_id: r.n_links for r in near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    links = np.bincount(np.array(plain(rows)).ravel(), minlength=len(rows))
    assert near_vectors.least_collisions(350, 0.98) > 255
    assert all(got[k] <= links[k] for k in range(len(rows))) and sum(got.values()) >= 0.9 * links.sum() > 0


def test_least_collisions_of_thousands_of_lines():
    assert 0.6 * 4_000 < near_vectors.least_collisions(4_000, 0.9) < 0.75 * 4_000
    assert near_vectors.least_collisions(24, 1.0) == 24


def test_text_labels_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = clusters(30)
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, near_vectors.near_vectors(df).collect()))
    named = df.withColumn("label", F.concat(F.lit("group "), F.col("label").cast("string")))
    extra = named.withColumns({c: F.lit("x") for c in ("node", "body", "copies", "cells", "t", "cell", "block", "i", "j", "links", "n_links", "component_id", "kept")})
    assert sorted(map(tuple, near_vectors.near_vectors(extra).collect())) == want


def test_recall_at_greater_depths(spark, monkeypatch):
    """As with very many vectors: cells by four and by six lines."""
    rows = clusters(120, seed=8)
    links = np.bincount(np.array(plain(rows)).ravel(), minlength=len(rows))
    df = spark.createDataFrame(rows, SCHEMA)
    for crowd, depth in ((len(rows) / 4 ** 3.5, 4), (len(rows) / 4 ** 5.5, 6)):
        monkeypatch.setattr(near_vectors, "CROWD", crowd)
        got = {r.vec_id: r.n_links for r in near_vectors.near_vectors(df).collect()}
        recall = sum(got.values()) / links.sum()
        print(f"depth {depth}: recall {recall:.3f} of {links.sum() // 2} links")
        assert all(got[k] <= links[k] for k in range(len(rows))) and recall >= 0.9
