import random
import re

import numpy as np
import pytest

from dimloom.llm import jaccard
from dimloom.operators.ids import materialize
from tests.llm.helpers import ODD, components, documents, frame, words


def shingles(text, size):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def plain(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t, *_ in rows]
    edges = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y)]
    return {i: (len(x), c) for (i, x), c in zip(sets, components([i for i, _ in sets], edges).values())}


def variants(n, edits, seed=3):
    """Near copies of one text around the threshold."""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(90)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append((1000 + k, " ".join(w), "", "", 0))
    return out


@pytest.mark.parametrize("size,percent,block", [(3, 90, 512), (5, 80, 8)])
def test_components_match_all_pairs(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    rows = documents()[:150] + variants(60, 5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, rows), size, percent).collect()}
    assert got == plain(rows, size, percent)


def test_odd_rows(spark):
    df = frame(spark, ODD).selectExpr("*", "0 as node", "1 as prefix", "2 as star", "3 as rep")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, 3, 90).collect()), key=str)
    n = len(shingles(ODD[9][1], 3))
    long = len(shingles(ODD[7][1], 3))
    assert got == sorted([(1, 12, 1), (2, 12, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (8, long, 8), (9, long + 1, 8), (10, n, 10),
                          (11, n + 2, 11), (11, n + 2, 11), (None, n, 10), (None, 0, None)], key=str)
    assert jaccard.jaccard_components(df.limit(0), 3, 90).count() == 0
    kept = [r.doc_id for r in jaccard.one_of_each(df, 3, 90).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [1, 3, 4, 5, 6, 8, 10, 11, 11, None]))


def test_prefixes_meet_for_every_similar_pair():
    rng = np.random.default_rng(1)
    of = lambda tokens: (tokens % np.uint64(251)).astype(np.uint8)  # noqa: E731  any level that the token fixes
    for n in (9, 10, 37, 200):
        x = rng.integers(0, 1 << 63, n).astype(np.uint64)
        y = x.copy()
        drop = n - -(-90 * n // 100)
        y = np.sort(y[drop:] if drop else y)
        x = np.sort(x)
        text = np.repeat([0, 1], [len(x), len(y)])
        every, at = np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])
        for order in range(jaccard.ORDERS):
            index = jaccard.prefixes(text, every, at, of(every), order, 90)
            assert set(every[index[text[index] == 0]]) & set(every[index[text[index] == 1]])


def test_sets_that_share_a_passage_only_ship_no_text(spark, monkeypatch):
    rng = random.Random(5)
    passage = " ".join(f"rare{k}" for k in range(12))  # its words come once a text, the others more often
    rows = [(k, " ".join([passage, *(f"w{rng.randrange(20)}" for _ in range(60))]), "", "", 0) for k in range(40)]
    rows += [(100 + k, rows[0][1] + f" tail{k}", "", "", 0) for k in range(3)]
    met = {}
    monkeypatch.setattr(jaccard, "materialize", lambda df, label: met.setdefault(label, materialize(df, label)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, rows), 5, 80).collect()}
    assert got == plain(rows, 5, 80)
    assert met["jaccard-parts"].select("node").distinct().count() == 43
    assert {r.rep for r in met["jaccard-close"].collect()} == {0, 100, 101, 102}


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_cards_lose_no_link(percent):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40_000).astype(np.uint64)  # large sets too: counts beyond a byte
    sets = []
    for n in (9, 60, 520, 40_000):
        for share in (1.0, 0.97, percent / 100, 0.4):
            k = int(n * share)
            sets.append(np.unique(np.concatenate([base[:k], rng.integers(0, 1 << 63, n - k).astype(np.uint64)])))
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    card = np.frombuffer(b"".join(jaccard.cards(np.concatenate(sets), at).to_pylist()), np.uint8).reshape(-1, jaccard.CARD)
    n, every = np.diff(at), np.ones(len(sets), bool)
    linked = [any(a != b and 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y)) for b, y in enumerate(sets)) for a, x in enumerate(sets)]
    found = jaccard.close(card, n, every, every, percent)
    assert not (np.array(linked) & ~found).any()
    assert any(linked) and not found.all()
