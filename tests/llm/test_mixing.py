from collections import Counter

from dimloom.llm import mixing
from tests.llm.helpers import ODD, documents, frame, words


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    whole, full, level = sum(sizes.values()), set(), 0.0
    while True:
        free = sum(weight[s] for s in names if s not in full)
        level = (whole - sum(3 * sizes[s] for s in full)) / free if free else level
        more = {s for s in names if weight[s] * level >= 3 * sizes[s]}
        if more == full or not free:
            return {s: min(weight[s] * level, 3.0 * sizes[s]) for s in names}
        full = more


def check(spark, rows):
    df = frame(spark, rows).selectExpr("*", "'x' as size", "'y' as taken", "0 as `starts`", "1 as `key`", "2 as `copy`")
    out = mixing.mix_sources(df).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want, taken = plain_targets(sizes), Counter()
    assert len(out) == len(rows)
    for r in out:
        assert r.size == len(words(r.text)) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) <= 1e-9 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size and 0 <= r.starts <= 3
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1, s
    return out


def test_taken_words_meet_targets(spark):
    check(spark, documents())


def test_odd_rows_capped_sources_and_reruns(spark):
    rows = ODD + [(50, "one two three", "", "tiny", 0), (51, "", "", "none", 0)]
    a, b = check(spark, rows), mixing.mix_sources(frame(spark, rows).repartition(5)).collect()
    key = lambda r: (str(r.doc_id), str(r.text), str(r.source), r.taken)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_no_words_and_empty_table(spark):
    out = mixing.mix_sources(frame(spark, [(1, None, None, None, None), (2, "", "", "a", 0)])).collect()
    assert [(r.target, r.taken) for r in out] == [(0.0, 0), (0.0, 0)]
    assert mixing.mix_sources(frame(spark, [])).count() == 0
