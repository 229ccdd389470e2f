import hashlib

from dimloom.llm import repeats
from tests.llm.helpers import ODD, documents, frame, words


def plain(rows):
    order = lambda i: repeats.LAST if i is None else i
    first = {}
    for i, text, *_ in rows:
        w = words(text)
        for k in range(len(w) - 12):
            x = tuple(w[k:k + 13])
            first[x] = min(first.get(x, repeats.LAST), order(i))
    out = []
    for i, text, *_ in rows:
        w = words(text)
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < order(i) for j in range(13)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return out


def test_matches_plain_version(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 5_000)
    rows = documents() + [(10**6 + r[0], *r[1:]) if r[0] else r for r in ODD]
    df = frame(spark, rows).selectExpr("*", "1 as print", "2 as own", "3 as given").repartition(5)
    got = [tuple(r) for r in repeats.substring_dedup(df).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_a_common_passage_goes_from_all_but_the_first(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"a{k} b{k} {passage} c{k}", "", "", 0) for k in range(50)]
    got = {r.doc_id: r.n_removed for r in repeats.substring_dedup(frame(spark, rows)).collect()}
    assert got == {k: 60 * (k > 0) for k in range(50)}
    spans = repeats.repeated_spans(frame(spark, rows)).collect()
    assert len(spans) == 49 and all(s.src_id < s.id and (s.pos, s.src_pos, s.n) == (2, 2, 48) for s in spans)


def test_empty_table(spark):
    assert repeats.substring_dedup(frame(spark, [])).count() == 0
