import duckdb
import numpy as np
import pyarrow as pa

from dimloom.llm import quality
from dimloom.llm.words import Words, slices
from tests.llm.helpers import ODD, SF, documents, frame, words


def plain(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    five = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    twice = {x for x in five if five.count(x) > 1} if len(five) < 3000 else {x for x, n in __import__("collections").Counter(five).items() if n > 1}
    covered = {k + j for k, x in enumerate(five) if x in twice for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_statistics_match_plain_version(spark):
    rows = documents() + [(10_000 + k, *r[1:]) for k, r in enumerate(ODD)] + [(20_000, "a b c d e a b c d e\nä|ö <é>\nä|ö <é>\n x\n x", "", "", 0)]
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, rows), None).collect()}
    for doc_id, text, *_ in rows:
        r, want = got[doc_id], plain(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, doc_id
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert (r.base_failed, r.kept, r.probability) == (failed, not failed, None)


def test_clashing_columns_are_replaced_and_others_stay(spark):
    df = frame(spark, ODD).selectExpr("*", "1 as kept", "'x' as n_words", "array(1) as `odd name`")
    out = quality.quality_rules(df, None)
    assert out.columns.count("kept") == 1 and "odd name" in out.columns
    assert out.count() == len(ODD) and out.where("kept").count() == 5 + 2 - 1
    assert quality.quality_rules(df.limit(0), None).count() == 0


def test_held_out_accuracy_and_calibration():
    rows = duckdb.sql("select text, quality from '/root/testdata/sf0.1/documents.parquet' join '/root/testdata/sf0.1/labels.parquet' using (doc_id) where text is not null order by hash(doc_id) limit 2400").fetchall()
    text, good = pa.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    n = 1600
    model = quality.fit(text[:n], good[:n], np.arange(n) % 5 == 0)
    parts = slices(pa.RecordBatch.from_arrays([text[n:]], ["text"]), "text")
    p = np.concatenate([model.probability(quality.scores(Words(x.column("text")), model.weights)) for x in parts])
    y = good[n:]
    assert ((p >= quality.KEEP_AT) == y).mean() > 0.95
    assert (p[y == 1] >= quality.KEEP_AT).mean() > 0.98
    assert abs(p.mean() - y.mean()) < 0.05


def test_training_needs_both_classes(spark):
    docs = frame(spark, documents())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert quality.train(docs, labels.where("quality = 1")) is None
    assert quality.train(docs, labels.limit(0)) is None
    a, b = (quality.train(docs, labels.union(labels)) for _ in range(2))
    assert np.array_equal(a.weights, b.weights)
