import pytest

from dimloom.llm import licenses
from tests.llm.helpers import ODD, documents, frame

TEXTS = {100: ("Some prose of no interest.\nReleased under the MIT License.\nmore prose", "mit"), 101: ("Licensed under the Apache License, Version 2.0.", "apache"),
         102: ("This work is licensed under the GNU General Public License, version 3.", "gpl"), 103: ("a\nAll rights reserved.\nLicensed under CC BY-NC 4.0.", "cc-by-nc,proprietary"),
         104: ("The driver lost his license in the city, and all rights to the car.", None), 105: ("Distributed under the BSD 3-Clause License", "bsd"),
         106: ("This library is available under the GNU Lesser General Public License, version 2.1.", "lgpl"), 107: ("the of and to in", None)}


@pytest.fixture(scope="module")
def scanned(spark):
    rows = ODD + documents() + [(i, t, "", "", 0) for i, (t, _) in TEXTS.items()]
    df = frame(spark, [(r[0] + 10**6 if r[0] is not None and r in ODD else r[0], *r[1:]) for r in rows if r[0] not in TEXTS or r[1] == TEXTS[r[0]][0]]).selectExpr("*", "1 as families", "2 as notice")
    classifier = licenses.train(spark, df)
    return df, classifier, licenses.license_scan(df, classifier).collect()


def test_families_are_found_and_prose_is_not(scanned):
    df, classifier, out = scanned
    assert len(out) == df.count()
    got = {r.doc_id: r.families for r in out}
    assert {i: got[i] for i in TEXTS} == {i: f for i, (_, f) in TEXTS.items()}
    known = {"cc-by-nc": "CC BY-NC", "gpl": "GNU General Public", "apache": "Apache License", "mit": "MIT License", "proprietary": "All rights reserved"}
    for r in df.where(f"doc_id < 100 or doc_id > 107").collect():
        if r.doc_id is not None:
            assert got[r.doc_id] == (",".join(sorted(k for k, v in known.items() if v in (r.text or ""))) or None)


def test_paragraphs_and_odd_rows(scanned, spark):
    df, classifier, out = scanned
    rows = licenses.license_paragraphs(df.where("doc_id = 103"), classifier).collect()
    assert {(r.paragraph, r.family, r.confirmed) for r in rows} == {(1, "proprietary", True), (2, "cc-by-nc", True)}
    assert all(classifier.least <= r.probability <= 1 for r in rows)
    counts = {r.doc_id: (r.n_paragraphs, r.n_notices) for r in out}
    assert counts[10**6 + 3] == counts[10**6 + 4] == counts[10**6 + 5] == (0, 0)
    assert licenses.license_scan(df.limit(0), classifier).count() == 0


def test_calibration_sees_all_paragraphs(spark, monkeypatch):
    monkeypatch.setattr(licenses, "UNKNOWN_ROWS", 100)
    like = "Distributed under the terms of the GNU General Public, version 3 or version 2, number {}"  # near a notice, but names no licence
    rows = [(k, f"the of and to in number {k}\nanother line of prose number {k}", "", "", 0) for k in range(1000)] + [(10**4 + k, like.format(k), "", "", 0) for k in range(10)]
    df = frame(spark, rows)
    classifier = licenses.train(spark, df)
    scored = classifier.score(licenses.with_grams(licenses.paragraphs(df, "doc_id", "text"), "notice"))
    assert scored.where(licenses.known_chance("chances") > licenses.LEAST).count() >= 10
    assert scored.where(licenses.known_chance("chances") > classifier.least).count() <= licenses.FALSE_SHARE * 2010 + 1
