import hashlib

import duckdb

from dimloom.llm import lines
from tests.llm.helpers import ODD, SF, documents, frame, words


def plain(rows, every=lines.EVERY):
    """Texts after removal: rows in the order of (null last, id), ties keep."""
    cut = {}
    for k, (i, text, *_) in enumerate(rows):
        if text is None:
            continue
        parts, now, before = [], [], 0
        all_lines = text.split("\n")
        for line in all_lines:
            h = int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
            now.append(line)
            if (h + 31 * before) % every == 0:
                parts.append(now)
                now = []
            before = h
        cut[k] = parts + ([now] if now else [])
    able = lambda c: len(c) >= 2 and sum(bool(words(x)) for x in c) >= 2
    first = {}
    for k, parts in cut.items():
        for p, c in enumerate(parts):
            if able(c):
                place = (rows[k][0] is None, rows[k][0] or 0, p)
                first["\n".join(c)] = min(first.get("\n".join(c), place), place)
    out = []
    for k, (i, text, *_) in enumerate(rows):
        keep = [c for p, c in enumerate(cut.get(k, [])) if not able(c) or first["\n".join(c)] == (i is None, i or 0, p)]
        out.append((i, None if text is None else "\n".join("\n".join(c) for c in keep), sum(map(len, cut.get(k, []))) - sum(map(len, keep))))
    return out


def test_matches_plain_version(spark):
    rows = documents()[:60] + [(10**6 + (r[0] or 0), *r[1:]) if r[0] else r for r in ODD]
    df = frame(spark, rows).selectExpr("*", "1 as k", "2 as body", "3 as id", "4 as n_lines")
    got = lines.line_dedup(df)
    assert got.columns.count("n_lines") == 1 and {"k", "body", "id"} <= set(got.columns)
    assert sorted(map(str, ((r.doc_id, r.text, r.n_removed_lines) for r in got.collect()))) == sorted(map(str, plain(rows)))
    assert lines.line_dedup(df.limit(0)).count() == 0


def test_matches_sql(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF}/documents.parquet'")
    want = duckdb.sql(lines.ORACLE).fetchall()
    got = lines.line_dedup(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")).select("doc_id", "text", "n_lines", "n_chunks", "n_removed_lines")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_an_inserted_line_moves_no_later_boundary(spark):
    body = [f"line number {k} of the passage" for k in range(60)]
    rows = [(1, "\n".join(body), "", "", 0), (2, "\n".join(body[:20] + ["something new"] + body[20:]), "", "", 0)]
    got = {r.doc_id: r.n_removed_lines for r in lines.line_dedup(frame(spark, rows)).collect()}
    assert got[1] == 0 and got[2] > 40
