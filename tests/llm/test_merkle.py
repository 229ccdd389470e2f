"""The Merkle manifest against a plain version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from dimloom.llm import merkle
from tests.llm.helpers import ODD, SF, documents, frame


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """The root, and per node the siblings before and behind its ancestor on each level."""
    paths, at, now = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(now) > 1:
        for k, a in enumerate(at):
            run = now[a - a % 3:a - a % 3 + 3]
            paths[k].append(("".join(run[:a % 3]), "".join(run[a % 3 + 1:])))
            at[k] = a // 3
        now = [H(*now[j:j + 3]) for j in range(0, len(now), 3)]
    return now[0] if now else None, paths


def plain(rows):
    """doc_id -> the contract's other columns, for rows of documents."""
    leaves = {}
    for d, text, lang, source, n in rows:
        own = H(*map(framed, (d, source, lang, n, text)))
        even = d is not None and zlib.crc32(str(d).encode()) % 2 == 0
        other = H(*map(framed, (d, source, lang, n, text.replace("\n", "")))) if even and text is not None else own
        leaves.setdefault(source, []).append((d is not None, d or 0, own, other))
    order = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    subs, out = [], []
    for s in order:
        leaves[s].sort()
        subs.append(climb([x[2] for x in leaves[s]]))
    root, upper = climb([r for r, _ in subs])
    for s, (sub, paths), rest in zip(order, subs, upper):
        for (known, d, own, other), path in zip(leaves[s], paths):
            h = other
            for left, right in path + rest:
                h = H(left, h, right)
            out.append((d if known else None, own, sub, root, H(*[a + b for a, b in path + rest]), h, h == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows", [ODD, [], ODD[:1], documents()])
def test_manifest_equals_the_plain_version(spark, rows):
    found = rows_of(merkle.verified_manifest(frame(spark, rows)))
    assert found == plain(rows)


@pytest.mark.parametrize("n", [2, 3, 4, 9, 10, 28, 100])
def test_every_shape_of_small_trees(spark, n):
    """Many rounds (blocks of 9 nodes), one source that holds nearly all rows."""
    rows = [(k * 7919 % 1009, f"line {k}\nline", "en", "hot" if k % 11 else "rare", k) for k in range(n)]
    old = merkle.LEVELS, merkle.BLOCK
    merkle.LEVELS, merkle.BLOCK = 2, 9
    try:
        assert rows_of(merkle.verified_manifest(frame(spark, rows))) == plain(rows)
    finally:
        merkle.LEVELS, merkle.BLOCK = old


def test_tampering_is_found_where_a_line_feed_was(spark):
    got = {r["doc_id"]: r["verified"] for r in merkle.verified_manifest(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    hit = {d for d, text, *_ in documents() if zlib.crc32(str(d).encode()) % 2 == 0 and "\n" in (text or "")}
    assert hit and {d for d, ok in got.items() if not ok} == hit


def test_clashing_columns(spark):
    df = frame(spark, ODD)
    extra = df.withColumns({c: F.lit("x") for c in ("tree", "i", "n", "node", "block", "path", "place", "leaf", "root", "d0", "b1", "top")})
    assert rows_of(merkle.verified_manifest(extra)) == plain(ODD)
