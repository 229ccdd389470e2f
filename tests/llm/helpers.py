"""Small tables with the awkward cases, and plain versions of what operators compute."""

import re

import pyarrow.parquet as pq
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LONG = " ".join(f"w{k * 7919 % 3001}" for k in range(30_000))
LINES = "first line here\nsecond line there\nthird\nfourth one\nfifth of them\nsixth\nseventh and last\neighth"
#: Nulls in every column, empty and blank texts, ties, repeated rows, a long text.
ODD = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "b", 1), (2, "one two THREE four five six seven eight nine ten eleven twelve thirteen fourteen", None, "a", None),
       (3, None, "en", "a", 0), (4, "", "en", None, 0), (5, " \n\t ", "en", "a", 4), (6, "word", "en", "c", 4), (7, "word", "de", "c", 4), (8, LONG, "en", "b", 9), (9, LONG + " tail", "en", "b", 9),
       (10, LINES, "en", "a", 1), (11, "intro\n" + LINES + "\noutro", "en", "a", 1), (11, "intro\n" + LINES + "\noutro", "en", "a", 1), (None, LINES, "en", "a", 1), (None, None, None, None, None)]


def words(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def documents(path=SF):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in pq.read_table(f"{path}/documents.parquet").to_pylist()]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def components(ids, edges):
    """The smallest id reachable from each."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
