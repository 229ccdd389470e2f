"""Substring dedup by paths of repeated token k-mers, compacted and verified on source coordinates.

The k-mers (``WINDOW`` words) of all texts are the edges of a De Bruijn graph
whose nodes are their overlaps. An occurrence's source is one in a document
with a smaller id: the smallest of those that meet it first. Steps:

1. Edges are routed by their minimizer (the least hash of their 5-word parts),
   so neighbouring edges of a path travel together and equal edges meet. A
   map task first settles what it can alone and sends each edge's smallest
   occurrence only: a very common edge is one row a chunk.
2. Where edges meet, every later occurrence learns its source. Occurrences
   that follow one another, with sources that do too, are one nonbranching
   path: a path ends where the next edge is not repeated or branches away
   from the source.
3. Paths are joined per document and compacted into maximal spans, then
   joined with their source document; both sides digest the words under the
   span, and the digests are compared.
4. Each word that a span covers is removed.

Should a span's words differ from its source's (a collision of 64-bit
hashes), the whole is done again with other hashes.

Defined results: a null or empty text has no words; a null id counts as
larger than all others; rows that repeat an id are one document to each
other (no row has a smaller id); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm.words import Words, mix, slices, windows
from dimloom.operators.ids import materialize

U = np.uint64
WINDOW = 13
PART_WORDS = 5
#: Edges that a map task settles at a time.
CHUNK = 1_000_000
#: Routing parts for each shuffle partition; a task works on one part at a time.
PARTS = 8
TRIES = 4
LAST = (1 << 63) - 1
RUN = "id long, print long, pos int, n int, src_id long, src_print long, src_pos int"
SPAN = "array<struct<start:int,n:int,src_id:bigint,src_print:bigint,src_start:int>>"


def prints(w: Words) -> np.ndarray:
    """A hash of each whole text, which tells apart rows of one id."""
    return w.spans(w.at[:-1], w.at[1:], seed=0).view(np.int64)


def edges(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, hash, minimizer) of every edge, by the words' own seed."""
    at, hashes = windows(w.hash, w.first, WINDOW)
    small = np.zeros(len(w.hash), U)
    where, parts = w.windows(PART_WORDS)
    small[where] = parts
    least = small[at]
    for k in range(1, WINDOW - PART_WORDS + 1):
        least = np.minimum(least, small[at + k])
    return at, hashes, mix(least)


def sources(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each edge its first occurrence (index) by document id, and whether that is in a smaller document."""
    by_doc = np.argsort(doc, kind="stable") if np.any(doc[1:] < doc[:-1]) else None
    order = np.argsort(hashes if by_doc is None else hashes[by_doc], kind="stable")
    order = order if by_doc is None else by_doc[order]
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else order
    source = np.empty(len(h), np.int64)
    source[order] = first
    return source, doc[source] < doc


def runs(row: np.ndarray, pos: np.ndarray, src_row: np.ndarray, src_pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first, length) of the maximal runs in which all places step together; sorted by row and pos."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (pos[1:] != pos[:-1] + 1) | (src_row[1:] != src_row[:-1]) | (src_pos[1:] != src_pos[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(row)))


def found_runs(row: np.ndarray, pos: np.ndarray, src: np.ndarray, at: np.ndarray, ids: np.ndarray, text_prints: np.ndarray) -> list[np.ndarray]:
    """The columns of ``RUN`` for the occurrences ``at`` with source ``src[at]``."""
    order = at[np.lexsort((pos[at], row[at]))]
    first, n = runs(row[order], pos[order], row[src[order]], pos[src[order]])
    k = order[first]
    s = src[k]
    return [ids[row[k]], text_prints[row[k]], pos[k].astype(np.int32), n.astype(np.int32), ids[row[s]], text_prints[row[s]], pos[s].astype(np.int32)]


def send(parts: int, seed: int):
    """Map side: (part, kind, blobs) with kind 0 for runs already found, 1 for edges to settle where they meet."""
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("blobs", pa.list_(pa.binary()))])

    def flush(held: list[tuple], texts: int) -> Iterator[pa.RecordBatch]:
        row, pos, h, part = (np.concatenate([x[k] for x in held]) for k in range(4))
        ids, text_prints = (np.concatenate([x[k] for x in held]) for k in (4, 5))
        src, later = sources(h, ids[row])
        out: list[tuple[int, int, list[bytes]]] = []
        if later.any():
            blobs = found_runs(row, pos, src, np.flatnonzero(later), ids, text_prints)
            out.append((int(part[0]), 0, [b.tobytes() for b in blobs]))
        stay = np.flatnonzero(~later)
        stay = stay[np.argsort(part[stay], kind="stable")]  # rows and places stay in order within a part
        cuts = np.flatnonzero(np.diff(part[stay])) + 1
        for index in np.split(stay, cuts) if len(stay) else []:
            r, p = row[index], pos[index]
            new = np.ones(len(index), bool)
            new[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1)
            k = np.flatnonzero(new)
            used, local = np.unique(r[k], return_inverse=True)
            out.append((int(part[index[0]]), 1, [h[index].tobytes(), local.astype(np.uint32).tobytes(), p[k].astype(np.uint32).tobytes(),
                                                 np.diff(np.append(k, len(index))).astype(np.uint32).tobytes(), ids[used].tobytes(), text_prints[used].tobytes()]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*out)), schema.types)], schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, n = [], 0, 0
        for batch in batches:
            for piece in slices(batch, "text"):
                w = Words(piece.column("text"), seed=seed)
                at, h, least = edges(w)
                row = w.text[at]
                held.append((row + texts, at - w.first[row], h, (least % U(parts)).astype(np.int32), piece.column("doc_id").fill_null(LAST).to_numpy(), prints(w)))
                texts, n = texts + w.texts, n + len(at)
                if n >= CHUNK:
                    yield from flush(held, texts)
                    held, texts, n = [], 0, 0
        if n:
            yield from flush(held, texts)

    return task


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side, part by part (rows come sorted by part): the runs found."""
    names = [x.split()[0] for x in RUN.split(", ")]
    types = [np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, np.int32]
    now, held = None, []

    def close() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        h = np.concatenate([np.frombuffer(b[0], U) for b in held])
        n = np.concatenate([np.frombuffer(b[3], np.uint32) for b in held]).astype(np.int64)
        base = np.cumsum([0, *(len(b[4]) // 8 for b in held)])
        row = np.repeat(np.concatenate([np.frombuffer(b[1], np.uint32).astype(np.int64) + k for b, k in zip(held, base)]), n)
        begin = np.concatenate([np.frombuffer(b[2], np.uint32) for b in held]).astype(np.int64)
        pos = np.arange(len(row)) + np.repeat(begin - np.cumsum(n) + n, n)
        ids, text_prints = (np.concatenate([np.frombuffer(b[k], np.int64) for b in held]) for k in (4, 5))
        src, later = sources(h, ids[row])
        if later.any():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found_runs(row, pos, src, np.flatnonzero(later), ids, text_prints)], names)

    for batch in batches:
        for part, kind, blobs in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if part != now:
                yield from close()
                now, held = part, []
            if kind:
                held.append(blobs)
            else:
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b, t)) for b, t in zip(blobs, types)], names)
    yield from close()


def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the paths of each document that follow one another into maximal spans."""
    for batch in batches:
        paths = batch.column("paths")
        flat, at = paths.flatten(), np.concatenate([[0], np.cumsum(paths.value_lengths().to_numpy())])
        pos, n, src_id, src_print, src_pos = (flat.field(k).to_numpy() for k in range(5))
        doc = np.repeat(np.arange(len(paths)), np.diff(at))
        order = np.lexsort((pos, doc))
        doc, pos, n, src_id, src_print, src_pos = (x[order] for x in (doc, pos, n, src_id, src_print, src_pos))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + n[:-1]) | (src_id[1:] != src_id[:-1]) | (src_print[1:] != src_print[:-1]) | (src_pos[1:] != src_pos[:-1] + n[:-1])
        k = np.flatnonzero(new)
        length = np.add.reduceat(n, k).astype(np.int32) if len(k) else n[:0]
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(doc[k])), batch.column("print").take(pa.array(doc[k])), pa.array(pos[k]), pa.array(length),
                                          pa.array(src_id[k]), pa.array(src_print[k]), pa.array(src_pos[k])], ["id", "print", "pos", "n", "src_id", "src_print", "src_pos"])


def repeated_spans(docs: DataFrame, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Maximal spans (columns of ``RUN``): the ``n`` edges from word ``pos`` on of a document, and where its source has them.

    ``id`` is the document's (``LAST`` if null) and ``print`` its text's hash.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    parts = PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(send(parts, seed), "part int, kind int, blobs array<binary>")
    paths = sent.repartition("part").sortWithinPartitions("part").mapInArrow(settle, RUN)
    by_doc = paths.groupBy("id", "print").agg(F.collect_list(F.struct("pos", "n", "src_id", "src_print", "src_pos")).alias("paths"))
    return by_doc.mapInArrow(compact, RUN)


def digests(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    return [hashlib.blake2b(b" ".join(words[a:a + n + WINDOW - 1]), digest_size=16).digest() for a, n in spans]


def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the covered words of each text and digests its spans, as occurrence and as source."""
    for batch in batches:
        for part in slices(batch, "text"):
            yield judged_rows(part)


def judged_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: dict[str, list] = {name: [] for name in JUDGED.names}
    for i, p, text, own, given in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "print", "text", "own", "given"))):
        words = (text or "").encode().split()
        keep = np.ones(len(words), bool)
        for s in own or []:
            keep[s["pos"]:s["pos"] + s["n"] + WINDOW - 1] = False
        left = words if keep.all() else [words[k] for k in np.flatnonzero(keep).tolist()]
        seen = digests(words, [(s["pos"], s["n"]) for s in own or []])
        made = digests(words, [(s["src_pos"], s["n"]) for s in given or []])
        row = (i, len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest(), p,
               [{**{k: s[k] for k in ("src_id", "src_print", "src_pos", "n")}, "digest": d} for s, d in zip(own or [], seen)],
               [{"src_pos": s["src_pos"], "n": s["n"], "digest": d} for s, d in zip(given or [], made)])
        for column, value in zip(out.values(), row):
            column.append(value)
    return pa.RecordBatch.from_pydict(out, JUDGED)


JUDGED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("print", pa.int64()),
                    ("own", pa.list_(pa.struct([("src_id", pa.int64()), ("src_print", pa.int64()), ("src_pos", pa.int32()), ("n", pa.int32()), ("digest", pa.binary())]))),
                    ("given", pa.list_(pa.struct([("src_pos", pa.int32()), ("n", pa.int32()), ("digest", pa.binary())])))])
JUDGED_DDL = ("doc_id long, n_words long, n_removed long, kept_sha256 string, print long, "
              "own array<struct<src_id:bigint,src_print:bigint,src_pos:int,n:int,digest:binary>>, given array<struct<src_pos:int,n:int,digest:binary>>")


def with_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(prints(Words(piece.column("text"))))], ["doc_id", "text", "print"])


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per row of ``docs``."""
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    for seed in range(TRIES):
        spans = materialize(repeated_spans(docs, seed), "repeat-spans")
        own = spans.groupBy("id", "print").agg(F.collect_list(F.struct("pos", "n", "src_id", "src_print", "src_pos")).alias("own"))
        given = (spans.select("src_id", "src_print", "src_pos", "n").distinct()
                 .groupBy("src_id", "src_print").agg(F.collect_list(F.struct("src_pos", "n")).alias("given"))
                 .withColumnRenamed("src_id", "id").withColumnRenamed("src_print", "print"))
        known = own.join(given, ["id", "print"], "full").withColumnRenamed("print", "text_print")
        texts = docs.mapInArrow(with_prints, "doc_id long, text string, print long")
        met = texts.join(known, (F.coalesce(texts["doc_id"], F.lit(LAST)) == known["id"]) & (texts["print"] == known["text_print"]), "left")
        judged = materialize(met.select("doc_id", "text", "print", "own", "given").mapInArrow(judge, JUDGED_DDL), "repeat-judged")
        key = ["src_id", "src_print", "src_pos", "n"]
        seen = judged.select(F.explode("own").alias("s")).select("s.*").groupBy(*key, "digest").count()
        made = judged.select(F.coalesce("doc_id", F.lit(LAST)).alias("src_id"), F.col("print").alias("src_print"), F.explode("given").alias("s"))
        made = made.select("src_id", "src_print", "s.src_pos", "s.n", F.col("s.digest").alias("right")).distinct()
        wrong = seen.join(made, key, "left").where("not (digest <=> right)").limit(1).count()
        if not wrong:
            return judged.select("doc_id", "n_words", "n_removed", "kept_sha256")
    raise RuntimeError(f"spans differ from their sources under {TRIES} hash seeds")
