"""N-gram Jaccard join with prefix filters under several global token orders.

Two texts whose shingle sets have a Jaccard similarity of t or more share a
token among the first ``n - ceil(t n) + 1`` of each, whatever the one global
order of all tokens. So several orders are used: each puts a token the later
the more frequent its rarest word is in the corpus (by a count sketch of
fixed size over every text), in finer or coarser steps, and breaks ties by
hashes of its own seed. A pair is verified only if it shares a prefix token
under every order.

1. Texts become sets of 64-bit shingle hashes; equal sets form one class.
2. Prefix tokens of the first order are grouped; a token that two or more
   classes hold puts them into the *star* of its smallest class. Pairs that
   share a token meet in that token's star; a class enters a star once,
   however many tokens lead there.
   Linked sets differ in size by a factor of 1/t at most, so a star falls apart
   by size: sets meet in the star's part of one size class, and those of the
   next class visit it. A class alone in its part is sent nowhere.
3. Before any text is shipped, the parts compare *cards*: counts of a set's
   shingles by 8 bits of their hash. The cards of two sets differ, summed over
   the counts, by no more than the sets do, so a set whose card is too far from
   all others of its part links with none there and leaves it. Sets that share
   a rare passage only, whose number grows faster than the corpus, end here.
4. What stays is split into blocks of bounded size, and every two blocks meet in
   a task of their own, which intersects the filters of all orders, verifies
   the survivors on their whole sets, and emits a spanning set of the links
   it found: never the pairs of a group.
5. Components of the links, then one row per document.

Defined results: a null or wordless text has no set (0 shingles) and links
with nothing; fewer words than a shingle form one shorter shingle; equal
texts and repeated rows share a class; rows with a null id take part, and
their id is never a component's smallest (null only if a component has no
other id); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.components import connected_components
from dimloom.llm.words import Words, mix, slices, windows
from dimloom.operators.ids import materialize

U = np.uint64
ORDERS = 3
#: Counters of the frequency sketch (4 bytes each in a task, 1 when broadcast), and the most tasks that fill one.
#: It tells rare words apart while it has about as many counters as the corpus has words; more only costs memory.
SKETCH = 1 << 22
SKETCH_TASKS = 1024
PART = 1 << 14
#: Rows and shingles of one block of a star.
BLOCK_ROWS = 512
BLOCK_SHINGLES = 400_000
#: Counts of a card (a byte each), and rows of one block of cards.
CARD = 256
CARD_ROWS = 2048


def shingle_sets(column: pa.Array, size: int, lower: bool, levels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, level) of each distinct shingle of each text, sorted by the first two.

    A shingle's level is its rarest word's (0 without ``levels``).
    """
    w = Words(column, lower)
    at, hashes = w.windows(size)
    text = w.text[at]
    level = np.zeros(len(at), np.uint8)
    if levels is not None:
        own = levels[(w.hash & U(SKETCH - 1)).astype(np.int64)]
        level = own[at]
        for k in range(1, size):
            level = np.minimum(level, own[at + k])
    short = np.flatnonzero((w.count > 0) & (w.count < size))
    if len(short):
        more = []
        for d in short:
            whole = w.hash[w.first[d]:w.first[d + 1]]
            _, one = windows(whole, np.array([0, len(whole)]), len(whole))
            more.append(mix(one ^ U(len(whole))))
        text, hashes = np.append(text, short), np.concatenate([hashes, *more])
        level = np.append(level, np.zeros(len(short), np.uint8) if levels is None else [own[w.first[d]:w.first[d + 1]].min() for d in short]).astype(np.uint8)
    order = np.lexsort((hashes, text))
    text, hashes, level = text[order], hashes[order], level[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new], level[new]


def starts(text: np.ndarray, texts: int) -> np.ndarray:
    return np.searchsorted(text, np.arange(texts + 1))


def signatures(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit value for each set (order-free sum of mixed elements, and the size)."""
    total = np.zeros(len(hashes) + 1, U)
    np.add.accumulate(mix(hashes ^ U(0x5851F42D4C957F2D)), out=total[1:])
    return mix((total[at[1:]] - total[at[:-1]]) + np.diff(at).astype(U) * U(0x9E3779B97F4A7C15))


def cards(hashes: np.ndarray, at: np.ndarray) -> pa.Array:
    """Of each set, how many of its elements fall to each of ``CARD`` values of their hash (255 stands for more)."""
    width = pa.binary(CARD)
    out = []
    for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
        counts = np.bincount((mix(hashes[low:high]) & U(CARD - 1)).astype(np.int64), minlength=CARD)
        out.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
    return pa.array(out, width).cast(pa.binary())


def close(card: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which sets may link with another one across the two sides, by their cards and sizes; all that do are among them.

    Linked sets of a and b elements differ in ``(a + b) (100 - percent) / (100 + percent)`` elements at most.
    """
    found = np.zeros(len(n), bool)
    others = np.flatnonzero(right)
    theirs, size, ones = card[others], n[others], np.ones(CARD, np.float32)
    for k in np.flatnonzero(left).tolist():
        total = size + n[k]
        able = np.flatnonzero(((100 + percent) * np.minimum(size, n[k]) >= percent * total) & (others != k))
        near = theirs[able]
        apart = (np.maximum(near, card[k]) - np.minimum(near, card[k])).astype(np.float32) @ ones
        able = able[(100 + percent) * apart.astype(np.int64) <= (100 - percent) * total[able]]
        if len(able):
            found[k] = True
            found[others[able]] = True
    return found


def frequency_sketch(docs: DataFrame, text: str, lower: bool) -> np.ndarray:
    """Logarithms (in eighths) of counters by the low bits of each word's hash, over all texts: ``SKETCH`` bytes, whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for part in slices(batch, text):
                place, n = np.unique(Words(part.column(text), lower).hash & U(SKETCH - 1), return_counts=True)
                total[place.astype(np.int64)] += n.astype(np.uint32)
        yield pa.RecordBatch.from_pydict({"part": list(range(SKETCH // PART)), "counts": [total[k:k + PART].tobytes() for k in range(0, SKETCH, PART)]}, pa.schema([("part", pa.int32()), ("counts", pa.binary())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch["part"].to_pylist(), batch["counts"].to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"part": list(total), "levels": [np.minimum(8 * np.log2(x + 1.0), 255).astype(np.uint8).tobytes() for x in total.values()]}, pa.schema([("part", pa.int32()), ("levels", pa.binary())]))

    parts = docs.select(f"`{text}`").coalesce(SKETCH_TASKS).mapInArrow(count, "part int, counts binary")
    rows = parts.repartition(16, "part").mapInArrow(add, "part int, levels binary").collect()
    levels = np.zeros(SKETCH, np.uint8)
    for k, b in rows:
        levels[k * PART:(k + 1) * PART] = np.frombuffer(b, np.uint8)
    return levels


def rank(hashes: np.ndarray, level: np.ndarray, order: int) -> np.ndarray:
    """A token's place in a global order: its level (in steps that double with the order) first, then a seeded hash.

    The places are distinct but for the 8 bits that the level takes, and a
    tie is broken by the token itself wherever the places are sorted.
    """
    return ((level >> np.uint8(2 * order)).astype(U) << U(56)) | (mix(hashes ^ U((order + 1) * 0x2545F4914F6CDD1D & (1 << 64) - 1)) >> U(8))


def prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    """``n - ceil(percent n / 100) + 1``, and 0 for an empty set."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def prefixes(text: np.ndarray, hashes: np.ndarray, at: np.ndarray, level: np.ndarray, order: int, percent: int) -> np.ndarray:
    """Indexes of the elements that lie in their set's prefix under one order."""
    by = np.lexsort((hashes, rank(hashes, level, order), text))
    place = np.arange(len(by)) - at[text[by]]
    return by[place < prefix_sizes(np.diff(at), percent)[text[by]]]


def least_partner(percent: int) -> int:
    """Sets below this size link with equal sets only."""
    return math.ceil(percent / (100 - percent)) if percent < 100 else 1 << 62


def size_class(n: str, percent: int) -> Column:
    """Sets of n and m >= n elements, ``100 n >= percent m``, lie in the same class or in neighbouring ones."""
    width = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1.0  # a hair wider, against rounding
    return F.floor(F.log(F.col(n).cast("double")) / width)


def matrix(row: np.ndarray, column: np.ndarray, rows: int, other: np.ndarray, others_column: np.ndarray, others: int) -> np.ndarray:
    """How many columns each row of one sparse 0/1 matrix shares with each row of another."""
    both = np.intersect1d(column, others_column)
    out = np.zeros((rows, others), np.float32)
    for k in range(0, len(both), 4096):
        part = both[k:k + 4096]

        def dense(r: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
            at = np.minimum(np.searchsorted(part, c), len(part) - 1)
            hit = part[at] == c
            m = np.zeros((n, len(part)), np.float32)
            m[r[hit], at[hit]] = 1
            return m

        out += dense(row, column, rows) @ dense(other, others_column, others).T
    return out


def spanning(u: np.ndarray, v: np.ndarray, n: int) -> list[int]:
    """Indexes of edges that connect whatever all edges connect."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k, (a, b) in enumerate(zip(u.tolist(), v.tolist())):
        a, b = root(a), root(b)
        if a != b:
            parent[a] = b
            out.append(k)
    return out


def links(texts: pa.Array, left: np.ndarray, right: np.ndarray, size: int, lower: bool, percent: int, levels: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links (by index into ``texts``) between the texts marked ``left`` and those marked ``right``."""
    row, token, level = shingle_sets(texts, size, lower, levels)
    n = len(texts)
    at = starts(row, n)
    count = np.diff(at)
    sides = [np.flatnonzero(left), np.flatnonzero(right)]
    place = [np.full(n, -1) for _ in sides]
    for p, s in zip(place, sides):
        p[s] = np.arange(len(s))

    def shared(index: np.ndarray) -> np.ndarray:
        r, t = row[index], token[index]
        a, b = (p[r] >= 0 for p in place)
        return matrix(place[0][r[a]], t[a], len(sides[0]), place[1][r[b]], t[b], len(sides[1]))

    total = count[sides[0]][:, None] + count[sides[1]][None, :]
    small = np.minimum(count[sides[0]][:, None], count[sides[1]][None, :])
    # the shared part must reach percent * total / (100 + percent), and is no larger than the smaller set
    able = ((100 + percent) * small >= percent * total) & (sides[0][:, None] != sides[1][None, :])
    for order in range(ORDERS):
        if not able.any():
            return []
        able &= shared(prefixes(row, token, at, level, order, percent)) > 0
    if not able.any():
        return []
    part = np.zeros(n, bool)
    part[sides[0][able.any(axis=1)]] = True
    part[sides[1][able.any(axis=0)]] = True
    same = shared(np.flatnonzero(part[row])).astype(np.int64)
    u, v = np.nonzero(able & ((100 + percent) * same >= percent * total))
    u, v = sides[0][u], sides[1][v]
    return [(int(u[k]), int(v[k])) for k in spanning(u, v, n)]


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, lower: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, print): one row per row of ``docs``; ``print`` is ``xxhash64`` of its text.

    Texts link when ``100 * intersection >= percent * union`` of their sets
    of ``size``-word shingles; a component's id is its smallest document id.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    printed = docs.withColumn("print", F.xxhash64("text"))
    levels = spark.sparkContext.broadcast(frequency_sketch(docs, "text", lower))  # SKETCH bytes

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, token, level = shingle_sets(part.column("text"), size, lower, levels.value)
                at = starts(row, part.num_rows)
                n = np.diff(at)
                index = prefixes(row, token, at, level, 0, percent)
                index = index[n[row[index]] >= least_partner(percent)]
                edge = np.searchsorted(row[index], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("print"), pa.array(n.astype(np.int64)), pa.array(signatures(token, at).view(np.int64), mask=n == 0),
                     pa.ListArray.from_arrays(pa.array(edge), pa.array(token[index].view(np.int64))), cards(token, at)], ["doc_id", "print", "n_shingles", "node", "prefix", "card"])

    signed = materialize(printed.mapInArrow(sign, "doc_id long, print long, n_shingles long, node long, prefix array<long>, card binary"), "jaccard-sets")
    classes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"))

    held = signed.select("node", F.explode("prefix").alias("token"))
    shared = held.groupBy("token").agg(F.min("node").alias("star"), F.max("node").alias("top")).where("star != top").select("token", "star")
    stars = held.join(shared, "token").select("star", "node").distinct().join(classes, "node")
    stars = materialize(stars.withColumn("own", size_class("n", percent)), "jaccard-stars")
    # a visitor meets those of the class itself there; among themselves visitors meet in their own class's part
    parts = stars.withColumn("part", F.explode(F.array("own", F.col("own") - 1)))
    some = parts.groupBy("star", "part").agg(F.count_if(F.col("own") == F.col("part")).alias("own"), F.count(F.lit(1)).alias("all")).where("own > 0 and all > 1")
    stars = materialize(parts.drop("own").join(some.select("star", "part"), ["star", "part"])
                        .select(F.xxhash64("star", "part").alias("star"), "node", "rep", "n"), "jaccard-parts")

    def near_of(stars: DataFrame, blocks: Column) -> DataFrame:
        """The sets of each star, in every two blocks of it that they belong to."""
        return (stars.join(stars.groupBy("star").agg(blocks.cast("int").alias("blocks")), "star")
                .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("star", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "rep", "n"))

    def compare(table: pa.Table) -> pa.Table:
        node, once = np.unique(table["node"].to_numpy(), return_index=True)  # an id may come with the same text again
        table = table.take(pa.array(once))
        card = np.frombuffer(b"".join(table["card"].to_pylist()), np.uint8).reshape(-1, CARD)
        block, i, j = table["block"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
        return table.filter(pa.array(close(card, table["n"].to_numpy(), block == i, block == j, percent))).select(["star", "node", "rep", "n"])

    carded = near_of(stars, F.ceil(F.count(F.lit(1)) / CARD_ROWS))
    shown = signed.where("node is not null and size(prefix) > 0").select(F.col("node").alias("own"), "doc_id", "card")
    dealt = shown.join(carded.hint("merge"), (shown["own"] == carded["node"]) & shown["doc_id"].eqNullSafe(carded["rep"])).drop("own", "doc_id")
    stars = materialize(dealt.groupBy("star", "i", "j").applyInArrow(compare, "star long, node long, rep long, n long").distinct(), "jaccard-close")
    near = near_of(stars, F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES))).drop("n")
    # a merge join at every size: the plan of a small table is that of a large one
    met = docs.join(near.hint("merge"), docs["doc_id"].eqNullSafe(near["rep"]))

    def link(table: pa.Table) -> pa.Table:
        # an id may stand for several texts: only a class's own is taken, and once
        row, token, _ = shingle_sets(table["text"].combine_chunks(), size, lower)
        mine = np.flatnonzero(signatures(token, starts(row, table.num_rows)).view(np.int64) == table["node"].to_numpy())
        node, once = np.unique(table["node"].to_numpy()[mine], return_index=True)
        found: list[tuple[int, int]] = []
        if len(node) > 1:
            table = table.take(pa.array(mine[once]))
            block, i, j = table["block"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
            found = links(table["text"].combine_chunks(), block == i, block == j, size, lower, percent, levels.value)
        return pa.table({"u": pa.array([node[a] for a, _ in found], pa.int64()), "v": pa.array([node[b] for _, b in found], pa.int64())})

    edges = met.select("star", "i", "j", "block", "node", "text").groupBy("star", "i", "j").applyInArrow(link, "u long, v long")
    parts = connected_components(edges)
    named = parts.join(classes, "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    grouped = parts.join(named, "component").select("node", "component_id")
    # written first, so that Spark may split the join on a class of very many copies
    every = materialize(classes.join(grouped, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id")), "jaccard-classes")
    return (signed.select("doc_id", "print", "n_shingles", "node").join(every, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "print"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose group has a smaller id (rows that repeat an id are one document, and stay)."""
    found = jaccard_components(docs, size, percent, doc_id=doc_id, text=text)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("gone_id"), F.col("print").alias("gone_print")).distinct()
    return docs.join(gone, docs[doc_id].cast("long").eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs[text]) == gone["gone_print"]), "left_anti")
