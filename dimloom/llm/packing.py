"""Hierarchical residual packing of token pieces into sequences of a fixed capacity.

Each partition tokenises its texts and packs the pieces best-fit, longest
first, over whole-piece lengths. Nearly full bins are final. The others
become items of the next round: they are dealt to tasks of a bounded number
of bins, packed best-fit again, and so on up the tree, until one task holds
them all or a round no longer lowers their number. Every round's result is a
written table; pieces learn their place by joining the rounds' bins.

Tokens: the given tokenizer's, cached by pre-token. A pre-token's ids do not
depend on its surroundings in these vocabularies (the text is normalised,
split by a pattern that drops white space, and each part is merged alone), so
each distinct white-space-delimited word is encoded once a task. A worker process
keeps the tokenizer for its next task, but not the words.

Defined results: a null text is empty and has the end token alone; texts
longer than the capacity are cut, others never; rows that repeat an id are
packed as rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm.words import Words, mix, slices
from dimloom.operators.ids import materialize

CAPACITY = 4096
END = 1
#: A bin with less room than this is final.
ROOM = 16
#: The most bins that one task of a later round packs.
FAN_IN = 100_000
#: A later round must lower the number of bins by this share, or it is the last.
GAIN = 0.01
#: The most words whose ids a task keeps (about 50 bytes each).
CACHE = 500_000
#: Words that are encoded as one text, a special token after each.
JOINED = 500
U = np.uint64


class Encoder:
    """Ids of texts, by words: each distinct word is encoded once while it stays in the cache.

    The cache is keyed by 64-bit hashes, and holds (hash, place and number of
    its ids) sorted by hash. The tokenizer lower-cases, so words that differ
    in ASCII case share an entry, but for those with a ``|``: the special
    tokens, which hold one, are told apart before that. New words are encoded
    many at a time with a special token after each, which cuts a text before
    anything else happens to it; words with a ``|`` are encoded alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # a task has one core: the tokenizer's own threads, one a core of the machine, mostly wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.mark = next(((k, t.content) for k, t in self.tokenizer.get_added_tokens_decoder().items()
                          if "|" in t.content and not (t.normalized or t.single_word or t.lstrip or t.rstrip)), None)
        self.forget()

    def forget(self) -> None:
        self.hash, self.at, self.size, self.flat = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def ids(self, texts: list[str]) -> Iterator[list[int]]:
        return (e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the words in some order, place of each word's ids in it, their number)."""
        alone = np.fromiter(("|" in w or not self.mark for w in words), bool, len(words))
        size = np.zeros(len(words), np.int64)
        single = list(self.ids([words[k] for k in np.flatnonzero(alone).tolist()]))
        size[alone] = [len(ids) for ids in single]
        flat = np.fromiter(chain.from_iterable(single), np.uint32)
        at = np.zeros(len(words), np.int64)
        at[alone] = np.cumsum(size[alone]) - size[alone]
        if not alone.all():
            mark, text = self.mark
            plain = [words[k] for k in np.flatnonzero(~alone).tolist()]
            joined = np.fromiter(chain.from_iterable(self.ids([text.join([*plain[k:k + JOINED], ""]) for k in range(0, len(plain), JOINED)])), np.uint32)
            end = np.flatnonzero(joined == mark)
            start = np.concatenate([[0], end[:-1] + 1])
            size[~alone] = end - start
            at[~alone] = len(flat) + start - np.arange(len(plain))
            flat = np.concatenate([flat, joined[joined != mark]])
        return flat, at, size

    def place(self, keys: np.ndarray, word: Callable[[int], str]) -> np.ndarray:
        """Places in the cache of these sorted keys, the words of which are encoded if they are new."""
        found = np.searchsorted(self.hash, keys)
        new = np.ones(len(keys), bool)
        inside = found < len(self.hash)
        new[inside] = self.hash[found[inside]] != keys[inside]
        if len(self.hash) + new.sum() > CACHE:
            self.forget()
            found, new = np.zeros(len(keys), np.int64), np.ones(len(keys), bool)
        index = np.flatnonzero(new)
        flat, at, size = self.encode([word(k) for k in index.tolist()])
        at += len(self.flat)
        self.flat = np.concatenate([self.flat, flat])
        self.hash, self.at, self.size = (np.insert(a, found[index], b) for a, b in ((self.hash, keys[index]), (self.at, at), (self.size, size)))
        return np.searchsorted(self.hash, keys)

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a column."""
        w = Words(column, lower=True)
        bars = np.concatenate([[0], np.cumsum(w.data == ord("|"))])
        keys, barred = w.hash, np.flatnonzero(bars[w.end] > bars[w.start])
        if len(barred):
            keys = keys.copy()
            keys[barred] = mix(Words(column).hash[barred])
        keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
        raw, start, end = w.data.tobytes(), w.start[first].tolist(), w.end[first].tolist()
        place = self.place(keys, lambda k: raw[start[k]:end[k]].decode())
        length = self.size[place][back]
        total = np.concatenate([[0], np.cumsum(length)])
        # place of each id of the slice in the cache
        every = self.flat[np.arange(total[-1]) + np.repeat(self.at[place][back] - total[:-1], length)]
        for a, b in zip(w.first[:-1], w.first[1:]):
            yield every[total[a]:total[b]]


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the fill of each bin: best fit, longest first, ties in the given order."""
    bins, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if a bin has room r
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        fits = open_rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[k], offset[k] = b, fill[b]
        fill[b] += need
        if room > need:
            by_room[room - need].append(b)
            open_rooms |= 1 << (room - need)
    return bins, offset, np.array(fill, np.int64)


def pack_pieces(docs: DataFrame, encoder: Callable[[], Encoder], doc_id: str, text: str) -> DataFrame:
    """One row per piece, packed within its partition: (doc_id, piece, start, length, ids_crc32, bin, offset)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        found = [array("q") for _ in names]
        nulls = array("q")
        for batch in batches:
            for part in slices(batch, text):
                for i, ids in zip(part.column(doc_id).to_pylist(), encode.texts(part.column(text))):
                    ids = np.append(ids, np.uint32(END))
                    for piece, start in enumerate(range(0, len(ids), CAPACITY)):
                        cut = ids[start:start + CAPACITY].astype("<u4")
                        if i is None:
                            nulls.append(len(found[0]))
                        for column, value in zip(found, (i or 0, piece, start, len(cut), zlib.crc32(cut.tobytes()))):
                            column.append(value)
        encode.forget()
        columns = [np.frombuffer(c, np.int64) for c in found]
        unknown = np.zeros(len(columns[0]), bool)
        unknown[np.frombuffer(nulls, np.int64)] = True
        bins, offset, _ = best_fit(columns[3])
        bins += TaskContext.get().partitionId() << 32
        table = pa.table([pa.array(columns[0], mask=unknown), *map(pa.array, columns[1:]), pa.array(bins), pa.array(offset)], [*names, "bin", "offset"])
        yield from table.to_batches(max_chunksize=100_000)

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias(doc_id), F.col(f"`{text}`").alias(text)).mapInArrow(
        pack, ", ".join(f"{n} long" for n in [*names, "bin", "offset"]))


def pack_bins(bins: DataFrame, tasks: int, level: int) -> DataFrame:
    """(bin, parent, shift, fill of the parent): bins packed into parents by ``tasks`` tasks."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("bin", pa.int64()), ("fill", pa.int64())]))
        parent, shift, fill = best_fit(table["fill"].to_numpy())
        whole = fill[parent]
        parent = parent + ((level << 56) + (TaskContext.get().partitionId() << 32))
        yield from pa.table({"bin": table["bin"], "parent": parent, "shift": shift, "fill": whole}).to_batches(max_chunksize=100_000)

    # the tasks draw from all bins alike; sorted, so that a task run again packs alike
    return bins.select("bin", "fill").repartition(tasks, F.xxhash64("bin", F.lit(level))).sortWithinPartitions("bin").mapInArrow(pack, "bin long, parent long, shift long, fill long")


def pack_sequences(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    pieces = materialize(pack_pieces(docs, lambda: worker_encoder(tokenizer), doc_id, text), "pack-pieces")
    place = None  # (bin of a piece, its parent so far, shift)
    under = pieces.groupBy("bin").agg(F.sum("length").alias("fill")).where(F.col("fill") <= CAPACITY - ROOM)
    under = materialize(under, "pack-bins")
    count, level = under.count(), 0
    while count > 1:
        level += 1
        tasks = -(-count // FAN_IN)
        done = materialize(pack_bins(under, tasks, level), "pack-round")
        step = done.select(F.col("bin").alias("_bin"), F.col("parent").alias("_parent"), F.col("shift").alias("_shift"))
        if place is None:
            place = step.toDF("bin", "parent", "shift")
        else:
            place = place.join(step, place["parent"] == step["_bin"], "left").select(
                "bin", F.coalesce("_parent", "parent").alias("parent"), (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift"))
        place = materialize(place, "pack-places")
        under = done.where(F.col("fill") <= CAPACITY - ROOM).select(F.col("parent").alias("bin"), "fill").distinct()
        left = under.count()
        if tasks == 1 or left > (1 - GAIN) * count:
            break
        count = left
    if place is None:
        return pieces.withColumnRenamed("bin", "sequence_id").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    place = place.select(F.col("bin").alias("_bin"), "parent", "shift")
    return pieces.join(place, pieces["bin"] == place["_bin"], "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("parent", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """The worker process's encoder of this file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
