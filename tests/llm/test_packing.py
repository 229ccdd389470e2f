import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimloom.llm import packing
from dimloom.llm.queries import vocabulary
from tests.llm.helpers import ODD, documents, frame


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_word_cache_gives_the_tokenizers_ids(tokenizer):
    texts = [r[1] or "" for r in documents()] + ["<|endoftext|>x it's 'tis ''s don’t", "a b c", "é ́e", "x\x00y", "İSTANBUL ΣΑΣ ΣΑΣ.", "가 1½٣"]
    encoder = packing.Encoder(vocabulary())
    got = [ids.tolist() for ids in encoder.texts(pa.array(texts))]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_are_encoded_many_at_a_time(tokenizer, monkeypatch):
    words = ["a", "", "<", ">", "x|y", "<|endoftext|>", "<|startoftext|>b", "\u0301e", "e", "\u00a0", "|", "\x00", "don't", "ΣΑΣ", "İ", "<", "漢字1½"] + [f"w{k}" for k in range(40)]
    encoder, seen = packing.Encoder(vocabulary()), []
    ids = encoder.ids
    monkeypatch.setattr(packing, "JOINED", 7)
    monkeypatch.setattr(encoder, "ids", lambda texts: seen.extend(texts) or ids(texts))
    for some in (words, ["x|y"], ["a"], []):
        flat, at, size = encoder.encode(some)
        assert [flat[a:a + n].tolist() for a, n in zip(at, size)] == [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
    assert len(seen) <= 4 + 8 + 2
    encoder.mark = None
    flat, at, size = encoder.encode(words)
    assert [flat[a:a + n].tolist() for a, n in zip(at, size)] == [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_fills_no_bin_over_and_leaves_no_two_that_fit(lengths):
    bins, offset, fill = packing.best_fit(np.array(lengths, np.int64), 50)
    for b in range(len(fill)):
        items = sorted((offset[k], lengths[k]) for k in np.flatnonzero(bins == b))
        assert [o for o, _ in items] == [0, *np.cumsum([n for _, n in items])[:-1]]
        assert sum(n for _, n in items) == fill[b] <= 50
    assert len(fill) < 2 or sum(sorted(fill)[:2]) > 50


@pytest.mark.parametrize("fan_in", [packing.FAN_IN, 7])
def test_sequences_are_gapless_and_whole(spark, tokenizer, monkeypatch, fan_in):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)
    rows = ODD + documents()[:120]
    out = packing.pack_sequences(frame(spark, rows).selectExpr("*", "1 as bin", "2 as offset", "3 as sequence_id").repartition(6), vocabulary()).collect()
    want = []
    for r, e in zip(rows, tokenizer.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)):
        ids = np.array(e.ids + [1], "<u4")
        want += [(str(r[0]), k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for items in places.values():
        items.sort()
        assert [o for o, _ in items] == [0, *np.cumsum([n for _, n in items])[:-1]] and sum(n for _, n in items) <= 4096
    bound = -(-sum(r.length for r in out) // 4096)
    assert len(places) <= bound * 1.1 + 2 + (fan_in == 7) * 8


def test_empty_table(spark):
    assert packing.pack_sequences(frame(spark, []), vocabulary()).count() == 0
