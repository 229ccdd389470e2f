"""Hashes of words made to collide under a polynomial, in each operator that tells words apart by hash."""

import numpy as np
import pyarrow as pa

from dimloom.llm import jaccard, packing, quality, repeats
from dimloom.llm.queries import vocabulary
from dimloom.llm.words import Words, span_hashes
from tests.llm.helpers import frame


def thue_morse(n, first="a", second="b"):
    return "".join(first if bin(k).count("1") % 2 == 0 else second for k in range(n))


A, B = thue_morse(1024), thue_morse(1024, "b", "a")


def test_hashes_differ_under_every_seed():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 20_000).astype(np.uint8)
    start = rng.integers(0, 15_000, 4000)
    end = start + np.where(rng.random(4000) < 0.1, rng.integers(0, 5000, 4000), rng.integers(0, 40, 4000))
    spans = [bytes(data[a:b]) for a, b in zip(start, end)]
    marks = [span_hashes(data, start, end, seed) for seed in (0, 1, 2)]
    for h in marks:
        assert len(set(h.tolist())) == len(set(spans)) and len({(s, int(x)) for s, x in zip(spans, h)}) == len(set(spans))
    assert not (marks[0] == marks[1]).any() and not (marks[1] == marks[2]).any()
    hard = [Words(pa.array([f"{A} {B}"]), seed=seed).hash for seed in range(3)]
    assert all(h[0] != h[1] for h in hard) and len({int(x) for h in hard for x in h}) == 6


def test_statistics_lines(spark):
    found = quality.statistics(Words(pa.array([f"{A}\n{B}\n{A}"])))
    assert found["n_dup_lines"].tolist() == [1] and found["n_words"].tolist() == [3]


def test_ids_are_the_tokenizer_s():
    from tokenizers import Tokenizer

    texts = [f"{A} x {B}", f"{B} {A}"]
    own = Tokenizer.from_file(vocabulary())
    got = [x.tolist() for x in packing.Encoder(vocabulary()).texts(pa.array(texts))]
    assert got == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_links_and_removals(spark):
    words = [f"w{k}" for k in range(12)]
    one, other = " ".join([*words, A, *words[::-1]]), " ".join([*words, B, *words[::-1]])
    df = frame(spark, [(1, one, "en", "a", 1), (2, other, "en", "a", 1), (3, one, "en", "a", 1)])
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df, size=3, percent=90).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    left = {r.doc_id: r.n_removed for r in repeats.substring_dedup(df).collect()}
    assert left == {1: 0, 2: 0, 3: 25}
