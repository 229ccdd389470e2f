"""The pipeline against plain versions of its stages, and the registry of its queries."""

import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from dimloom.llm import quality
from dimloom.llm.queries import vocabulary
from dimloom.llm.words import Words
from tests.llm import test_jaccard, test_lines, test_mixing, test_quality
from tests.llm.helpers import ODD, SF, documents, frame


def key(r):
    return str(tuple(r))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and output of each stage, as ``run`` chains them, over documents and odd rows."""
    rows = documents() + [(10**6 + r[0], *r[1:]) for r in ODD if r[0] is not None and r[0] != 11] + [r for r in ODD if r[0] is None]
    root = str(tmp_path_factory.mktemp("stages"))
    docs, found = frame(spark, rows).selectExpr("*"), [rows]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(os.path.join(root, name))
        columns = docs.columns
        docs = spark.read.parquet(os.path.join(root, name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        found.append([tuple(r) for r in docs.collect()])
    return found


def test_quality_stage(spark, stages):
    model = quality.train(frame(spark, stages[0]), spark.read.parquet(f"{SF}/labels.parquet"))
    want = []
    for r in stages[0]:
        n, _, _, _, repeats = test_quality.plain(r[1])
        good = model.probability(quality.scores(Words(pa.array([r[1]], pa.string())), model.weights))[0] >= quality.KEEP_AT
        if n >= 10 and 100 * repeats <= 20 * n and good:
            want.append(r)
    assert sorted(map(key, stages[1])) == sorted(map(key, want)) and 100 < len(want) < len(stages[0])


def test_line_stage(stages):
    texts = {r[0]: t for r, (_, t, _) in zip(stages[1], test_lines.plain(stages[1]))}
    assert len(stages[2]) == len(stages[1])
    for r in stages[2]:
        if r[0] is not None:
            assert r[1] == texts[r[0]] and r[4] == len(r[1])


def test_jaccard_stage(stages):
    known = [r for r in stages[2] if r[0] is not None]
    groups = test_jaccard.plain(known, 5, 80)
    assert sorted(r[0] for r in stages[3] if r[0] is not None) == sorted(i for i, (_, c) in groups.items() if c == i)


def test_mixing_stage(stages):
    before, after = Counter(map(key, stages[3])), Counter(map(key, stages[4]))
    sizes, got = Counter(), Counter()
    for r in stages[3]:
        sizes[r[3]] += len(test_mixing.words(r[1]))
    for r in stages[4]:
        got[r[3]] += len(test_mixing.words(r[1]))
    longest = max(len(test_mixing.words(r[1])) for r in stages[3])
    for s, target in test_mixing.plain_targets(sizes).items():
        assert abs(got[s] - target) <= longest
    assert all(n <= 3 * before[k] for k, n in after.items())


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    want = []
    for r in stages[4]:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(r[0], k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted(map(key, (r[:5] for r in stages[5]))) == sorted(map(key, want))
    places = defaultdict(list)
    for r in stages[5]:
        places[r[5]].append((r[6], r[3]))
    for items in places.values():
        items.sort()
        assert [o for o, _ in items] == [0, *np.cumsum([n for _, n in items])[:-1]] and sum(n for _, n in items) <= 4096


def test_every_operator_is_registered():
    numbers = [int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark, workdir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(f"{workdir}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{workdir}/labels.parquet")
    out = corpus_pipeline.run(spark, workdir)
    assert out.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
