"""Each pipeline stage against plain Python over what its predecessor kept."""

import re
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from teamlines.llm import quality
from teamlines.llm.common import read_table
from teamlines.session import materialized
from test_decontam import brute as brute_leaks
from test_learned import crc
from test_neardup import brute_set

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and comes out of it."""
    docs, out = read_table(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        found = materialized(stage(spark, docs, SMALL))
        out[name] = (docs, found)
        docs = found
    return out


def rows(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_stages_and_registration(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "benchmark", "packing"]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns
            assert set(rows(after)) <= set(rows(before))


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    texts = rows(before)
    stats = {i: quality.statistics(t) for i, t in texts.items()}
    told = [(stats[r.doc_id], r.quality) for r in read_table(spark, SMALL, "labels").collect() if r.doc_id in texts and crc(r.doc_id) % 5]
    x, y = np.array([s for s, _ in told]), np.array([v for _, v in told], float)
    rng, d, n = np.random.default_rng(quality.SEED), len(quality.STATISTICS), quality.FREQUENCIES
    waves, phases = rng.normal(size=(d, n)) / (quality.WIDTH * np.sqrt(d)), rng.uniform(0, 2 * np.pi, n)
    spread = x.std(axis=0)
    spread[spread <= 1e-9] = 1

    def features(s):
        return np.hstack([np.cos(np.clip((s - x.mean(axis=0)) / spread, -5, 5) @ waves + phases) * np.sqrt(2 / n), np.ones((len(s), 1))])

    z = features(x)
    weights = np.linalg.solve(z.T @ z + len(x) * quality.PENALTY * np.eye(n + 1), z.T @ y)
    edges = np.linspace(-0.5, 1.5, quality.BINS + 1)

    def raw(s):
        return np.clip(features(s) @ weights, -0.5, 1.5)

    bins = defaultdict(list)
    for b, v in zip(np.clip(np.searchsorted(edges, raw(x), "right") - 1, 0, quality.BINS - 1), y):
        bins[b].append(v)
    points = [(edges[b] + edges[b + 1]) / 2 for b in sorted(bins)]
    levels = quality.isotonic([len(bins[b]) for b in sorted(bins)], [sum(bins[b]) for b in sorted(bins)])
    score = dict(zip(stats, np.interp(raw(np.array(list(stats.values()))), points, levels)))
    want = {i for i, s in score.items() if s >= quality.ACCEPT}
    near = {i for i, s in score.items() if abs(s - quality.ACCEPT) < 1e-6}
    assert set(rows(after)) - near == want - near


def test_exact_stage(stages):
    before, after = map(rows, stages["exact"])
    groups = defaultdict(list)
    for i, t in before.items():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    assert set(after) == {min(g) for g in groups.values()}


def test_near_stage(stages):
    before, after = map(rows, stages["near"])
    ids = sorted(before)
    sets = {i: brute_set(before[i], 4) for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if j < i and (both := len(sets[i] & sets[j])) and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert set(after) == {find(i) for i in ids}


def test_benchmark_stage(spark, stages):
    before, after = map(rows, stages["benchmark"])
    items = [(r.item_id, r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
    listed = list(before.items())
    leaked = {listed[n][0] for n, _ in brute_leaks(listed, items)}
    assert set(after) == set(before) - leaked


def test_packing_stage(spark, stages):
    docs, found = stages["packing"]
    parts = found.collect()
    per_document, per_sequence = defaultdict(int), defaultdict(int)
    for p in parts:
        per_document[p.doc_id] += p.length
        per_sequence[p.sequence_id] += p.length
    assert set(per_document) == set(rows(docs))
    assert all(per_document[p.doc_id] == p.doc_tokens for p in parts)
    assert sorted(per_sequence.values())[1:] == [1024] * (len(per_sequence) - 1)
    assert corpus_pipeline.run(spark, SMALL).count() == len(parts)


def test_awkward_documents(spark, tmp_path):
    """Nulls, empty texts, repeated rows, extra columns and empty tables go through all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_id long, kept int, digest string"
    long = " ".join(f"word{i * i % 977}" for i in range(30_000))
    made = [(1, None, "en", "a"), (2, "", None, None), (3, "same words here", "en", "b"), (3, "same words here", "en", "b"), (None, "no id at all", "de", "a"),
            (5, long, "en", "a"), (6, long + " end", "en", "a"), (7, " \n ", "en", "c")]
    for name, documents in (("some", made), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame([(*d, 5, 1, 2, "x") for d in documents], schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(3, 1, 0), (None, 0, 0), (5, 1, 0), (6, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, None), (2, ""), (None, "nothing like any of the documents above, surely")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, folder).collect()
        assert bool(found) == bool(documents)
        if documents:
            assert {5, None} <= {r.doc_id for r in found} and 6 not in {r.doc_id for r in found}
