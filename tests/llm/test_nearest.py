"""Nearest neighbours against brute force."""

import duckdb
import numpy as np
import pytest

from teamlines.llm import nearest
from teamlines.llm.queries import op12_projection_forest

SCHEMA = "vec_id long, embedding array<float>, label int, row_id long, leaf int, vector string"


def brute(rows, k=20):
    """``{(row number of the query): [(vec_id, score), ...]}`` over all rows."""
    sound = [i for i, (n, v) in enumerate(rows) if n is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    vectors = {i: np.array(rows[i][1], np.float32).astype(float) for i in sound}
    out = {}
    for q in sound:
        if rows[q][0] % 20 == 0:
            near = [(-float((vectors[q] * vectors[i]).sum()), rows[i][0], i) for i in sound if i != q and len(vectors[i]) == len(vectors[q])]
            out[q] = [(i, -s) for s, i, _ in sorted(near)[:k]]
    return out


def lists(found):
    by = {}
    for r in found.collect():
        by.setdefault((r.query_id, r.row_id), []).append((r.rank, r.vec_id, r.score))
    for ranked in by.values():
        ranked.sort()
        assert [x[0] for x in ranked] == list(range(1, len(ranked) + 1))
        assert [(-s, i) for _, i, s in ranked] == sorted((-s, i) for _, i, s in ranked)
    return by


def table(written, rows):
    return written([(i, v and [x if x is None else float(x) for x in v], 1, 2, 3, "x") for i, v in rows], SCHEMA, "embeddings")


def made(n, seed, width=16, clusters=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    return [(i, (centres[i % clusters] + 0.4 * rng.normal(size=width)).astype(np.float32).tolist()) for i in range(n)]


def awkward():
    nan, inf = float("nan"), float("inf")
    rows = made(300, 4, 6)
    rows += [(1000, [1.0] * 6)] * 3 + [(1001 + i, [1.0] * 6) for i in range(90)]
    rows += [(2000, None), (2020, [0.0] * 6), (2040, [1.0, None, 0, 0, 0, 0]), (2060, [nan, 1.0, 0, 0, 0, 0]), (2080, [inf, 1.0, 0, 0, 0, 0]), (2100, []), (2120, [1.0, 2.0]), (None, [9.0] * 6)]
    rows += [(3000, [50.0, -50, 3, 2, 1, 0]), (3020, [-1e-20] * 6), rows[0], rows[0], (-20, rows[3][1])]
    return rows


def test_query_on_awkward_rows(spark, written, tmp_path):
    """Searching all leaves is exact: ties, copies, repeated rows and unusable vectors included."""
    rows = awkward()
    docs = table(written, rows)
    found = lists(nearest.nearest(docs, recall=1.0, block_vectors=64, block_queries=8, leaf=16, trials=10_000))
    want = brute([(i, v) if i != 2120 else (i, None) for i, v in rows])
    assert sorted([(rows[q][0], [(i, round(s, 9)) for i, s in w]) for q, w in want.items()], key=str) == sorted(
        [(q, [(i, round(s, 9)) for _, i, s in w]) for (q, _), w in found.items()], key=str
    )
    again = op12_projection_forest(spark, str(tmp_path))
    assert again.columns == ["query_id", "rank", "vec_id", "score"]
    assert {r.query_id for r in again.collect()} == {q for q, _ in found}


@pytest.mark.parametrize("n", [0, 1, 2, 15])
def test_few_rows(written, n):
    found = lists(nearest.nearest(table(written, made(n, 1))))
    want = brute(made(n, 1))
    assert {q: [i for _, i, _ in w] for (q, _), w in found.items()} == {q: [i for i, _ in w] for q, w in want.items() if w}


def test_recall_on_given_vectors(spark):
    """On the given table, which has hardly any structure, and on clusters, where few leaves do."""
    folder = "/root/testdata/sf0.1"
    told = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet'").fetchall()
    want = brute(told)
    found = lists(op12_projection_forest(spark, folder).selectExpr("*", "query_id AS row_id"))
    hits = sum(len({i for i, _ in w} & {i for _, i, _ in found[told[q][0], told[q][0]]}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, w in want.items():
        score = dict(w)
        assert all(abs(score[i] - s) < 1e-12 for _, i, s in found[told[q][0], told[q][0]] if i in score)


def test_budget_follows_the_data():
    rows = np.array([v for _, v in made(4_000, 2, 16, 64)])
    flat = np.random.default_rng(3).normal(size=(4_000, 16))
    shares = []
    for plain in (rows, flat):
        lifted = nearest._lifted(plain, np.linalg.norm(plain, axis=1).max())
        forest = nearest.grow(lifted, 4, 6)
        asked = np.arange(100)
        budget = nearest.measured_budget(forest, lifted, asked, plain, 20, 0.95)
        shares.append(budget)
        own = forest.leaf_of(lifted) + np.arange(4) * forest.leaves
        scores = plain[asked] @ plain.T
        scores[asked, asked] = -np.inf
        near = np.argsort(-scores, axis=1)[:, :20]
        for b, enough in ((budget, True), (budget - 1, False)):
            reached = forest.search(nearest._queries(plain[asked], 17), b)
            recall = np.mean([[np.isin(own[j], reached[i]).any() for j in near[i]] for i in range(100)])
            assert (recall >= 0.95) == enough
    assert shares[0] < shares[1]


def test_the_queue_takes_the_best_leaf_of_all_trees():
    rng = np.random.default_rng(8)
    forest = nearest.grow(rng.normal(size=(500, 5)), 3, 4)
    queries = rng.normal(size=(20, 5))
    margins = forest.margins(queries)
    for i, order in enumerate(forest.search(queries, 48)):
        wrong = []
        for place in order:
            tree, node, total = place // 16, place % 16 + 16, 0.0
            while node > 1:
                m = margins[i, tree, node // 2]
                total += m * m if (node % 2 == 1) != (m > 0) else 0
                node //= 2
            wrong.append(total)
        assert len(set(order)) == 48 and (np.diff(wrong) >= -1e-12).all()
