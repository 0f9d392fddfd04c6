"""Merkle roots and proofs against a tree built in plain Python."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from teamlines.llm import merkle
from teamlines.llm.ordering import in_order, join_counted
from teamlines.llm.queries import op11_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, tree int, digest string, partition int, row_id string"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """Levels of nodes from ``nodes`` to the single one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        other = i ^ 1
        yield i % 2, level[other] if other < len(level) else None
        i //= 2


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {n: climb([leaf_of(r) for r in groups[n]]) for n in names}
    top = climb([trees[n][-1][0] for n in names])
    out = []
    for t, n in enumerate(names):
        for i, r in enumerate(groups[n]):
            proof = [*path(trees[n], i), *path(top, t)]
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            folded = leaf_of((*r[:3], r[3] + 1, r[4])) if bad else leaf_of(r)
            for odd, other in proof:
                folded = H(*([other, folded] if odd else [folded, other]) if other else [folded])
            told = H(*[o for _, o in proof if o])
            out.append((r[0], leaf_of(r), trees[n][-1][0], top[-1][0], told, folded, folded == top[-1][0]))
    return out


def table(written, rows):
    return written([(*r, 1, "x", 2, "y") for r in rows], SCHEMA, "documents")


def corpus(n, langs, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("abc"), rng.choice(langs), rng.randint(0, 99), f"text é {i}") for i in range(n)]
    rng.shuffle(rows)
    return rows


AWKWARD = [
    (None, None, None, None, None), (None, "s", None, 3, ""), (7, "", "", 0, ""), (7, None, "", None, None), (8, "a", "xx", 2147483647, "word " * 90_000),
    (8, "a", "en", 5, "same"), (8, "a", "en", 5, "same"), (8, "a", "en", 5, "other"), (-3, "-", "-", -1, "-"), (9, "1:a", "Zz", 1, "\U0001f600"),
]


@pytest.mark.parametrize(
    "rows",
    [
        corpus(2_500, ["en", "en", "en", "fr", "ü", None], 1) + AWKWARD, corpus(1, ["en"], 2), corpus(5, ["en"], 3), corpus(1_024, ["en"], 4), corpus(1_025, ["en"], 5),
        corpus(40, [str(i) for i in range(40)], 6), AWKWARD,
    ],
)
def test_query_equals_plain_tree(spark, written, tmp_path, rows):
    table(written, rows)
    found = op11_merkle_manifest(spark, str(tmp_path))
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found.collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_proofs_lead_to_the_root(written):
    """Each row's own proof, folded here, gives the root; large tables of ancestors are joined without broadcast alike."""
    rows = corpus(300, ["a", "b", None], 9) + AWKWARD
    docs = table(written, rows)
    seen = []
    for few in (10_000, 0):
        found = merkle.proofs(docs, few=few).collect()
        assert len({r.row_id for r in found}) == len(rows) and all(r.verified for r in found)
        for r in found:
            node = r.leaf
            for s in r.proof:
                node = H(s.digest, node) if s.sibling == "left" else H(node, s.digest) if s.sibling else H(node)
            assert node == r.root
        seen.append(sorted(map(str, found)))
    assert seen[0] == seen[1]


def test_empty_table(written):
    found = merkle.proofs(table(written, []))
    assert found.count() == 0 and "verified" in found.columns


def test_places_and_counted_join(spark):
    rows = spark.range(1_000).selectExpr("id", "id % 7 AS k", "(id * 37) % 1000 AS v").repartition(5)
    placed = in_order(rows, "k", "v").collect()
    assert [r.position for r in sorted(placed, key=lambda r: (r.k, r.v))] == list(range(1_000))
    names = rows.groupBy("k").count().selectExpr("k", "k * 10 AS name", "count AS n")
    for hot in (1, 3, 7, 1_000):
        assert sorted((r.id, r.name) for r in join_counted(rows, names, ["k"], "n", hot).collect()) == [(i, i % 7 * 10) for i in range(1_000)]
