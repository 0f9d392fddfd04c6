"""Near duplicates against all pairs in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from teamlines.llm import neardup, shingles

SCHEMA = "doc_id long, text string, row_id string, n int, label int, digest string, a int, b int, value int"


def table(written, rows):
    return written([(*r, "x", 1, 2, "d", 3, 4, 5) for r in rows], SCHEMA)


def brute_set(text, width):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not data:
        return frozenset()
    if len(data) < width:
        return frozenset([tuple(data)])
    return frozenset(tuple(data[i : i + width]) for i in range(len(data) - width + 1))


def brute(rows, width, percent):
    sets = [brute_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    low = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(str((d, len(s), low[find(i)] if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def words(n, tag=""):
    return [f"{tag}{random.choice('abcdefgh')}{random.randint(0, 10**6)}" for _ in range(n)]


def edited(base, share):
    return [w if random.random() > share else f"e{random.randint(0, 10**9)}" for w in base]


def corpus():
    random.seed(11)
    rows = []
    passage = words(60)
    hot = words(120)
    for _ in range(60):  # near copies of one text, some links weaker than the threshold
        rows.append(edited(hot, random.choice([0.01, 0.02, 0.05])))
    for _ in range(60):  # unrelated texts that share most of their words
        rows.append(passage + words(20))
    for _ in range(40):
        rows.append(passage[:40] + words(80) + passage[40:])
    chain = words(150)
    for i in range(12):  # a chain: neighbours are linked, ends are not
        rows.append(chain[i * 6 : i * 6 + 100])
    for _ in range(30):
        rows.append(words(random.randint(1, 30)))
    for _ in range(5):
        rows.append(words(2000))
    rows += [rows[3], rows[3], rows[70], rows[-1][:-60]]
    texts = [" ".join(r) for r in rows]
    texts += ["", None, " \n ", "One", "one", "ONE two", "one two", "É a b c d", "é a b c d", texts[0].upper(), texts[1].replace(" ", "\t\n")]
    out = [(i, t) for i, t in enumerate(texts)]
    random.shuffle(out)
    return out + [(out[0][0], out[0][1]), (out[0][0], out[0][1]), (None, texts[5]), (None, None), (None, " ".join(words(9)))]


@pytest.mark.parametrize("width,k,short", [(4, 32, 32), (5, 12, 2)])
def test_components_equal_all_pairs(spark, written, width, k, short):
    rows = corpus()
    found = neardup.near_duplicates(table(written, rows), width=width, k=k, short=short).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in found) == brute(rows, width, 80)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in found)
    kept = [r for r in found if r.row_id == r.keep_row]
    assert len(kept) == len({r.keep_row for r in found})


def test_dropping(written):
    docs = table(written, corpus())
    kept = neardup.drop_near_duplicates(docs, width=5)
    assert kept.columns == docs.columns
    whole = brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    told = [eval(x) for x in whole]  # noqa: S307
    full = {c for _, n, c in told if n and c is not None}
    rows = kept.where(F.col("doc_id").isNotNull() & (F.trim(F.translate(F.coalesce("text", F.lit("")), "\n", "")) != "")).collect()
    assert sorted(r.doc_id for r in rows) == sorted(full)


def test_empty(written):
    docs = table(written, [])
    assert neardup.near_duplicates(docs).count() == 0
    assert neardup.drop_near_duplicates(docs).count() == 0
    assert neardup.near_duplicates(table_of_blanks(written)).where("kept").count() == 2


def table_of_blanks(written):
    return written([(1, None, *"xx"), (2, "  ", *"xx")], "doc_id long, text string, p string, q string", "blank")


def test_shingle_sets_of_long_and_short_texts():
    random.seed(2)
    texts = [None, "", "a", "A B", "a b c d", "x " * 300_000, " ".join(words(3000)), "\x0b\x0c a\r\nb", "é b c d e"]
    for width in (1, 4, 5):
        together = [len(s) for s in shingles.shingle_sets(texts, width)]
        assert together == [len(brute_set(t, width)) for t in texts]
        assert together == [len(shingles.shingle_set(t, width)) for t in texts]


def test_bound_of_shared_values():
    assert neardup.least_shared(32, 80) <= 12 and neardup.least_shared(128, 80) > 60 and neardup.least_shared(1, 80) == 1
