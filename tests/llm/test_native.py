"""Exact deduplication, secret scans and line removal on small awkward tables."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from teamlines.llm import exact, lines, secrets

AWKWARD = [
    (5, "a  b", "x"), (3, "a\tb", "y"), (4, "a b", "x"), (3, "a\tb", "y"), (None, "a b", None), (None, None, None),
    (9, "", "x"), (8, None, "z"), (7, "A b", "x"), (6, " a b", "x"), (10, "w " * 200_000, "x"), (11, "a b", "x"),
]
SCHEMA = "doc_id long, text string, source string, row_id string, content string, digest int, keep_id int, kind string, place int"


def table(written, rows):
    return written([(*r, "s", "t", 1, 2, "k", 3) for r in rows], SCHEMA)


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return groups


@pytest.mark.parametrize("digest", [exact.sha256, lambda c: F.pmod(F.crc32(c), F.lit(2)), lambda c: F.lit(1)])
def test_groups_with_and_without_colliding_digests(written, digest):
    docs = table(written, AWKWARD)
    found = exact.duplicate_groups(docs, salts=3, digest=digest).collect()
    assert len(found) == len(AWKWARD)
    for content, ids in expected_groups(AWKWARD).items():
        sha = hashlib.sha256(content.encode()).hexdigest()
        mine = [r for r in found if r.text_sha256 == sha]
        first = min((i for i in ids if i is not None), default=None)
        assert sorted(str(r.doc_id) for r in mine) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in mine} == {(first, len(ids))}
        assert [r.doc_id for r in mine if r.kept] == [first]


def test_dropping_keeps_one_row_and_all_columns(written):
    docs = table(written, AWKWARD)
    kept = exact.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(expected_groups(AWKWARD))


def test_empty_tables(written):
    docs = table(written, [])
    assert exact.duplicate_groups(docs).count() == 0
    assert lines.remove_boilerplate(docs).count() == 0
    assert secrets.find_secrets(docs).count() == 0


def brute_spans(text):
    rules = [
        ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
        ("access", "AKIA[A-Z0-9]+", 0, 18),
        ("hex", "[0-9a-f]+", 0, 16),
    ]
    found = []
    for place, (kind, pattern, group, least) in enumerate(rules):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def test_secrets_equal_a_plain_scan(written):
    random.seed(3)
    bits = ["password", "PassWd", "token", "api_key", "APIKEY", "secret", "toKen", "=", ":", " ", "  ", '"', "'", "AKIA",
            "ABCDEFGHIJKL0123", "0123456789abcdef", "deadbeef", "longvalue_1234", "short", "é", "\U0001f600", "\n", "AKIAAKIA"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "token=secret=abcdefghijklmnop", "token: secret: abcdefghijklmnop", "f" * 100_000, "AKIA" + "B" * 13, "AKIA" + "B" * 14]
    texts += ["password=abcdefghijkl " * 3000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s"), (None, "token=abcdefghijklmn", None)]
    docs = table(written, rows)
    found = secrets.find_secrets(docs, rules=secrets.BASE).collect()
    got = sorted((str(r.doc_id), r.spans, r.base_sha256) for r in found)
    spans = [(str(i), brute_spans(t)) for i, t, _ in rows]
    assert got == sorted((i, s, hashlib.sha256(s.encode()).hexdigest()) for i, s in spans)
    more = {str(r.doc_id): r.base_sha256 for r in secrets.find_secrets(docs).collect()}
    assert more == {i: hashlib.sha256(s.encode()).hexdigest() for i, s in spans}


def test_trigram_queries():
    q = secrets.trigram_query
    assert q("hello") == {frozenset({"hel", "ell", "llo"})}
    assert q("a.c") == secrets.ANY and q("[0-9]+") == secrets.ANY and q("(abc)?") == secrets.ANY
    assert q("abc|bcd") == {frozenset({"abc"}), frozenset({"bcd"})}
    assert q("(abc)+x*def") == {frozenset({"abc", "def"})}
    assert q("ab[cd]e") == {frozenset({"abc", "bce"}), frozenset({"abd", "bde"})}


def brute_lines(rows, least):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" ") and site is not None:
                sites[line.strip(" ")].add(site)
    out = []
    for doc_id, text, _ in rows:
        every = (text or "").split("\n")
        stay = [x for x in every if len(sites[x.strip(" ")]) < least]
        out.append((str(doc_id), len(every), len(every) - len(stay), "\n".join(stay)))
    return sorted(out)


@pytest.mark.parametrize("least", [1, 3, 40, 300])
def test_lines_equal_exact_counts(written, least):
    random.seed(4)
    rows = [(i, "\n".join(random.choices(["", " foot", "foot ", "common", f"own {i}", f"some {i % 5}", "été"], k=random.randint(0, 9))), f"s{i % 320}") for i in range(900)]
    rows += [(1, None, "s"), (2, "", None), (None, "common\n\ncommon", None), (3, "common\n" * 5000, "q"), rows[5], rows[5]]
    found = lines.remove_boilerplate(table(written, rows), min_sites=least)
    got = sorted((str(r.doc_id), r.n_lines, r.n_removed, r.clean_text) for r in found.collect())
    assert got == brute_lines(rows, least)
