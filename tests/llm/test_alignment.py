"""Token alignment against all pairs of byte ranges."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from teamlines.llm import alignment
from teamlines.llm.queries import op13_tokenizer_alignment

SCHEMA = "doc_id long, text string, a_id int, row_id int, links string, best int"
ALPHABET = " etaoinshrdlu\n\t.,AZ09é漢字\U0001f600ß́<>|;"
SPECIAL = ["<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "▁", "\x00", "\r\n", "﻿", "​", "  "]


@pytest.fixture(scope="module")
def spelled():
    """Token ids and bytes of both tokenizers, from the libraries themselves."""
    import json

    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    codec = Tokenizer.from_file(path)
    codec.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = dict(zip(map(chr, visible), visible))
    code.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in visible)})
    entries = {i: t for t, i in json.load(open(path))["model"]["vocab"].items()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def both(text):
        a = [(i, bytes(code[c] for c in entries[i])) for i in codec.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in pieces.encode(text):
            name = pieces.id_to_piece(i)
            b.append((i, bytes.fromhex(name[3:5]) if pieces.is_byte(i) else name.replace("▁", " ").encode()))
        return a, b

    return both


def ranges(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(texts, both):
    """Rows of the query, without ids, from every pair of byte ranges."""
    linked, base = [], []
    for text in texts:
        a, b = both(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            linked.append([])
            base.append((0, 0, 0, 0, ""))
            continue
        ra, rb = ranges(a), ranges(b)
        links = [(i, j) for i, p, q in ra for j, r, s in rb if p < s and r < q]
        ends = sorted({q for *_, q in ra} & {s for *_, s in rb})
        groups, low = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, p, q in side if low <= p and q <= end) for side in (ra, rb)))
            low = end
        linked.append(links)
        base.append((len(a), len(b), len(ends), len(links), sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(p for links in linked for p in set(links))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return [(*row[:4], sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), row[4]) for row, links in zip(base, linked)]


def texts_of(seed, n=60):
    rng = random.Random(seed)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.choice([1, 5, 40, 200]))) for _ in range(n)]
    made += [" ".join(rng.choice(["the", "tokenizer", "Straße", "naïve", "unbelievable", "12345"]) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    made += [f"a{s}b" for s in SPECIAL] + SPECIAL + [None, "", "   ", "\n", "x" * 700, "same", "same", "same"]
    return made


@pytest.mark.parametrize("hot", [1, 30, 100_000])
def test_query_equals_all_pairs(spark, written, tmp_path, spelled, hot, monkeypatch):
    texts = texts_of(hot)
    ids = [None, *range(1, len(texts))]
    written([(i, t, 1, 2, "x", 3) for i, t in zip(ids, texts)], SCHEMA, "documents")
    monkeypatch.setattr(alignment.alignments, "__defaults__", (hot,))
    found = op13_tokenizer_alignment(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i, *row) for i, row in zip(ids, brute(texts, spelled))]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("lane", [1, 2, 7, 1 << 20])
def test_lanes_don_t_matter(lane):
    pair = alignment.pair_of(alignment.vocabulary_path(), alignment.pieces_path())
    coded = [pair.encode(t) for t in texts_of(5, 20)]
    told, pairs = alignment.merged(pair, coded, lane)
    plain, all_pairs = alignment.merged(pair, coded)
    assert told == plain and (pairs == all_pairs).all()


def test_groups_and_a_very_long_text(written, spelled):
    long = "Extraordinary étude, 漢字 and more. " * 20_000
    rows = written([(1, "naïve Straße", 1, 2, "x", 3), (2, long, 1, 2, "x", 3), (3, None, 1, 2, "x", 3)], SCHEMA)
    found = {r.doc_id: r for r in alignment.alignments(rows, groups=True).collect()}
    a, b = spelled("naïve Straße")
    parts = [g.split("|") for g in found[1].groups.split(";")]
    assert [int(x) for p, _ in parts for x in p.split(",")] == [i for i, _ in a]
    assert [int(x) for _, p in parts for x in p.split(",")] == [i for i, _ in b]
    assert found[3].groups == "" and found[2].n_links >= max(found[2].n_a, found[2].n_b) > 100_000
    assert sha256(found[2].groups.encode()).hexdigest() == found[2].groups_sha256


def test_empty(written):
    assert alignment.alignments(written([], SCHEMA)).count() == 0


def test_steps_are_few():
    """A batch takes as many steps as its longest lane, not its longest text."""
    ends = np.arange(1, 10_001)
    first = np.arange(0, 10_000, 100)
    links, cuts = alignment.lockstep(ends, ends, first, first + 100, first)
    assert links.shape == cuts.shape == (2, 10_000)
