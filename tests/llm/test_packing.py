"""Token files and packing against plain tokenization."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from teamlines.llm import packing, tokens

SCHEMA = "doc_id long, text string, source string, tokens int, queue string, block int, row_id int"


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def corpus():
    random.seed(5)
    rows = []
    for i in range(400):
        words = [random.choice(["the", "quick", "été", "naïve", "\n\n", "  ", "x1", "\U0001f600", "ß", "42"]) for _ in range(random.choice([0, 3, 40, 300]))]
        rows.append((i, " ".join(words), random.choice(["a", "a", "a", "b", "c", None])))
    rows += [(1000, None, "a"), (1001, "", None), (1002, "long text " * 4000, "b"), (None, "no id", "c"), rows[3], rows[3], (1003, "a<|endoftext|>b", "c")]
    return rows


def table(written, rows):
    return written([(*r, 1, "q", 2, 3) for r in rows], SCHEMA)


def test_ids_equal_the_tokenizers_library(codec):
    path = tokens.vocabulary_path()
    for _, text, _ in corpus():
        assert tokens.token_ids(text, path).tolist() == codec.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("window,targets,block_rows", [(1024, None, 50_000), (64, {"a": 1, "b": 1, "c": 1, None: 1}, 40), (100, {"b": 5.0}, 7), (1, None, 100)])
def test_every_id_lies_in_one_piece(written, codec, window, targets, block_rows):
    rows = corpus()
    if window == 1:
        rows = [r for r in rows if len(r[1] or "") < 300]
    found = packing.pack(table(written, rows), window, targets, block_rows=block_rows).collect()
    ids = {t: codec.encode(t or "", add_special_tokens=False).ids + [0] for _, t, _ in rows}
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_row[r.row_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32
    whole = []
    for parts in by_row.values():
        parts.sort(key=lambda r: r.start)
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        told = np.concatenate([np.frombuffer(p.ids, "<u2") for p in parts]).tolist()
        assert {p.doc_tokens for p in parts} == {len(told)}
        whole.append((str(parts[0].doc_id), str(parts[0].source), told))
    assert sorted(whole) == sorted((str(i), str(s), ids[t]) for i, t, s in rows)
    last = max(by_sequence)
    assert sorted(by_sequence) == list(range(last + 1))
    for n, parts in by_sequence.items():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        assert n == last or sum(p.length for p in parts) == window


def mixtures(found, window):
    """Of each full window, how far its sources' shares are from those of all tokens."""
    size, by = Counter(), defaultdict(Counter)
    for r in found:
        size[r.source] += r.length
        by[r.sequence_id][r.source] += r.length
    total = sum(size.values())
    return [sum(abs(by[n][s] / window - size[s] / total) for s in size) / 2 for n in range(total // window)]


def test_windows_of_the_given_table_follow_the_mixture(spark):
    """Registered settings: every window holds every source at its share, to a few tokens."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = packing.pack(docs).select("source", "length", "sequence_id").collect()
    away = mixtures(found, 1024)
    assert len({r.source for r in found}) == 20 and len(away) > 5_000
    assert np.mean(away) <= 0.02 and max(away) <= 0.05


def replayed(queues, window):
    """Plain deficit round-robin: ``(source, place)`` of all tokens in the order served. ``queues`` has tokens and quanta."""
    deficit, at, order, turn = dict.fromkeys(queues, 0), dict.fromkeys(queues, 0), [], 0
    while any(at[s] < n for s, (n, _) in queues.items()):
        turn += 1
        for s in sorted(queues):
            n, quantum = queues[s]
            deficit[s] += quantum
            whole = int(deficit[s])
            deficit[s] -= whole
            take = min(whole, n - at[s])
            order += [(s, at[s] + i) for i in range(take)]
            at[s] += take
    return order


@pytest.mark.parametrize("window,targets", [(128, {"a": Fraction(1, 2), "b": Fraction(1, 4), "c": Fraction(1, 4)}), (64, {"a": Fraction(1, 64), "b": Fraction(62, 64), "c": Fraction(1, 64)}), (8, {"a": Fraction(1, 16), "b": Fraction(14, 16), "c": Fraction(1, 16)})])
def test_windows_equal_a_replayed_round_robin(spark, window, targets):
    """Sources that run dry, and one with less than a token a window, included."""
    rng = random.Random(window)
    listed = [(i, i, "abc"[min(i % 9, 2)], rng.choice([1, 2, 9, 60])) for i in range(120)]
    docs = spark.createDataFrame(listed, "row_id long, doc_id long, queue string, tokens long")
    cut = packing.pieces(docs, window, {k: float(v) for k, v in targets.items()}, 32).collect()
    begin = {r.row_id: (r.queue, r.begin) for r in packing.queue_places(docs, 32).collect()}
    sizes = Counter()
    for _, _, s, n in listed:
        sizes[s] += n
    got = {}
    for r in cut:
        queue, first = begin[r.row_id]
        for i in range(r.length):
            got[r.sequence_id * window + r.offset + i] = (queue, first + r.start + i)
    want = replayed({s: (n, targets[s] * window) for s, n in sizes.items()}, window)
    assert [got[i] for i in range(len(got))] == want


def test_a_small_source_is_spread(written):
    """Nine tokens of one source lie a ninth of all windows apart."""
    rows = [(i, "some words here " * 40, "big") for i in range(400)] + [(1000 + i, "x y", "small") for i in range(3)]
    found = [r for r in packing.pack(table(written, rows)).collect()]
    total = sum(r.length for r in found)
    places = sorted(r.sequence_id * 1024 + r.offset + i for r in found if r.source == "small" for i in range(r.length))
    assert len(places) == 9
    for n, place in enumerate(places, 1):
        assert abs(place - n * total / 9) <= 2 * 1024


def test_empty(written):
    docs = table(written, [])
    assert packing.pack(docs).count() == 0
    assert tokens.token_counts(docs).count() == 0


@pytest.mark.parametrize("block", [7, 1000, 1 << 20])
def test_separator_scan_counts_tokens(written, codec, block):
    rows = corpus()
    found = tokens.token_counts(table(written, rows), block_tokens=block).collect()
    codec.encode_special_tokens = True  # a separator's string in a text is plain text here
    want = sorted((str(i), len(codec.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    codec.encode_special_tokens = False
    assert sorted((str(r.doc_id), r.tokens) for r in found) == want


def test_scan_of_a_file_without_last_separator(spark, tmp_path):
    name = str(tmp_path / "flat.bin")
    np.array([5, 5, 9, 9, 7, 7, 7, 9, 4, 4], "<u2").tofile(name)
    files = spark.createDataFrame([(name, 10), (str(tmp_path / "none.bin"), 0)], "file string, tokens long")
    for block in (1, 2, 3, 100):
        found = tokens.scan_separators(files, 9, block).orderBy("nth").collect()
        assert [(r.nth, r.start, r.tokens) for r in found] == [(0, 0, 2), (1, 3, 0), (2, 4, 3), (3, 8, 2)]
