"""Benchmark matches against an edit distance over all places."""

import random
from functools import lru_cache

import numpy as np
import pytest

from teamlines.llm import decontam

DOCS = "doc_id long, text string, item_id long, block int, row_id int, edits int"


def docs_of(written, rows):
    return written([(*r, 1, 2, 3, 4) for r in rows], DOCS, "docs")


def items_of(written, rows):
    return written([(*r, 1, 2) for r in rows], "item_id long, text string, doc_id int, block int", "items")


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnorstuvé") for _ in range(rng.randint(1, 9))) for _ in range(n))


def fewest_edits(pattern, text):
    """Edits of ``pattern`` against its best place in ``text``."""
    row = np.zeros(len(text) + 1, int)
    letters = np.array(list(text)) if text else np.empty(0, str)
    step = np.arange(len(text) + 1)
    for i, c in enumerate(pattern):
        diagonal = np.concatenate([[i + 1], row[:-1] + (letters != c)])
        row = np.minimum.accumulate(np.minimum(diagonal, row + 1) - step) + step
    return int(row.min())


def allowed(w):
    """Edits in ``w`` characters: 7.5 %, fewer where that leaves no run of ten between them."""
    return max(0, min(int(0.075 * w), w // 10 - 1))


def stands_whole(want, plain):
    """Whether ``want`` is in ``plain`` with no word going on beyond its ends."""
    at = plain.find(want)
    while at >= 0:
        edges = ((at - 1, at), (at + len(want) - 1, at + len(want)))
        if not any(0 <= i and j < len(plain) and plain[i].isalnum() and plain[j].isalnum() for i, j in edges):
            return True
        at = plain.find(want, at + 1)
    return False


@lru_cache(maxsize=8)
def runs_of(plain, run):
    """Where each stretch of ``run`` characters begins."""
    places = {}
    for t in range(len(plain) - run + 1):
        places.setdefault(plain[t : t + run], []).append(t)
    return places


def leaked(want, plain):
    """Whether 80 characters of ``want`` (all, if shorter) lie in ``plain`` with the edits allowed.

    Of ``e + 1`` disjoint parts of a window, ``e`` edits leave one as it is: only starts near a shared run of
    that length are aligned, with the text around it.
    """
    if len(want) < 24:
        return any(c.isalnum() for c in want) and stands_whole(want, plain)
    w = min(80, len(want))
    e = allowed(w)
    run = w // (e + 1)
    places, tried = runs_of(plain, run), set()
    for p in range(len(want) - run + 1):
        for t in places.get(want[p : p + run], ()):
            for s in range(max(0, p + run - w), min(p, len(want) - w) + 1):
                low = t - (p - s) - e
                if (s, low) not in tried:
                    tried.add((s, low))
                    if fewest_edits(want[s : s + w], plain[max(0, low) : low + w + 2 * e]) <= e:
                        return True
    return False


def brute(rows, items):
    wanted = [(i, decontam.normalise(t)) for i, t in items]
    plain = [decontam.normalise(t) for _, t in rows]
    return {(n, i) for n, text in enumerate(plain) for i, want in wanted if want and leaked(want, text)}


def test_short_cut_of_the_brute_force():
    """The shared run loses nothing against all starts at all places."""
    rng = random.Random(3)
    for trial in range(60):
        item = decontam.normalise(prose(30, trial))[: rng.choice([24, 40, 79, 80, 95])].strip().ljust(24, "x")
        part = item[rng.randint(0, max(0, len(item) - 80)) :][:80]
        text = decontam.normalise(prose(6, trial + 50) + damaged(part, rng.randint(0, 9), rng) + prose(6, trial + 90))
        w = min(80, len(item))
        plain = any(fewest_edits(item[s : s + w], text) <= allowed(w) for s in range(len(item) - w + 1))
        assert leaked(item, text) == plain


def damaged(text, edits, rng):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.4:
            chars[at] = "z"
        elif kind < 0.7:
            del chars[at]
        else:
            chars.insert(at, "q")
    return "".join(chars)


def corpus():
    rng = random.Random(8)
    items = [(i, prose(rng.randint(6, 60), i)) for i in range(25)]
    items += [(30, "short"), (31, ""), (32, None), (33, "x" * 24), (34, items[0][1]), (35, "ab " * 200), (36, "short"), (37, "?!"), (38, "q"), (39, "twenty-one characters"), (0, items[0][1])]
    rows = []
    for i in range(80):
        text = prose(rng.randint(0, 150), 1000 + i)
        if i % 2:
            item = items[rng.randrange(25)][1]
            part = item if i % 4 == 1 else item[: rng.randint(20, len(item))]
            part = damaged(part, rng.randint(0, max(1, len(part) // 9)), rng)
            at = rng.randint(0, len(text))
            text = text[:at] + (" " if i % 3 else "") + part.upper() + "\n\t " + text[at:]
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, "Short "), (203, "a short one"), (204, "y" * 10 + "x" * 40), (205, "AB\n" * 100), rows[1], rows[1]]
    rows += [(208, "a short, SHORT story"), (209, "shorter"), (210, "in\tshort."), (211, "x" * 24 + "-short")]
    rows += [(None, "pre " + items[3][1]), (206, prose(2_500, 5) + items[4][1][:100] + prose(100, 6)), (207, items[5][1])]
    return rows, items


def test_matches_equal_all_places():
    rows, items = corpus()
    index = decontam.Index(sorted({x for x in items if x[1] is not None}, key=str))
    got = decontam.matches_in(index, [t for _, t in rows])
    assert {(n, i) for n, i, *_ in got} == brute(rows, items)
    for n, _, _, _, start, end in got:
        assert 0 <= start < end <= len(decontam.normalise(rows[n][1]))


@pytest.mark.parametrize("block_chars", [1 << 20, 900])
def test_query_and_filter(written, block_chars):
    rows, items = corpus()
    docs, benchmark = docs_of(written, rows), items_of(written, items)
    found = decontam.leaks(docs, benchmark, block_chars=block_chars).collect()
    want = brute(rows, items)
    assert sorted(str((r.doc_id, r.item_id)) for r in found) == sorted(str((rows[n][0], i)) for n, i in want)
    kept = decontam.drop_leaks(docs, benchmark, block_chars=block_chars)
    assert kept.columns == docs.columns
    leaked = {n for n, _ in want}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for n, (d, _) in enumerate(rows) if n not in leaked)


def test_empty_tables(written):
    rows, items = corpus()
    assert decontam.leaks(docs_of(written, []), items_of(written, items)).count() == 0
    assert decontam.drop_leaks(written(rows, "doc_id long, text string", "all"), written([], "item_id long, text string", "none")).count() == len(rows)


def test_filter_keeps_its_promise():
    """A window with as many edits as allowed still shares the q-grams asked for, in one band."""
    rng = random.Random(1)
    for trial in range(300):
        w = rng.choice([24, 30, 41, 60, 80])
        item = prose(60, trial)[:w].strip().ljust(w, "x")
        index = decontam.Index([(1, item)])
        w = len(decontam.normalise(item))
        text = damaged(item, rng.randint(0, decontam.edit_budget(w)), rng)
        values = decontam.codes(prose(20, trial + 9) + text + prose(20, trial + 99))
        window, band = decontam.retained(index, values)
        edits, _ = decontam.aligned(index, values, window, band)
        assert len(edits) and edits.min() <= decontam.edit_budget(w)


@pytest.mark.parametrize("length", [80, 85, 99, 118])
def test_run_from_any_start_of_an_item(length):
    """Any 80 characters of an item are enough, wherever in the item they begin and with as many edits as allowed."""
    item = decontam.normalise(prose(60, 77))[:390]
    index = decontam.Index([(1, item)])
    rng = random.Random(length)
    texts, damages = [], []
    for start in range(len(item) - length + 1):
        run = item[start : start + length]
        texts.append("Ø" * 50 + run + "ø" * 50)
        damages.append("Ø" * 50 + damaged(run[:80], decontam.edit_budget(80), rng) + "ø" * 50)
    assert {n for n, *_ in decontam.matches_in(index, texts)} == set(range(len(texts)))
    near = {n for n, t in enumerate(damages) if fewest_edits(item[n : n + 80], decontam.normalise(t)) <= decontam.edit_budget(80)}
    assert near and near <= {n for n, *_ in decontam.matches_in(index, damages)}
    assert not decontam.matches_in(index, ["Ø" * 50 + item[s : s + 73] + "ø" * 50 for s in range(0, 300, 7)])


def test_windows_counted_once():
    item = decontam.normalise(prose(90, 78))[:300].strip()
    (found,) = decontam.matches_in(decontam.Index([(1, item)]), ["Ø" * 40 + item])
    assert found[2:] == (len(item) - 80 + 1, 0, 40, 40 + len(item))


@pytest.mark.parametrize("item", ["a", "42", "forty two", "What is 6 x 7?", "twenty-one characters", "x" * 23])
def test_short_items_stand_whole(item):
    index = decontam.Index([(1, item)])
    plain = decontam.normalise(item)
    inside = [f"Ø {item}", f"{item.upper()}\n\tø", f"ø ({item}) ø", item, f"ø {item}{item} {item}"]
    outside = [f"ø{item}" if plain[0].isalnum() else "ø", "", f"Ø {plain[:-1]}~" if len(plain) > 1 else "ø", None]
    assert {n for n, *_ in decontam.matches_in(index, inside + outside)} == set(range(5))
    (found,) = decontam.matches_in(index, [f"Ø {item}, {item}"])
    assert found == (0, 1, 1, 0, 2, 4 + 2 * len(plain))
