"""Benchmark decontamination by q-gram filtering and banded alignment.

Texts are lower-cased and white space becomes one space. A window begins at every character of a
benchmark item. A window of ``w`` characters that lies in a document with at most ``e`` edits
shares at least ``w + 1 - q (e + 1)`` q-grams with it, all on diagonals at most ``e`` apart. Items
are cut into segments so that each window lies in one. The shared q-grams of a document and a
segment are counted in overlapping bands of diagonals, the bands with enough of them for one window
are retained, and a banded alignment of every window of the segment confirms them.

Items too short for shared q-grams to tell (under ``LEAST_CHARS``) are searched as they are: the whole
item without edits, where no word goes on beyond its ends.

The benchmark is a query set: it is cut into blocks of bounded size by a hash of the item, and each
block is compared with all documents in one scan that shuffles nothing.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import drop_rows, numbered, rows_of
from teamlines.llm.shingles import mix

Q = 10
WINDOW = 80  # characters, about thirteen words
EDITS = 0.075  # of a window's characters
LEAST_CHARS = 24  # shorter items allow no edits and are searched whole
STARTS = 81  # windows of one segment
SPAN = WINDOW + STARTS - 1  # characters of a segment
BAND = 8  # no smaller than the most edits; bands are twice as wide and overlap by half
BLOCK_CHARS = 1 << 20
CHUNK_CHARS = 1 << 21
MOST_HITS = 1 << 22
ALIGNED = 128  # segments aligned at a time
_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = 1 << 21  # a code that no character has


def normalise(text):
    """Lower case, one space for each run of white space, none at the ends."""
    return " ".join((text or "").lower().split())


def codes(text):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(values, q=Q):
    """A hash of the q codes that begin at each place."""
    n = len(values) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide, h = values.astype(np.uint64), np.zeros(n, np.uint64)
    for j in range(q):
        h = h * _BASE + wide[j : n + j]
    return mix(h)


def edit_budget(w, q=Q, share=EDITS):
    """The edits allowed in ``w`` characters, so few that the filter's count stays positive."""
    return max(0, min(int(share * w), w // q - 1, BAND))


class Index:
    """The q-grams of the segments of some items."""

    def __init__(self, items):
        self.items, self.segments, self.owner, short = [], [], [], {}
        for item_id, text in items:
            plain = normalise(text)
            if len(plain) < LEAST_CHARS:
                if any(c.isalnum() for c in plain):
                    short.setdefault(len(plain), {}).setdefault(plain, []).append(item_id)
                continue
            values = codes(plain)
            for start in range(0, max(1, len(values) - WINDOW + 1), STARTS):
                self.segments.append(values[start : start + SPAN])
                self.owner.append(len(self.items))
            self.items.append(item_id)
        self.owner = np.array(self.owner, np.int64)
        self.short = {n: (np.unique(np.concatenate([grams(codes(t), n) for t in told])), told) for n, told in short.items()}
        hashes = [grams(s) for s in self.segments]
        count = np.array([len(h) for h in hashes], np.int64)
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.segment_of = np.repeat(np.arange(len(count)), count)[order]
        self.place_of = (np.concatenate([np.arange(n) for n in count]) if hashes else np.empty(0, np.int64))[order]
        self.hashes, self.first, self.many = np.unique(flat[order], return_index=True, return_counts=True)
        self.length = np.array([len(s) for s in self.segments], np.int64)
        self.size = np.minimum(self.length, WINDOW)  # of a window
        self.budget = np.array([edit_budget(n) for n in self.size], np.int64)
        self.needed = self.size + 1 - Q * (self.budget + 1)
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True


def retained(index, values):
    """``(segment, band)`` of the bands of ``values`` that share enough q-grams with a segment for one of its windows."""
    h = grams(values)
    at = np.flatnonzero(index.maybe[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
    known = np.searchsorted(index.hashes, h[at])
    known[known == len(index.hashes)] = 0
    same = index.hashes[known] == h[at]
    at, known = at[same], known[same]
    many = index.many[known]
    bands = len(values) // BAND + 2 * (SPAN // BAND) + 4  # more than there are, so keys don't meet
    shift = SPAN // BAND + 2
    keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
    cuts = np.searchsorted(np.cumsum(many), np.arange(MOST_HITS, many.sum() + MOST_HITS, MOST_HITS))
    begin = 0
    for cut in cuts:
        part = slice(begin, min(cut + 1, len(at)))
        begin = part.stop
        n = many[part]
        listing = np.repeat(index.first[known[part]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        segment = index.segment_of[listing]
        diagonal = np.repeat(at[part], n) - index.place_of[listing]
        low = segment * bands + diagonal // BAND + shift
        k, c = np.unique(np.concatenate([low, low - 1]), return_counts=True)
        keys, where = np.unique(np.concatenate([keys, k]), return_inverse=True)
        sums = np.bincount(where, np.concatenate([sums, c]), len(keys)).astype(np.int64)
    segment, band = keys // bands, keys % bands - shift
    enough = sums >= index.needed[segment] if len(keys) else np.zeros(0, bool)
    return segment[enough], band[enough]


def aligned(index, values, segment, band):
    """Edits of each segment's windows (columns, by start) against its band of ``values``, and where the best alignments end.

    Columns without a window have more edits than any budget.
    """
    edits, ends = np.full((len(segment), STARTS), 127, np.int8), np.zeros((len(segment), STARTS), np.int64)
    width = 2 * BAND + 2 * BAND + 1
    padded = np.concatenate([np.full(width + SPAN, _NONE, np.uint32), values, np.full(width + 2 * SPAN, _NONE, np.uint32)])
    for length in np.unique(index.length[segment]):
        mine = np.flatnonzero(index.length[segment] == length)
        for begin in range(0, len(mine), ALIGNED):
            part = mine[begin : begin + ALIGNED]
            w, origin = min(WINDOW, int(length)), width + SPAN
            starts = int(length) - w + 1
            base = band[part] * BAND - BAND + origin
            text = padded[np.arange(length + width)[:, None] + base]
            pattern = np.stack([index.segments[x] for x in segment[part]], axis=1)
            # Cell (k, p) of a segment: its character p against the text at base + p + k.
            differ = np.stack([text[k : k + length] != pattern for k in range(width)]).view(np.int8)
            # Cell (k, s) after i steps is that of i characters of window s and the text up to base + s + i + k.
            cost = np.zeros((width, starts, len(part)), np.int8)  # at most w
            more = np.empty_like(cost[0])
            for i in range(w):
                ahead = cost[1:] + np.int8(1)
                cost += differ[:, i : i + starts]
                np.minimum(cost[:-1], ahead, out=cost[:-1])
                for k in range(1, width):
                    np.add(cost[k - 1], np.int8(1), out=more)
                    np.minimum(cost[k], more, out=cost[k])
            best = cost.argmin(axis=0)
            edits[part, :starts] = cost.min(axis=0).T
            ends[part, :starts] = (base - origin + w + np.arange(starts)[:, None] + best).T
    return edits, ends


def _word_bounds(values):
    """At each place between characters, ends included, whether no word goes on across it."""
    distinct, where = np.unique(values, return_inverse=True)
    word = np.array([c < _NONE and chr(c).isalnum() for c in distinct.tolist()], bool)[where]
    inside = np.zeros(len(values) + 1, bool)
    inside[1:-1] = word[1:] & word[:-1]
    return ~inside


def short_matches(index, plain, begins, values):
    """``(text number, item id, 1, 0, start, end)`` of the short items that stand whole in the texts of a chunk."""
    if not index.short:
        return []
    bound, begun, found = _word_bounds(values), np.array([b for _, b in begins]), {}
    for n, (hashes, told) in index.short.items():
        at = np.flatnonzero(bound[: len(bound) - n] & bound[n:])
        at = at[np.isin(grams(values, n)[at], hashes)]
        for place, k in zip(at.tolist(), (np.searchsorted(begun, at, "right") - 1).tolist()):
            i, start = begins[k][0], place - begins[k][1]
            for item in told.get(plain[i][start : start + n], ()):
                low, high = found.get((i, item), (start, start + n))
                found[i, item] = (min(low, start), max(high, start + n))
    return [(i, item, 1, 0, low, high) for (i, item), (low, high) in found.items()]


def _chunks(texts):
    """Runs of normalised texts with their codes, in a row, far enough apart that no band holds two."""
    gap = np.full(2 * SPAN, _NONE, np.uint32)
    held, begins, size = [], [], 0
    for i, text in enumerate(texts):
        values = codes(text)
        begins.append((i, size))
        held += [values, gap]
        size += len(values) + len(gap)
        if size >= CHUNK_CHARS:
            yield begins, np.concatenate(held)
            held, begins, size = [], [], 0
    if held:
        yield begins, np.concatenate(held)


def matches_in(index, texts):
    """``(text number, item id, windows, least edits, start, end)`` of each text and item that match."""
    plain = [normalise(t) for t in texts]
    out = []
    for begins, values in _chunks(plain):
        out += short_matches(index, plain, begins, values)
        if not index.segments:
            continue
        segment, band = retained(index, values)
        held = [np.empty((0, 4), np.int64)]
        for begin in range(0, len(segment), 8 * ALIGNED):
            part = segment[begin : begin + 8 * ALIGNED]
            edits, ends = aligned(index, values, part, band[begin : begin + 8 * ALIGNED])
            at, start = np.nonzero(edits <= index.budget[part][:, None])
            held.append(np.stack([part[at], start, edits[at, start], ends[at, start]], axis=1))
        segment, start, edits, ends = np.concatenate(held).T
        begun = np.array([b for _, b in begins])
        text = np.searchsorted(begun, ends - 1, "right") - 1
        owner, window = index.owner[segment], segment * STARTS + start
        order = np.lexsort((window, owner, text))
        text, owner, window, edits, ends, size = (x[order] for x in (text, owner, window, edits, ends, index.size[segment]))
        other = np.concatenate([[True], (text[1:] != text[:-1]) | (owner[1:] != owner[:-1])])[: len(text)]
        first = np.flatnonzero(other)
        if not len(first):
            continue
        other[1:] |= window[1:] != window[:-1]
        sizes = np.array([len(plain[i]) for i, _ in begins])
        high = np.minimum(ends - begun[text], sizes[text])  # an alignment may end in the gap by edits
        low = np.maximum(0, high - size)
        found = (np.add.reduceat(other.astype(np.int64), first), np.minimum.reduceat(edits, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first))
        out += [(begins[t][0], index.items[k], *row) for t, k, *row in zip(*(x.tolist() for x in (text[first], owner[first], *found)))]
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, text="text", doc_id="doc_id", item_id="item_id", item_text="text", block_chars=BLOCK_CHARS):
    """``row_id, doc_id, item_id, windows, edits, start, end``: one row per document and benchmark item found in it.

    ``windows`` of the item match, the best with ``edits``; ``start`` and ``end`` bound them in the
    normalised text. An item of under ``LEAST_CHARS`` is one window. Null and empty texts and items match
    nothing, nor do items without a letter or digit. Repeated documents and items each give their rows,
    in no order among equal matches; items that repeat in id and text count once. Very long texts are
    read whole. An empty table of either kind gives no rows. Only the named columns are read, under
    names of their own.
    """
    rows = rows_of(docs, doc_id=doc_id, text=text)
    items = benchmark.select(benchmark[item_id].alias("item_id"), benchmark[item_text].alias("text")).where("text IS NOT NULL").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    kinds = rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"row_id long, doc_id {kinds[0]}, item_id {kinds[1]}, windows long, edits long, start long, end long"
    if not blocks:
        return rows.sparkSession.createDataFrame([], schema)
    each = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = [_against(rows, [(r["item_id"], r["text"]) for r in each.where(F.col("block") == b).collect()], schema) for b in range(blocks)]
    return reduce(DataFrame.unionByName, found)


def _against(rows, items, schema):
    held = rows.sparkSession.sparkContext.broadcast(sorted(items, key=str))  # a block: bounded by block_chars and one item
    made = {}
    kind, named = pa.int64(), pa.string() if "item_id string" in schema else pa.int64()

    def search(batches):
        for batch in batches:
            if "index" not in made:
                made["index"] = Index(held.value)
            got = matches_in(made["index"], batch.column("text").to_pylist())
            at = pa.array([g[0] for g in got], kind)
            columns = [batch.column("row_id").take(at), batch.column("doc_id").take(at)]
            columns.append(pa.array([g[1] for g in got], named))
            columns += [pa.array([g[i] for g in got], kind) for i in range(2, 6)]
            yield pa.RecordBatch.from_arrays(columns, names=["row_id", "doc_id", "item_id", "windows", "edits", "start", "end"])

    return rows.select("row_id", "doc_id", "text").where("text IS NOT NULL").mapInArrow(search, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **settings):
    """``docs`` without the rows in which a benchmark item is found; all columns stay."""
    docs = numbered(docs)
    return drop_rows(docs, leaks(docs, benchmark, **settings))
