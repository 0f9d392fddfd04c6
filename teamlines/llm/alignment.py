"""Alignment of two tokenizers' tokens over the same bytes by lockstep merging.

Tokenizer A is a byte-level BPE and B a piece BPE; both token sequences of a text spell the same
bytes. Every lane of a batch holds a pointer into A and one into B, and one NumPy vector of each
advances all lanes at once: a step emits the lanes' token pairs as links, emits a cut where both
tokens end at one byte, and moves the pointers of the tokens that end first. Lanes that are done are
compacted away. A long document is dealt to several lanes of ``LANE`` A tokens, each with the B token
over its first byte, so a batch takes few steps however long its texts are.

How many documents hold an id pair linked is counted over the whole corpus. Batches count their own
documents first, so what is shuffled is a row per batch and pair. The documents then take up the
counts by pair: pairs of so large a share that there can be only few are broadcast, the others shuffled.
"""

from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from teamlines.llm.common import rows_of
from teamlines.llm.ordering import join_counted
from teamlines.llm.tokens import encoder, vocabulary_path
from teamlines.session import materialized

PIECES = "piece_bpe_32k.model"
LANE = 256  # A tokens
CHUNK_BYTES = 1 << 20  # of texts merged at a time, or one text
HOT_PAIRS = 100_000


def pieces_path(name=PIECES):
    """Where the installed piece model lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_bytes(piece):
    """What a piece spells: U+2581 is a space, ``<0xHH>`` one byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Pair:
    """Both tokenizers, the bytes of their tokens, and the tokens as written in a group."""

    def __init__(self, path_a, path_b):
        import sentencepiece

        self.a, self.b = encoder(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.n_a, self.n_b = self.a.n_vocab, self.b.get_piece_size()
        spelled_a = [self.a.decode_single_token_bytes(i) for i in range(self.n_a)]
        self.spelled_b = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.n_b)]
        self.size_a = np.array([len(x) for x in spelled_a], np.int64)
        self.size_b = np.array([len(x) for x in self.spelled_b], np.int64)
        # by tokenizer and by whether a token is its group's last
        self.written = [b"%d%c" % (i, end) for n, ends in ((self.n_a, b",|"), (self.n_b, b",;")) for end in ends for i in range(n)]

    def encode(self, text):
        """Ids of both, or None where they don't spell the text."""
        if not text:
            return None
        whole = " " + text
        raw = whole.encode()
        a, b = self.a.encode_ordinary(whole), self.b.encode(text)
        if self.a.decode_bytes(a) != raw or b"".join(map(self.spelled_b.__getitem__, b)) != raw:
            return None
        return a, b


@cache
def pair_of(path_a, path_b):
    """Once a process."""
    return Pair(path_a, path_b)


def lockstep(ends_a, ends_b, first, stop, at_b):
    """``(links, cuts)``: token places ``(a, b)`` of all overlapping pairs, and of those that end at one byte.

    A lane merges A tokens ``first`` to ``stop`` (exclusive), from B token ``at_b`` on. Ends are bytes
    counted over all texts. Each pair is linked by the lane that has its A token.
    """
    ia, ib, stop = first.copy(), at_b.copy(), stop.copy()
    links, cuts = [], []
    alive = ia < stop
    while True:
        if not alive.all():
            ia, ib, stop = ia[alive], ib[alive], stop[alive]
        if not len(ia):
            break
        links.append(np.stack([ia, ib]))
        ea, eb = ends_a[ia], ends_b[ib]
        both = ea == eb
        cuts.append(np.stack([ia[both], ib[both]]))
        ia = ia + (ea <= eb)
        ib = ib + (eb <= ea)
        alive = ia < stop
    empty = np.empty((2, 0), np.int64)
    return np.concatenate(links or [empty], axis=1), np.concatenate(cuts or [empty], axis=1)


def lanes(counts_a, ends_a, sizes_a, ends_b, lane=LANE):
    """``first, stop, at_b`` of the lanes of texts with so many A tokens."""
    begins = np.concatenate([[0], np.cumsum(counts_a)])
    many = -(-counts_a // lane)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    first = np.repeat(begins[:-1], many) + nth * lane
    stop = np.minimum(first + lane, np.repeat(begins[1:], many))
    return first, stop, np.searchsorted(ends_b, ends_a[first] - sizes_a[first], "right")


def merged(pair: Pair, coded, lane=LANE, groups=False):
    """Per text ``(n_a, n_b, n_groups, n_links, digest or groups)``, and ``text, a, b, links`` of the distinct id pairs of each text, in order."""
    known = [i for i, c in enumerate(coded) if c]
    told = [(0, 0, 0, 0, "")] * len(coded)
    if not known:
        return told, np.empty((4, 0), np.int64)
    counts_a = np.array([len(coded[i][0]) for i in known], np.int64)
    counts_b = np.array([len(coded[i][1]) for i in known], np.int64)
    ids_a = np.fromiter((x for i in known for x in coded[i][0]), np.int64, counts_a.sum())
    ids_b = np.fromiter((x for i in known for x in coded[i][1]), np.int64, counts_b.sum())
    sizes_a = pair.size_a[ids_a]
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(pair.size_b[ids_b])
    links, cuts = lockstep(ends_a, ends_b, *lanes(counts_a, ends_a, sizes_a, ends_b, lane))
    begin_a = np.concatenate([[0], np.cumsum(counts_a)])
    cuts = cuts[:, np.argsort(cuts[0])]
    owner = np.searchsorted(begin_a, links[0], "right") - 1
    n_links = np.bincount(owner, minlength=len(known))
    n_groups = np.bincount(np.searchsorted(begin_a, cuts[0], "right") - 1, minlength=len(known))
    key = (owner * pair.n_a + ids_a[links[0]]) * pair.n_b + ids_b[links[1]]
    keys, times = np.unique(key, return_counts=True)
    pairs = np.stack([np.array(known)[keys // (pair.n_a * pair.n_b)], keys // pair.n_b % pair.n_a, keys % pair.n_b, times])
    # All groups of all texts in a row: a group's A tokens, then its B tokens.
    up_a, up_b = cuts + 1
    low_a, low_b = (np.concatenate([[0], x[:-1]]) for x in (up_a, up_b))
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[cuts[0]], last_b[cuts[1]] = True, True
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + np.repeat(low_b, up_a - low_a)] = ids_a + last_a * pair.n_a
    order[np.arange(len(ids_b)) + np.repeat(up_a, up_b - low_b)] = ids_b + last_b * pair.n_b + 2 * pair.n_a
    begins = np.concatenate([[0], np.cumsum(counts_a + counts_b)])
    for k, i in enumerate(known):
        written = b"".join(map(pair.written.__getitem__, order[begins[k] : begins[k + 1]].tolist()))[:-1]
        name = written.decode() if groups else sha256(written).hexdigest()
        told[i] = (int(counts_a[k]), int(counts_b[k]), int(n_groups[k]), int(n_links[k]), name)
    return told, pairs


def _chunks(texts):
    """``(begin, end)`` of neighbouring texts of bounded size, or one text."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "") + 64
        if size >= CHUNK_BYTES:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _lists(offsets, values, kind):
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def align(docs: DataFrame, path_a=None, path_b=None, text="text", doc_id="doc_id", groups=False, lane=LANE):
    """Written once: ``row_id, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, a_ids, b_ids, links`` of every row.

    The three lists hold a row's distinct linked id pairs and how often each is linked. With ``groups`` a
    column of that name holds the groups themselves. The first row of each run of texts merged together
    also carries that run's document counts, ``run_a, run_b, run_n``.
    """
    path_a, path_b = path_a or vocabulary_path(), path_b or pieces_path()
    rows = rows_of(docs, doc_id=doc_id, text=text)

    def merge(batches):
        pair = pair_of(path_a, path_b)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in _chunks(texts):
                told, (owner, a, b, times) = merged(pair, [pair.encode(t) for t in texts[begin:end]], lane, groups)
                n = end - begin
                offsets = np.searchsorted(owner, np.arange(n + 1))
                shared, documents = np.unique(a * pair.n_b + b, return_counts=True)
                run = np.full(n + 1, len(shared))
                run[0] = 0
                columns = [batch.column("row_id").slice(begin, n), batch.column("doc_id").slice(begin, n)]
                columns += [pa.array([t[i] for t in told], pa.int64()) for i in range(4)]
                names = [t[4] for t in told]
                columns.append(pa.array([sha256(s.encode()).hexdigest() if s else "" for s in names] if groups else names, pa.string()))
                columns += [_lists(offsets, x, pa.int32()) for x in (a, b, times)]
                columns += [_lists(run, x, pa.int32()) for x in (shared // pair.n_b, shared % pair.n_b, documents)]
                if groups:
                    columns.append(pa.array(names, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=fields)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row_id long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a_ids array<int>, b_ids array<int>, links array<int>, run_a array<int>, run_b array<int>, run_n array<int>"
    schema += ", groups string" if groups else ""
    fields = [c.split()[0] for c in schema.split(", ")]
    return materialized(rows.mapInArrow(merge, schema))


def pair_counts(aligned: DataFrame):
    """``a_id, b_id, documents, best``: how many documents hold each id pair linked, and whether no pair of its A id has more."""
    runs = aligned.where(F.size("run_n") > 0).select(F.explode(F.arrays_zip("run_a", "run_b", "run_n")).alias("p"))
    counted = runs.groupBy(F.col("p.run_a").alias("a_id"), F.col("p.run_b").alias("b_id")).agg(F.sum("p.run_n").alias("documents"))
    most = F.max("documents").over(Window.partitionBy("a_id"))  # no A id has more pairs than B has pieces
    return counted.withColumn("best", F.col("documents") == most)


def alignments(docs: DataFrame, hot=HOT_PAIRS, **settings):
    """``align`` with each row's ``n_best`` and ``count_sum`` from the corpus-wide counts of its linked pairs.

    Texts that are null or empty, or that either tokenizer doesn't spell back byte by byte (B reads
    U+2581 as a space), have no tokens: zeros, and an empty ``groups_sha256``. White space alone is a text.
    Strings of special tokens in a text are plain text. Very long texts are merged whole. Repeated rows
    are documents of their own and give equal results. An empty table gives no rows. Only the named
    columns are read, under names of their own.
    """
    found = align(docs, **settings)
    counts = materialized(pair_counts(found))
    held = found.select("row_id", F.explode(F.arrays_zip("a_ids", "b_ids", "links")).alias("p"))
    held = held.select("row_id", F.col("p.a_ids").alias("a_id"), F.col("p.b_ids").alias("b_id"), F.col("p.links").alias("links"))
    known = counts.select("a_id", "b_id", "best", F.col("documents").alias("n"), F.col("documents").alias("count"))
    met = join_counted(held, known, ["a_id", "b_id"], "n", hot)
    sums = met.groupBy("row_id").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("count")).alias("count_sum"))
    whole = found.drop("run_a", "run_b", "run_n").join(sums, "row_id", "left")
    return whole.fillna(0, ["n_best", "count_sum"])
