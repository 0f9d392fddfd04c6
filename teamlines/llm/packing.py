"""Mixture-controlled packing by deficit round-robin over one token queue per source.

Each source is a queue of its documents in a shuffled order that only the ids fix. A round fills one
window: in every round a source's deficit grows by its quantum, its target share of a window, and it
serves as many whole tokens of its queue as the deficit covers; the fraction that is left is carried
to the next round, across windows, blocks and partitions. A queue that never waits has served
``floor(round * quantum)`` tokens after a round. So the round of every token, deficits included, follows
from its place in its queue, and no task has to replay the rounds before. A source with less than a
token a window is served where its share adds up to one. A queue that is empty drops out and the
others fill the windows.

The order of all tokens is (round, source, place in queue); windows are cut from it every
``window`` tokens, so all are full but the last. Whole tokens make a round a little shorter than a
window, by less than a token a source in all, however many rounds there are. Queue places and window
places are prefix sums in two levels: within blocks of bounded size, and over the block totals.
"""

import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from teamlines.llm.common import rows_of
from teamlines.llm.tokens import encoder, vocabulary_path
from teamlines.session import materialized

WINDOW = 1024
SEPARATOR = 0  # fixed value: the id after each document
BLOCK_ROWS = 1_024
FANOUT = 1024  # blocks whose totals one task adds up


def token_table(docs: DataFrame, path=None, text="text", doc_id="doc_id", source="source"):
    """``row_id, doc_id, source, tokens, ids`` of every row, written once: 16-bit ids, the separator at the end."""
    path = path or vocabulary_path()
    rows = rows_of(docs, doc_id=doc_id, source=source, text=text)

    def encode(batches):
        codec = encoder(path)
        for batch in batches:
            data, counts = [], []
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text or "", allowed_special="all")
                ids.append(SEPARATOR)
                counts.append(len(ids))
                data.append(np.array(ids, "<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), batch.column("source"), pa.array(counts, pa.int64()), pa.array(data, pa.binary())],
                names=["row_id", "doc_id", "source", "tokens", "ids"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return materialized(rows.mapInArrow(encode, f"row_id long, doc_id {kind}, source string, tokens long, ids binary"))


def _offsets(totals: DataFrame, keys, block, amount):
    """``keys, block, before``: sums of ``amount`` over all earlier blocks of the same ``keys``.

    No task gets more than ``FANOUT`` blocks of a key, or the totals of that many blocks.
    """
    group = totals.withColumn("above", F.expr(f"{block} div {FANOUT}"))
    inner = Window.partitionBy(*keys, "above").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    part = group.withColumn("inside", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    upper = group.groupBy(*keys, "above").agg(F.sum(amount).alias("whole"))
    outer = Window.partitionBy(*keys or [F.lit(0)]).orderBy("above").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.withColumn("earlier", F.coalesce(F.sum("whole").over(outer), F.lit(0))).drop("whole")
    told = part.join(upper, [*keys, "above"])
    return told.select(*keys, block, (F.col("inside") + F.col("earlier")).alias("before"))


def queue_places(documents: DataFrame, block_rows=BLOCK_ROWS):
    """``documents`` (``row_id, doc_id, queue, tokens``) with ``begin``, the tokens before each in its queue."""
    hashed = documents.withColumn("mixed", F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("row_id"))))
    rows = documents.count()
    bits = max(0, ceil(rows / block_rows) - 1).bit_length()
    # Blocks are ranges of the hash, so the order doesn't depend on how many there are.
    hashed = hashed.withColumn("block", F.shiftright("mixed", 64 - bits) if bits else F.lit(0).cast("long"))
    hashed = materialized(hashed)
    order = Window.partitionBy("queue", "block").orderBy("mixed", "doc_id", "tokens", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = hashed.withColumn("inside", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    totals = hashed.groupBy("queue", "block").agg(F.sum("tokens").alias("amount"))
    first = -(1 << (bits - 1)) if bits else 0  # block numbers are signed; _offsets counts from 0
    numbered = totals.withColumn("block", F.col("block") - first)
    before = _offsets(numbered, ["queue"], "block", "amount").withColumn("block", F.col("block") + first)
    return placed.join(before, ["queue", "block"]).select("row_id", "queue", "tokens", (F.col("inside") + F.col("before")).alias("begin"))


def quanta(documents: DataFrame, window=WINDOW, targets=None):
    """``queue, quantum``: tokens of each source a round. Without ``targets`` its share of all tokens.

    ``targets`` maps sources to weights; sources it doesn't name share one weight of the rest, their
    part of the tokens. Weights are above 0 and scaled to sum to 1.
    """
    if targets and min(targets.values()) <= 0:
        raise ValueError("a source with no share of a window can't be packed")
    sizes = documents.groupBy("queue").agg(F.sum("tokens").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 1
    natural = F.col("size") / F.lit(float(total))
    if targets:
        given = documents.sparkSession.createDataFrame([(str(k), float(v)) for k, v in targets.items()], "queue string, weight double")
        sizes = sizes.join(F.broadcast(given), "queue", "left")  # as many rows as the caller named
        share = F.coalesce("weight", natural)
        weight = sizes.agg(F.sum(share)).first()[0] or 1.0
        return sizes.select("queue", (share / F.lit(weight) * window).alias("quantum"))
    return sizes.select("queue", (natural * window).alias("quantum"))


def _runs():
    """``round, low, high`` of the stretches of a document, ``begin`` to ``begin + tokens``, that its queue serves round by round."""
    served = lambda n: F.floor(n * F.col("quantum")).cast("long")
    end = F.col("begin") + F.col("tokens")
    # Quanta of a token or more: a stretch a round. The rounds tried are one more at both ends than can have tokens.
    first, last = F.greatest(F.floor(F.col("begin") / F.col("quantum")).cast("long"), F.lit(1)), F.floor(end / F.col("quantum")).cast("long") + 2
    by_round = F.transform(
        F.sequence(first, last),
        lambda n: F.struct(n.alias("round"), F.greatest(served(n - 1), F.col("begin")).alias("low"), F.least(served(n), end).alias("high")),
    )
    # Smaller ones: a token at a time, in the round in which the quanta first add up to it.
    by_token = F.transform(
        F.sequence(F.col("begin"), end - 1),
        lambda t: F.struct(F.ceil((t + 1) / F.col("quantum")).cast("long").alias("round"), t.alias("low"), (t + 1).alias("high")),
    )
    return F.filter(F.when(F.col("quantum") >= 1, by_round).otherwise(by_token), lambda x: x["low"] < x["high"])


def pieces(documents: DataFrame, window=WINDOW, targets=None, block_rows=BLOCK_ROWS):
    """``row_id, start, length, sequence_id, offset`` for ``documents`` (``row_id, doc_id, queue, tokens``)."""
    served = materialized(quanta(documents, window, targets))
    queues = max(1, served.count())
    placed = queue_places(documents, block_rows).join(served, "queue")
    cut = placed.select("row_id", "queue", "begin", F.inline(_runs()))
    parts = materialized(
        cut.select("row_id", "queue", "low", (F.col("low") - F.col("begin")).alias("start"), (F.col("high") - F.col("low")).alias("length"), "round")
    )
    # A block is a run of rounds; a round has a stretch a source, and one more for each document that ends in it.
    rounds = max(1, block_rows // (2 * min(queues, window)))
    blocked = parts.withColumn("block", F.expr(f"round div {rounds}L"))
    totals = blocked.groupBy("block").agg(F.sum("length").alias("amount"))
    order = Window.partitionBy("block").orderBy("round", "queue", "low").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocked.withColumn("inside", F.coalesce(F.sum("length").over(order), F.lit(0)))
    told = inside.join(_offsets(totals, [], "block", "amount"), "block").withColumn("at", F.col("before") + F.col("inside"))
    # A stretch can cross one window's end or more.
    split = told.select("row_id", "start", "length", "at", F.explode(F.expr(f"sequence(at div {window}, (at + length - 1) div {window})")).alias("sequence_id"))
    begins = F.greatest(F.col("sequence_id") * window, "at")
    ends = F.least((F.col("sequence_id") + 1) * window, F.col("at") + F.col("length"))
    return split.select(
        "row_id",
        (F.col("start") + begins - F.col("at")).alias("start"),
        (ends - begins).alias("length"),
        "sequence_id",
        (begins - F.col("sequence_id") * window).alias("offset"),
    )


def pack(docs: DataFrame, window=WINDOW, targets=None, path=None, text="text", doc_id="doc_id", source="source", block_rows=BLOCK_ROWS):
    """Sequences of at most ``window`` tokens, one row per piece of a document.

    Returns ``row_id, doc_id, source, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset``:
    ``ids`` are little-endian 16-bit ids. Each id, and the separator after each document, lies in
    exactly one piece; a sequence's pieces have no gaps; all sequences but the last are full. A null
    or empty text is its separator alone. A null source is a queue of its own. A row without id has a
    place in its queue by its row number. Repeated rows are each packed. A very long text is cut like any
    other. An empty table gives no pieces. Only the named columns are read, under names of their own.
    """
    written = token_table(docs, path, text, doc_id, source)
    queue = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    named = {f"={k}" if k is not None else "": v for k, v in (targets or {}).items()}
    listed = written.select("row_id", "doc_id", queue.alias("queue"), "tokens")
    piece = F.struct("start", "length", "sequence_id", "offset")
    cut = pieces(listed, window, named, block_rows).groupBy("row_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    met = written.join(cut, "row_id")

    def lay(batches):
        for batch in batches:
            listed = batch.column("pieces")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(listed.offsets.to_numpy()))
            start, length, sequence, offset = (x.to_numpy(zero_copy_only=False) for x in listed.flatten().flatten())
            first = _first_of_runs(owner, start, length, sequence, offset)
            owner, start, sequence, offset = owner[first], start[first], sequence[first], offset[first]
            length = np.add.reduceat(length, first) if len(first) else length
            # A document's pieces are all of its ids in order, so the documents' bytes are the pieces' bytes.
            data = b"".join(batch.column("ids").to_pylist())
            ends = np.concatenate([[0], np.cumsum(length)])
            wide = memoryview(np.frombuffer(data, "<u2").astype("<u4").tobytes())
            cuts = (4 * ends).tolist()
            crc = [zlib.crc32(wide[i:j]) for i, j in zip(cuts, cuts[1:])]
            ids = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer((2 * ends).astype(np.int64).tobytes()), pa.py_buffer(data)]).cast(pa.binary())
            at = pa.array(owner)
            whole = lambda name: batch.column(name).take(at)
            yield pa.RecordBatch.from_arrays(
                [whole("row_id"), whole("doc_id"), whole("source"), pa.array(start), pa.array(length), ids, pa.array(crc, pa.int64()), whole("tokens"),
                 pa.array(sequence), pa.array(offset)],
                names=["row_id", "doc_id", "source", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = written.schema["doc_id"].dataType.simpleString()
    return met.select("row_id", "doc_id", "source", "tokens", "ids", "pieces").mapInArrow(
        lay,
        f"row_id long, doc_id {kind}, source string, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )


def _first_of_runs(owner, start, length, sequence, offset):
    """Where the pieces begin that don't go on from the one before, in the same document and sequence."""
    on = (owner[1:] == owner[:-1]) & (sequence[1:] == sequence[:-1])
    on &= (start[1:] == start[:-1] + length[:-1]) & (offset[1:] == offset[:-1] + length[:-1])
    return np.flatnonzero(np.concatenate([[True], ~on])[: len(owner)])
