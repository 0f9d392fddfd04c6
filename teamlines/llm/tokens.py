"""Token ids of texts, flat token files, and a scan for the separators in them."""

import base64
import uuid
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import numbered, rows_of
from teamlines.session import materialized, scratch_path

VOCABULARY = "byte_bpe_50k"
END_OF_TEXT = 50256  # fixed value: the id of <|endoftext|>, the only special token of that vocabulary
BLOCK_TOKENS = 1 << 20


def vocabulary_path(name=VOCABULARY):
    """Where the installed vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


@cache
def encoder(path):
    """The byte-level BPE of a rank file, once a process.

    The same vocabulary and splitting as the ``.json`` file that the tokenizers library reads, with
    the same ids, about seven times as fast; ``<|endoftext|>`` in a text is the special token, as there.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": END_OF_TEXT}
    )


def token_ids(text, path):
    """Ids of one text as unsigned 16-bit numbers; null is empty."""
    return np.array(encoder(path).encode(text or "", allowed_special="all"), np.uint16)


# -- flat files --

PLAN = "file string, first_row long, row_ids array<long>, tokens long"


def _file_system(uri):
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def write_token_files(docs: DataFrame, path=None, text="text", folder=None, separator=END_OF_TEXT):
    """Each task's texts as one flat file of little-endian 16-bit ids, ``separator`` after each text.

    Nothing in a file says where its texts begin. Returns a written table ``file, row_ids, tokens``:
    the files of the tasks that succeeded and, by position, the rows whose texts they hold (in the
    parts of at most one Arrow batch). A file of a failed attempt has another name and is not listed.
    ``separator`` inside a text would end it early, so its special token is read as plain text.
    """
    spark = docs.sparkSession
    path = path or vocabulary_path()
    folder = folder or scratch_path(spark, "tokens")
    rows = rows_of(docs, text=text)

    def write(batches):
        codec = encoder(path)
        name = f"{folder}/part-{uuid.uuid4().hex}.bin"
        out, first, listed = None, 0, []
        for batch in batches:
            if out is None:
                system, place = _file_system(name)
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(place)
            total = 0
            for value in batch.column("text").to_pylist():
                ids = np.array([*codec.encode_ordinary(value or ""), separator], np.uint16)
                out.write(ids.astype("<u2").tobytes())
                total += len(ids)
            listed.append((first, batch.column("row_id"), total))
            first += batch.num_rows
        if out is not None:
            out.close()
        for first, ids, total in listed:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([first], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([total], pa.int64())],
                names=["file", "first_row", "row_ids", "tokens"],
            )

    return materialized(rows.mapInArrow(write, PLAN))


def scan_separators(files: DataFrame, separator=END_OF_TEXT, block_tokens=BLOCK_TOKENS):
    """``file, nth, start, tokens`` of every text in flat files ``file, tokens`` (the length in ids).

    Files are cut into blocks that different tasks read. A task finds the separators of its block by
    one vector comparison. Texts that cross blocks are stitched by a prefix scan over the blocks of a
    file: the separators before a block number its texts, and the last separator before it is where
    its first text starts. Ids after the last separator of a file are one more text, without a separator.
    ``tokens`` doesn't count the separator. An empty file has no texts.
    """
    blocks = files.where("tokens > 0").select(
        "file", "tokens", F.explode(F.expr(f"sequence(0L, (tokens - 1) div {block_tokens}L)")).alias("block")
    )
    n = files.sparkSession.sparkContext.defaultParallelism
    dealt = blocks.repartition(max(n, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "file", "block")

    def find(batches):
        for batch in batches:
            for name, tokens, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
                system, place = _file_system(name)
                at = block * block_tokens
                with system.open_input_file(place) as source:
                    source.seek(2 * at)
                    ids = np.frombuffer(source.read(2 * min(block_tokens, tokens - at)), "<u2")
                ends = np.flatnonzero(ids == separator) + at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([tokens], pa.int64()), pa.array([block], pa.int64()), pa.array([ends.tolist()], pa.list_(pa.int64()))],
                    names=["file", "tokens", "block", "ends"],
                )

    found = materialized(dealt.mapInArrow(find, "file string, tokens long, block long, ends array<long>"))
    counts = found.select("file", "block", F.size("ends").cast("long").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    before = "over (partition by file order by block rows between unbounded preceding and 1 preceding)"
    scan = counts.select(
        "file",
        "block",
        F.expr(f"coalesce(sum(n) {before}, 0L)").alias("nth"),
        F.expr(f"coalesce(max(last) {before}, -1L)").alias("carried"),
    )
    stitched = found.join(scan, ["file", "block"])
    inner = stitched.select("file", "nth", "carried", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.coalesce(F.get("ends", F.col("i") - 1), F.col("carried")) + 1
    texts = inner.select("file", (F.col("nth") + F.col("i")).alias("nth"), start.alias("start"), (F.col("end") - start).alias("tokens"))
    ended = counts.groupBy("file").agg(F.sum("n").alias("nth"), F.coalesce(F.max("last"), F.lit(-1)).alias("last"))
    rest = files.select("file", "tokens").where("tokens > 0").join(ended, "file").where("last + 1 < tokens")
    return texts.unionByName(
        rest.select("file", "nth", (F.col("last") + 1).alias("start"), (F.col("tokens") - F.col("last") - 1).alias("tokens"))
    )


def token_counts(docs: DataFrame, path=None, text="text", doc_id="doc_id", block_tokens=BLOCK_TOKENS):
    """``row_id, doc_id, tokens, file, start`` of every row, counted by scanning flat token files.

    A null or empty text has no tokens. Repeated rows are counted each, and rows without id too. Very long
    texts are counted whole, over as many blocks as they take. No file is written for an empty table, and
    its result is empty. Only the named columns are read, under names of their own.
    """
    docs = numbered(docs)
    written = write_token_files(docs, path, text)
    files = written.groupBy("file").agg(F.sum("tokens").alias("tokens"))
    found = scan_separators(files, block_tokens=block_tokens)
    order = written.select("file", "first_row", F.posexplode("row_ids").alias("i", "row_id"))
    named = order.select("file", (F.col("first_row") + F.col("i")).alias("nth"), "row_id")
    ids = rows_of(docs, doc_id=doc_id)
    return found.join(named, ["file", "nth"]).join(ids, "row_id").select("row_id", "doc_id", "tokens", "file", "start")
