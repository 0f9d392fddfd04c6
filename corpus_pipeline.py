"""From raw documents to packed training sequences, in five stages.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns the rows it
keeps, with the columns of ``docs``. The last returns the pieces of the packed sequences. ``run``
writes what each stage returns as Parquet and gives the next one what it reads back.

A filter numbers the rows it reads by file and place, decides by number, and picks the rows by broadcast
bitmaps of the numbers, so that texts stay where they are; beyond 32 MB of bitmaps the numbers are joined.
Columns beside those of documents, whatever their names, pass through the filters unread.
"""

from teamlines.llm import decontam, exact, neardup, packing, quality
from teamlines.llm.common import read_table
from teamlines.session import materialized

NEAR_WIDTH = 4  # words of a shingle, as op10's contract has it


def quality_filter(spark, docs, sf_dir):
    """Documents that the quality classifier accepts.

    Learned from labels of documents whose id's CRC-32 five does not divide; null labels are left out, repeated
    ones all count. Null and empty texts are scored like others; equal texts, repeated rows and ties of score fare
    alike. Very long texts are measured whole. Without labels every document scores 0.5 and stays. An empty table
    stays empty.
    """
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_filter(spark, docs, sf_dir):
    """One document of each group of equal texts: the smallest id, rows without an id last.

    Null counts as empty. Of repeated rows, and of rows that tie by id, one stays. Very long texts are compared
    whole. An empty table stays empty.
    """
    return exact.drop_duplicates(docs)


def near_filter(spark, docs, sf_dir):
    """One document of each component of near duplicates: the smallest id, rows without an id last.

    Texts without words (null, empty, white space) are no near duplicates and all stay. Of repeated rows, and of
    rows that tie by id, one stays. Very long texts are compared as whole sets. An empty table stays empty.
    """
    return neardup.drop_near_duplicates(docs, width=NEAR_WIDTH)


def leak_filter(spark, docs, sf_dir):
    """Documents that hold no benchmark item.

    Null and empty texts hold none; null and empty items, and those without a letter or digit, are in none. Repeated
    rows, rows without an id and items that tie fare alike. Very long texts are searched whole. With an empty
    benchmark all documents stay; an empty table stays empty.
    """
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark, docs, sf_dir):
    """Pieces of the documents left, in sequences that follow the mixture of their sources.

    A null or empty text is its separator alone; a null source is a source of its own. Repeated rows and rows
    without an id are each packed, places that tie go by row. Very long texts are cut like any other. An empty
    table gives no pieces.
    """
    found = packing.pack(docs)
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", quality_filter),
    ("exact", exact_filter),
    ("near", near_filter),
    ("benchmark", leak_filter),
    ("packing", pack),
]

ORACLE_SQL = None  # trained scores, alignment and tokenization are beyond SQL; the tests hold each stage against plain Python


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
