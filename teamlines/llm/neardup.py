"""Near duplicates by bottom-k sketches of one hash function.

A document is the set of its word shingles. Documents with equal sets form a class, and one of
them stands for it. The ``k`` smallest hashes of a set are its sketch:

1. *Inverted lists* of the retained values give overlaps. Members of a short list are paired; in
   a long one all members are compared with one centre, so its cost is linear.
2. *Union sketches*: the ``k`` smallest values of two sketches are a sample of the union, and the
   part in both estimates the overlap. Pairs that far below the threshold are dropped; the bound
   is one that a linked pair misses with a chance of 1e-9.
3. *Exact Jaccard* on the full sets confirms every link.

Two linked sets share at least ``least_shared`` retained values (same bound). If at least one
of those lists is short, or holds one component only, nothing is missed. Documents with that many
values in long lists of several components are compared once more, exactly: their shingles are
ordered rarest first, and the first ``n - ceil(t n) + 1`` of each are looked up (linked sets
always share one of these). What is left are long lists of texts just below and above the
threshold: every member outside a list's largest component is compared with the whole list, in
blocks of bounded memory that give out links alone. No partner is capped.
"""

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import ids_first, keep_rows, numbered, rows_of
from teamlines.llm.components import components
from teamlines.llm.ordering import join_counted
from teamlines.llm.shingles import digest, shingle_sets
from teamlines.session import materialized

WIDTH, PERCENT = 5, 80
RETAINED = 32
SHORT_LIST = 32
PER_CENTRE = 128  # partners of a centre, about, in one block
CENTRES, CENTRE_VALUES = 128, 1 << 21  # centres of a block, and values of their sets, about
PER_BLOCK = 4096  # other members of a block, about


def least_shared(k, percent, chance=1e-9):
    """The number of ``k`` union values that a pair at the threshold has in common, but for ``chance``."""
    p, below = percent / 100, 0.0
    for shared in range(k + 1):
        below += comb(k, shared) * p**shared * (1 - p) ** (k - shared)
        if below > chance:
            return max(1, shared)
    return k


def sketch_rows(docs: DataFrame, width, k, text="text", doc_id="doc_id"):
    """``row_id, doc_id, n, digest, sketch`` of every row."""
    rows = rows_of(docs, doc_id=doc_id, text=text)

    def sketch(batches):
        for batch in batches:
            n, digests, kept = [], [], []
            for values in shingle_sets(batch.column("text").to_pylist(), width):
                n.append(len(values))
                digests.append(digest(values))
                kept.append(values[:k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(kept, pa.list_(pa.int64()))],
                names=["row_id", "doc_id", "n", "digest", "sketch"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sketch, f"row_id long, doc_id {kind}, n long, digest binary, sketch array<long>")


def _lists(values: DataFrame):
    """Of ``row_id, n, value`` the rows whose value others have too, with the length of the list and a centre."""
    shared = values.groupBy("value").agg(F.count("*").alias("length"), F.min("row_id").alias("centre")).where("length > 1")
    return materialized(join_counted(values, materialized(shared.withColumn("often", F.col("length"))), ["value"], "often"))


def _pairs(lists: DataFrame, percent, short):
    """Candidate pairs ``a, b``: all of a short list that sizes allow, and those with the centre of a long one."""
    member = F.struct("row_id", "n")
    few = lists.where(F.col("length") <= short).groupBy("value").agg(F.array_sort(F.collect_list(member)).alias("all"))
    one = few.select(F.explode("all").alias("x"), "all")
    near = F.filter(
        "all",
        lambda y: (y["row_id"] > F.col("x.row_id"))
        & (100 * F.least(y["n"], F.col("x.n")) >= percent * F.greatest(y["n"], F.col("x.n"))),
    )
    inside = one.select(F.col("x.row_id").alias("a"), F.explode(F.transform(near, lambda y: y["row_id"])).alias("b"))
    star = lists.where((F.col("length") > short) & (F.col("row_id") != F.col("centre")))
    return inside.union(star.select(F.col("centre").alias("a"), F.col("row_id").alias("b"))).distinct()


def _estimated(pairs: DataFrame, sketches: DataFrame, percent, k):
    """The pairs that union sketches leave; sets of at most ``k`` values are known whole."""
    left = sketches.select(F.col("row_id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = sketches.select(F.col("row_id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    sized = pairs.join(left, "a").join(right, "b")
    sized = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
    told = sized.withColumn("union", union).withColumn("both", F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), "union")))
    whole = (F.col("n_a") <= k) & (F.col("n_b") <= k)
    sure = 100 * F.size(F.array_intersect("s_a", "s_b")) >= percent * F.size(F.array_union("s_a", "s_b"))
    return told.where(F.when(whole, sure).otherwise(F.col("both") >= least_shared(k, percent))).select("a", "b")


def confirmed(asked: DataFrame, texts: DataFrame, width, percent):
    """Edges ``a, b`` that join what links join within blocks ``x, y, z, row_id, other``.

    Every centre is compared with every other row of its block. The texts of a block meet in one
    task, centres first. It holds the centres' sets as one index and reads the other texts one by
    one, so its memory doesn't grow with the block. A row linked to several centres gives one
    edge, and two centres that such a row joins give one, so edges are never more than the rows.
    """
    key = ["x", "y", "z"]
    met = asked.join(texts.select("row_id", "text"), "row_id").repartition(*key).sortWithinPartitions(*key, "other")

    def compare(batches):
        block, centres = None, None
        for batch in batches:
            a, b = [], []
            sets = shingle_sets(batch.column("text").to_pylist(), width)
            told = zip(*(batch.column(c).to_pylist() for c in [*key, "row_id", "other"]), sets)
            for x, y, z, row, other, values in told:
                if block != (x, y, z):
                    block, centres = (x, y, z), _Centres()
                if not other:
                    centres.add(row, values)
                    continue
                near = [c for c in centres.linked(values, percent) if c != row]
                if near:
                    a.append(near[0])
                    b.append(row)
                for c in near[1:]:
                    if centres.join(near[0], c):
                        a.append(near[0])
                        b.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return materialized(met.select(*key, "row_id", "other", "text").mapInArrow(compare, "a long, b long"))


class _Centres:
    """The sets of a block's centres and an index of their values."""

    def __init__(self):
        self.rows, self.sets, self.values, self.root = [], [], None, {}

    def _find(self, row):
        while (above := self.root.get(row, row)) != row:
            self.root[row] = row = self.root.get(above, above)
        return row

    def join(self, one, two):
        """Whether two centres were still apart; now they aren't."""
        one, two = self._find(one), self._find(two)
        self.root[two] = one
        return one != two

    def add(self, row, values):
        self.rows.append(row)
        self.sets.append(values)

    def linked(self, values, percent):
        if self.values is None:
            self.rows, self.sizes = np.array(self.rows, np.int64), np.array([len(s) for s in self.sets], np.int64)
            flat = np.concatenate(self.sets) if self.sets else np.empty(0, np.int64)
            order = np.argsort(flat, kind="stable")
            self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)[order]
            self.values, self.first, self.many = np.unique(flat[order], return_index=True, return_counts=True)
            self.sets = None
        if not len(self.values):
            return []
        at = np.searchsorted(self.values, values)
        at[at == len(self.values)] = 0
        at = at[self.values[at] == values]
        n = self.many[at]
        listing = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(n)[:-1]])[: len(n)], n) + np.arange(n.sum())
        both = np.bincount(self.owner[listing.astype(np.int64)], minlength=len(self.rows))
        near = (both > 0) & (100 * both >= percent * (self.sizes + len(values) - both))
        return self.rows[near].tolist()


def _pair_blocks(pairs: DataFrame):
    """Blocks of one centre ``a``; one with many partners has a block for every ``PER_CENTRE`` of them."""
    pairs = materialized(pairs)
    often = pairs.groupBy("a").agg(F.count("*").alias("n"))
    salted = pairs.join(often, "a").select("a", "b", F.expr(f"pmod(xxhash64(b), 1 + n div {PER_CENTRE})").alias("y"))
    z = F.lit(0).cast("long").alias("z")
    centres = salted.select("a", "y").distinct().select(F.col("a").alias("x"), "y", z, F.col("a").alias("row_id"), F.lit(False).alias("other"))
    return centres.union(salted.select(F.col("a").alias("x"), "y", z, F.col("b").alias("row_id"), F.lit(True).alias("other")))


def _rest_blocks(rest: DataFrame):
    """Blocks that compare all members of an open list outside its largest component with the whole list."""
    sizes = rest.groupBy("value", "label").agg(F.count("*").alias("size"), F.sum(F.greatest("n", F.lit(CENTRE_VALUES // CENTRES))).alias("weight"))
    whole = sizes.groupBy("value").agg(F.max(F.struct("size", "label")).alias("most"), F.sum("size").alias("length"))
    outside = sizes.join(whole, "value").where("label <> most.label").groupBy("value", "length", F.col("most.label").alias("most"))
    plan = materialized(outside.agg(F.expr(f"1 + sum(weight) div {CENTRE_VALUES}").alias("parts")))
    planned = join_counted(rest, plan.withColumn("often", F.col("length")), ["value"], "often").withColumn("salts", F.expr(f"1 + length div {PER_BLOCK}"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    centres = planned.where("label <> most").select("value", F.expr("pmod(xxhash64(row_id), parts)").alias("y"), "salts", "row_id")
    centres = centres.select(F.col("value").alias("x"), "y", every("salts").alias("z"), "row_id", F.lit(False).alias("other"))
    others = planned.select(F.col("value").alias("x"), every("parts").alias("y"), F.expr("pmod(xxhash64(row_id), salts)").alias("z"), "row_id", F.lit(True).alias("other"))
    return centres.union(others)


def _open(lists: DataFrame, labels: DataFrame, short):
    """The rows of long lists that hold several components, with their ``label``."""
    long = lists.where(F.col("length") > short).select("value", "row_id", "n")
    named = long.join(labels, "row_id", "left").withColumn("label", F.coalesce("label", "row_id"))
    many = named.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("often")).where("low < high")
    return materialized(join_counted(named, materialized(many.select("value", "often")), ["value"], "often"))


def _rare_first(rows: DataFrame, width, percent):
    """``row_id, n, value``: of each set the rarest values, one of which any linked set shares."""

    def explode(batches):
        for batch in batches:
            for row, values in zip(batch.column("row_id").to_pylist(), shingle_sets(batch.column("text").to_pylist(), width)):
                n = len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row), pa.int64()), pa.array(np.full(n, n), pa.int64()), pa.array(values)],
                    names=["row_id", "n", "value"],
                )

    values = materialized(rows.mapInArrow(explode, "row_id long, n long, value long"))
    often = values.groupBy("value").agg(F.count("*").alias("often"))
    place = F.expr("row_number() over (partition by row_id order by often, value)")
    ranked = values.join(often, "value").withColumn("place", place)
    return ranked.where(f"place <= n - (n * {percent} + 99) div 100 + 1").select("row_id", "n", "value")


def linked_rows(docs: DataFrame, sketches: DataFrame, width, percent, k, short, text="text"):
    """Labels of the components that all links between rows of ``sketches`` make."""
    texts = rows_of(docs, text=text)
    lists = _lists(sketches.select("row_id", "n", F.explode("sketch").alias("value")))

    def compare(lists, texts):
        return confirmed(_pair_blocks(_estimated(_pairs(lists, percent, short), sketches, percent, k)), texts, width, percent)

    found = compare(lists, texts)
    labels = components(found)
    hard = _open(lists, labels, short).groupBy("row_id", "n").agg(F.count("*").alias("open"))
    hard = materialized(hard.where(F.col("open") >= F.least(F.lit(least_shared(k, percent)), F.expr(f"(n * {percent} + 99) div 100"))))
    if hard.isEmpty():
        return labels
    # All that follows compares these documents only, so their texts are taken out of the corpus once.
    texts = materialized(texts.join(hard.select("row_id"), "row_id", "left_semi").select("row_id", "text"))
    lists = _lists(_rare_first(texts, width, percent))
    found = found.union(compare(lists, texts))
    labels = components(found)
    rest = _open(lists, labels, short)
    if rest.isEmpty():
        return labels
    return components(found.union(confirmed(_rest_blocks(rest), texts, width, percent)))


def near_duplicates(docs: DataFrame, width=WIDTH, percent=PERCENT, k=RETAINED, short=SHORT_LIST, text="text", doc_id="doc_id"):
    """One row per row of ``docs``: ``row_id, doc_id, n_shingles, component_id, keep_row, kept``.

    ``component_id`` is the smallest id that links reach, the row's own if there are none;
    ``keep_row`` is the row that stays, of rows with equal ids exactly one. Texts without words
    (null, empty, white space) have no shingles and no links. Rows without an id are compared
    like others but give no id. Repeated rows are one class, in which the first stays; ids that tie go
    by row. Very long texts are compared as whole sets. An empty table gives no rows. Only the named
    columns are read, under names of their own.
    """
    docs = numbered(docs)
    rows = materialized(sketch_rows(docs, width, k, text, doc_id))
    full = rows.where("n > 0")
    classes = materialized(full.groupBy("digest").agg(F.min("row_id").alias("chosen"), F.count("*").alias("often")))
    sketches = full.join(classes.select(F.col("chosen").alias("row_id")), "row_id", "left_semi").select("row_id", "n", "sketch")
    labels = linked_rows(docs, materialized(sketches), width, percent, k, short, text)
    named = classes.join(labels.withColumnRenamed("row_id", "chosen"), "chosen", "left")
    named = materialized(named.select("digest", F.coalesce("label", "chosen").alias("label"), "often"))
    member = materialized(join_counted(full.select("row_id", "doc_id", "digest"), named, ["digest"], "often").select("row_id", "doc_id", "label"))
    first = materialized(member.groupBy("label").agg(F.min(ids_first()).alias("first"), F.count("*").alias("often")))
    told = join_counted(member, first, ["label"], "often").select("row_id", "first")
    told = rows.select("row_id", "doc_id", "n").join(told, "row_id", "left")
    return told.select(
        "row_id",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.id")).alias("component_id"),
        F.coalesce("first.row", "row_id").alias("keep_row"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, **settings):
    """``docs`` with one row of each component; all columns stay."""
    docs = numbered(docs)
    return keep_rows(docs, near_duplicates(docs, **settings).where("row_id = keep_row"))
