"""Nearest neighbours by a forest of random-projection trees, searched through one priority queue.

The trees are grown on a bounded sample: a node splits its vectors at the median of their projections
on a random direction. All vectors are routed to one leaf of every tree. A query walks the whole forest
at once: one priority queue holds nodes of all trees by the squared margins that the query is on the
wrong side of, and the best node is taken until as many leaves are reached as the forest's ``budget``.
How many that has to be is measured on the sample against brute force, so that data without structure
are searched wider than clustered ones. The vectors of the leaves reached are compared exactly.

Largest inner product is nearest: vectors of unlike length get one more component that makes all
equally long, under which the order by inner product is the order by distance.

A cell is a subtree of one tree. Vectors and queries meet by cell, in blocks of bounded size: a cell
that holds a great part of all vectors or queries is cut into more blocks, not into a longer task.
"""

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from teamlines.llm.common import rows_of
from teamlines.session import materialized

TREES = 4
SAMPLE = 16_384  # vectors that the trees are grown on (about; by hash of the row)
LEAF = 256  # vectors of a leaf, while the sample is large enough to tell
LEAST_SAMPLED = 16  # of the sample in a leaf
CELLS = 8  # a tree, at most
TRIALS = 256  # sampled vectors that the budget is measured with
RECALL = 0.97  # of the sample's true neighbours that the budget has to reach
BLOCK_VECTORS = 16_384
BLOCK_QUERIES = 4_096
AT_ONCE = 512  # queries compared at a time
SEED = 5


@dataclass
class Forest:
    directions: np.ndarray  # tree, inner node (heap order from 1), component
    cuts: np.ndarray  # tree, inner node
    depth: int
    budget: int = 1

    @property
    def leaves(self):
        return 1 << self.depth

    def margins(self, vectors):
        """Of every vector at every inner node of every tree; above 0 goes right."""
        return np.einsum("tnd,vd->vtn", self.directions, vectors, optimize=True) - self.cuts

    def leaf_of(self, vectors):
        """A leaf of each tree for every vector."""
        node = np.ones((len(vectors), len(self.cuts)), np.int64)
        trees = np.arange(len(self.cuts))
        for _ in range(self.depth):
            side = np.einsum("vtd,vd->vt", self.directions[trees, node], vectors) > self.cuts[trees, node]
            node = 2 * node + side
        return node - self.leaves

    def search(self, vectors, budget=None):
        """``tree * leaves + leaf`` of the ``budget`` leaves that a shared priority queue reaches first, per vector."""
        budget = min(budget or self.budget, len(self.cuts) * self.leaves)
        found = np.empty((len(vectors), budget), np.int64)
        first = self.leaves
        for begin in range(0, len(vectors), AT_ONCE):
            part = self.margins(vectors[begin : begin + AT_ONCE])
            for row, margins in enumerate(part.tolist(), begin):
                queue = [(0.0, t, 1) for t in range(len(self.cuts))]
                taken = 0
                while taken < budget:
                    wrong, tree, node = heapq.heappop(queue)
                    while node < first:  # down the query's own side; the other waits
                        m = margins[tree][node]
                        right = m > 0
                        heapq.heappush(queue, (wrong + m * m, tree, 2 * node + (not right)))
                        node = 2 * node + right
                    found[row, taken] = tree * first + node - first
                    taken += 1
        return found


def grow(sample, trees=TREES, depth=1, seed=SEED):
    """A forest over the rows of ``sample``: random unit directions, cut at the median."""
    rng = np.random.default_rng(seed)
    n = 1 << depth
    directions = rng.normal(size=(trees, n, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    cuts = np.zeros((trees, n))
    for t in range(trees):
        node = np.ones(len(sample), np.int64)
        for level in range(depth):
            for k in range(1 << level, 2 << level):
                mine = np.flatnonzero(node == k)
                if len(mine):
                    along = sample[mine] @ directions[t, k]
                    cuts[t, k] = np.median(along)
                    node[mine] = 2 * k + (along > cuts[t, k])
    return Forest(directions, cuts, depth)


def measured_budget(forest: Forest, sample, asked, plain, k, recall=RECALL):
    """The fewest leaves that reach ``recall`` of the ``k`` nearest in the sample, over queries ``asked`` (row numbers)."""
    scores = plain[asked] @ plain.T
    scores[np.arange(len(asked)), asked] = -np.inf
    k = min(k, len(plain) - 1)
    if k < 1:
        return 1
    near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    total = len(forest.cuts) * forest.leaves
    order = forest.search(_queries(plain[asked], sample.shape[1]), total)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(total), order.shape), axis=1)
    own = forest.leaf_of(sample) + np.arange(len(forest.cuts)) * forest.leaves
    reached = np.stack([rank[i, own[near[i]]].min(axis=1) for i in range(len(asked))]) + 1
    return int(np.sort(reached, axis=None)[max(0, int(np.ceil(recall * reached.size)) - 1)])


def _lifted(vectors, longest):
    """One more component, after which all vectors are as long as the longest."""
    short = np.sqrt(np.maximum(longest * longest - np.einsum("vd,vd->v", vectors, vectors), 0.0))
    return np.concatenate([vectors, short[:, None]], axis=1) / longest


def _queries(vectors, width):
    """Of length 1, without a part in the added component."""
    out = np.zeros((len(vectors), width))
    out[:, :-1] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return out


def _matrix(column, kind):
    """Rows of a binary column as vectors."""
    if not len(column):
        return np.empty((0, 0))
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


def usable(table: DataFrame, vector="embedding", vec_id="vec_id"):
    """``(rows, kind, length)``: ``row_id, vec_id, vector`` as bytes, their number type, and how long vectors are.

    Left out are rows without id, and null or zero vectors or such with null or non-finite components.
    Vectors have to be of one length, the most frequent (of equally frequent ones, the shortest).
    """
    rows = rows_of(table, vec_id=vec_id, vector=vector).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    element = rows.schema["vector"].dataType.elementType.simpleString()
    kind, arrow = ("<f4", pa.float32()) if element == "float" else ("<f8", pa.float64())
    most = rows.where("size(vector) > 0").groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = most["n"] if most else 0

    def pack(batches):
        for batch in batches:
            column = batch.column("vector")
            flat = column.flatten().cast(arrow).to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, -1)
            data = pa.array([v.tobytes() for v in flat], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("vec_id"), data], names=["row_id", "vec_id", "vector"])

    number = F.col("vector").cast("array<double>")
    sound = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(number, lambda x: x != 0)
    good = rows.where((F.size("vector") == length) & sound) if length else rows.limit(0)
    return materialized(good.mapInArrow(pack, "row_id long, vec_id long, vector binary")), kind, length


def fitted(rows: DataFrame, kind, k, trees=TREES, sample=SAMPLE, leaf=LEAF, recall=RECALL, trials=TRIALS, seed=SEED):
    """``(forest, longest)`` from about ``sample`` of ``rows``; the longest vector is found among all."""

    def lengths(batches):
        for batch in batches:
            vectors = _matrix(batch.column("vector"), kind)
            if len(vectors):
                yield pa.RecordBatch.from_pydict({"n": [len(vectors)], "longest": [float(np.sqrt(np.einsum("vd,vd->v", vectors, vectors)).max())]})

    n, longest = rows.select("vector").mapInArrow(lengths, "n long, longest double").agg(F.sum("n"), F.max("longest")).first()
    if not n:
        return None, 1.0
    mixed = F.pmod(F.xxhash64("row_id", F.lit(seed)), F.lit(1 << 40))
    chosen = rows.where(mixed < int(min(1.0, sample / n) * (1 << 40))).select("row_id", "vector").toArrow().sort_by("row_id")
    plain = _matrix(chosen.column("vector"), kind)
    if not len(plain):
        return None, longest
    lifted = _lifted(plain, longest)
    fit = max(1, min(n // leaf, len(plain) // LEAST_SAMPLED))
    forest = grow(lifted, trees, max(1, fit.bit_length() - 1), seed)
    asked = np.random.default_rng(seed).permutation(len(plain))[:trials]
    forest.budget = measured_budget(forest, lifted, asked, plain, k, recall)
    return forest, longest


def nearest(table: DataFrame, k=20, every=20, vector="embedding", vec_id="vec_id", cells=CELLS, block_vectors=BLOCK_VECTORS, block_queries=BLOCK_QUERIES, **settings):
    """``row_id, query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id ``every`` divides.

    Candidates are all rows but the query's own. ``score`` is the inner product of the original vectors in
    double precision; larger ranks first, ties by smaller id, then row. Rows left out by ``usable`` (null id
    or vector, zero, null or non-finite components, another length) are neither queries nor candidates.
    Fewer candidates than ``k`` are all returned. Repeated rows are queries and candidates of their own.
    An empty table gives no rows. Only the named columns are read, under names of their own.
    """
    spark = table.sparkSession
    rows, kind, length = usable(table, vector, vec_id)
    # Of equal vectors only so many can be among the nearest; Spark limits them before the shuffle.
    first = Window.partitionBy("vector").orderBy("vec_id", "row_id")
    candidates = materialized(rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).drop("nth"))
    asked = rows.where(F.col("vec_id") % every == 0)
    forest, longest = fitted(candidates, kind, k, **settings)
    schema = "row_id long, query_id long, rank int, vec_id long, score double"
    if forest is None:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast(forest)  # directions: trees * sample / LEAST_SAMPLED vectors at most
    low = max(0, forest.depth - max(1, cells).bit_length() + 1)  # levels below a cell

    def route(batches):
        for batch in batches:
            vectors = _matrix(batch.column("vector"), kind)
            if not len(vectors):
                continue
            own = held.value.leaf_of(_lifted(vectors, longest)) + np.arange(len(forest.cuts)) * forest.leaves
            at = pa.array(np.repeat(np.arange(len(vectors)), own.shape[1]))
            leaf = own.reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf >> low), pa.array(leaf), *(batch.column(c).take(at) for c in ("row_id", "vec_id", "vector"))],
                names=["cell", "leaf", "row_id", "vec_id", "vector"],
            )

    def ask(batches):
        for batch in batches:
            vectors = _matrix(batch.column("vector"), kind)
            if not len(vectors):
                continue
            reached = np.sort(held.value.search(_queries(vectors, length + 1)), axis=1)
            owner, leaf = np.repeat(np.arange(len(vectors)), reached.shape[1]), reached.reshape(-1)
            key = owner * (len(forest.cuts) << forest.depth) + (leaf >> low)
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            leaves = pa.ListArray.from_arrays(pa.array([*begins, len(leaf)], pa.int32()), pa.array(leaf))
            at = pa.array(owner[begins])
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf[begins] >> low), leaves, *(batch.column(c).take(at) for c in ("row_id", "vector"))],
                names=["cell", "leaves", "row_id", "vector"],
            )

    routed = materialized(candidates.mapInArrow(route, "cell long, leaf long, row_id long, vec_id long, vector binary"))
    wanted = materialized(asked.select("row_id", "vector").mapInArrow(ask, "cell long, leaves array<long>, row_id long, vector binary"))
    # As many rows as the forest has cells.
    blocks = routed.groupBy("cell").agg(F.ceil(F.count("*") / block_vectors).cast("int").alias("parts"))
    turns = wanted.groupBy("cell").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("turns"))
    plan = F.broadcast(materialized(blocks.join(turns, "cell")))
    numbered = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = F.pmod(F.xxhash64("row_id"), F.col("parts")).cast("int")
    turn = F.pmod(F.xxhash64("row_id"), F.col("turns")).cast("int")
    left = routed.join(plan, "cell").select("*", part.alias("part"), numbered("turns").alias("turn")).drop("parts", "turns")
    right = wanted.join(plan, "cell").select("*", turn.alias("turn"), numbered("parts").alias("part")).drop("parts", "turns")

    def compare(vectors, queries):
        return _best(vectors, queries, kind, k)

    keys = ["cell", "part", "turn"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_row long, vec_id long, near_row long, score double")
    # Trees find the same rows; every block gives k of a query at most.
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "near_row")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    ids = asked.select(F.col("row_id").alias("query_row"), F.col("vec_id").alias("query_id"))
    return ranked.join(ids, "query_row").select(F.col("query_row").alias("row_id"), "query_id", "rank", "vec_id", "score")


def _best(vectors: pa.Table, queries: pa.Table, kind, k):
    """The ``k`` nearest of each query among the block's vectors in the leaves that it reached."""
    empty = pa.table({"query_row": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "near_row": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not vectors.num_rows or not queries.num_rows:
        return empty
    leaf = vectors.column("leaf").to_numpy()
    order = np.argsort(leaf, kind="stable")
    leaf, rows, ids = leaf[order], vectors.column("row_id").to_numpy()[order], vectors.column("vec_id").to_numpy()[order]
    plain = _matrix(vectors.column("vector"), kind)[order]
    asked, own = _matrix(queries.column("vector"), kind), queries.column("row_id").to_numpy()
    wanted = queries.column("leaves").combine_chunks()
    offsets, listed = wanted.offsets.to_numpy(), wanted.values.to_numpy()
    names, begins = np.unique(leaf, return_index=True)
    ends = np.append(begins[1:], len(leaf))
    out = []
    for low in range(0, len(asked), AT_ONCE):
        high = min(low + AT_ONCE, len(asked))
        owner = np.repeat(np.arange(low, high), np.diff(offsets[low : high + 1]))
        mine = listed[offsets[low] : offsets[high]]
        pairs = []
        for name, begin, end in zip(names, begins, ends):
            who = owner[mine == name]
            if not len(who):
                continue
            scores = asked[who] @ plain[begin:end].T
            scores[own[who][:, None] == rows[begin:end]] = -np.inf
            n = min(k, end - begin)
            edge = np.partition(scores, -n, axis=1)[:, -n]
            # All that may tie with the last one, whatever the rounding of this product.
            slack = 1e-9 * np.abs(edge) + 1e-12 * np.linalg.norm(asked[who], axis=1)
            q, v = np.nonzero((scores >= (edge - slack)[:, None]) & (scores > -np.inf))
            pairs.append(np.stack([who[q], v + begin]))
        if not pairs:
            continue
        q, v = np.concatenate(pairs, axis=1)
        exact = np.multiply(asked[q], plain[v]).sum(axis=1)
        rank = np.lexsort((rows[v], ids[v], -exact, q))
        q, v, exact = q[rank], v[rank], exact[rank]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < k
        out.append(pa.table({"query_row": own[q[keep]], "vec_id": ids[v[keep]], "near_row": rows[v[keep]], "score": exact[keep]}))
    return pa.concat_tables(out) if out else empty
