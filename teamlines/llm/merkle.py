"""Merkle tree over the rows of a table, with a proof of every row by pointer jumping.

Each partition of the table (a language) is a tree over its rows in order, and one more tree joins
the partitions' roots. A node's first proof segment is its sibling, and its pointer leads to its
parent; the node that ends a partition's tree is a leaf of the joining tree. A self-join of the nodes
by pointer concatenates a node's segment with that of the node it points to and so doubles the
distance, until every leaf's segment reaches the root. Leaves at level ``2**k - 1`` join the nodes of
that level, so later rounds keep only the levels that later joins can meet: 40 levels take six joins.

The trees are built ten levels at a time: a group of 1,024 neighbours is hashed in one place, so no
task holds more of a partition than that, however many rows it has.
"""

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import rows_of
from teamlines.llm.ordering import HOT_KEYS, in_order, join_counted
from teamlines.session import materialized

LEVELS = 10  # built at a time
JOINING = -1  # the tree over the partitions' roots
DONE = -2  # a pointer past the root; with the row's own number, so that such rows don't meet in one task
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ALONE, RIGHT, LEFT = b"\0", b"\1", b"\2"  # first byte of a proof's entry: where the sibling stands


def leaf_hash(fields):
    """Lowercase hex SHA-256 over columns: ``-`` for null, else UTF-8 byte count, colon, value."""
    parts = []
    for c in fields:
        value = c.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def _hashed(run):
    return sha256("".join(d.hex() for d in run).encode()).digest()


def _raised(digests, levels):
    """The nodes above neighbours, level by level, ``digests`` first."""
    found = [digests]
    for _ in range(levels):
        digests = [_hashed(digests[i : i + 2]) for i in range(0, len(digests), 2)]
        found.append(digests)
    return found


def _entry(row, i):
    if i % 2:
        return LEFT + row[i - 1]
    return RIGHT + row[i + 1] if i + 1 < len(row) else ALONE


NODES = "tree long, level int, idx long, height int, digest binary, entry binary"


def _build(batches):
    for batch in batches:
        out = {name: [] for name in ("tree", "level", "idx", "height", "digest", "entry")}
        for tree, base, height, block, digests in zip(*(batch.column(n).to_pylist() for n in ("tree", "base", "height", "block", "digests"))):
            up = min(LEVELS, height - base)
            rows = _raised(digests, up)
            for j, row in enumerate(rows):
                for i, digest in enumerate(row):
                    out["tree"].append(tree)
                    out["level"].append(base + j)
                    out["idx"].append((block << (LEVELS - j)) + i)
                    out["height"].append(height)
                    out["digest"].append(digest)
                    out["entry"].append(_entry(row, i) if j < up else None)
        kinds = dict(tree=pa.int64(), level=pa.int32(), idx=pa.int64(), height=pa.int32(), digest=pa.binary(), entry=pa.binary())
        yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in out.items()})


def _trees(lowest: DataFrame, highest):
    """All nodes (``NODES``) of trees given by ``tree, idx, height, digest`` of their leaves.

    Nodes without an entry are the trees' roots. ``highest`` is the greatest height.
    """
    found, level, now = [], 0, lowest
    while True:
        block = F.shiftright("idx", LEVELS)
        pair = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        grouped = now.groupBy("tree", "height", block.alias("block")).agg(F.transform(pair, lambda x: x["digest"]).alias("digests"))
        built = materialized(grouped.withColumn("base", F.lit(level)).mapInArrow(_build, NODES))
        whole = F.col("entry").isNotNull() | (F.col("level") == F.col("height"))
        found.append(built.where(whole))
        level += LEVELS
        if level >= highest:
            break
        now = built.where(~whole).select("tree", "idx", "height", "digest")
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def _height(n):
    """Levels above ``n`` leaves: the bits of ``n - 1``."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def _pointers(nodes: DataFrame, joined):
    """``tree, level, idx, segment, up`` of the nodes below the trees' roots; ``joined`` is the joining tree's height."""
    last = F.col("level") + 1 == F.col("height")
    parent = F.struct(F.col("tree").alias("tree"), (F.col("level") + 1).alias("level"), F.shiftright("idx", 1).alias("idx"))
    joining = F.struct(F.lit(JOINING).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"))
    up = F.when(~last, parent).when((F.col("tree") != JOINING) & F.lit(joined > 0), joining)
    return nodes.where("entry IS NOT NULL").select("tree", "level", "idx", F.array("entry").alias("segment"), up.alias("up"))


def _jumped(left: DataFrame, right: DataFrame, few):
    """``left`` (``up, segment, number`` and more) after the jumps that ``right`` holds; rows past the root stay."""
    to = right.select(F.struct("tree", "level", "idx").alias("at"), F.col("segment").alias("more"), F.col("up").alias("next"))
    if few:
        to = F.broadcast(to)
    past = F.struct(F.lit(DONE).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("number").alias("idx"))
    met = left.withColumn("at", F.coalesce("up", past)).join(to, "at", "left")
    rest = [c for c in left.columns if c not in ("up", "segment")]
    grown = F.when(F.col("more").isNull(), F.col("segment")).otherwise(F.concat("segment", "more"))
    return met.select(*rest, F.col("next").alias("up"), grown.alias("segment"))


def _folded(start, segment):
    """The root that a leaf (hex) and its proof lead to."""

    def step(acc, s):
        side, other = F.substring(s, 1, 1), F.lower(F.hex(F.substring(s, 2, 32)))
        both = F.when(side == F.lit(RIGHT), F.concat(acc, other)).when(side == F.lit(LEFT), F.concat(other, acc)).otherwise(acc)
        return F.sha2(both, 256)

    return F.aggregate(segment, start, step)


def proofs(docs: DataFrame, changed=None, fields=FIELDS, partition="lang", order="doc_id", few=HOT_KEYS):
    """A row per row of ``docs``: its leaf, its partition's root, the root, its proof and whether a copy of the row passes it.

    Returns ``row_id, doc_id, partition, leaf, subroot, root, proof, proof_sha256, folded_root, verified``.
    ``proof`` lists per level where the sibling stands (``left``, ``right``, or null without one) and its
    digest. ``changed`` maps fields to columns that a tampered copy holds in their place; the copy's
    leaf is folded with the proof of the true row, and is verified if that gives the root.

    Rows of a partition ascend by ``order``, nulls first; rows that tie there ascend by leaf, and rows
    repeated in all fields are leaves of their own, side by side. Null is a partition of its own, the
    first. Null fields hash as ``-``, apart from empty ones; whole texts of any length are hashed. An empty
    table gives no rows. Only the named columns are read, under names of their own, so others may clash.
    """
    spark = docs.sparkSession
    altered = [(changed or {}).get(c, docs[c]) for c in fields]
    hashed = rows_of(docs, order=order, partition=partition, leaf=leaf_hash([docs[c] for c in fields]), copy=leaf_hash(altered))
    copy = F.when(F.col("copy") != F.col("leaf"), F.unhex("copy"))
    key = F.coalesce(F.concat(F.lit("="), F.col("partition").cast("string")), F.lit(""))
    leaves = materialized(hashed.select("row_id", "order", "partition", key.alias("key"), F.unhex("leaf").alias("digest"), copy.alias("copy")))
    placed = in_order(leaves, F.col("key"), F.asc_nulls_first("order"), F.col("digest"), F.col("row_id"))
    counted = placed.groupBy("key").agg(F.min("position").alias("first"), F.count("*").alias("n"))
    parts = materialized(in_order(counted, F.col("first"), name="tree"))  # keys ascend as their first places do
    n_parts, largest = parts.agg(F.count("*"), F.max(_height(F.col("n")))).first()
    kind = leaves.schema["order"].dataType.simpleString(), leaves.schema["partition"].dataType.simpleString()
    if not n_parts:
        told = "leaf string, subroot string, root string, proof array<struct<sibling: string, digest: string>>, proof_sha256 string, folded_root string, verified boolean"
        return spark.createDataFrame([], f"row_id long, doc_id {kind[0]}, partition {kind[1]}, {told}")

    rows = materialized(
        join_counted(placed, parts.select("key", "tree", "first", _height(F.col("n")).alias("height"), "n"), ["key"], "n").select(
            "row_id", "order", "partition", "tree", (F.col("position") - F.col("first")).alias("idx"), "height", "digest", "copy"
        )
    )
    nodes = _trees(rows.select("tree", "idx", "height", "digest"), largest)
    joined = (n_parts - 1).bit_length()
    subroots = nodes.where("entry IS NULL").select(F.col("tree").alias("idx"), "digest")
    joining = _trees(subroots.select(F.lit(JOINING).cast("long").alias("tree"), "idx", F.lit(joined).alias("height"), "digest"), joined)
    root = joining.where("entry IS NULL").first()["digest"].hex()

    jumps = materialized(_pointers(nodes, joined).unionByName(_pointers(joining, joined)))
    start = F.when(F.col("height") > 0, F.struct("tree", F.lit(0).alias("level"), "idx"))
    if joined:
        start = start.otherwise(F.struct(F.lit(JOINING).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx")))
    empty = F.array().cast("array<binary>")
    state = rows.select("row_id", "order", "partition", "tree", "digest", "copy", F.col("row_id").alias("number"), start.alias("up"), empty.alias("segment"))
    chain = largest + joined
    for k in range(chain.bit_length()):
        # Rows in trees stand at level 2**k - 1; in the joining tree anywhere.
        meets = jumps.where((F.col("level") == (1 << k) - 1) | (F.col("tree") == JOINING))
        state = _jumped(state, meets, meets.count() <= few)
        if k + 1 < chain.bit_length():
            needed = (F.col("level") + 1) % (1 << (k + 1)) == 0
            numbered = jumps.where(needed | (F.col("tree") == JOINING)).withColumn("number", F.xxhash64("tree", "level", "idx"))
            jumps = materialized(_jumped(numbered, jumps, jumps.count() <= few).drop("number"))

    sizes = parts.select("tree", "n").join(subroots.withColumnsRenamed({"idx": "tree", "digest": "subroot"}), "tree")
    met = join_counted(materialized(state), materialized(sizes), ["tree"], "n")
    leaf, hexed = F.lower(F.hex("digest")), lambda s: F.lower(F.hex(F.substring(s, 2, 32)))
    side = lambda s: F.when(F.substring(s, 1, 1) == F.lit(LEFT), "left").when(F.substring(s, 1, 1) == F.lit(RIGHT), "right")
    entry = lambda s: F.struct(side(s).alias("sibling"), F.when(F.octet_length(s) > 1, hexed(s)).alias("digest"))
    siblings = F.transform(F.filter("segment", lambda s: F.octet_length(s) > 1), hexed)
    found = met.select(
        "row_id",
        F.col("order").alias("doc_id"),
        "partition",
        leaf.alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(root).alias("root"),
        F.transform("segment", entry).alias("proof"),
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        _folded(F.lower(F.hex(F.coalesce("copy", "digest"))), F.col("segment")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
