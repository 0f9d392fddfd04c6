"""Quality scores: kernel ridge regression on document statistics, calibrated.

Statistics of the whole text are mapped to random Fourier features, which approximate a Gaussian
kernel. Each task sums its part of the normal equations, the sums are added by key, and the ridge
weights are solved for on the driver (a matrix of fixed size). Isotonic regression over a fixed
number of score bins, counted by Spark, turns raw scores into probabilities.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import keep_rows, numbered, rows_of
from teamlines.llm.shingles import word_hashes
from teamlines.session import materialized

FREQUENCIES = 256
WIDTH = 0.7  # kernel width, in units of the square root of the number of statistics
PENALTY = 1e-3  # of the ridge, a row
BINS = 1000
SEED = 20
ACCEPT = 0.3

# Statistics in order. The symbols are ASCII punctuation that prose seldom has.
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
STATISTICS = (
    "log_chars", "upper", "digits", "white", "marks", "exclaims", "symbols", "wide", "log_words", "word_chars", "distinct_words",
    "most_common", "repeats_last", "distinct_lines", "words_a_line", "words_a_stop", "symbol_words", "shout_words",
)


def _class(members):
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_UPPER, _LETTER, _DIGIT = _class(range(65, 91)), _class([*range(65, 91), *range(97, 123)]), _class(range(48, 58))
_WHITE, _MARKS, _SYMBOL = _class([32, *range(9, 14)]), _class(b".,;:'\"?-()"), _class(SYMBOLS)


def statistics(text):
    """``STATISTICS`` of one text; null and empty texts have zeros."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    if n == 0:
        return np.zeros(len(STATISTICS))
    counts = np.bincount(raw, minlength=256)
    words = word_hashes(data)
    k = len(words)
    letters = counts[_LETTER].sum()
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = lambda table: counts[table].sum() / n
    most = np.unique(words, return_counts=True)[1] if k else np.ones(1)
    parts = data.split()
    marked = sum(1 for w in parts if w.translate(None, SYMBOLS) != w)
    shouted = sum(1 for w in parts if len(w) > 1 and w.isupper())
    return np.array([
        np.log1p(n),
        counts[_UPPER].sum() / max(letters, 1),
        share(_DIGIT),
        share(_WHITE),
        share(_MARKS),
        counts[33] / n,
        share(_SYMBOL),
        counts[128:].sum() / n,
        np.log1p(k),
        np.log1p((n - counts[_WHITE].sum()) / max(k, 1)),
        len(most) / max(k, 1),
        most.max() / max(k, 1),
        np.count_nonzero(words[1:] == words[:-1]) / max(k, 1),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(k / max(len(lines), 1)),
        np.log1p(k / (counts[46] + 1)),
        marked / max(k, 1),
        shouted / max(k, 1),
    ])


def statistics_table(docs: DataFrame, text="text", doc_id="doc_id"):
    """``row_id, doc_id, stats`` of every row, written once."""
    rows = rows_of(docs, doc_id=doc_id, text=text)

    def measure(batches):
        for batch in batches:
            stats = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array(stats, pa.list_(pa.float64()))], names=["row_id", "doc_id", "stats"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return materialized(rows.mapInArrow(measure, f"row_id long, doc_id {kind}, stats array<double>"))


@dataclass(frozen=True)
class Model:
    """What scores need; of fixed size."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    low: float
    high: float
    points: np.ndarray
    levels: np.ndarray

    def features(self, stats):
        scaled = np.clip((stats - self.mean) / self.scale, -5, 5)
        waves = np.cos(scaled @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats):
        return np.clip(self.features(stats) @ self.weights, self.low, self.high)

    def score(self, stats):
        return np.interp(self.raw(stats), self.points, self.levels)


def _matrix(column):
    return np.array(column.to_pylist(), np.float64).reshape(-1, len(STATISTICS))


def _summed(rows: DataFrame, groups=64):
    """Adds the arrays of ``part, i, sums`` over ``part``, in two levels so that no task adds those of all parts."""

    def add(key, table):
        total = np.sum(np.stack(table.column("sums").to_numpy(zero_copy_only=False)), axis=0)
        return pa.table({"part": [0], "i": [table.column("i")[0].as_py()], "sums": [total]}, schema=schema)

    schema = pa.schema([("part", pa.int64()), ("i", pa.int64()), ("sums", pa.list_(pa.float64()))])
    kind = "part long, i long, sums array<double>"
    some = rows.withColumn("group", F.pmod("part", F.lit(groups))).groupBy("i", "group").applyInArrow(add, kind)
    return some.groupBy("i").applyInArrow(add, kind)


def isotonic(counts, sums):
    """Levels that never fall and are nearest to ``sums / counts``, by pooling neighbours that violate."""
    blocks = []
    for n, s in zip(counts, sums):
        blocks.append([n, s, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, s, k = blocks.pop()
            blocks[-1][0] += n
            blocks[-1][1] += s
            blocks[-1][2] += k
    return np.concatenate([np.full(k, s / n) for n, s, k in blocks])


def fit(labelled: DataFrame, frequencies=FREQUENCIES, width=WIDTH, penalty=PENALTY, bins=BINS, seed=SEED):
    """A :class:`Model` of ``stats, label`` over all rows; None if there are none."""
    d = len(STATISTICS)
    at = lambda i: F.col("stats")[i]
    asked = [F.sum(at(i)) for i in range(d)] + [F.sum(at(i) * at(i)) for i in range(d)]
    n, *moments = labelled.agg(F.count("*"), *asked).first()
    if not n:
        return None
    mean = np.array(moments[:d]) / n
    spread = np.sqrt(np.maximum(np.array(moments[d:]) / n - mean**2, 0))
    rng = np.random.default_rng(seed)
    first = Model(
        mean, np.where(spread > 1e-9, spread, 1.0), rng.normal(size=(d, frequencies)) / (width * np.sqrt(d)),
        rng.uniform(0, 2 * np.pi, frequencies), np.zeros(frequencies + 1), -0.5, 1.5, np.zeros(1), np.zeros(1),
    )

    def normal(batches):
        from pyspark import TaskContext

        total = np.zeros((frequencies + 1, frequencies + 2))
        for batch in batches:
            z = first.features(_matrix(batch.column("stats")))
            y = np.array(batch.column("label").to_pylist(), np.float64)
            total += z.T @ np.hstack([z, y[:, None]])
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(total), pa.int64()), pa.array(range(len(total)), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))],
            names=["part", "i", "sums"],
        )

    sums = _summed(labelled.select("stats", "label").mapInArrow(normal, "part long, i long, sums array<double>")).collect()
    total = np.array([r["sums"] for r in sorted(sums, key=lambda r: r["i"])])
    ridge = total[:, :-1] + n * penalty * np.eye(frequencies + 1)
    weights = np.linalg.solve(ridge, total[:, -1])
    fitted = Model(**{**first.__dict__, "weights": weights})
    edges = np.linspace(fitted.low, fitted.high, bins + 1)

    def place(batches):
        for batch in batches:
            raw = fitted.raw(_matrix(batch.column("stats")))
            where = np.clip(np.searchsorted(edges, raw, "right") - 1, 0, bins - 1)
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), batch.column("label")], names=["bin", "label"])

    counted = labelled.select("stats", F.col("label").cast("double").alias("label")).mapInArrow(place, "bin long, label double")
    table = sorted(counted.groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("s")).collect())
    points = np.array([(edges[b] + edges[b + 1]) / 2 for b, _, _ in table])
    levels = isotonic([n for _, n, _ in table], [s for _, _, s in table])
    return Model(**{**fitted.__dict__, "points": points, "levels": np.clip(levels, 0, 1)})


def scores(docs: DataFrame, labels: DataFrame, text="text", doc_id="doc_id", label="quality", accept=ACCEPT, **settings):
    """``row_id, doc_id, held_out, score, predicted`` of every row.

    Labels are learned only from documents whose ``crc32(id) mod 5`` isn't 0; a label of null is
    left out, several labels of an id all count. Without any label each score is 0.5. Null and empty
    texts have statistics of 0 and are scored like others. Equal texts, repeated rows among them, get equal
    scores. Very long texts are measured whole. An empty table gives no rows. Only the named columns are read,
    under names of their own.
    """
    stats = statistics_table(docs, text, doc_id)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    told = labels.select(labels[doc_id].alias("doc_id"), labels[label].alias("label")).where("label IS NOT NULL")
    labelled = materialized(stats.where(~held).join(told, "doc_id").select("stats", "label"))
    model = fit(labelled, **settings)

    def apply(batches):
        for batch in batches:
            found = model.score(_matrix(batch.column("stats"))) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("doc_id"), pa.array(found)], names=["row_id", "doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(apply, f"row_id long, doc_id {kind}, score double")
    return scored.select("row_id", "doc_id", held.alias("held_out"), "score", (F.col("score") >= accept).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, **settings):
    """``docs`` without the rows that the classifier rejects; all columns stay."""
    docs = numbered(docs)
    return keep_rows(docs, scores(docs, labels, **settings).where("predicted = 1"))
