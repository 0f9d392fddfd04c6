"""Language of a text by a small convolutional network over its bytes.

Bytes are embedded, filters of several widths slide over windows of a fixed length, each filter's
largest response in a window is kept, and a softmax names the language. The network is trained in
numpy on all windows of a bounded sample of labelled texts. Whole texts are predicted: neighbouring windows overlap
by the widest filter less one byte, so no run of bytes is cut, and the windows' probabilities are
averaged by their length.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from teamlines.llm.common import numbered, rows_of

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
SAMPLE = 250  # documents a language that training takes, by hash of the row; fewer are all taken. Each is read whole
LANGUAGES = 256  # that are learned: the most frequent ones
EPOCHS = 3
LEAST_STEPS = 600  # of training; few windows are gone through more often
AT_ONCE = 512
SEED = 7
UNKNOWN = "und"


@dataclass
class Network:
    languages: list
    embedding: np.ndarray
    filters: list
    biases: list
    dense: np.ndarray
    shift: np.ndarray

    def pooled(self, windows, keep=None):
        """The largest response of each filter, and where it was if ``keep`` is a list."""
        embedded = self.embedding[windows]
        out = []
        for weights, bias, width in zip(self.filters, self.biases, WIDTHS):
            size = windows.shape[1] - width + 1
            spread = np.concatenate([embedded[:, i : i + size] for i in range(width)], axis=2)
            response = spread.reshape(-1, spread.shape[2]) @ weights
            response = response.reshape(len(windows), size, -1)
            if keep is None:
                out.append(response.max(axis=1))
            else:
                at = response.argmax(axis=1)
                keep.append((spread, at))
                out.append(np.take_along_axis(response, at[:, None], axis=1)[:, 0])
            out[-1] = np.maximum(out[-1] + bias, 0)
        return np.concatenate(out, axis=1)

    def probabilities(self, windows):
        return softmax(self.pooled(windows) @ self.dense + self.shift)


def softmax(x):
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(data: bytes, size=WINDOW):
    """Overlapping windows of all of ``data``, the last one filled up with zero bytes."""
    step = size - max(WIDTHS) + 1
    n = max(1, -(-(len(data) - size) // step) + 1)
    padded = np.zeros((n - 1) * step + size, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, size)[::step]


def train(texts, labels, epochs=EPOCHS, seed=SEED, rate=0.01, batch=64, steps=LEAST_STEPS):
    """A :class:`Network` from texts and their languages, by Adam on the cross entropy."""
    languages = sorted(set(labels))
    pieces = [windows_of(t.encode()) for t in texts]
    x = np.concatenate(pieces)
    y = np.repeat([languages.index(v) for v in labels], [len(p) for p in pieces])
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.normal(size=shape) * np.sqrt(2 / shape[0])).astype(np.float32)
    net = Network(
        languages, rng.normal(size=(256, EMBEDDING)).astype(np.float32), [draw(w * EMBEDDING, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS], draw(FILTERS * len(WIDTHS), len(languages)), np.zeros(len(languages), np.float32),
    )
    held = [net.embedding, *net.filters, *net.biases, net.dense, net.shift]
    speed, power = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held]
    turn = 0
    for _ in range(max(epochs, -(-steps // -(-len(x) // batch)))):
        order = rng.permutation(len(x))
        for begin in range(0, len(x), batch):
            turn += 1
            rows = order[begin : begin + batch]
            for p, g, m, v in zip(held, _gradients(net, x[rows], y[rows]), speed, power):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return net


def _gradients(net, x, y):
    kept = []
    pooled = net.pooled(x, kept)
    error = softmax(pooled @ net.dense + net.shift)
    error[np.arange(len(y)), y] -= 1
    error /= len(y)
    back = (error @ net.dense.T) * (pooled > 0)
    embedding, filters, biases = np.zeros_like(net.embedding), [], []
    for i, ((spread, at), weights, width) in enumerate(zip(kept, net.filters, WIDTHS)):
        part = back[:, i * FILTERS : (i + 1) * FILTERS]
        best = spread[np.arange(len(x))[:, None], at]  # the bytes that gave each filter's maximum
        filters.append(np.einsum("nfd,nf->df", best, part))
        biases.append(part.sum(axis=0))
        into = part[:, :, None] * weights.T[None]
        for j in range(width):
            which = x[np.arange(len(x))[:, None], at + j]
            np.add.at(embedding, which.ravel(), into[:, :, j * EMBEDDING : (j + 1) * EMBEDDING].reshape(-1, EMBEDDING))
    return [embedding, *filters, *biases, pooled.T @ error, error.sum(axis=0)]


def predict(net, texts):
    """``(language, share)`` of each text: the largest average probability of its windows. Ties go to the first name."""
    held, owners, total = [], [], [np.zeros(len(net.languages)) for _ in texts]

    def flush():
        if held:
            found = net.probabilities(np.concatenate(held))
            at = 0
            for i, part in zip(owners, held):
                total[i] += found[at : at + len(part)].sum(axis=0)
                at += len(part)
            held.clear()
            owners.clear()

    waiting = 0
    for i, text in enumerate(texts):
        windows = windows_of(text.encode())
        for begin in range(0, len(windows), AT_ONCE):
            held.append(windows[begin : begin + AT_ONCE])
            owners.append(i)
            waiting += len(held[-1])
            if waiting >= AT_ONCE:
                flush()
                waiting = 0
    flush()
    return [(net.languages[int(t.argmax())], float(t.max() / t.sum())) for t in total]


def sample_of(labelled: DataFrame, sample=SAMPLE, most=LANGUAGES):
    """``lang, text`` of the first ``sample`` rows of each language by a hash of the row, all if there are fewer.

    ``labelled`` has ``row_id, lang, text``. Languages beyond the ``most`` frequent ones are left out, so at most
    ``most * sample`` whole texts leave the tasks. Only languages and row numbers are shuffled, and Spark limits
    these per language before it does. Rows that repeat have numbers of their own, so equal rows are sampled like others.
    """
    named = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).select("lang")
    mixed = Window.partitionBy("lang").orderBy(F.xxhash64("row_id"), "row_id")
    first = labelled.select("lang", "row_id").withColumn("nth", F.row_number().over(mixed)).where(F.col("nth") <= sample)
    chosen = first.join(F.broadcast(named), "lang", "left_semi").select("row_id")  # at most sample * most rows
    rows = labelled.join(F.broadcast(chosen), "row_id", "left_semi").select("lang", "row_id", "text").collect()
    return sorted(rows, key=lambda r: (r["lang"], r["row_id"]))


def languages(docs: DataFrame, text="text", lang="lang", doc_id="doc_id", sample=SAMPLE, **settings):
    """``row_id, doc_id, held_out, lang_pred, score`` of every row.

    The network learns only from documents with a language whose ``crc32(id) mod 4`` isn't 2, from at most
    ``sample`` of each of the ``LANGUAGES`` most frequent languages, which are read whole. A text that is null or
    has no letter is ``und`` with score 0, and so is every text if nothing was learned. Languages that tie go to the
    first by name. Equal texts, repeated rows among them, get equal results; rows without id are held out of
    learning but named. Very long texts are named by all their windows. An empty table gives no rows. Only the named
    columns are read, under names of their own.
    """
    docs = numbered(docs)
    rows = rows_of(docs, doc_id=doc_id, text=text, lang=lang)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    known = rows.where(~held & letter & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("row_id", "text", "lang")
    taken = sample_of(known, sample)
    net = train([r["text"] for r in taken], [r["lang"] for r in taken], **settings) if taken else None

    def name(batches):
        for batch in batches:
            texts, told = batch.column("text").to_pylist(), batch.column("letter").to_pylist()
            asked = [i for i, ok in enumerate(told) if ok and net]
            langs, shares = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for i, (value, share) in zip(asked, predict(net, [texts[i] for i in asked]) if asked else []):
                langs[i], shares[i] = value, share
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), batch.column("held_out"), pa.array(langs), pa.array(shares)],
                names=["row_id", "doc_id", "held_out", "lang_pred", "score"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    asked = rows.select("row_id", "doc_id", held.alias("held_out"), "text", letter.alias("letter"))
    return asked.mapInArrow(name, f"row_id long, doc_id {kind}, held_out boolean, lang_pred string, score double")
