"""Quality and language: held-out results, learning rules and awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from teamlines.llm import langid, quality
from teamlines.llm.common import read_table

MIDDLE = "/root/testdata/sf0.01"


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def area(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    values, inverse, counts = np.unique(np.array(scores)[order], return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    ranks[order] = (ends - (counts - 1) / 2)[inverse]
    good = np.array(labels) == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_of_held_out_documents(spark):
    docs, labels = read_table(spark, MIDDLE, "documents"), read_table(spark, MIDDLE, "labels")
    found = {r.doc_id: r for r in quality.scores(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (crc(d) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in found.items())
    asked = [(found[r.doc_id].score, r.quality) for r in labels.collect() if r.doc_id in found and found[r.doc_id].held_out]
    assert area(*zip(*asked)) > 0.95


def test_held_out_labels_change_nothing(spark, written):
    docs, labels = read_table(spark, "/root/testdata/sf0.001", "documents"), read_table(spark, "/root/testdata/sf0.001", "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = {r.doc_id: r.score for r in quality.scores(docs, labels).collect()}
    two = {r.doc_id: r.score for r in quality.scores(docs, turned).collect()}
    assert one == two


SCHEMA = "doc_id long, text string, lang string, stats string, score double, label int, row_id int, kept string"
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, "the and of it", "en"), (4, "the and of it", None), (None, "der die und das", "de"),
    (5, "12 34 !!", "de"), (6, "word " * 100_000, "en"), (7, "der die und das nicht", "de"), (7, "der die und das nicht", "de"), (8, "\U0001f600", "en"), (9, "é", None),
]


def table(written, rows=ROWS):
    return written([(*r, "s", 0.5, 1, 2, "k") for r in rows], SCHEMA)


def test_quality_of_awkward_rows(written):
    docs = table(written)
    for name, told in (("none", []), ("one", [(3, 1)]), ("some", [(3, 1), (3, None), (5, 0), (6, 0), (7, 1), (7, 1), (1, 0), (99, 1), (None, 1)])):
        labels = written([(*t, "x") for t in told], "doc_id long, quality int, stats string", name)
        found = quality.scores(docs, labels).collect()
        assert len(found) == len(ROWS)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
        assert len({r.score for r in found if r.doc_id in (3, 4)}) == 1
        if not told:
            assert {r.score for r in found} == {0.5}
        kept = quality.keep_good(docs, labels)
        assert kept.columns == docs.columns
        assert kept.count() == sum(r.predicted for r in found)
    assert quality.scores(table(written_as(written, "empty"), []), labels).count() == 0


def written_as(written, name):
    return lambda rows, schema: written(rows, schema, name)


def test_isotonic_levels():
    assert quality.isotonic([1, 1, 1], [1, 0, 1]).tolist() == [0.5, 0.5, 1.0]
    assert quality.isotonic([2, 2, 4], [0, 1, 4]).tolist() == [0, 0.5, 1]
    rng = np.random.default_rng(0)
    n, s = rng.integers(1, 9, 200), rng.random(200)
    levels = quality.isotonic(n, s * n)
    assert (np.diff(levels) >= 0).all() and abs((levels * n).sum() - (s * n).sum()) < 1e-9


def test_normal_equations_summed_by_parts(spark, written):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(quality.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    model = quality.fit(written([(r.tolist(), float(v)) for r, v in zip(x, y)], "stats array<double>, label double"), frequencies=40)
    z = model.features(x)
    want = np.linalg.solve(z.T @ z + 300 * quality.PENALTY * np.eye(41), z.T @ y)
    assert np.allclose(model.weights, want)


def test_language_of_held_out_documents(spark):
    docs = read_table(spark, MIDDLE, "documents")
    found = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    asked = [r.lang_pred == r.lang for r in found if r.held_out]
    assert np.mean(asked) > 0.97


def test_language_of_awkward_rows(written):
    found = langid.languages(table(written)).collect()
    got = sorted(((str(r.doc_id), r.lang_pred, r.score > 0) for r in found))
    assert len(found) == len(ROWS)
    assert {g for g in got if g[0] in ("1", "2", "5", "8")} == {(i, "und", False) for i in ("1", "2", "5", "8")}
    assert all(g[1] in ("en", "de") and g[2] for g in got if g[0] not in ("1", "2", "5", "8"))
    blank = langid.languages(table(written_as(written, "blank"), [(1, "text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in blank] == [("und", 0.0)]
    assert langid.languages(table(written_as(written, "none"), [])).count() == 0


def test_held_out_languages_change_nothing(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.languages(docs).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in langid.languages(docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))).collect()}
    assert one == two


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    x, y = rng.integers(1, 40, (6, 20)).astype(np.uint8), rng.integers(0, 3, 6)
    net = langid.train(["abc def", "ghi jkl", "mno"], ["a", "b", "c"], epochs=1, steps=1)
    for name in ("embedding", "dense", "shift"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters, net.biases = [w.astype(np.float64) for w in net.filters], [b.astype(np.float64) for b in net.biases]
    loss = lambda: -np.log(net.probabilities(x)[np.arange(len(y)), y]).mean()
    params = [net.embedding, *net.filters, *net.biases, net.dense, net.shift]
    for p, g in zip(params, langid._gradients(net, x, y)):
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in p.shape)
            if p is net.embedding:
                at = (int(x[0, 3]), at[1])
            old = p[at]
            p[at] = old + 1e-6
            high = loss()
            p[at] = old - 1e-6
            low = loss()
            p[at] = old
            assert g[at] == pytest.approx((high - low) / 2e-6, abs=1e-5)


def test_windows_cover_every_byte():
    for n in (0, 1, 127, 128, 129, 252, 253, 254, 10_000):
        data = bytes(range(1, 251)) * (n // 250 + 1)
        data = data[:n]
        found = langid.windows_of(data)
        step = langid.WINDOW - max(langid.WIDTHS) + 1
        back = b"".join(bytes(w[:step]) for w in found[:-1]) + bytes(found[-1])
        assert back[:n] == data and not back[n:].strip(b"\0")
        assert len(found) == 1 or found[-1][max(langid.WIDTHS) - 1 :].any()


def plain_prediction(net, text):
    """Language and share by single windows, places and filters."""
    data, size = text.encode(), langid.WINDOW
    step, total = size - max(langid.WIDTHS) + 1, np.zeros(len(net.languages))
    begin = 0
    while True:
        window = list(data[begin : begin + size]) + [0] * max(0, size - len(data) + begin)
        pooled = []
        for weights, bias, width in zip(net.filters, net.biases, langid.WIDTHS):
            for f in range(weights.shape[1]):
                best = max(
                    sum(float(net.embedding[window[i + j]] @ weights[j * langid.EMBEDDING : (j + 1) * langid.EMBEDDING, f]) for j in range(width))
                    for i in range(size - width + 1)
                )
                pooled.append(max(best + float(bias[f]), 0))
        logits = np.array(pooled) @ net.dense.astype(float) + net.shift
        share = np.exp(logits - logits.max())
        total += share / share.sum()
        begin += step
        if begin + max(langid.WIDTHS) - 1 >= len(data):
            break
    return net.languages[int(np.argmax(total))], total.max() / total.sum()


def test_predictions_equal_a_plain_network():
    texts = ["the cat sat on the mat " * 12, "der Hund und die Katze " * 12, "le chat noir est là " * 12]
    net = langid.train(texts, ["en", "de", "fr"], epochs=4)
    asked = [t[:n] for t in texts for n in (1, 5, 128, 200)] + ["ünïcödé \U0001f600"]
    for text, (name, share) in zip(asked, langid.predict(net, asked)):
        want = plain_prediction(net, text)
        assert name == want[0] and share == pytest.approx(want[1], abs=1e-4)


def test_repeated_rows_are_sampled_like_others(spark, written):
    rows = [(5_000, "immer die gleiche Zeile " * 3, "de")] * 3_000 + [(i, f"some line of words {i}", "en") for i in range(100)] + [(i, f"quelques mots {i}", "fr") for i in range(3)]
    docs = table(written, rows)
    known = langid.rows_of(docs, doc_id="doc_id", text="text", lang="lang").select("row_id", "text", "lang")
    taken = langid.sample_of(known, 40)
    assert {v: sum(r.lang == v for r in taken) for v in ("de", "en", "fr")} == {"de": 40, "en": 40, "fr": 3}
    assert all(r.text in {t for _, t, _ in rows} for r in taken)
    assert {r.lang for r in langid.sample_of(known, 40, most=2)} == {"de", "en"}
    found = langid.languages(docs, sample=40).collect()
    assert {r.lang_pred for r in found if r.doc_id == 5_000} == {"de"}
