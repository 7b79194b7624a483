"""The classifier: its parts against plain loops, its accuracy on texts it has not learned."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.llm import toxicity as op

SF = "/root/testdata/sf0.1"


def test_features_tell_words_apart():
    ids, doc = op.features(["Bad words, bad!", "", "ab", "12", "été"])
    assert doc.tolist() == [0] * 5 + [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3
    rows = ids.tolist()
    assert rows[0] == rows[2] and rows[0] != rows[1] and not any(rows[3]) and not any(rows[5])
    # "bad" has no start or end shorter than itself; "words" has starts of 3 and 4 letters.
    assert [bool(x) for x in rows[0]] == [False, False, False, True, False]
    assert [bool(x) for x in rows[1]] == [True, True, False, True, True]
    assert op.features(["words"])[0][0].tolist() == rows[1] and op.features(["drows"])[0][0, 3] != rows[1][3]
    prefix = op.features(["wordy words"])[0]
    assert prefix[0, :2].tolist() == prefix[1, :2].tolist() and prefix[0, 3] != prefix[1, 3]


def plain_pooled(net, ids):
    words = net.table[ids].sum(axis=1)
    real = max(1, len(ids) - op._PAD)
    out = []
    for w in op.WIDTHS:
        for f in range(op.FILTERS):
            out.append(max(0.0, max(
                sum(words[i + k] @ net.filters[w][k][:, f] for k in range(w)) + net.offset[w][f]
                for i in range(real))))
    return out


def test_pooling_against_loops(monkeypatch):
    rng = np.random.default_rng(1)
    net = op.Network.fresh(3)
    net.table[1:] = rng.normal(size=(op.BUCKETS - 1, op.DEPTH))
    for w in op.WIDTHS:
        net.offset[w][:] = rng.normal(size=op.FILTERS)
    texts = ["one two three four", "", "x", " ".join(random.Random(2).choices("ab cd efg hij".split(), k=50)), "1"]
    want = [plain_pooled(net, op.features([t])[0]) for t in texts]
    for at_once in (1 << 16, 7):  # long texts go piece by piece
        monkeypatch.setattr(op, "_WORDS", at_once)
        ids, doc = op.features(texts)
        np.testing.assert_allclose(net.pooled(ids, doc, len(texts)), want, rtol=1e-4, atol=1e-4)


def test_gradients_against_differences():
    rng = np.random.default_rng(5)
    net = op.Network.fresh(5)
    ids = [op.features([t])[0] for t in ("alpha beta gamma delta", "beta alpha", "gamma")]
    net.table[1:] = rng.normal(size=(op.BUCKETS - 1, op.DEPTH)) * 0.5
    toxic, weight = np.array([True, False, True]), np.ones(3)

    def loss():
        net._projected = None
        z = np.array([plain_pooled(net, i) for i in ids]) @ net.out + net.bias
        return float(np.sum(np.log1p(np.exp(-z)) * toxic + np.log1p(np.exp(z)) * ~toxic))

    seen = {}

    class Recorder(op._Adam):
        def move(self, name, value, gradient):
            seen[name] = gradient.copy()

    moved = op._move_rows
    op._move_rows = lambda table, gradient, touched, adam: seen.update(table=gradient.copy())
    try:
        op._step(net, Recorder(0.0), ids, toxic, weight)
    finally:
        op._move_rows = moved
    for name, value in (("filters-2", net.filters[2]), ("out", net.out), ("table", net.table)):
        flat, gradient = value.reshape(-1), seen[name].reshape(-1)
        for at in np.argsort(-abs(gradient))[:4]:
            step, old = 1e-2, flat[at]
            flat[at] = old + step
            up = loss()
            flat[at] = old - step
            down = loss()
            flat[at] = old
            assert (up - down) / (2 * step) == pytest.approx(gradient[at], rel=0.1, abs=1e-3)


def corpus(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))
    rows = []
    for i in range(300):
        words = [word() for _ in range(rng.randint(20, 60))]
        if i % 5 == 0:
            words[rng.randrange(len(words))] = "zorg"
        rows.append((i, " ".join(words), "en", int(i % 5 == 0)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int"), rows


def test_learns_a_word_and_scores_all_rows(spark):
    docs, labels, rows = corpus(spark)
    more = spark.createDataFrame(
        [(7, rows[7][1], "en"), (None, "zorg zorg", None), (401, None, "en"), (402, "", "xx"), (403, "1 2", "en"),
         (404, "word " * 50_000 + "zorg", "en"), (405, "word " * 50_000, "en")], docs.schema)
    labels = labels.union(spark.createDataFrame([(None, 1), (9999, 1), (401, 0), (3, None), (0, 0)], labels.schema))
    every = docs.union(more).selectExpr("*", "1 AS score", "2 AS toxic", "3 AS predicted", "4 AS r")
    model = op.train(every, labels.selectExpr("*", "'de' AS lang", "'zorg' AS text"))
    found = op.score(every, model).collect()
    assert len(found) == 307 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    want = {r[0]: r[3] for r in rows}
    assert sum(r.predicted == want[r.doc_id] for r in found if r.doc_id in want) >= 0.98 * 301
    by_id = {r.doc_id: r.predicted for r in found if r.doc_id is None or r.doc_id > 400}
    assert by_id == {None: 1, 401: 0, 402: 0, 403: 0, 404: 1, 405: 0}


def test_the_sample_is_bounded_and_takes_an_id_once(spark):
    docs, labels, _ = corpus(spark)
    long = spark.createDataFrame([(0, "zorg " * 5000, "en")], docs.schema)
    rows = op.sample(docs.union(long).union(docs), labels.union(labels), most=20).collect()
    assert len(rows) == 40 == len({r.doc_id for r in rows}) and sum(r.toxic for r in rows) == 20
    assert max(len(r.text) for r in rows) <= 10_000


def test_tables_without_labels_or_rows(spark):
    docs, labels, _ = corpus(spark)
    for some in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        model = op.train(docs, some)
        assert {(r.score, r.predicted) for r in op.score(docs, model).collect()} == {(0.0, 0)}
    assert op.score(docs.limit(0), op.train(docs, labels)).collect() == []
    assert op.score(docs, op.train(docs.limit(0), labels)).count() == 300


def test_thresholds_are_per_language():
    logits = np.concatenate((np.linspace(0, 1, 50), np.linspace(2, 3, 50), np.linspace(10, 11, 50), np.linspace(14, 15, 50)))
    toxic = np.repeat([False, True, False, True], 50)
    found, default = op._calibrated(logits, toxic, ["en"] * 100 + ["de"] * 100)
    assert 1 < found["en"] < found["de"] < 14 and found["de"] > 10
    assert op._calibrated(logits, toxic * False, ["en"] * 200) == ({}, 0.0)


def test_held_out_part(spark):
    ids = spark.range(500).selectExpr("id AS doc_id").union(spark.sql("SELECT CAST(NULL AS LONG)"))
    for r in ids.select("doc_id", op.held_out().alias("out")).collect():
        assert r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = op.train(docs, labels.where(~op.held_out()))
    found = op.score(docs, model).where(op.held_out()).join(labels, "doc_id")
    rates = {r.toxic: r.rate for r in found.groupBy("toxic").agg(F.avg("predicted").alias("rate")).collect()}
    assert rates[1] > 0.85 and rates[0] < 0.03


def test_thresholds_come_from_all_labels_that_trained_nothing(spark):
    docs, labels, rows = corpus(spark)
    model = op.train(docs, labels, most=20)
    found = op.judged(docs, model)
    texts = {r.doc_id: r for r in found.collect()}
    want = {r[0]: r[3] for r in rows}
    rest = [i for i in want if i not in set(model.learned)]
    assert len(model.learned) == 30 and len(rest) == 270
    steps = np.round(np.array([texts[i].logit for i in rest]) * 1024) / 1024
    assert op.thresholds(found, labels, model) == op._calibrated(
        steps, np.array([want[i] for i in rest], bool), [texts[i].lang for i in rest])
    scored = op.score_calibrated(docs.union(docs.limit(1)), labels, model)
    assert scored.count() == 301 and scored.columns == ["doc_id", "score", "predicted"]
    assert all(r.predicted == (r.score >= 0.7) for r in scored.collect())
    assert op.score_calibrated(docs, labels.limit(0), op.train(docs, labels.limit(0))).count() == 300
