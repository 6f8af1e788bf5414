"""Held-out accuracy, the gradients, and passages described in pieces."""

import random
import zlib

import numpy as np
import pytest

from callmill.llm import passage_quality, queries

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.op11_quality_classifier(spark, SF_DIR).collect()}
    assert len(got) == 1000
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held_out = [(got[d].score, y, got[d].predicted) for d, y in labels.items() if got[d].held_out]
    good, bad = [s for s, y, _ in held_out if y], [s for s, y, _ in held_out if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.98 and np.mean([p == y for _, y, p in held_out]) > 0.95


def test_labels_of_the_test_fold_are_not_learned_from(spark):
    """The model is the same whatever the labels of that fold are."""
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    fold = passage_quality.in_test_fold(F.col("doc_id"))
    other = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = passage_quality.train(docs, labels, 100), passage_quality.train(docs, other, 100)
    assert all((getattr(one, name) == getattr(two, name)).all() for name in passage_quality.Model.LAYERS)


def model(seed=0):
    r = np.random.default_rng(seed)
    made = passage_quality.fit(np.zeros((0, 144)), np.zeros(0, int), np.zeros(0))
    made.weigh = r.normal(size=passage_quality.WIDTH)
    made.bias = r.normal(size=1)
    return made


def test_gradients():
    x, counts = passage_quality.described([b"Some words here and more " * 20, b"", b"AB!! CD!! " * 100])
    x, y, made = x.astype(float), np.array([1.0, 0.0, 1.0]), model()

    def loss():
        codes, attention = made.passages(x)
        share = passage_quality._shared(attention, counts)
        bags = np.array([(share[:, None] * codes)[a:b].sum(axis=0) for a, b in ((0, 2), (2, 3), (3, 7))])
        p = 1 / (1 + np.exp(-(bags @ made.weigh + made.bias[0])))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    assert counts.tolist() == [2, 1, 4]
    for name, gradient in zip(made.LAYERS, passage_quality._step(made, x, counts, y)):
        layer, at = getattr(made, name), tuple(n // 2 for n in getattr(made, name).shape)
        layer[at] += 1e-5
        high = loss()
        layer[at] -= 2e-5
        low = loss()
        layer[at] += 1e-5
        assert (high - low) / 2e-5 == pytest.approx(gradient[at], rel=1e-3, abs=1e-9)


def test_statistics_of_a_passage():
    rows, counts = passage_quality.described(["Aé b!! b!! 12,\nx$$$ ".encode(), b" \n\t", b"", b"w " * 65])
    assert counts.tolist() == [1, 1, 1, 2]
    size = len("Aé b!! b!! 12,\nx$$$".encode())
    expected = {0: np.log(6) / np.log(65), 1: (3 + 3 + 3 + 3 + 4) / 50, 3: 1 / 4, 4: 2 / size, 5: 3 / size, 6: 4 / size,
                7: 1 / size, 8: 2 / size, 9: 1 / size, 10: 4 / size, 11: 4 / 5, 12: 2 / 5, 13: 1 / 5, 14: 1 / 5, 15: 3 / 5}
    for k, value in expected.items():
        assert rows[0, k] == pytest.approx(value, rel=1e-5), k
    assert not rows[1].any() and not rows[2].any()
    assert rows[3, 11] == pytest.approx(1 / 64) and rows[4, 0] == pytest.approx(np.log(2) / np.log(65))
    alone = [passage_quality.described([t])[0] for t in ("Aé b!! b!! 12,\nx$$$ ".encode(), b"w " * 65)]
    assert (rows[[0, 3, 4]] == np.concatenate(alone)).all()  # whatever stands beside it
    assert (rows[[0, 3], passage_quality.STATISTICS :] ** 2).sum(axis=1) == pytest.approx(1)


def test_long_texts_in_pieces(monkeypatch):
    """A text longer than a piece has the score of its passages put together, and no passage is lost."""
    r = random.Random(1)
    text = " ".join("".join(r.choice("abcD!") for _ in range(r.randint(1, 9))) for _ in range(3000))
    made = model()
    monkeypatch.setattr(passage_quality, "PIECE_BYTES", 2000)
    pieces = passage_quality.cut(text.encode())
    assert b"".join(pieces).decode() == text and max(map(len, pieces)) <= 2000 and len(pieces) > 5
    got, passages, best, weight = passage_quality.scores(["", text, "tail"], made)
    x, counts = passage_quality.described(pieces)
    codes, attention = made.passages(x)
    share = np.exp(attention - attention.max())
    share /= share.sum()
    assert passages.tolist() == [1, counts.sum(), 1] and best[1] == np.argmax(share)
    assert weight[1] == pytest.approx(share.max())
    assert got[1] == pytest.approx(1 / (1 + np.exp(-(share @ codes @ made.weigh + made.bias[0]))))
    assert passage_quality.cut(b"x" * 5000) == [b"x" * 2000, b"x" * 2000, b"x" * 1000]


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert {r.score for r in passage_quality.score(docs, passage_quality.train(docs, labels)).collect()} == {0.5}
