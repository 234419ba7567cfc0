import zlib

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import quality
from tickloom.llm.queries import QUERIES


def test_whole_text_is_seen():
    """A mark in the very last bytes of a long text moves its maxima."""
    net = quality.Network(1)
    plain = "a" * 50_000
    data, halves = quality.padded(plain + "&&&&&")
    base = net.pooled_halves(*quality.padded(plain))
    assert (net.pooled_halves(data, halves)[: len(base) - 1] == base[:-1]).all()
    assert not np.allclose(net.pooled_halves(data, halves)[-1], base[-1])


def test_pooling_agrees_with_one_place_at_a_time():
    net = quality.Network(2)
    data, halves = quality.padded("some words, é and more " * 40)
    places = np.array([sum(net.table[k][data[i + k]] for k in range(quality.WIDTH)) for i in range(halves * quality.HALF)])
    want = places.reshape(halves, quality.HALF, -1).max(axis=1)
    assert np.allclose(net.pooled_halves(data, halves), want, atol=1e-5)


def test_gradients_lower_the_loss():
    good = ["plain words of a good text number %d" % k for k in range(30)]
    bad = ["$$$ ### bad %d ### $$$" % k for k in range(30)]
    examples = [(*quality.chunks_of(t), y) for y, texts in ((1, good), (0, bad)) for t in texts]
    net = quality.train(examples, 0.5, epochs=8)
    assert min(quality.score_text(net, t) for t in good) > 0.6 > 0.4 > max(quality.score_text(net, t) for t in bad)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest table has too few labels to learn from
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = QUERIES["op1_byte_cnn_quality"](spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert np.mean(held) > 0.95


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "word " * 30_000, 3), (None, "x", 4)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (9, None), (None, 1)], "doc_id long, quality int")
    net = quality.learn(docs, labels, F.col("doc_id").isNotNull())
    got = quality.score(docs, net).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got) and got[0].score == got[1].score
    assert quality.learn(docs, labels.where("quality = 1"), F.lit(True)) is None
    assert quality.learn(docs.limit(0), labels.limit(0), F.lit(True)) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(docs.limit(0), net).collect() == []


def test_ids_bound_the_sample(spark, monkeypatch):
    """An id that documents repeat many times is one example and its piece."""
    drawn = []
    monkeypatch.setattr(quality, "train", lambda examples, share: drawn.extend(examples))
    docs = spark.createDataFrame([(1, f"text number {k}") for k in range(500)] + [(2, "another text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    quality.learn(docs, labels, F.lit(True))
    assert len(drawn) == 4 and {y for *_, y in drawn} == {0, 1}


def plain_score(net, text):
    """Every place of the whole text by plain loops: filters, maxima by half chunk, both halves of a chunk, the layers."""
    data, halves = quality.padded(text)
    maxima = []
    for h in range(halves):
        at = [[sum(float(net.table[k][data[i + k]][f]) for k in range(quality.WIDTH)) for f in range(net.table.shape[2])] for i in range(h * quality.HALF, (h + 1) * quality.HALF)]
        maxima.append([max(col) for col in zip(*at)])
    return np.array(maxima)


def test_pooling_of_whole_texts_by_plain_loops():
    net = quality.Network(3)
    for text in ("", "a", "Kurz, é.", "word " * 60):
        data, halves = quality.padded(text)
        assert np.allclose(net.pooled_halves(data, halves), plain_score(net, text), atol=1e-4)
