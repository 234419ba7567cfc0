"""Quality of a text by a small convolutional network over its bytes.

Filters of a few bytes slide over the whole UTF-8 text. Their answers are max-pooled over
overlapping chunks that cover it from end to end; a hidden layer judges each chunk, and the mean
and the maximum of its units over all chunks give one probability. Filters and layers are learned
by gradient descent, all in numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.batches import small_batches, with_columns
from tickloom.llm.sampling import sample_per_class

WIDTH = 5
FILTERS = 24
HIDDEN = 12
HALF = 192  # chunks are two halves long and begin at every half
DOCS_PER_CLASS = 1500
#: Of a document to learn from, this many evenly spread chunks at most, and a short piece.
CHUNKS_PER_DOC = 24
PIECE = (12, 160)
EPOCHS = 12
BATCH = 16
MIN_STEPS = 800  # few examples are gone over more often
RATE = 0.004


class Network:
    """table: answers of the filters to each byte at each place; then the layers' weights."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.table = draw(WIDTH, 256, FILTERS, scale=0.3)
        self.bias = np.zeros(FILTERS, np.float32)
        self.hidden = draw(FILTERS + 1, HIDDEN, scale=0.3)
        self.hidden_bias = np.zeros(HIDDEN, np.float32)
        self.out = draw(2 * HIDDEN, scale=0.3)
        self.out_bias = np.zeros(1, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def answers(self, data: np.ndarray) -> np.ndarray:
        """The filters at every place of the bytes that has WIDTH - 1 more behind it."""
        n = len(data) - WIDTH + 1
        total = self.table[0].take(data[:n], axis=0)
        for k in range(1, WIDTH):
            total += self.table[k].take(data[k : k + n], axis=0)
        return total

    def pooled_halves(self, data: np.ndarray, halves: int) -> np.ndarray:
        """Maxima of the filters over each half; data has HALF bytes for each and WIDTH - 1 more."""
        out = np.empty((halves, FILTERS), np.float32)
        step = 64
        for k in range(0, halves, step):
            m = min(step, halves - k)
            out[k : k + m] = self.answers(data[k * HALF : (k + m) * HALF + WIDTH - 1]).reshape(m, HALF, FILTERS).max(axis=1)
        return out


def padded(text: str | None) -> tuple[np.ndarray, int]:
    """A text's bytes up to a whole number of halves (one at least) and a filter's width; zeros fill up."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    halves = max(1, -(-len(raw) // HALF))
    data = np.zeros(halves * HALF + WIDTH - 1, np.uint8)
    data[: len(raw)] = raw
    return data, halves


def _fill(n_bytes: int, chunks: int) -> np.ndarray:
    """How full each chunk is."""
    return np.clip((n_bytes - np.arange(chunks) * HALF) / (2 * HALF), 0, 1).astype(np.float32)


def score_text(net: Network, text: str | None) -> float:
    data, halves = padded(text)
    pooled = net.pooled_halves(data, halves)
    chunks = max(1, halves - 1)
    if halves > 1:
        pooled = np.maximum(pooled[:-1], pooled[1:])
    size = len((text or "").encode("utf-8", "surrogatepass"))
    return float(judge(net, pooled, _fill(size, chunks), np.zeros(chunks, np.int64), 1)[0][0])


def judge(net: Network, pooled: np.ndarray, fill: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple:
    """Probabilities of documents from their chunks (`doc` is sorted), and what learning needs."""
    x = np.concatenate([np.tanh(pooled + net.bias), fill[:, None]], axis=1)
    h = np.tanh(x @ net.hidden + net.hidden_bias)
    first = np.searchsorted(doc, np.arange(n_docs))
    count = np.bincount(doc, minlength=n_docs).astype(np.float32)
    mean = np.add.reduceat(h, first) / count[:, None]
    top = np.maximum.reduceat(h, first)
    z = np.concatenate([mean, top], axis=1)
    p = 1 / (1 + np.exp(-np.clip(z @ net.out + net.out_bias, -30, 30)))
    return p, x, h, z, top, count


def train(examples: list[tuple[list[bytes], np.ndarray, int]], share: float, seed: int = 0, epochs: int = EPOCHS) -> Network:
    """Learn from (chunks of 2 HALF + WIDTH - 1 bytes, how full each is, label).

    Classes weigh as if a `share` of all were of label 1. Adam, in mini-batches; only the places
    of the maxima have gradients.
    """
    net, rng = Network(seed), np.random.default_rng(seed)
    weights = net.weights()
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    epochs = max(epochs, -(-MIN_STEPS * BATCH // len(examples)))
    drawn, step = np.mean([label for *_, label in examples]), 0
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(len(examples)), max(1, len(examples) // BATCH)):
            step += 1
            rows = [examples[k] for k in part]
            chunks = np.frombuffer(b"".join(c for own, *_ in rows for c in own), np.uint8).reshape(-1, 2 * HALF + WIDTH - 1)
            doc = np.repeat(np.arange(len(rows)), [len(own) for own, *_ in rows])
            fill = np.concatenate([own for _, own, _ in rows])
            y = np.array([label for *_, label in rows], np.float32)
            pooled, spot = _pool(net, chunks)
            p, x, h, z, top, count = judge(net, pooled, fill, doc, len(rows))
            weight = np.where(y > 0, share / drawn, (1 - share) / (1 - drawn))
            dz = ((p - y) * weight / len(rows)).astype(np.float32)
            g_out, g_out_bias = z.T @ dz, dz.sum(keepdims=True)
            dmean, dtop = np.split(dz[:, None] * net.out, 2, axis=1)
            dh = (dmean / count[:, None])[doc] + np.where(h == top[doc], dtop[doc], 0)
            dh *= 1 - h * h
            g_hidden, g_hidden_bias = x.T @ dh, dh.sum(axis=0)
            dx = (dh @ net.hidden.T)[:, :FILTERS] * (1 - x[:, :FILTERS] ** 2)
            g_table = np.zeros_like(net.table)
            rows_, filters = np.repeat(np.arange(len(chunks)), FILTERS), np.tile(np.arange(FILTERS), len(chunks))
            for k in range(WIDTH):
                np.add.at(g_table[k], (chunks[rows_, spot.ravel() + k], filters), dx.ravel())
            grads = [g_table, dx.sum(axis=0), g_hidden, g_hidden_bias, g_out, g_out_bias]
            rate = RATE * (1 - epoch / epochs)
            for w, g, a, b in zip(weights, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    return net


def _pool(net: Network, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maxima of the filters over whole chunks, and where they are."""
    pooled = np.empty((len(chunks), FILTERS), np.float32)
    spot = np.empty((len(chunks), FILTERS), np.int64)
    for k, chunk in enumerate(chunks):
        own = net.answers(chunk)
        spot[k] = own.argmax(axis=0)
        pooled[k] = own[spot[k], np.arange(FILTERS)]
    return pooled, spot


def chunks_of(text: str | None, most: int = CHUNKS_PER_DOC) -> tuple[list[bytes], np.ndarray]:
    """Chunks to learn from, evenly spread if there are more than `most`, and how full they are."""
    data, halves = padded(text)
    size = len((text or "").encode("utf-8", "surrogatepass"))
    if halves == 1:
        data = np.concatenate([data[:HALF], np.zeros(HALF + WIDTH - 1, np.uint8)])
    n = max(1, halves - 1)
    picks = np.unique(np.linspace(0, n - 1, min(n, most)).round().astype(int))
    return [data[k * HALF : (k + 2) * HALF + WIDTH - 1].tobytes() for k in picks], _fill(size, n)[picks]


def piece_of(text: str | None) -> str:
    """A short piece of a text, so that short texts are known too; the same at each run."""
    text = text or ""
    rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    n = int(rng.integers(*PIECE))
    start = int(rng.integers(0, max(1, len(text) - n)))
    return text[start : start + n]


def learn(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = DOCS_PER_CLASS) -> Network | None:
    """A network from a bounded sample: `per_class` documents of each label, CHUNKS_PER_DOC chunks of each.

    `docs` has doc_id and text (of several rows of an id, the least text), `labels` doc_id and quality (0 or 1; of several, the larger).
    `usable` is a condition on doc_id. None if a class has no document.
    """
    marked = labels.where(usable & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {r.quality: r["count"] for r in marked.groupBy("quality").count().collect()}
    if len(sizes) < 2:
        return None
    sample = sample_per_class(marked, "quality", "doc_id", per_class)  # 2 per_class rows at most

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(2).to_pylist()
            made = [chunks_of(t) for t in [*texts, *map(piece_of, texts)]]
            columns = [pa.array(batch.column(k).to_pylist() * 2, t) for k, t in enumerate((pa.int64(), pa.int32()))]
            columns += [pa.array([b"".join(c) for c, _ in made], pa.binary()), pa.array([f.tobytes() for _, f in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "chunks", "fill"])

    own = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # one row for an id that `docs` repeats, so that ids bound what reaches the driver
    rows = own.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"), F.min("text").alias("text"))
    size = 2 * HALF + WIDTH - 1
    examples = []
    for r in sorted(rows.mapInArrow(cut, "doc_id long, quality int, chunks binary, fill binary").collect(), key=lambda r: (r.doc_id, bytes(r.chunks))):
        raw = bytes(r.chunks)
        examples.append(([raw[k : k + size] for k in range(0, len(raw), size)], np.frombuffer(r.fill, np.float32), r.quality))
    if len({label for *_, label in examples}) < 2:
        return None
    return train(examples, sizes[1] / (sizes[0] + sizes[1]))


def score(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Documents with `score`, the probability that the whole text is good (null texts: as empty ones).

    Without a network it is 0.5. A column of that name gives way.
    """
    known = docs.sparkSession.sparkContext.broadcast(net)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        net = known.value
        return {"score": [score_text(net, t) if net else 0.5 for t in batch.column(0).to_pylist()]}

    return with_columns(docs, "score double", work, [text])
