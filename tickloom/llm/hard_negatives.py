"""Hard negatives: near rows of another label, found through one-bit codes with certain bounds.

Components are integers. A code is the signs of a vector that a fixed matrix with orthonormal
columns turns into at least 512 dimensions. Let w be what the code stands for in the vector's own
space. Stored beside it are how well vector and w agree, which makes a multiple of w the best guess
of the vector, and the length of what remains. An anchor is turned too and cut into eight bit planes,
so its product with w comes from counts of common bits. What remains is at right angles to w, so by
Cauchy and Schwarz its product with the anchor is at most its length times that of the anchor's own
part beside w. Guess and bound give an interval that holds the true score whatever the data; rows
whose interval cannot reach the best of a request are left out, all others are scored in integers.

Coded vectors are written once. Anchors come in blocks, a broadcast of bounded size each; every
task passes its vectors by a block and keeps the best of each request, so vectors are never
shuffled and no pair of anchor and row becomes a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.batches import keep
from tickloom.workspace import new_folder

BITS = 512
PLANES = 8
BLOCK = 2048
ROWS = 4096
#: A task's first rows come in small batches, so that what must be reached is known early.
FIRST = 256
ANCHORS = 128
_WORST = np.iinfo(np.int64).min
_FOUND = "anchor int, slot int, vec_id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def integer_rows(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and v (array of long): floor(scale * component), of the rows that take part.

    Left out are rows whose id, label or vector is null, and vectors that are empty, of another length
    than most (of two as frequent, the longer), hold null or non-finite components, or components so
    large that a score could leave a long. Of rows with one id that with the least label, then the
    least vector, stands for all.
    """
    exact = F.transform("embedding", lambda x: x.cast("double") * scale)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), exact.alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    most = math.isqrt((1 << 62) // sizes.n) if sizes else 0
    fits = lambda x: x.isNotNull() & (F.abs(x) <= float(most))  # noqa: E731  false for NaN, which is above all
    rows = rows.where((F.size("v") == (sizes.n if sizes else 0)) & F.forall("v", fits))
    whole = rows.withColumn("v", F.transform("v", lambda x: F.floor(x)))
    return whole.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.*")


class Coder:
    """Turns, codes and measures vectors."""

    def __init__(self, size: int, seed: int = 0):
        self.bits = 64 * -(-max(BITS, size) // 64)
        rng = np.random.default_rng(seed)
        self.turn = np.linalg.qr(rng.normal(size=(self.bits, size)))[0]

    def signs(self, vectors: np.ndarray) -> np.ndarray:
        return np.packbits(vectors @ self.turn.T > 0, axis=1, bitorder="little").view("<u8")

    def stands_for(self, codes: np.ndarray) -> np.ndarray:
        """w of each code."""
        bits = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little")
        return (2.0 * bits - 1) @ self.turn / math.sqrt(self.bits)

    def measured(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes; the multiple of w nearest to each vector; what remains; the square of w."""
        codes = self.signs(vectors)
        w = self.stands_for(codes)
        square = np.maximum((w * w).sum(axis=1), 1e-30)
        times = (vectors * w).sum(axis=1) / square
        rest = np.linalg.norm(vectors - times[:, None] * w, axis=1)
        return codes, times, rest, square


@dataclass
class Coded:
    """A batch of coded vectors."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    codes: np.ndarray
    times: np.ndarray
    rest: np.ndarray
    square: np.ndarray


class Anchors:
    """A block of anchors with their bit planes and, for each, requests: bounds of scores, best first."""

    def __init__(self, coder: Coder, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.ids, self.labels, self.v = ids, labels, v
        turned = v.astype(float) @ coder.turn.T
        self.low = turned.min(axis=1)
        top = (1 << PLANES) - 1
        self.step = np.maximum((turned.max(axis=1) - self.low) / top, 1e-30)
        levels = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, top).astype(np.uint8)
        self.total = levels.sum(axis=1, dtype=np.int64)
        self.planes = [np.packbits(levels >> b & 1, axis=1, bitorder="little").view("<u8") for b in range(PLANES)]
        off = turned - (self.low[:, None] + self.step[:, None] * levels)
        self.root = math.sqrt(coder.bits)
        self.off = np.abs(off).sum(axis=1) / self.root
        self.length = np.linalg.norm(v.astype(float), axis=1)
        self.bits = coder.bits

    def intervals(self, some: slice, rows: Coded) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of some anchors with every row."""
        shape = len(self.ids[some]), len(rows.ids)
        common = np.zeros(shape, np.int32)
        words = np.ascontiguousarray(rows.codes.T)
        for b, plane in enumerate(self.planes):
            count = np.zeros(shape, np.uint16)
            for k, word in enumerate(words):
                count += np.bitwise_count(plane[some, k, None] & word)
            common += count.astype(np.int32) << b
        ones = np.bitwise_count(rows.codes).sum(axis=1, dtype=np.int64)
        y = self.low[some, None] * (2 * ones - self.bits) + self.step[some, None] * (2 * common - self.total[some, None])
        y /= self.root
        off = self.off[some, None]
        beside = np.sqrt(np.maximum(self.length[some, None] ** 2 - np.maximum(np.abs(y) - off, 0) ** 2 / rows.square, 0))
        half = np.abs(rows.times) * off + rows.rest * beside
        half += 1e-9 * self.length[some, None] * (np.abs(rows.times) + rows.rest + 1) + 1e-6
        guess = rows.times * y
        return guess - half, guess + half


class Best:
    """The k best rows of each request, by score and then the smaller id."""

    def __init__(self, requests: int, k: int):
        self.k, self.requests = k, requests
        self.request = self.ids = self.scores = np.zeros(0, np.int64)

    def add(self, request: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        request, ids, scores = (np.concatenate(x) for x in ((self.request, request), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, request))
        request = request[order]
        first = np.searchsorted(request, request, "left")
        order = order[np.arange(len(request)) - first < self.k]
        self.request, self.ids, self.scores = np.sort(request[np.arange(len(request)) - first < self.k]), ids[order], scores[order]

    def least(self) -> np.ndarray:
        """The score that a row must reach; the lowest of all where there are fewer than k."""
        out = np.full(self.requests, _WORST)
        last = np.flatnonzero(np.append(self.request[1:] != self.request[:-1], True)) if len(self.request) else np.zeros(0, int)
        full = last[np.bincount(self.request, minlength=self.requests)[self.request[last]] >= self.k]
        out[self.request[full]] = self.scores[full]
        return out


def search(anchors: Anchors, rows: Coded, best: Best, low: np.ndarray, high: np.ndarray, same_label: bool) -> int:
    """Put rows between `low` and `high` (anchor by slot) into `best`; how many pairs were scored.

    Request anchor * slots + slot wants rows of the same label, or of others. A row must be able to
    reach the k best found so far; of a request that has fewer, the k best lower ends of intervals
    that lie wholly inside.
    """
    slots, k, scored = low.shape[1], best.k, 0
    reached = best.least().reshape(-1, slots)
    for start in range(0, len(anchors.ids), ANCHORS):
        some = slice(start, min(start + ANCHORS, len(anchors.ids)))
        least, most = anchors.intervals(some, rows)
        fit = ((anchors.labels[some, None] == rows.labels) == same_label) & (anchors.ids[some, None] != rows.ids)
        held = reached[some]
        asked = np.zeros(fit.shape, bool)
        for s in range(slots):
            lo, hi = low[some, s, None], high[some, s, None]
            must = np.maximum(held[:, s, None], lo).astype(float)
            new = np.flatnonzero(held[:, s] == _WORST)
            if len(new) and len(rows.ids) >= k:
                sure = np.where(fit[new] & (least[new] >= lo[new]) & (most[new] <= hi[new]), least[new], -np.inf)
                must[new] = np.maximum(must[new], np.partition(sure, -k, axis=1)[:, -k, None])
            asked |= (most >= must) & (least <= hi)
        at, row = np.nonzero(asked & fit)
        for cut in range(0, len(at), 1 << 16):
            a, r = at[cut : cut + (1 << 16)], row[cut : cut + (1 << 16)]
            scores = np.einsum("ij,ij->i", anchors.v[some][a], rows.v[r])
            for s in range(slots):
                good = (scores >= np.maximum(low[some, s], held[:, s])[a]) & (scores <= high[some, s][a])
                best.add((start + a[good]) * slots + s, rows.ids[r[good]], scores[good])
        scored += len(at)
    return scored


_CODED = "vec_id long, label long, v array<long>, codes array<long>, times double, rest double, square double"


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(n, -1)


def _coded(rows: DataFrame, coder: Coder) -> DataFrame:
    known = rows.sparkSession.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, *figures = known.value.measured(_matrix(batch.column(2), batch.num_rows).astype(float))
            offsets = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, *(pa.array(f) for f in figures)], [c.split()[0] for c in _CODED.split(", ")])

    return rows.select("vec_id", "label", "v").mapInArrow(run, _CODED)


def _found(coded: DataFrame, block: Anchors, low: np.ndarray, high: np.ndarray, same_label: bool, k: int) -> tuple[DataFrame, Broadcast]:
    """The k best of each request: anchor (its place in the block), slot, vec_id, score, rank; and what was sent for it."""
    sent = coded.sparkSession.sparkContext.broadcast((block, low, high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, low, high = sent.value
        best = Best(low.size, k)
        for whole in batches:
            start, size = 0, ROWS if len(best.ids) else FIRST
            while start < whole.num_rows:
                batch = whole.slice(start, size)
                start, size = start + size, min(ROWS, 4 * size)
                v, codes = (_matrix(batch.column(j), batch.num_rows) for j in (2, 3))
                search(block, Coded(np.asarray(batch.column(0)), np.asarray(batch.column(1)), v, codes.view(np.uint64), *(np.asarray(batch.column(j)) for j in (4, 5, 6))), best, low, high, same_label)
        anchor, slot = np.divmod(best.request, low.shape[1])
        columns = [anchor.astype(np.int32), slot.astype(np.int32), best.ids, best.scores]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in _FOUND.split(", ")])

    found = coded.mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), sent


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low_pct: int = 50, high_pct: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, of the table that `integer_rows` gives.

    An anchor's positives are its best other rows of its label. For each, the best rows of other
    labels whose score lies between low_pct and high_pct percent of the positive's; ties go to the
    smaller id. A positive with none has no row; so has an anchor without positives. An empty table
    gives no rows. Positives of one block of anchors pass the driver, 2,048 or so anchors with five each.
    """
    spark = rows.sparkSession
    rows = keep(rows, "integers")
    one = rows.first()
    if one is None:
        return spark.createDataFrame([], RESULT)
    coder = Coder(len(one.v))
    coded = keep(_coded(rows, coder), "coded")
    anchors = coded.where(is_anchor).select("vec_id", "label", "v")
    n_blocks, path = max(1, -(-anchors.count() // BLOCK)), new_folder(spark, "negatives")
    for number in range(n_blocks):
        own = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == number).orderBy("vec_id").collect()
        _mined(coded, coder, own, positives, negatives, low_pct, high_pct).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)


def _mined(coded: DataFrame, coder: Coder, own: list, positives: int, negatives: int, low_pct: int, high_pct: int) -> DataFrame:
    """The result rows of one block of anchors (vec_id, label, v), written."""
    spark = coded.sparkSession
    if not own:
        return spark.createDataFrame([], RESULT)
    block = Anchors(coder, *(np.array([r[j] for r in own], np.int64) for j in range(3)))
    any_score = np.full((len(own), 1), _WORST), np.full((len(own), 1), np.iinfo(np.int64).max)
    found, sent = _found(coded, block, *any_score, same_label=True, k=positives)
    near = found.select("anchor", (F.col("rank") - 1).alias("slot"), "vec_id", "score").collect()
    sent.destroy()
    low, high = np.ones((len(own), positives), np.int64), np.zeros((len(own), positives), np.int64)  # nothing lies between
    for r in near:
        low[r.anchor, r.slot], high[r.anchor, r.slot] = -(-low_pct * r.score // 100), high_pct * r.score // 100
    positive = spark.createDataFrame([(r.anchor, r.slot, own[r.anchor].vec_id, r.vec_id, r.score) for r in near], "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
    found, sent = _found(coded, block, low, high, same_label=False, k=negatives)
    named = found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(F.broadcast(positive), ["anchor", "slot"])
    made = keep(named.select(*[f.split()[0] for f in RESULT.split(", ")]), "block")
    sent.destroy()
    return made
