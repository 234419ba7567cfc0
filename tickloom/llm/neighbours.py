"""Nearest vectors by inner product: multi-index hashing over learned rotated binary codes.

Codes are the signs of rotated vectors. Rotations are learned on a bounded sample: each starts at
random and is turned, step by step, so that the vectors come near their own signs. Unequal lengths
are evened out first by one more component, which keeps the order of inner products.

A code is split into substrings and each is indexed. Two codes within Hamming radius r agree, in
one substring of m at least, within r / m bits; probing the substrings' indexes that far therefore
finds every code within r. Those within r are reranked by the vectors. The radius is the one that
holds the wanted share of true neighbours in the sample; queries that find too few widen it.

Vectors are packed in shards, written once. Queries come in blocks, a broadcast of bounded size each;
every task takes the block past its shards and keeps the best so far. Vectors are not shuffled again, and
pairs of query and candidate never become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.batches import keep
from tickloom.workspace import new_folder

SAMPLE = 4096
ROTATIONS = 4
STEPS = 30
SUBSTRING = 16
RECALL = 0.98
SHARD = 8192
BLOCK = 128
QUERIES = 4096
FOUND = "query_id long, vec_id long, score double"


class Coder:
    """Learned rotations, the length that all vectors are brought to, and the search radius."""

    def __init__(self, sample: np.ndarray, longest: float, k: int, recall: float = RECALL, seed: int = 0):
        """`sample` holds vectors as rows, `longest` is the greatest length of all vectors."""
        self.longest = longest
        rng = np.random.default_rng(seed)
        rows = self.evened(sample)
        self.rotations = [self._turned(rows, rng) for _ in range(ROTATIONS)]
        self.bits = sum(r.shape[1] for r in self.rotations)
        self.radius = self._radius(sample, k, recall)

    @staticmethod
    def _turned(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        turn, _ = np.linalg.qr(rng.normal(size=(rows.shape[1], rows.shape[1])))
        for _ in range(STEPS):  # the rotation that takes the rows nearest to their present signs
            u, _, v = np.linalg.svd(rows.T @ np.sign(rows @ turn))
            turn = u @ v
        return turn

    def evened(self, vectors: np.ndarray) -> np.ndarray:
        """Candidates on a sphere; directions of queries are not changed by it."""
        x = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))
        return np.concatenate([x, rest], axis=1) if (rest > 1e-3).any() or not len(x) else np.concatenate([x, np.zeros_like(rest)], axis=1)

    def _signs(self, rows: np.ndarray) -> np.ndarray:
        bits = np.concatenate([rows @ r > 0 for r in self.rotations], axis=1)
        spare = -bits.shape[1] % 64
        bits = np.pad(bits, ((0, 0), (0, spare)))
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        return self._signs(self.evened(vectors))

    def query_codes(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return self._signs(np.concatenate([x, np.zeros((len(x), 1))], axis=1))

    def _radius(self, sample: np.ndarray, k: int, recall: float) -> int:
        """Bits that hold the wanted share of the true neighbours in the sample."""
        queries = sample[:256]
        inner = queries @ sample.T
        inner[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            return self.bits
        best = np.argpartition(-inner, k - 1, axis=1)[:, :k]
        far = distances(self.query_codes(queries)[:, None], self.codes(sample)[best])
        return int(np.quantile(far, recall, method="higher"))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class MultiIndex:
    """Substrings of codes, each with its values and, for every code, the place of its value."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.codes = codes
        parts = codes.view("<u2")[:, : -(-bits // SUBSTRING)]
        self.tables = [np.unique(part, return_inverse=True) for part in parts.T]

    def within(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """For each query, which codes differ from it in `radius` bits at most.

        If every substring differed in more bits than it is probed for, the codes would differ in
        more than `radius`.
        """
        found = np.zeros((len(queries), len(self.codes)), bool)
        near, first = divmod(radius, len(self.tables))
        parts = queries.view("<u2")
        for k, (values, place) in enumerate(self.tables):
            reach = near if k <= first else near - 1
            if reach < 0:
                break
            found |= (np.bitwise_count(values ^ parts[:, k, None]) <= reach)[:, place]
        for own, query in zip(found, queries):
            at = np.flatnonzero(own)
            own[at] = distances(self.codes[at], query) <= radius
        return found


def distinct(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id once, with the best of its scores."""
    order = np.lexsort((-scores, ids))
    first = np.ones(len(ids), bool)
    first[1:] = np.diff(ids[order]) != 0
    return ids[order[first]], scores[order[first]]


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in an order that its length alone decides: equal rows have equal scores wherever they stand."""
    return (rows * query).sum(axis=1)


def best_in_shard(index: MultiIndex, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, codes: np.ndarray, radius: int, bits: int, k: int) -> list:
    """For each query, ids and scores of the k best ids in a shard, best first, ties to the smaller id.

    Rows of one id are one candidate with the best of their scores, if one of them is found. A matrix
    product picks those that may be among the best, within its error; they are scored again by `products`.
    """
    out: list = [None] * len(query_ids)
    todo = np.arange(len(query_ids))
    names, place = np.unique(ids, return_inverse=True)
    by_name = np.argsort(place, kind="stable")
    starts = np.searchsorted(place[by_name], np.arange(len(names)))
    longest = np.sqrt((vectors * vectors).sum(axis=1).max(initial=0.0))
    while len(todo):
        found = index.within(codes[todo], radius) & (ids != query_ids[todo, None])
        if len(names) < len(ids):
            some = np.logical_or.reduceat(found[:, by_name], starts, axis=1)
            found, count = some[:, place], some.sum(axis=1)
        else:
            count = found.sum(axis=1)
        enough = (count >= k) | (radius >= bits)
        for q, own in zip(todo[enough], found[enough]):
            at = np.flatnonzero(own)
            if len(at) > k:
                rough = vectors[at] @ queries[q]
                once = distinct(ids[at], rough)[1] if len(names) < len(ids) else rough
                if len(once) > k:  # none that ties with the k-th is left out
                    error = 1e-15 * len(queries[q]) * longest * np.sqrt(queries[q] @ queries[q])
                    at = at[rough >= np.partition(once, -k)[-k] - 2 * error]
            own_ids, scores = ids[at], products(vectors[at], queries[q])
            if len(names) < len(ids):
                own_ids, scores = distinct(own_ids, scores)
            order = np.lexsort((own_ids, -scores))[:k]
            out[q] = own_ids[order], scores[order]
        todo, radius = todo[~enough], radius + len(index.tables)
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (array of double) of the rows that take part.

    Left out are rows whose id or vector is null, and vectors that are empty, of another length
    than most (of two as frequent, the longer), zero, or hold null or non-finite components.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def packed(rows: DataFrame, per_row: int) -> DataFrame:
    """Rows with up to about `per_row` vectors each: ids and vectors as doubles."""
    parts = max(1, -(-rows.count() // per_row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        for batch in batches:
            ids.append(np.asarray(batch.column(0)))
            vectors.append(np.asarray(batch.column(1).flatten()))
        if sum(map(len, ids)):
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(x).tobytes()], pa.binary()) for x in (ids, vectors)], ["ids", "vectors"])

    return rows.repartition(parts).mapInArrow(run, "ids binary, vectors binary")


def _unpacked(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(vectors, np.float64).reshape(len(own), -1)


def fit(rows: DataFrame, k: int, sample: int = SAMPLE, recall: float = RECALL) -> Coder | None:
    """A coder from `sample` vectors, those whose ids hash lowest, one of each id; None if there are no vectors."""
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    lowest = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    drawn = rows.join(F.broadcast(lowest), "vec_id").groupBy("vec_id").agg(F.max("v").alias("v")).orderBy(F.xxhash64("vec_id"), "vec_id").collect() if longest else []
    return Coder(np.array([r.v for r in drawn]), float(np.sqrt(longest)), k, recall) if drawn else None


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 20, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k nearest found in `vectors`, its own id left out.

    Both tables have vec_id and embedding; a query's rows of the same id count as its own. Score
    is the inner product in double precision. Ids that repeat in `vectors` are one candidate, the
    best; ids that repeat in `queries` are one query, with the best score over its rows. Extra columns are not looked at; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = keep(usable(vectors), "vectors")
    coder = fit(rows, k, sample, recall)
    asked = usable(queries)
    if coder is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = coder.rotations[0].shape[0] - 1
    asked = keep(asked.where(F.size("v") == size).dropDuplicates(["vec_id", "v"]), "queries")
    shards = keep(packed(rows, SHARD), "shards")
    n_blocks, path = -(-asked.count() // QUERIES), new_folder(spark, "nearest")
    for number in range(n_blocks):
        # a block of a stated query set passes the driver, so its size is bounded
        own = asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)) == number).orderBy("vec_id", "v").collect()
        sent = spark.sparkContext.broadcast((coder, np.array([r.vec_id for r in own], np.int64), np.array([r.v for r in own], float).reshape(len(own), size)))
        shards.mapInArrow(_search(sent, k), FOUND).write.mode("append").parquet(path)
        sent.destroy()
    if not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = spark.read.schema(FOUND).parquet(path).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(sent, k: int):
    """Arrow function from shards to the k best of each query of a block among the shards of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, query_ids, queries = sent.value
        codes, held = coder.query_codes(queries), {}
        for batch in batches:
            for n in range(batch.num_rows):
                ids, vectors = _unpacked(*(batch.column(j)[n].as_py() for j in range(2)))
                index = MultiIndex(coder.codes(vectors), coder.bits)
                for start in range(0, len(query_ids), BLOCK):
                    some = slice(start, start + BLOCK)
                    best = best_in_shard(index, ids, vectors, query_ids[some], queries[some], codes[some], coder.radius, coder.bits, k)
                    for q, (found, scores) in zip(query_ids[some].tolist(), best):
                        if q in held:
                            found, scores = distinct(np.concatenate([held[q][0], found]), np.concatenate([held[q][1], scores]))
                            order = np.lexsort((found, -scores))[:k]
                            found, scores = found[order], scores[order]
                        held[q] = found, scores
        if held:
            columns = [np.repeat(list(held), [len(x[0]) for x in held.values()]), *(np.concatenate([x[j] for x in held.values()]) for j in range(2))]
            kinds = pa.int64(), pa.int64(), pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "vec_id", "score"])

    return run
