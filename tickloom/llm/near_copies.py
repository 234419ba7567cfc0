"""Near copies by the Jaccard coefficient of their sets of word shingles.

Rows with the same set are one node. Candidates are found by SimHash as in op5 (simhash.py): each
node has a fingerprint of its distinct three-word shingles, all fingerprints within RADIUS bits are
linked, and the nodes of a class meet, so no pair within RADIUS bits is missed. Most sets at 0.8 are
further apart than any such search can reach, so MinHash adds to these: the least values of a set
under BANDS * ROWS hashes are cut into bands, and two sets that agree in a whole band meet too.

Every candidate is confirmed on the sets themselves. In a bucket, a class or a band, all are first
compared with one of them; then those of its members that this left in different components are
compared with each other (in a class those within RADIUS bits), so that a group of many copies costs
what its rows cost and no such pair is left out.

Sets at 0.8 agree in a band of 6 with 0.26, and in none of 24 with 0.0007.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tickloom.llm import simhash
from tickloom.llm.batches import free_name, keep, small_batches
from tickloom.llm.components import components

AT_LEAST = 0.8
SHINGLE = 5
#: Bits that fingerprints of one class may differ in from link to link; a bucket agrees on 20 or more.
RADIUS = 4
BANDS = 24
ROWS = 6
SEED = 42
_CHUNK = 1024
_RNG = np.random.default_rng(SEED)
_TURN = _RNG.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
_TIMES = _RNG.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending; a text of fewer words is one shingle.

    A-Z are lower-cased and words are parted by ASCII white space.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    begins = [0, *(gaps[: len(words) - shingle] + 1).tolist()]
    ends = [*gaps[shingle - 1 :].tolist(), len(line)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b], SEED) for a, b in zip(begins, ends)], np.uint64))


def bands(own: np.ndarray) -> list[int]:
    """A signed number for each band of a set; an empty set has none."""
    if not len(own):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(own), _CHUNK):
        least = np.minimum(least, ((own[start : start + _CHUNK] ^ _TURN) * _TIMES).min(axis=1))
    raw = least.tobytes()
    size = ROWS * 8
    return [_signed(xxhash.xxh64_intdigest(raw[k * size : (k + 1) * size], k)) for k in range(BANDS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _node(own: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(own.tobytes(), SEED))


def fingerprint(text: str | None) -> int:
    """SimHash of a text's distinct shingles, as a signed number.

    Shingles are op5's; that repeats count once keeps one line, many times over, from making unlike
    texts alike.
    """
    return _signed(simhash.majority(shingles(text, simhash.SHINGLE)))


def _marked(rows: DataFrame, shingle: int) -> DataFrame:
    """doc_id, hash, node, size, fingerprint and bands of rows (doc_id, hash, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(2).to_pylist()
            sets = [shingles(t, shingle) for t in texts]
            numbers = [pa.array(c, pa.int64()) for c in ([_node(s) for s in sets], [len(s) for s in sets], [fingerprint(t) for t in texts])]
            columns = [batch.column(0), batch.column(1), *numbers, pa.array([bands(s) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "node", "size", "fp", "bands"])

    return rows.mapInArrow(run, "doc_id long, hash long, node long, size long, fp long, bands array<long>")


def _classes(nodes: DataFrame) -> DataFrame:
    """node, size, fp and bucket: the SimHash class, of fingerprints linked within RADIUS bits."""
    linked = simhash.classes(keep(nodes.select("fp").distinct(), "fingerprints"), RADIUS).toDF("linked", "root")
    named = nodes.join(linked, nodes["fp"] == linked["linked"], "left")
    # a number that is a band's too would only make candidates
    return named.select("node", "size", "fp", F.xxhash64(F.lit("class"), F.coalesce("root", "fp")).alias("bucket"))


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """node and own (the set) of rows (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            made = pa.array([shingles(t, shingle).tobytes() for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["node", "own"])

    return rows.mapInArrow(run, "node long, own binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, at_least: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets reach the coefficient."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(common >= at_least * (len(x) + len(y) - common) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    with_a = pairs.join(sets.toDF("a", "own_a"), "a")
    return with_a.join(sets.toDF("b", "own_b"), "b").select("a", "b", "own_a", "own_b").mapInArrow(run, "a long, b long")


def _roots(marked: DataFrame, rows: DataFrame, at_least: float, shingle: int) -> DataFrame:
    """node and root of the nodes that are linked with others."""
    nodes = marked.dropDuplicates(["node"])
    classed = keep(_classes(nodes), "classes")
    spread = classed.union(nodes.select("node", "size", F.lit(None).cast("long"), F.explode("bands")))
    many = spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("centre")).where("n > 1").drop("n")
    met = keep(spread.join(many, "bucket"), "buckets")
    chosen = marked.join(met.select("node").distinct(), "node").groupBy("node").agg(F.min(F.struct("doc_id", "hash")).alias("r"))
    texts = rows.join(chosen.select("node", "r.*"), ["doc_id", "hash"]).select("node", "text").dropDuplicates(["node"])
    sets = keep(_sets(texts, shingle), "shingles")
    stars = met.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    links = keep(_confirmed(stars, sets, at_least), "stars")
    roots = components(links)
    named = met.join(roots, "node", "left").select("bucket", "node", "size", "fp", F.coalesce("root", "node").alias("root"))
    mixed = named.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("bucket")
    apart = keep(named.join(mixed, "bucket"), "apart")
    other = apart.toDF("bucket", "node_b", "size_b", "fp_b", "root_b")
    alike = (F.col("root") < F.col("root_b")) & (F.least("size", "size_b") >= at_least * F.greatest("size", "size_b") - 1e-9)
    near = F.coalesce(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_b"))) <= RADIUS, F.lit(True))  # bands have no fp
    rest = apart.join(other, "bucket").where(alike & near).select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()
    return components(links.union(keep(_confirmed(rest, sets, at_least), "rest")))


def drop_near_copies(docs: DataFrame, at_least: float = AT_LEAST, shingle: int = SHINGLE) -> DataFrame:
    """Documents less all but one row of each group of near copies; the smallest doc_id stays.

    Groups are linked by pairs that reach the coefficient. Rows that share a doc_id are judged by
    their own texts; of those with the smallest doc_id of a group, one with the smallest text hash
    stays. Texts without words, and null ones, are copies of each other. Documents without a
    doc_id all stay.
    """
    text = F.col("text").cast("string")
    hashed = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), hashed.alias("hash"), text.alias("text"))
    marked = keep(_marked(rows, shingle), "marked")
    roots = _roots(marked, rows, at_least, shingle)
    least = marked.groupBy("node").agg(F.min(F.struct("doc_id", "hash")).alias("r"))
    named = least.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("r").alias("r"))
    own_id, own_hash = free_name(docs, "_stays"), free_name(docs, "_hash")
    stays = named.select(F.col("r.doc_id").alias(own_id), F.col("r.hash").alias(own_hash + "_"))
    known = docs.withColumn(own_hash, hashed)
    here = (known["doc_id"].cast("long") == stays[own_id]) & (known[own_hash] == stays[own_hash + "_"])
    kept = known.join(stays, here, "left_semi").dropDuplicates(["doc_id", own_hash]).drop(own_hash)
    return kept.unionByName(docs.where("doc_id IS NULL"))
