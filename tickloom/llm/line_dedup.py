"""Lines that many documents repeat, kept in one of them only.

Two Bloom filters hold the hashes of line keys seen once and seen twice. Every task fills a pair
from its documents, pairs are merged, and a second pass takes the lines that the filter of the
twice seen knows: only these suspects are shuffled, to be counted exactly and to find the
document that keeps them. Filters grow with the number of documents up to a bound; beyond it they
let more lines through to the shuffle, and results stay exact.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.batches import free_name, keep, small_batches, with_columns

MIN_CHARS = 20
MIN_DOCS = 3
BITS_PER_DOC = 64  # about eight bits for each of eight lines
MAX_BITS = 1 << 30
HASHES = 4
SEGMENT_BYTES = 1 << 18
WHITE = " \t\n\r\x0b\x0c"


def line_keys(text: str | None, min_chars: int) -> set[bytes]:
    """Distinct keys of a text's lines: ends stripped, A-Z lower-cased, `min_chars` code points or more."""
    lines = (line.strip(WHITE) for line in (text or "").split("\n"))
    return {line.encode().lower() for line in lines if len(line) >= min_chars}


class Bloom:
    """Bits under hashes; `size` is a power of two."""

    def __init__(self, size: int, data: bytes | None = None):
        self.size = size
        self.bits = np.zeros(size // 8, np.uint8) if data is None else np.frombuffer(data, np.uint8)

    def _spots(self, hashes: np.ndarray) -> np.ndarray:
        low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
        steps = np.arange(HASHES, dtype=np.uint64)[:, None]
        return ((low + steps * high) & np.uint64(self.size - 1)).astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        for spots in self._spots(hashes):
            np.bitwise_or.at(self.bits, spots >> 3, (1 << (spots & 7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for spots in self._spots(hashes):
            found &= (self.bits[spots >> 3] >> (spots & 7).astype(np.uint8) & 1).astype(bool)
        return found


def filter_size(n_docs: int, bits_per_doc: int = BITS_PER_DOC, max_bits: int = MAX_BITS) -> int:
    return min(max_bits, 1 << max(16, (bits_per_doc * n_docs - 1).bit_length()))


def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Once and twice of two sets of documents: what both have seen once is seen twice."""
    return a[0] | b[0], a[1] | b[1] | (a[0] & b[0])


def seen_twice(docs: DataFrame, size: int, min_chars: int) -> bytes:
    """Bits of the filter of keys that two documents or more may hold; `size` bits at most reach the driver."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bloom(size), Bloom(size)
        for batch in small_batches(batches):
            hashes = [xxhash.xxh64_intdigest(k) for text in batch.column(0).to_pylist() for k in line_keys(text, min_chars)]
            values, counts = np.unique(np.array(hashes, np.uint64), return_counts=True)
            twice.add(values[(counts > 1) | once.has(values)])
            once.add(values)
        pairs = [(once.bits[k : k + SEGMENT_BYTES], twice.bits[k : k + SEGMENT_BYTES]) for k in range(0, size // 8, SEGMENT_BYTES)]
        rows = [(k, *(zlib.compress(x.tobytes(), 1) for x in p)) for k, p in enumerate(pairs) if p[0].any()]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["segment", "once", "twice"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by segment; one pair is held at a time."""
        at, held = None, None
        out: list[tuple[int, bytes]] = []
        for batch in batches:
            for segment, *pair in zip(*(c.to_pylist() for c in batch.columns)):
                new = tuple(np.frombuffer(zlib.decompress(x), np.uint8) for x in pair)
                if segment != at and held is not None:
                    out.append((at, zlib.compress(held[1].tobytes(), 1)))
                at, held = segment, new if segment != at else merge(held, new)
        if held is not None:
            out.append((at, zlib.compress(held[1].tobytes(), 1)))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["segment", "twice"])

    filled = docs.select("text").mapInArrow(fill, "segment int, once binary, twice binary")
    united = filled.repartition("segment").sortWithinPartitions("segment").mapInArrow(unite, "segment int, twice binary")
    bits = bytearray(size // 8)
    for row in united.toLocalIterator():
        part = zlib.decompress(row.twice)
        bits[row.segment * SEGMENT_BYTES : row.segment * SEGMENT_BYTES + len(part)] = part
    return bytes(bits)


def suspects(docs: DataFrame, size: int, bits: bytes, min_chars: int) -> DataFrame:
    """(line, doc_id) of lines that may stand in several documents; a line is the md5 of its key."""
    known = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = Bloom(size, known.value)
        for batch in small_batches(batches):
            doc, keys = [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = line_keys(text, min_chars)
                keys += found
                doc += [d] * len(found)
            hit = np.flatnonzero(twice.has(np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64))).tolist()
            lines = [hashlib.md5(keys[k]).digest() for k in hit]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), pa.array([doc[k] for k in hit], pa.int64())], ["line", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "line binary, doc_id long")


def lines_to_drop(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id and the lines (md5 of keys) that it loses.

    Counts are of distinct doc_id and are added up before the shuffle, so a line that a third of
    all documents hold is many small counts. Null doc_id count as one document below all others.
    """
    size = filter_size(docs.count())
    found = keep(suspects(docs, size, seen_twice(docs, size, min_chars), min_chars), "suspects")
    held = found.groupBy("line", "doc_id").agg(F.lit(1).alias("one"))
    repeated = held.groupBy("line").agg(F.sum("one").alias("n_docs"), F.max("doc_id").alias("keeper")).where(F.col("n_docs") >= min_docs)
    # written, so that both sides of the join are shuffled and Spark may split a line that many hold
    lost = found.join(keep(repeated, "repeated"), "line").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Documents with `text` less its repeated lines, and n_lines (before) and n_dropped (both long).

    A key of at least `min_chars` code points found in at least `min_docs` documents stays in the
    largest doc_id that holds it. A null text stays null and counts as one line, as does an empty
    one. Columns named n_lines or n_dropped give way. Rows that share a doc_id are one document.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lost = lines_to_drop(source, min_chars, min_docs)
    whole = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")])
    owner, lines = free_name(whole, "_owner"), free_name(whole, "_lines")
    lost = lost.select(F.col("doc_id").alias(owner), F.col("lines").alias(lines))
    joined = whole.join(lost, whole["doc_id"].cast("long").eqNullSafe(F.col(owner)), "left")
    others = [c for c in whole.columns if c.lower() != "text"]

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        texts, before, after = [], [], []
        for text, gone in zip(*(c.to_pylist() for c in batch.columns)):
            parts = (text or "").split("\n")
            before.append(len(parts))
            if gone:
                known = set(gone)
                parts = [x for x in parts if not is_one_of(x, known, min_chars)]
                text = "\n".join(parts)
            texts.append(text)
            after.append(len(parts))
        return {"text": texts, "n_lines": before, "n_dropped": [a - b for a, b in zip(before, after)]}

    made = with_columns(joined, "text string, n_lines long, n_dropped long", work, ["text", lines], others)
    return made.select(*[F.col(f"`{c}`") for c in whole.columns], "n_lines", "n_dropped")


def is_one_of(line: str, keys: set[bytes], min_chars: int) -> bool:
    """Whether the md5 of a line's key is among these."""
    line = line.strip(WHITE)
    return len(line) >= min_chars and hashlib.md5(line.encode().lower()).digest() in keys
