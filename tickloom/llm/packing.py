"""Documents packed into sequences of a fixed number of tokens.

Bounded-space online best fit: pieces arrive one by one, a fixed number of bins is open, and a
piece goes to the open bin it fills best. The free spaces of the open bins are the set bits of
one integer, so the best bin is its lowest set bit at or above the piece's length. When one bin
too many is open, the fullest is closed.

Documents are encoded once; what is packed is their lengths. Pieces are dealt evenly over tasks
and each task packs its own, so no task or driver sees all of them. A task leaves at most
`open_bins` bins partly filled.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.batches import keep, small_batches
from tickloom.llm.tokens import encoder

CAPACITY = 2048
OPEN_BINS = 1024
PIECES_PER_TASK = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACES = "sequence_id long, offset long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first."""
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, first if s == 0 and first else capacity) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (doc_id, text): PIECES, and `ids` if wanted.

    A text that is null or empty has the end id alone. Documents that repeat are cut once per
    row. Other columns are left out. `ids` are little-endian unsigned 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = struct.pack("<I", end_id)
        with encoder(tokenizer) as words:
            for batch in small_batches(batches):
                rows: list[tuple] = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = words.encode(text) + end
                    for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * s : 4 * (s + n)]
                        rows.append((doc, k, s, n, zlib.crc32(part), *([part] if with_ids else [])))
                columns = list(zip(*rows)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


class Packer:
    """Online best fit with a bounded number of open bins."""

    def __init__(self, capacity: int, open_bins: int, first_number: int = 0):
        self.capacity, self.open_bins, self.next = capacity, open_bins, first_number
        self.free = 0  # bit f: a bin with f free places is open
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        self.n_open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Number of the bin and the place in it for a piece of 1 to `capacity` tokens."""
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.next
            self.next += 1
        left = space - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.n_open += 1
            if self.n_open > self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
        return number, self.capacity - space


def place_pieces(cuts: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Add sequence_id and offset to pieces. `cuts` is read twice: hand over a written table.

    Pieces are dealt round robin, which Spark makes repeatable by sorting first, and packed in
    the order of doc_id and piece; a task that runs again makes the same sequences.
    """
    tasks = max(1, -(-cuts.count() // per_task))
    names = cuts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            spots = [packer.place(n) for n in batch.column("length").to_pylist()]
            numbers, offsets = zip(*spots) if spots else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())], [*names, "sequence_id", "offset"])

    dealt = cuts.repartition(tasks).sortWithinPartitions("doc_id", "piece", "ids_crc32")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cuts.schema)
    return dealt.mapInArrow(run, f"{schema}, {PLACES}")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document, with its sequence and its place there.

    Columns: PIECES and PLACES, and `ids` if wanted. No documents: no rows.
    """
    return place_pieces(keep(pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity, open_bins)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces packed with ids: sequence_id, n_tokens, ids.

    A sequence has at most `capacity` pieces, so the groups are small.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
