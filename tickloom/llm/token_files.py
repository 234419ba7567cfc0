"""Token ids of a corpus in compressed files, in ascending doc_id order.

A file row is a segment: some documents in order, one table of frequencies over all their ids,
and blocks coded with it (see rans.py), each of which decodes alone. Segments are rows of a
Parquet data set, so any store that Spark writes can hold them and readers take them in parallel.

    part, segment       place: parts are ranges of doc_id in order, segments count from 0 in each
    doc_ids, lengths    documents in order and their ids, end id included
    n_tokens            sum of lengths
    table               frequencies, packed
    blocks              n_tokens, crc32, words, checkpoints (states, word)
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.llm import rans
from tickloom.llm.batches import small_batches
from tickloom.llm.tokens import encoder

DOCS_PER_PART = 20_000
MAX_PARTS = 100_000
SEGMENT_TOKENS = 1 << 20
WORDS_KEPT = 100_000
BLOCK_TOKENS = rans.LANES * rans.TOKENS_PER_LANE
SEGMENT = (
    "part int, segment int, doc_ids array<long>, lengths array<long>, n_tokens long, table binary, "
    "blocks array<struct<n_tokens: long, crc32: long, words: binary, checkpoints: array<struct<states: binary, word: long>>>>"
)
DOCUMENT = "part int, segment int, place int, doc_id long, before long, n_tokens long, ids_crc32 long"


def _segment(part: int, number: int, docs: list, ids: list[np.ndarray]) -> dict:
    flat = np.concatenate(ids)
    table = rans.Table.of(flat)
    return {
        "part": part, "segment": number, "doc_ids": docs, "lengths": [len(x) for x in ids], "n_tokens": len(flat), "table": table.pack(),
        "blocks": [rans.encode(flat[k : k + BLOCK_TOKENS], table) for k in range(0, len(flat), BLOCK_TOKENS)],
    }


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, per_part: int = DOCS_PER_PART) -> None:
    """Encode documents (doc_id, text) and write them, smallest doc_id first, null ones before all.

    A null or empty text has the end id alone. Rows that repeat a doc_id, or have none, stand side by
    side, by a hash of their texts; parts are ranges of both, so many of them are many tasks' work.
    Texts are put in order before they are encoded: a task goes from texts to segments.
    """
    text = F.col("text").cast("string")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    parts = max(1, min(MAX_PARTS, -(-docs.count() // per_part)))
    placed = source.repartitionByRange(parts, "doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    schema = to_arrow_schema(T.StructType.fromDDL(SEGMENT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, ids, size = None, 0, [], [], 0
        end = struct.pack("<I", end_id)
        with encoder(tokenizer, kept=WORDS_KEPT) as words:
            for batch in small_batches(batches):
                for doc, text, part in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part"))):
                    held.append(doc)
                    ids.append(np.frombuffer(words.encode(text) + end, "<u4"))
                    size += len(ids[-1])
                    if size >= SEGMENT_TOKENS:
                        yield pa.RecordBatch.from_pylist([_segment(part, number, held, ids)], schema)
                        number, held, ids, size = number + 1, [], [], 0
        if held:
            yield pa.RecordBatch.from_pylist([_segment(part, number, held, ids)], schema)

    numbered = placed.select("doc_id", "text", F.spark_partition_id().alias("part"))
    # the words have no repeats left to find
    numbered.mapInArrow(run, SEGMENT).write.option("compression", "none").parquet(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """part, segment and the number of ids before it: a sum over parts, then over a part's segments."""
    sizes = segments.select("part", "segment", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # MAX_PARTS + 1 rows at most
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", earlier.alias("part_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return sizes.join(F.broadcast(parts), "part").select("part", "segment", (F.col("part_start") + F.col("inside")).alias("segment_start"))


def segment_ids(row: dict) -> np.ndarray:
    """All ids of a segment, block by block, each against its checksum."""
    table = rans.Table.unpack(row["table"])
    return np.concatenate([rans.decode(b, table) for b in row["blocks"]])


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, and `ids` if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = segment_ids(row).astype("<u4")
                ends = np.cumsum(row["lengths"])
                begins = ends - row["lengths"]
                parts = [ids[a:b].tobytes() for a, b in zip(begins, ends)]
                n = len(parts)
                columns = [[row["part"]] * n, [row["segment"]] * n, list(range(n)), row["doc_ids"], begins.tolist(), row["lengths"], [zlib.crc32(x) for x in parts], *([parts] if with_ids else [])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    segments = spark.read.schema(SEGMENT).parquet(path)
    names = ["part", "segment", "place", "doc_id", "before", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
    found = segments.mapInArrow(run, DOCUMENT + (", ids binary" if with_ids else ""))
    placed = found.join(segment_starts(segments), ["part", "segment"])
    return placed.select("doc_id", (F.col("segment_start") + F.col("before")).alias("start"), *names[5:])
