"""Near copies by 64-bit fingerprints that differ in a few bits.

Equal fingerprints are one node. Two fingerprints within `radius` bits agree on all but `radius`
of any cut into blocks, so each node goes to one bucket for every choice of agreeing blocks, and
links are sought inside buckets only. A bucket with too many nodes is dealt out again over blocks
of its remaining bits; what then shares a bucket has few bits left to differ in, so it is bounded.

Inside buckets fingerprints are compared bit-sliced: plane b holds bit b of all fingerprints, 64
to a word. To compare every fingerprint with the one s places on, planes are shifted by s and
differences are counted in carry-save counters, one word operation for 64 distances. Words whose
64 distances all exceed the radius, or lie outside a bucket, are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.batches import free_name, keep, small_batches
from tickloom.llm.components import components

RADIUS = 2
SHINGLE = 3
SEED = 42
BLOCKS = 4
#: More nodes than this in a bucket are dealt out again.
MAX_BUCKET = 1024
CHUNK = 1 << 15
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64 bits: each is 1 if over half of the shingles' hashes have it. No words: 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    begins = [0, *(gaps[: len(words) - shingle] + 1).tolist()]
    ends = [*gaps[shingle - 1 :].tolist(), len(line)]
    digest = xxhash.xxh64_digest
    return majority(np.frombuffer(b"".join([digest(line[a:b], seed) for a, b in zip(begins, ends)]), ">u8"))


def majority(hashes: np.ndarray) -> int:
    """Unsigned 64 bits: each is 1 if over half of the 64-bit hashes have it. No hashes: 0."""
    octets = hashes.astype(">u8", copy=False).view(np.uint8).reshape(-1, 8)
    ones = [np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)]
    return int.from_bytes(np.packbits(np.concatenate(ones) * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row of documents (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = np.array([fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, fp long")


def _blocks(bits: list[int], count: int) -> list[list[int]]:
    """The bits in `count` blocks of consecutive ones."""
    return [list(map(int, b)) for b in np.array_split(bits, count)]


def _masks(bits: list[int], radius: int) -> list[int]:
    """For every choice of blocks that two fingerprints within the radius may agree on, its bits."""
    blocks = _blocks(bits, radius + 2)
    return [sum(1 << b for block in some for b in block) for some in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket(fp: Column, mask: int, number: int) -> Column:
    return F.struct(F.lit(number).alias("cut"), fp.bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("bits"))


def buckets(nodes: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """fp and bucket of all nodes in buckets of two or more; `nodes` has distinct fp.

    With radius + 2 blocks two agree, 32 bits of 64 at radius 2. In a large bucket the same is done
    with the other bits, so 16 bits are left free and at most 65,536 nodes meet.
    """
    masks = _masks(list(range(64)), radius)
    rows = nodes.select("fp", F.explode(F.array(*[_bucket(F.col("fp"), m, k) for k, m in enumerate(masks)])).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(sizes, "bucket")
    fine = []
    for k, m in enumerate(masks):
        rest = [b for b in range(64) if not m >> b & 1]
        fine += [(k, m | sub, len(masks) + len(masks) * k + j) for j, sub in enumerate(_masks(rest, radius))]
    again = F.array(*[F.when(F.col("bucket.cut") == k, _bucket(F.col("fp"), m, n)) for k, m, n in fine])
    large = rows.where(F.col("n") > max_bucket).select("fp", F.explode(F.filter(again, lambda x: x.isNotNull())).alias("bucket"))
    return rows.where(F.col("n") <= max_bucket).select("fp", "bucket").union(large)


def _shifted(planes: np.ndarray, s: int, words: np.ndarray) -> np.ndarray:
    """Words of planes moved down by s bits; planes have a spare word at their end."""
    whole, bits = divmod(s, 64)
    last = planes.shape[-1] - 1
    low = planes[..., np.minimum(words + whole, last)]
    if not bits:
        return low
    high = planes[..., np.minimum(words + whole + 1, last)]
    return (low >> np.uint64(bits)) | (high << np.uint64(64 - bits))


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes (64, words + 1) of fingerprints; bit i of a plane belongs to fingerprint i."""
    n = len(values)
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    words = -(-n // 64) + 1
    out = np.zeros((64, words * 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view("<u8").astype(np.uint64)


def near_pairs(values: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i < j of fingerprints in one group that differ in `radius` bits at most, by distance j - i.

    Rows of a group stand together.
    """
    n = len(values)
    planes = _planes(values)
    n_counters = (radius + 1).bit_length()
    _, sizes = np.unique(group, return_counts=True)
    bit_values = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for s in range(1, int(sizes.max(initial=1))):
        same = np.zeros(planes.shape[1] * 64, bool)
        same[: n - s] = group[: n - s] == group[s:]
        alive = np.packbits(same, bitorder="little").view("<u8").astype(np.uint64)
        words = np.flatnonzero(alive)
        alive = alive[words]
        counters = [np.zeros(len(words), np.uint64) for _ in range(n_counters)]
        for start in range(0, 64, 8):
            if not len(words):
                break
            part = planes[start : start + 8]
            for d in part[:, words] ^ _shifted(part, s, words):
                carry = d
                for k in range(n_counters):
                    counters[k], carry = counters[k] ^ carry, counters[k] & carry
                alive &= ~carry  # more than the counters hold
            # lanes that have passed the radius are out for good
            alive &= ~_above(counters, radius)
            left = np.flatnonzero(alive)
            if len(left) < len(words):
                words, alive, counters = words[left], alive[left], [c[left] for c in counters]
        if len(words):
            at = np.flatnonzero((alive[:, None] & bit_values) != 0)
            i = words[at // 64] * 64 + at % 64
            yield i, i + s


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is greater than the radius, compared bit by bit from the top."""
    above, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest place that each of n places is linked to by the pairs; at most n places are held."""
    root = np.arange(n)
    for i, j in pairs:
        a, b = root[i], root[j]
        while len(a := a[todo := np.flatnonzero(a != b)]):
            b = b[todo]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (up := root[root] != root).any():
                root[up] = root[root[up]]
            a, b = root[a], root[b]
    return root


def links_in_buckets(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b): from each fingerprint to the first of those it is connected with in its bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(cut, bits, fp):
            first = np.ones(len(fp), bool)
            first[1:] = (np.diff(cut) != 0) | (np.diff(bits) != 0)
            root = _forest(len(fp), near_pairs(fp.view(np.uint64), np.cumsum(first), radius))
            at = np.flatnonzero(root != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[root[at]])], ["a", "b"])

        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, np.asarray(c)]) for h, c in zip(held, batch.columns)]
            n = len(held[0])
            if n >= CHUNK:  # whole buckets go, the last stays until the next begins
                cut, bits, _ = held
                last = n - int(np.argmax(((cut != cut[-1]) | (bits != bits[-1]))[::-1])) if cut[0] != cut[-1] or bits[0] != bits[-1] else 0
                if last:
                    yield links(*(h[:last] for h in held))
                    held = [h[last:] for h in held]
        yield links(*held)

    flat = rows.select(F.col("bucket.cut").cast("long").alias("cut"), F.col("bucket.bits").alias("bits"), "fp")
    return flat.repartition("cut", "bits").sortWithinPartitions("cut", "bits", "fp").mapInArrow(run, "a long, b long")


def classes(nodes: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """node (a fingerprint) and root (the smallest it can reach) of those in `nodes` (fp, distinct) with links.

    `nodes` is read several times: hand over a written table.
    """
    return components(links_in_buckets(buckets(nodes, radius, max_bucket), radius))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of documents (doc_id, text).

    A-Z are lower-cased, words are parted by ASCII white space, shingles repeat as they occur; a
    text with fewer words than a shingle is one shingle. Texts without words, and null ones, have
    fingerprint 0 and are linked like any other. component_id is the smallest doc_id that can be
    reached over links; it is null where no document of the component has an id. Repeated rows
    each give a row; other columns are left out.
    """
    marked = keep(fingerprints(docs, shingle, seed), "fingerprints")
    nodes = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = classes(nodes, radius)
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.select(F.col("fp").alias("node"), "root").join(ids, "root").select("node", "component_id")
    return marked.join(found, marked["fp"] == found["node"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Documents less all but one of each group of near copies; the smallest doc_id stays.

    Rows that repeat the doc_id that stays are reduced to one. Documents without a doc_id all stay.
    """
    found = near_duplicates(docs.where("doc_id IS NOT NULL"), radius)
    own = free_name(docs, "_stays")
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias(own)).distinct()
    kept = docs.join(stays, docs["doc_id"].cast("long") == stays[own], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL"))
