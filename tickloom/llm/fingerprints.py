"""Fingerprints of improbable features, after the similarity digests that are made of Bloom filters.

A text's features are its windows of 32 bytes. A window's entropy is counted over its bytes and put in
one of 1,001 bins; how often each bin occurs in all texts says how improbable a window is. Of every 16
consecutive windows the least probable, the first of equals, gets a vote, and windows with at least
four votes are selected; a text of at most 64 windows has too few to choose from and keeps all. Each
sets five bits of a Bloom filter of 2,048; after 128 features the next filter of the chain begins. Two
filters are compared by the bits they share beyond chance, relative to the most they could, and count
as unlike where chance alone may share as many; a chain by the best partner of each of its filters.

30 zero bytes stand before each text, so that its first bytes are in windows of their own, and a text of
one byte is filled up with a zero to one window.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.batches import small_batches

WINDOW = 32
LEAD = 30
POPULAR = 16
VOTES = 4
FEW = 64
BITS = 2048
HASHES = 5
PER_FILTER = 128
BINS = 1001
BUFFER = 1 << 18
_ROWS_AT_ONCE = 4096
_SCALE = 1 << 12
_PART_BYTES = 32 << 20
_LAST = (1 << 62) - 1


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """What one more byte adds to the sum of c * log2(c) when c of its kind are there; entropy bins by that sum."""
    whole = np.array([round(_SCALE * c * math.log2(c)) if c else 0 for c in range(WINDOW + 2)], np.int64)
    most = int(whole[WINDOW])
    sums = np.arange(most + 1, dtype=np.float64)
    bins = np.rint((BINS - 1) * (1 - sums / most)).astype(np.int16)
    return np.diff(whole), bins


_MORE, _BIN = _steps()


def _counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, how many of the WINDOW - 1 bytes before it, and after it, equal it."""
    before, after = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
    for d in range(1, min(WINDOW, len(x))):
        same = (x[d:] == x[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    return before, after


def entropy_bins(x: np.ndarray) -> np.ndarray:
    """Bin of the entropy of each window of a buffer, in integers, so the same wherever a window stands.

    From one window to the next a byte leaves and one enters; the entropy's sum changes by the steps
    of their counts.
    """
    n = len(x) - WINDOW + 1
    before, after = _counts(x)
    # the byte that enters at i + WINDOW finds its kind among the WINDOW - 1 bytes before it; the
    # byte that leaves at i had its kind among the WINDOW - 1 bytes after it
    enters, leaves = _MORE[before[WINDOW:]], _MORE[after[: n - 1]]
    first = np.bincount(x[:WINDOW], minlength=1)
    start = int(sum(_MORE[:c].sum() for c in first))
    sums = np.empty(n, np.int64)
    sums[0] = start
    np.cumsum(enters - leaves, out=sums[1:])
    sums[1:] += start
    return _BIN[sums]


class Buffer:
    """Texts one behind the other; where each one's windows begin and end."""

    def __init__(self, texts: list[bytes]):
        parts = [bytes(LEAD) + t + bytes(max(0, WINDOW - LEAD - len(t))) for t in texts]
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        self.starts = ends - [len(p) for p in parts]
        self.stops = ends - WINDOW + 1
        self.valid = np.zeros(len(self.bytes) - WINDOW + 2, np.int8)
        self.valid[self.starts] += 1
        self.valid[self.stops] -= 1
        self.valid = np.cumsum(self.valid[:-1], dtype=np.int8).view(bool)
        self.bins = entropy_bins(self.bytes)


def groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The same texts, some at a time; one over BUFFER stands alone."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > BUFFER:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def _pieces(text: bytes) -> Iterator[tuple[int, int, np.ndarray]]:
    """Stretches of a long text: first window, runs that begin in it, entropy bins of the windows in those runs."""
    x = np.frombuffer(bytes(LEAD) + text, np.uint8)
    n = len(x) - WINDOW + 1
    for start in range(0, n, BUFFER):
        runs = min(BUFFER, n - start)
        end = min(n, start + runs + POPULAR - 1)
        yield start, runs, entropy_bins(x[start : end + WINDOW - 1])


def count_bins(texts: list[bytes]) -> np.ndarray:
    """Windows of each entropy bin; empty texts have none."""
    counts = np.zeros(BINS, np.int64)
    for group in groups([t for t in texts if t]):
        if len(group[0]) > BUFFER:
            for _, runs, bins in _pieces(group[0]):
                counts += np.bincount(bins[:runs], minlength=BINS)
        else:
            buffer = Buffer(group)
            counts += np.bincount(buffer.bins[buffer.valid], minlength=BINS)
    return counts


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each bin, the rarest first; of equally rare ones the higher entropy first."""
    ranks = np.empty(BINS, np.int64)
    ranks[np.lexsort((-np.arange(BINS), counts))] = np.arange(BINS)
    return ranks


def _winners(key: np.ndarray) -> np.ndarray:
    """The place of the least key in the run that begins at each place; keys hold their place in the low half."""
    n, least, width = len(key), key, 1
    while width < POPULAR:
        ahead = np.full(n, _LAST)
        ahead[: max(0, n - width)] = least[width:]
        least, width = np.minimum(least, ahead), 2 * width
    return least & 0xFFFFFFFF


def selected(buffer: Buffer, ranks: np.ndarray) -> np.ndarray:
    """Places of the windows with enough votes, ascending.

    Runs end with their text: as POPULAR is at most WINDOW, none reaches the windows of the next.
    """
    n = len(buffer.bins)
    key = np.where(buffer.valid, ranks[buffer.bins] << 32 | np.arange(n), _LAST)
    votes = np.bincount(_winners(key)[buffer.valid], minlength=n)
    few = np.repeat(buffer.stops - buffer.starts <= FEW, np.diff(buffer.starts, append=len(buffer.bytes)))[:n]
    return np.flatnonzero((votes >= VOTES) | few & buffer.valid)


def _selected_long(text: bytes, ranks: np.ndarray) -> np.ndarray:
    votes = np.zeros(LEAD + len(text) - WINDOW + 1, np.uint8)
    for start, runs, bins in _pieces(text):
        n = len(bins)
        votes[start : start + n] += np.bincount(_winners(ranks[bins] << 32 | np.arange(n))[:runs], minlength=n).astype(np.uint8)
    return np.flatnonzero(votes >= VOTES)


_ODD = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _hashed(x: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the window at each place: its four words multiplied and mixed in turn."""
    words = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[places].copy().view("<u8")
    h = np.zeros(len(places), np.uint64)
    for k in range(WINDOW // 8):
        h = (h ^ words[:, k]) * _ODD[k % 4]
        h ^= h >> np.uint64(29)
    h *= _ODD[0]
    return h ^ (h >> np.uint64(32))


def _filters(x: np.ndarray, places: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Bloom filters of the windows at the places, each put into the filter of its row; rows ascend."""
    out = np.zeros((rows, BITS // 8), np.uint8)
    for start in range(0, rows, _ROWS_AT_ONCE):
        a, b = np.searchsorted(row, [start, start + _ROWS_AT_ONCE])
        h = _hashed(x, places[a:b])
        bits = np.zeros((min(_ROWS_AT_ONCE, rows - start), BITS), np.uint8)
        for k in range(HASHES):
            bits[row[a:b] - start, (h >> np.uint64(11 * k) & np.uint64(BITS - 1)).astype(np.int64)] = 1
        out[start : start + len(bits)] = np.packbits(bits, axis=1, bitorder="little")
    return out.view("<u8")


class Digest:
    """The number of a text's features and its chain of filters."""

    def __init__(self, features: int, filters: np.ndarray):
        self.features, self.filters = features, filters

    def __str__(self) -> str:
        return f"{self.features}:{base64.b64encode(self.filters.tobytes()).decode()}"

    @staticmethod
    def parse(text: str) -> Digest:
        features, _, filters = text.partition(":")
        return Digest(int(features), np.frombuffer(base64.b64decode(filters), "<u8").reshape(-1, BITS // 64))

    def sizes(self) -> np.ndarray:
        sizes = np.full(len(self.filters), PER_FILTER)
        if len(sizes):
            sizes[-1] = self.features - PER_FILTER * (len(sizes) - 1)
        return sizes


def _grouped(texts: list[bytes], ranks: np.ndarray) -> Iterator[Digest]:
    if len(texts[0]) > BUFFER:
        x, starts = np.frombuffer(bytes(LEAD) + texts[0], np.uint8), np.zeros(1, int)
        places = _selected_long(texts[0], ranks)
    else:
        buffer = Buffer(texts)
        x, starts, places = buffer.bytes, buffer.starts, selected(buffer, ranks)
    owner = np.searchsorted(starts, places, "right") - 1
    counts = np.bincount(owner, minlength=len(texts))
    chains = -(-counts // PER_FILTER)
    first = np.cumsum(chains) - chains
    nth = np.arange(len(places)) - (np.cumsum(counts) - counts)[owner]
    filters = _filters(x, places, first[owner] + nth // PER_FILTER, int(chains.sum()))
    for n, a, m in zip(counts.tolist(), first.tolist(), chains.tolist()):
        yield Digest(n, filters[a : a + m])


def digests(texts: list[bytes], ranks: np.ndarray) -> list[Digest]:
    """Digest of each text; an empty one has no features."""
    made = (d for group in groups([t for t in texts if t]) for d in _grouped(group, ranks))
    return [next(made) if t else Digest(0, np.zeros((0, BITS // 64), np.uint64)) for t in texts]


def likeness(a: Digest, b: Digest) -> float:
    """From 0 to 1; 1 for equal digests, 0 where one alone has no features.

    Every filter of the digest with fewer features is set against its best partner in the other,
    weighted by its features.
    """
    if a.features == b.features and np.array_equal(a.filters, b.filters):
        return 1.0
    if not a.features or not b.features:
        return 0.0
    if (a.features, a.filters.tobytes()) > (b.features, b.filters.tobytes()):
        a, b = b, a
    ones = np.bitwise_count(b.filters).sum(axis=1, dtype=np.int64)
    total = 0.0
    for own, weight in zip(a.filters, a.sizes().tolist()):
        n = int(np.bitwise_count(own).sum(dtype=np.int64))
        common = np.bitwise_count(b.filters & own).sum(axis=1, dtype=np.int64)
        share, most = ones / BITS, np.minimum(n, ones)
        chance = n * share
        beyond = common > chance + 3 * np.sqrt(chance * (1 - share))
        total += weight * float(np.max(np.where(beyond, (common - chance) / (most - chance), 0)))
    return min(1.0, total / a.features)


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def learn_ranks(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Ranks of entropy bins by their counts over the whole texts of all documents; and the bytes of those texts.

    Spark adds the counts up; 1,001 of them reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros(BINS, np.int64), 0
        for batch in small_batches(batches):
            texts = _texts(batch, "text")
            counts, size = counts + count_bins(texts), size + sum(map(len, texts))
        yield pa.RecordBatch.from_arrays([pa.array([*range(BINS), -1]), pa.array([*counts.tolist(), size])], ["bin", "n"])

    counted = docs.select(_text("text").alias("text")).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    found = {r.bin: r.n for r in counted}
    return ranks_of(np.array([found.get(k, 0) for k in range(BINS)])), found.get(-1, 0)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the head of the next, or all of it."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list, texts: list[bytes], following: bytes, own: list[Digest], last: Digest, ranks: np.ndarray) -> pa.RecordBatch:
    """Result rows of consecutive texts, of which the last is followed by a given one."""
    plain = [t.decode() for t in [*texts, following]]
    changed = [edited(a, b).encode() for a, b in zip(plain, plain[1:])]
    after, near = digests(changed, ranks), [*own[1:], last]
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in plain[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
        pa.array([str(d) for d in own], pa.string()),
        pa.array([str(d) for d in after], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, near)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _RESULT.split(", ")])


def _inner(known) -> object:
    """All rows of a partition in order but the last, each with the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, ids, texts, own = known.value, [], [], []
        for batch in small_batches(batches):
            new = _texts(batch, "text")
            ids, texts, own = ids + batch.column("doc_id").to_pylist(), texts + new, own + digests(new, ranks)
            if len(texts) > 1:
                yield _compared(ids[:-1], texts[:-1], texts[-1], own[:-1], own[-1], ranks)
                ids, texts, own = ids[-1:], texts[-1:], own[-1:]

    return run


_EDGE = "part int, doc_id long, text string, is_last boolean"


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last row of a partition in order."""
    last = None

    def edge(row: pa.RecordBatch, is_last: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(row.column(c) for c in ("part", "doc_id", "text")), pa.array([is_last])], [f.split()[0] for f in _EDGE.split(", ")])

    for batch in batches:
        if batch.num_rows:
            if last is None:
                yield edge(batch.slice(0, 1), False)
            last = batch.slice(batch.num_rows - 1)
    if last is not None:
        yield edge(last, True)


def _outer(known) -> object:
    """Rows (doc_id, text, following): each is the last of its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, following = _texts(batch, "text"), _texts(batch, "following")
            for doc_id, own, then in zip(batch.column("doc_id").to_pylist(), texts, following):
                a, b = digests([own, then], known.value)
                yield _compared([doc_id], [own], then, [a], b, known.value)

    return run


def compare_edits(docs: DataFrame, part_bytes: int = _PART_BYTES) -> DataFrame:
    """doc_id, n_chars, fingerprints of a text and of its edited form, and likenesses to that and to the next text.

    Documents are in order of doc_id, nulls first, and those of one id by a hash of their texts; equal
    rows are next to each other. The first follows the last; a lone document follows itself. Null
    texts are empty. Extra columns are not looked at; an empty table gives no rows.

    Texts are shuffled once, into ranges of about `part_bytes`. Within a range each row meets its
    successor; for the last row of each the first of the next range that has any is looked up, by
    the numbers of ranges.
    """
    ranks, size = learn_ranks(docs)
    known = docs.sparkSession.sparkContext.broadcast(ranks)
    text = _text("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    ranged = rows.repartitionByRange(max(1, -(-size // part_bytes)), "doc_id", "hash")
    placed = ranged.sortWithinPartitions("doc_id", "hash").select("doc_id", "text")
    edges = placed.withColumn("part", F.spark_partition_id()).mapInArrow(_edges, _EDGE)
    last, first = edges.where("is_last").drop("is_last"), edges.where("NOT is_last")
    in_order = Window.orderBy("part")  # one number for each range
    wrapped = F.coalesce(F.lead("part").over(in_order), F.min("part").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    parts = first.select("part").select("part", wrapped.alias("then"))
    heads = first.select(F.col("part").alias("then"), F.col("text").alias("following"))
    ends = last.join(parts, "part").join(heads, "then").select("doc_id", "text", "following")
    return placed.mapInArrow(_inner(known), _RESULT).union(ends.mapInArrow(_outer(known), _RESULT))
