"""Benchmark passages in documents, by suffix arrays over the documents.

Documents are taken in shards of a few megabytes. A shard's words become numbers; words that no
benchmark item has cannot be part of a match, so its suffix array holds the suffixes that begin
with at least as many benchmark words in a row as the shortest window needs. Every suffix of every
item is then looked up by binary search, all of them side by side. Two searches bound the suffixes
that share the whole window, which gives all its places; the longest common beginning of an item's
suffix and its neighbours in the array is its longest verbatim match.

Nothing is shuffled: each task searches the shards of its own documents. A benchmark goes to the
tasks in blocks of bounded size, one after the other, over the same documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.batches import set_aside, with_columns

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))

_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of texts laid end to end: their hashes, their texts' numbers, and the bytes."""

    _steps = _backs = np.zeros(0, np.uint64)

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").encode() + b"\n" for t in texts]
        self.data = _FOLD[np.frombuffer(b"".join(parts), np.uint8)]
        n = len(self.data)
        if n >= len(Words._steps):  # kept over shards
            Words._steps, Words._backs = _powers(_STEP, n + 1), _powers(_BACK, n + 1)
        edges = np.flatnonzero(np.diff(_IS_WORD[self.data].view(np.int8), prepend=np.int8(0)))
        self.begin, self.end = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * Words._steps[:n], out=sums[1:])
        self.hash = (sums[self.end] - sums[self.begin]) * Words._backs[self.begin]
        self.hash ^= self.hash >> np.uint64(32)
        ends = np.cumsum([len(p) for p in parts])
        #: words of text k are first[k] up to first[k + 1]
        self.first = np.concatenate([[0], np.searchsorted(self.begin, ends)]).astype(np.int64)


class Benchmark:
    """A block of benchmark items with its words numbered from 1, and the windows of each item."""

    def __init__(self, items: list[tuple[int, str | None]], window: int):
        items = [(i, t) for i, t in items if t]
        words = Words([t for _, t in items])
        self.hashes, first_use, numbers = np.unique(words.hash, return_index=True, return_inverse=True)
        spelling = [words.data[words.begin[k] : words.end[k]] for k in first_use]
        self.spelled = np.concatenate([*spelling, np.zeros(0, np.uint8)])
        self.spelled_size = np.array([len(x) for x in spelling], np.int64)
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size
        # a small table by the hash's last bits turns away most words of a document
        self.mask = np.uint64((1 << max(16, len(self.hashes).bit_length() + 4)) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, bool)
        self.maybe[(self.hashes & self.mask).astype(np.int64)] = True
        #: all items' words, each item followed by zeros enough for any window to end in
        spaced, self.at, self.length, owner = [], [], [], []
        base = 0
        for k, (item, _) in enumerate(items):
            own = numbers[words.first[k] : words.first[k + 1]] + 1
            if not len(own):
                continue
            size = min(window, len(own))
            n = len(own) - size + 1
            self.at.append(base + np.arange(n))
            self.length.append(np.full(n, size))
            owner.append(np.full(n, item, np.int64))
            spaced.append(np.concatenate([own, [0]]))
            base += len(own) + 1
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        self.words = join(spaced).astype(np.int64)
        self.at, self.length, self.owner = join(self.at).astype(np.int64), join(self.length).astype(np.int64), join(owner)
        self.shortest = int(self.length.min()) if len(self.length) else 0

    def numbers(self, words: Words) -> np.ndarray:
        """Number of each word of a shard, 0 for words that no item has."""
        out = np.zeros(len(words.hash), np.int64)
        likely = np.flatnonzero(self.maybe[(words.hash & self.mask).astype(np.int64)])
        if not len(likely) or not len(self.hashes):
            return out
        spot = np.minimum(np.searchsorted(self.hashes, words.hash[likely]), len(self.hashes) - 1)
        same = self.hashes[spot] == words.hash[likely]
        out[likely[same]] = spot[same] + 1
        return out


class SuffixArray:
    """Sorted suffixes of a shard's runs of benchmark words; runs end at a 0."""

    def __init__(self, numbers: np.ndarray, first: np.ndarray, least: int):
        begin = np.flatnonzero(numbers)
        # the run that a word stands in ends at the next 0 or at the end of its text
        stops = np.union1d(np.flatnonzero(numbers == 0), first[1:])
        end = stops[np.searchsorted(stops, begin, side="right")]
        heads = np.flatnonzero(np.diff(end, prepend=-1))
        length = np.diff(heads, append=len(begin))
        kept = np.repeat(length >= least, length)
        begin, end = begin[kept], end[kept]
        # runs are laid one after the other, each with a 0 behind it
        breaks = np.flatnonzero(np.diff(end)) + 1
        close = lambda x, mark: np.append(np.insert(x, breaks, mark), mark)
        self.words, self.place = close(numbers[begin], 0), close(begin, -1)
        starts = close(end - begin >= least, False)
        order = self._sorted(self.words, int(length.max()) if len(length) else 0)
        self.order = order[starts[order]]

    @staticmethod
    def _sorted(words: np.ndarray, longest: int) -> np.ndarray:
        """Places in the order of their suffixes, by prefix doubling; places of 0 are left out.

        Suffixes that are equal up to their run's end stay in any order.
        """
        rank, step, n = words.astype(np.int64), 1, len(words)
        alive = np.flatnonzero(words)
        order = np.argsort(rank[alive], kind="stable")
        while step < longest and len(alive):
            ahead = np.where(alive + step < n, rank[np.minimum(alive + step, n - 1)], 0)
            pair = rank[alive] * (int(rank.max()) + 1) + ahead
            order = np.argsort(pair, kind="stable")
            new = np.cumsum(np.diff(pair[order], prepend=-1) != 0)
            rank = np.zeros(n, np.int64)
            rank[alive[order]] = new
            step *= 2
            if new[-1] == len(alive):
                break
        return alive[order]

    def compare(self, rows: np.ndarray, bench: Benchmark, at: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Common words of suffixes and item suffixes, up to `most`, and the sign of what follows (0: none)."""
        same = np.zeros(len(rows), np.int64)
        sign = np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            todo = todo[same[todo] < most[todo]]
            a = self.words[np.minimum(self.order[rows[todo]] + same[todo], len(self.words) - 1)]
            b = bench.words[np.minimum(at[todo] + same[todo], len(bench.words) - 1)]
            apart = (a != b) | (b == 0)
            sign[todo[apart]] = np.sign(a[apart] - b[apart])
            todo = todo[~apart]
            same[todo] += 1
        return same, sign

    def search(self, bench: Benchmark, at: np.ndarray, length: np.ndarray, right: bool) -> np.ndarray:
        """For each item suffix, the first row whose beginning is not below (right: above) its `length` words."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            _, sign = self.compare(mid, bench, at[open_], length[open_])
            up = sign <= 0 if right else sign < 0
            low[open_[up]] = mid[up] + 1
            high[open_[~up]] = mid[~up]
        return low


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of the ranges one after the other, and the range each belongs to."""
    size = high - low
    which = np.repeat(np.arange(len(low)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size), which


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0)).tolist()
    return list(zip(edges[::2], edges[1::2]))


def find_in_shard(texts: list[str | None], bench: Benchmark, excluded: np.ndarray = np.zeros(0, np.int64)) -> list[dict]:
    """Of every text: n_words, spans [begin, end) of hit words, items, and the longest match.

    The longest match is (item, words, place in the item, place in the text); ties go to the
    smaller item and then the earlier place. `excluded` words match nothing.
    """
    words = Words(texts)
    n = len(words.begin)
    out = [{"n_words": int(b - a), "spans": [], "items": [], "longest": None} for a, b in zip(words.first, words.first[1:])]
    if not bench.shortest or not n:
        return out
    numbers = bench.numbers(words)
    numbers[excluded] = 0
    array = SuffixArray(numbers, words.first, bench.shortest)
    if not len(array.order):
        return out
    low = array.search(bench, bench.at, bench.length, right=False)
    found = np.flatnonzero(low < len(array.order))
    same, _ = array.compare(low[found], bench, bench.at[found], bench.length[found])
    found = found[same == bench.length[found]]
    high = low.copy()
    high[found] = array.search(bench, bench.at[found], bench.length[found], right=True)
    # equal windows of several items have equal ranges: their places are marked once
    keys, group = np.unique(np.stack([low[found], high[found], bench.length[found]]), axis=1, return_inverse=True)
    rows, which = _ranges(keys[0], keys[1])
    begin, length = array.place[array.order[rows]], keys[2][which]
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, begin + length, -1)
    hit = np.cumsum(depth[:-1]) > 0
    # numbers stand for hashes: words that are not spelled alike are no match, and the rest is searched again
    wrong = _misspelled(words, np.flatnonzero(hit), numbers, bench)
    if len(wrong):
        return find_in_shard(texts, bench, np.union1d(excluded, wrong))
    # every (text, window) once, then the items that have this window
    text = np.searchsorted(words.first, begin, side="right") - 1
    pairs = np.unique(np.stack([text, which]), axis=1) if len(text) else np.zeros((2, 0), np.int64)
    owners: list[set[int]] = [set() for _ in range(keys.shape[1])]
    for g, item in zip(group.reshape(-1).tolist(), bench.owner[found].tolist()):
        owners[g].add(item)
    for t, w in pairs.T.tolist():
        out[t]["items"].append(w)
    best = _longest(array, bench, words, found, low, high)
    for t in np.unique(text).tolist():
        out[t]["spans"] = _spans(hit[words.first[t] : words.first[t + 1]])
        out[t]["items"] = sorted(set().union(*(owners[w] for w in out[t]["items"])))
        out[t]["longest"] = best[t]
    return out


def _misspelled(words: Words, places: np.ndarray, numbers: np.ndarray, bench: Benchmark) -> np.ndarray:
    """Those of the places where a word's bytes are not those of the benchmark word of its number."""
    k = numbers[places] - 1
    size = words.end[places] - words.begin[places]
    wrong = size != bench.spelled_size[k]
    same = np.flatnonzero(~wrong)
    mine, which = _ranges(words.begin[places[same]], words.end[places[same]])
    theirs = mine - words.begin[places[same]][which] + bench.spelled_at[k[same]][which]
    wrong[same[np.unique(which[words.data[mine] != bench.spelled[theirs]])]] = True
    return places[wrong]


def _longest(array: SuffixArray, bench: Benchmark, words: Words, hits: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[int, tuple]:
    """Of each text with a hit, the longest beginning that a suffix of it shares with an item's suffix."""
    rows, which = _ranges(low[hits], high[hits])
    at = bench.at[hits][which]
    same, _ = array.compare(rows, bench, at, np.full(len(rows), len(bench.words), np.int64))
    place = array.place[array.order[rows]]
    text = np.searchsorted(words.first, place, side="right") - 1
    item = bench.owner[hits][which]
    zeros = np.flatnonzero(bench.words == 0)
    item_first = at - np.concatenate([[0], zeros + 1])[np.searchsorted(zeros, at)]
    order = np.lexsort((place, item_first, item, -same, text))
    keep = order[np.flatnonzero(np.diff(text[order], prepend=-1))]
    return {int(text[k]): (int(item[k]), int(same[k]), int(item_first[k]), int(place[k] - words.first[text[k]])) for k in keep}


def benchmark_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str | None]]]:
    """Items (item_id, text) in blocks of about `block_bytes`, one at a time on the driver."""
    block, size = [], 0
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).orderBy("item_id", "text")
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        size += len(text or "")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


MATCHES = "n_words long, spans array<struct<begin: long, end: long>>, items array<long>, longest struct<item: long, n_words: long, item_at: long, at: long>"


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents with n_words, the spans of words hit, the items found and the longest verbatim match.

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII. A
    window is `window` words of an item, or the whole item if it has fewer. Null texts have no
    words, items without words or id match nothing. An empty benchmark hits nothing.
    """

    def work_for(items):
        held = {}

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            if "bench" not in held:
                held["bench"] = Benchmark(items.value, window)
            texts = batch.column(0).to_pylist()
            found = find_in_shard(texts, held["bench"])
            if batch.num_columns > 1:  # what earlier blocks found
                for f, spans, own, longest in zip(found, *(batch.column(c).to_pylist() for c in ("spans", "items", "longest"))):
                    hit = np.zeros(f["n_words"], bool)
                    for a, b in [*f["spans"], *((s["begin"], s["end"]) for s in spans)]:
                        hit[a:b] = True
                    f["spans"], f["items"] = _spans(hit), sorted({*f["items"], *own})
                    if longest and (not f["longest"] or (-longest["n_words"], longest["item"]) < (-f["longest"][1], f["longest"][0])):
                        f["longest"] = tuple(longest.values())
            name = ("item", "n_words", "item_at", "at")
            return {
                "n_words": [f["n_words"] for f in found],
                "spans": [[{"begin": a, "end": b} for a, b in f["spans"]] for f in found],
                "items": [f["items"] for f in found],
                "longest": [dict(zip(name, f["longest"])) if f["longest"] else None for f in found],
            }

        return work

    context = docs.sparkSession.sparkContext
    out, inputs = docs, ["text"]
    blocks = benchmark_blocks(benchmark.where("item_id IS NOT NULL"), block_bytes)
    for block in blocks:
        out = with_columns(out, MATCHES, work_for(context.broadcast(block)), inputs, docs.columns if inputs == ["text"] else out.columns, SHARD_BYTES)
        inputs = ["text", "spans", "items", "longest"]
    if inputs == ["text"]:
        out = with_columns(out, MATCHES, work_for(context.broadcast([])), inputs, docs.columns, SHARD_BYTES)
    return out


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns."""
    mine, back = set_aside(docs, {"n_words", "spans", "items", "longest"})
    return back(find_matches(mine, benchmark, window).where(F.size("spans") == 0))
