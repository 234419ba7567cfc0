"""A static range asymmetric numeral system over whole arrays of token ids.

Frequencies of a segment are scaled to a power of two and shared by its blocks. A block is coded
on its own by many interleaved states ("lanes"): token i belongs to lane i mod lanes, and numpy
steps all lanes at once. Checkpoints hold the states and the place in the word stream every few
steps, so that a reader may start there; every block has the crc32 of its ids.
"""

from __future__ import annotations

import zlib

import numpy as np

LOW = np.uint64(1 << 31)  # states stay in [LOW, LOW << 32); words have 32 bits
WORD = np.uint64(32)
SCALE_BITS = 20
LANES = 1024
TOKENS_PER_LANE = 256
CHECKPOINT_STEPS = 128
#: Ids below this are counted and looked up by place; greater ones are sorted and searched.
DENSE_IDS = 1 << 22


class Table:
    """Scaled frequencies of the ids of a segment."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray, bits: int):
        self.symbols, self.freqs, self.bits = symbols.astype(np.uint32), freqs.astype(np.uint64), bits
        self.starts = np.cumsum(self.freqs) - self.freqs
        self.slots: np.ndarray | None = None
        self.at: np.ndarray | None = None

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        """Every id that occurs has a frequency of at least one; the sum is a power of two."""
        if len(ids) and int(ids.max()) < DENSE_IDS:
            counts = np.bincount(ids)
            symbols = np.flatnonzero(counts)
            counts = counts[symbols]
        else:
            symbols, counts = np.unique(ids, return_counts=True)
        bits = max(SCALE_BITS, int(len(symbols)).bit_length() + 2)
        freqs = 1 + counts.astype(np.uint64) * np.uint64((1 << bits) - len(symbols)) // np.uint64(max(1, len(ids)))
        if len(symbols):
            freqs[np.argmax(counts)] += np.uint64((1 << bits) - int(freqs.sum()))
        return cls(symbols, freqs, bits)

    def pack(self) -> bytes:
        gaps = np.diff(self.symbols.astype(np.int64), prepend=0)
        body = np.stack([gaps, self.freqs.astype(np.int64)]).astype("<u4").tobytes()
        return bytes([self.bits]) + zlib.compress(body, 6)

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        gaps, freqs = np.frombuffer(zlib.decompress(data[1:]), "<u4").reshape(2, -1)
        return cls(np.cumsum(gaps.astype(np.int64)), freqs, data[0])

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Where the table holds each of the ids; it holds them all."""
        if not len(self.symbols) or self.symbols[-1] >= DENSE_IDS:
            return np.searchsorted(self.symbols, ids)
        if self.at is None:
            self.at = np.zeros(int(self.symbols[-1]) + 1, np.int32)
            self.at[self.symbols] = np.arange(len(self.symbols))
        return self.at[ids]

    def by_slot(self) -> np.ndarray:
        if self.slots is None:
            self.slots = np.repeat(np.arange(len(self.symbols), dtype=np.int32), self.freqs.astype(np.int64))
        return self.slots


def lanes_of(n: int) -> int:
    """Short blocks take fewer lanes, since each lane costs eight bytes."""
    return max(1, min(LANES, n // 64))


def encode(ids: np.ndarray, table: Table) -> dict:
    """One block: n_tokens, crc32, words, and checkpoints (states and word place; the first is the start)."""
    n, lanes = len(ids), lanes_of(len(ids))
    at = table.places(ids)
    freqs, starts, bits = table.freqs[at], table.starts[at], np.uint64(table.bits)
    limits = freqs << (np.uint64(63) - bits)  # a state from here on would outgrow 63 bits
    state, out, points, steps = np.full(lanes, LOW, np.uint64), [], [], -(-n // lanes)
    for step in range(steps - 1, -1, -1):  # what is coded last is read first
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x, f = state[: b - a], freqs[a:b]
        full = x >= limits[a:b]
        out.append(x[full].astype("<u4"))
        x = np.where(full, x >> WORD, x)
        q = x // f
        state[: b - a] = (q << bits) + (x - q * f) + starts[a:b]
        if step % CHECKPOINT_STEPS == 0:
            points.append((state.copy(), len(out)))
    before = np.concatenate([[0], np.cumsum([len(w) for w in reversed(out)])]).astype(np.int64)
    marks = [{"states": s.astype("<u8").tobytes(), "word": int(before[len(out) - k])} for s, k in reversed(points)]
    words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
    return {"n_tokens": n, "crc32": zlib.crc32(ids.astype("<u4").tobytes()), "words": words.tobytes(), "checkpoints": marks}


def decode(block: dict, table: Table, checkpoint: int = 0) -> np.ndarray:
    """The block's ids from a checkpoint to its end; from the first one, the checksum is tested."""
    n, lanes = block["n_tokens"], lanes_of(block["n_tokens"])
    if not n:
        return np.zeros(0, np.uint32)
    bits, mask, slots = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), table.by_slot()
    state = np.frombuffer(block["checkpoints"][checkpoint]["states"], "<u8").astype(np.uint64)
    words, at = np.frombuffer(block["words"], "<u4"), block["checkpoints"][checkpoint]["word"]
    first = checkpoint * CHECKPOINT_STEPS
    found = np.empty(n - first * lanes, np.int32)
    for step in range(first, -(-n // lanes)):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x = state[: b - a]
        slot = x & mask
        k = slots[slot.astype(np.int64)]
        found[a - first * lanes : b - first * lanes] = k
        x = table.freqs[k] * (x >> bits) + slot - table.starts[k]
        empty = np.flatnonzero(x < LOW)
        x[empty] = (x[empty] << WORD) | words[at : at + len(empty)].astype(np.uint64)
        at += len(empty)
        state[: b - a] = x
    ids = table.symbols[found]
    if checkpoint == 0 and zlib.crc32(ids.astype("<u4").tobytes()) != block["crc32"]:
        raise ValueError("block does not match its checksum")
    return ids
