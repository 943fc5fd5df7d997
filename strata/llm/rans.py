"""Static range asymmetric numeral system over token ids, with numpy.

All blocks share one table of frequencies. A block deals its ids to interleaved
lanes (id i to lane i mod lanes), each lane with a 64-bit state that gives off
32-bit words. Every `interval` steps a checkpoint holds all states and the place
in the words, so that the segments of a block can be decoded apart. A block
ends with a checksum of all before it.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = 0x31534E52
LOW = np.uint64(1 << 31)
LANES, INTERVAL = 1024, 256


class Table:
    """Frequencies of symbols scaled to a power of two; a symbol that occurs has one at least."""

    def __init__(self, freq: np.ndarray, scale: int):
        self.scale, self.freq = scale, freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    @classmethod
    def of(cls, counts: np.ndarray) -> Table:
        counts = np.asarray(counts, np.int64)
        present = np.flatnonzero(counts)
        scale = min(24, max(12, int(max(1, len(present)) - 1).bit_length() + 4))
        total, size = max(1, int(counts.sum())), 1 << scale
        freq = np.zeros(len(counts), np.int64)
        freq[present] = np.maximum(1, (counts[present].astype(np.float64) * (size / total)).astype(np.int64))
        order = present[np.argsort(-counts[present], kind="stable")]
        rest = size - int(freq.sum())
        if len(order) and rest > 0:
            freq[order[0]] += rest
        for s in order:  # takes what ones given to rare symbols have cost from the frequent ones
            if rest >= 0:
                break
            take = min(-rest, int(freq[s]) // 2)
            freq[s] -= take
            rest += take
        return cls(freq, scale)

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.scale], self.freq.astype(np.int64)]).astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        x = np.frombuffer(raw, "<u4")
        return cls(x[1:].astype(np.int64), int(x[0]))


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, interval: int = INTERVAL) -> bytes:
    n = len(ids)
    lanes = max(1, min(lanes, n // 16))
    steps = -(-n // lanes)
    scale, shift = np.uint64(table.scale), np.uint64(63 - table.scale)
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    given, marks, states = 0, [], []
    for s in range(steps - 1, -1, -1):
        sym = ids[s * lanes : (s + 1) * lanes]
        x, f = state[: len(sym)], table.freq[sym]
        full = x >= (f << shift)
        if full.any():
            out = x[full]
            words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4"))
            given += len(out)
            x[full] = out >> np.uint64(32)
        q = x // f
        x[:] = (q << scale) + (x - q * f) + table.start[sym]
        if s % interval == 0:
            marks.append(given)
            states.append(state.copy())
    payload = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    head = np.array([MAGIC, n, lanes, interval, len(marks), len(payload)], "<u4").tobytes()
    points = np.array([given - m for m in marks[::-1]], "<u4").tobytes()
    saved = np.concatenate(states[::-1]).astype("<u8").tobytes() if states else b""
    body = head + points + saved + payload.tobytes()
    return body + zlib.crc32(body).to_bytes(4, "little")


class Block:
    """A block's parts; raises ValueError where the checksum differs."""

    def __init__(self, raw: bytes, table: Table):
        if len(raw) < 28 or zlib.crc32(raw[:-4]) != int.from_bytes(raw[-4:], "little"):
            raise ValueError("checksum of a block differs")
        magic, self.n, self.lanes, self.interval, k, w = (int(v) for v in np.frombuffer(raw, "<u4", 6))
        if magic != MAGIC:
            raise ValueError("not a block of ids")
        self.table, self.segments = table, k
        self.points = np.frombuffer(raw, "<u4", k, 24)
        self.states = np.frombuffer(raw, "<u8", k * self.lanes, 24 + 4 * k).reshape(k, self.lanes)
        self.words = np.frombuffer(raw, "<u4", w, 24 + 4 * k + 8 * k * self.lanes)

    def segment(self, k: int) -> np.ndarray:
        """Ids from checkpoint k to the next; needs no other segment."""
        t, lanes = self.table, self.lanes
        first = k * self.interval * lanes
        n = min(self.n - first, self.interval * lanes)
        out = np.empty(n, np.uint32)
        state, at = self.states[k].copy(), int(self.points[k])
        mask, scale = np.uint64((1 << t.scale) - 1), np.uint64(t.scale)
        for s in range(-(-n // lanes)):
            size = min(lanes, n - s * lanes)
            x = state[:size]
            slot = x & mask
            sym = t.symbol[slot]
            out[s * lanes : s * lanes + size] = sym
            x[:] = t.freq[sym] * (x >> scale) + slot - t.start[sym]
            low = np.flatnonzero(x < LOW)
            if len(low):
                x[low] = (x[low] << np.uint64(32)) | self.words[at : at + len(low)]
                at += len(low)
        return out

    def ids(self) -> np.ndarray:
        """All ids: the segments are decoded side by side from their checkpoints, a step of all of them at once."""
        t, lanes, k, steps = self.table, self.lanes, self.segments, self.interval
        if k < 3:
            return np.concatenate([self.segment(i) for i in range(k)]) if k else np.zeros(0, np.uint32)
        full = k - 1  # the last may be short
        out = np.empty((full, steps * lanes), np.uint32)
        state, at = self.states[:full].copy(), self.points[:full].astype(np.int64)
        mask, scale = np.uint64((1 << t.scale) - 1), np.uint64(t.scale)
        for s in range(steps):
            slot = state & mask
            sym = t.symbol[slot]
            out[:, s * lanes : (s + 1) * lanes] = sym
            state = t.freq[sym] * (state >> scale) + slot - t.start[sym]
            low = state < LOW
            taken = np.cumsum(low, axis=1)
            row, col = np.nonzero(low)
            state[row, col] = (state[row, col] << np.uint64(32)) | self.words[at[row] + taken[row, col] - 1]
            at += taken[:, -1]
        return np.concatenate([out.reshape(-1), self.segment(full)])
