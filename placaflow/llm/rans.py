"""Static range asymmetric numeral coding of token ids, vectorised over interleaved lanes.

A block of ids is dealt to `LANES` lanes, id i to lane i % LANES; every lane is a coder with a
64-bit state that writes 32-bit words, and all lanes share one word stream. Frequencies add up
to 2**SCALE. Blocks are independent: each has its own states, words and checksum.
"""

from __future__ import annotations

import zlib

import numpy as np

SCALE = 20
LANES = 2048
LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MASK = np.uint64((1 << SCALE) - 1)


class Corrupt(ValueError):
    """A block whose checksum or length does not fit."""


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to 2**SCALE, none of the symbols that occur below 1."""
    used = np.flatnonzero(counts)
    if len(used) > 1 << SCALE:
        raise ValueError("more symbols than the scale allows")
    out = np.zeros(len(counts), dtype=np.int64)
    if not len(used):
        return out
    share = counts[used].astype(np.float64) * ((1 << SCALE) / counts[used].sum())
    scaled = np.maximum(1, np.floor(share)).astype(np.int64)
    spare = (1 << SCALE) - int(scaled.sum())
    order = np.argsort(-scaled, kind="stable")
    while spare:  # the most frequent symbols bear the rounding
        part = scaled[order]
        step = np.where(part > 1, np.minimum(part // 2, -spare), 0) if spare < 0 else np.full(len(part), spare)
        total = np.cumsum(step)
        step = np.clip(abs(spare) - (total - step), 0, step)
        scaled[order] = part + step if spare > 0 else part - step
        spare = (1 << SCALE) - int(scaled.sum())
    out[used] = scaled
    return out


class Coder:
    """Encodes and decodes blocks with one frequency table."""

    def __init__(self, table: np.ndarray) -> None:
        self.freq = table.astype(np.uint64)
        self.start = (np.cumsum(table) - table).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - SCALE)
        used = np.flatnonzero(table)
        self.symbol = np.repeat(used, table[used]).astype(np.uint32)

    def encode(self, ids: np.ndarray) -> bytes:
        """States of the lanes, then the words in reading order."""
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, LOW, dtype=np.uint64)
        words: list[np.ndarray] = []
        for step in range(steps - 1, -1, -1):
            symbols = ids[step * LANES : (step + 1) * LANES]
            x = state[: len(symbols)]
            freq = self.freq[symbols]
            full = x >= self.limit[symbols]
            if full.any():
                words.append(x[full].astype(np.uint32))
                x = np.where(full, x >> _WORD, x)
            whole = x // freq
            state[: len(symbols)] = (whole << np.uint64(SCALE)) + (x - whole * freq) + self.start[symbols]
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        return state.astype("<u8").tobytes() + stream.astype("<u4").tobytes()

    def decode(self, data: bytes, n: int) -> np.ndarray:
        state = np.frombuffer(data, "<u8", LANES).copy()
        words = np.frombuffer(data, "<u4", offset=8 * LANES)
        out = np.empty(n, dtype=np.uint32)
        at = 0
        for step in range(-(-n // LANES)):
            lanes = min(LANES, n - step * LANES)
            x = state[:lanes]
            slot = x & _MASK
            symbols = self.symbol[slot]
            out[step * LANES : step * LANES + lanes] = symbols
            x = self.freq[symbols] * (x >> np.uint64(SCALE)) + slot - self.start[symbols]
            low = np.flatnonzero(x < LOW)
            if len(low):
                x[low] = (x[low] << _WORD) | words[at : at + len(low)]
                at += len(low)
            state[:lanes] = x
        if at != len(words) or (state != LOW).any():
            raise Corrupt("the words of a block do not fit its length")
        return out


def checksum(data: bytes) -> int:
    return zlib.crc32(data)
