"""A static range asymmetric numeral system over numpy vectors.

A block of symbols is dealt to LANES interleaved coders (symbol i to lane
i mod LANES) that share one frequency table and one stream of 16-bit words.
Every CHECKPOINT steps the block keeps the coders' states and their place in
the stream, so the parts between checkpoints decode independently: here all
of them at once, as further lanes."""

from __future__ import annotations

import numpy as np

SCALE_BITS = 16
SCALE = 1 << SCALE_BITS
LANES = 1024
CHECKPOINT = 64


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to SCALE; every symbol that occurs keeps 1 at
    least.  All-zero counts give all of the scale to symbol 0."""
    counts = np.asarray(counts, np.float64)
    if len(counts) > SCALE:
        raise ValueError(f"at most {SCALE} symbols")
    total = counts.sum()
    if total == 0:
        out = np.zeros(max(len(counts), 1), np.int64)
        out[0] = SCALE
        return out
    out = np.where(counts > 0, np.maximum(1, np.floor(counts * SCALE / total)), 0).astype(np.int64)
    excess = int(out.sum()) - SCALE
    for i in np.argsort(-out, kind="stable"):  # the commonest give and take
        if excess == 0:
            break
        give = min(excess, int(out[i]) - 1) if excess > 0 else excess
        out[i] -= give
        excess -= give
    return out


class Coder:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint32)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint32)
        self.symbol = np.repeat(np.arange(len(freq)), freq).astype(np.uint16)
        self.slot_freq = self.freq[self.symbol]
        self.slot_bias = np.arange(SCALE, dtype=np.uint32) - self.cum[self.symbol]

    def encode(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, checkpoint states, checkpoint places).  The first
        checkpoint is the block's beginning."""
        n = len(symbols)
        steps = -(-n // LANES)
        x = np.full(LANES, SCALE, np.uint32)
        words, used, states = [], np.zeros(steps + 1, np.int64), []
        f_all, c_all = self.freq[symbols], self.cum[symbols]
        if n and not f_all.all():
            raise ValueError("a symbol has no frequency")
        for t in range(steps - 1, -1, -1):
            f, c = f_all[t * LANES:(t + 1) * LANES], c_all[t * LANES:(t + 1) * LANES]
            y = x[:len(f)]
            full = (y >> 16) >= f
            out = y[full]
            words.append(out.astype(np.uint16))
            used[t] = len(out)
            y = np.where(full, y >> 16, y)
            q = y // f
            x[:len(f)] = (q << 16) + (y - q * f) + c
            if t % CHECKPOINT == 0:
                states.append(x.copy())
        places = (np.cumsum(used) - used)[:max(steps, 1):CHECKPOINT]
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint16)
        return stream, np.array(states[::-1], np.uint32).reshape(-1, LANES), places[:len(states)]

    def decode(self, n: int, words: np.ndarray, states: np.ndarray, places: np.ndarray,
               first: int = 0, last: int | None = None) -> np.ndarray:
        """Symbols of the parts that begin at checkpoints first..last-1 (all
        by default)."""
        parts = len(states) if last is None else last
        whole = n // (LANES * CHECKPOINT)  # parts that are full
        ends = min(parts, whole)
        words = np.concatenate([words, np.zeros(1, np.uint16)]).astype(np.uint32)
        out = []
        if ends > first:
            x, at = states[first:ends].copy(), places[first:ends].astype(np.int64).copy()
            part = np.empty((ends - first, CHECKPOINT, LANES), np.uint16)
            for t in range(CHECKPOINT):
                x, at = self._step(x, at, words, part[:, t, :])
            out.append(part.ravel())
        if parts > ends >= 0 and parts > max(first, whole):
            x, at = states[whole:whole + 1].copy(), places[whole:whole + 1].astype(np.int64).copy()
            left = n - whole * LANES * CHECKPOINT
            for t in range(-(-left // LANES)):
                width = min(LANES, left - t * LANES)
                row = np.empty((1, width), np.uint16)
                y, at = self._step(x[:, :width], at, words, row)
                x[:, :width] = y
                out.append(row.ravel())
        return np.concatenate(out) if out else np.zeros(0, np.uint16)

    def _step(self, x, at, words, into):
        slot = x & np.uint32(SCALE - 1)
        into[...] = self.symbol[slot]
        x = self.slot_freq[slot] * (x >> np.uint32(16)) + self.slot_bias[slot]
        short = x < SCALE
        rank = np.cumsum(short, axis=1)
        place = (at[:, None] + rank - 1)[short]
        x[short] = (x[short] << np.uint32(16)) | words[place]
        return x, at + rank[:, -1]
