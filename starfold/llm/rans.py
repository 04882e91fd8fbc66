"""Static range asymmetric numeral system over numpy lanes.

The symbols of a block are dealt to ``lanes`` states of 64 bits, symbol i to lane i modulo
``lanes``; all lanes take a step at once. Words of 32 bits that overflow are kept in the
order in which a decoder wants them. Every ``every`` steps the states and the place in the
words are noted as a checkpoint, from which decoding can start, so the stretches between
checkpoints are decoded side by side.
"""

from __future__ import annotations

import numpy as np

LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


def frequencies(counts: np.ndarray, bits: int | None = None) -> tuple[np.ndarray, int]:
    """``counts`` scaled to a total of 2**bits, at least 1 for every symbol that occurs."""
    seen = counts > 0
    bits = bits or max(12, int(seen.sum()).bit_length() + 4)
    if int(seen.sum()) > 1 << bits or bits > 24:
        raise ValueError("too many symbols for the table")
    scaled = np.zeros(len(counts), np.uint64)
    if seen.any():
        spare, total = (1 << bits) - int(seen.sum()), int(counts.sum())
        scaled[seen] = [1 + int(c) * spare // total for c in counts[seen]]
        scaled[int(np.argmax(counts))] += np.uint64((1 << bits) - int(scaled.sum()))
    return scaled, bits


class Coder:
    """Encoder and decoder for one table of frequencies."""

    def __init__(self, scaled: np.ndarray, bits: int, lanes: int = 2048, every: int = 128):
        self.scaled, self.bits, self.lanes, self.every = scaled.astype(np.uint64), np.uint64(bits), lanes, every
        self.starts = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64)
        self.limits = self.scaled << np.uint64(63 - bits)
        self._symbols = None

    def encode(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States per checkpoint (the first is the block's start), where each reads on in
        the words, and the words."""
        lanes, n = self.lanes, len(symbols)
        state, words, states, read = np.full(lanes, LOW, np.uint64), [], [], []
        emitted = 0
        for step in range(-(-n // lanes) - 1, -1, -1):
            some = symbols[step * lanes:(step + 1) * lanes]
            x, f = state[:len(some)], self.scaled[some]
            over = x >= self.limits[some]
            if over.any():
                words.append(x[over].astype(np.uint32))
                emitted += len(words[-1])
                x = np.where(over, x >> _WORD, x)
            high = x // f
            state[:len(some)] = (high << self.bits) + (x - high * f) + self.starts[some]
            if step % self.every == 0:
                states.append(state.copy())
                read.append(emitted)
        stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
        return np.array(states[::-1], np.uint64).reshape(-1, lanes), emitted - np.array(read[::-1], np.int64), stream

    def decode(self, states: np.ndarray, read: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.scaled), dtype=np.uint32), self.scaled.astype(np.int64))
        lanes, every = self.lanes, self.every
        steps = -(-n // lanes)
        out = np.empty((len(states), every, lanes), np.uint32)
        x, at = states.copy(), read.astype(np.int64).copy()
        words = np.append(words, np.uint32(0)).astype(np.uint64)
        mask = np.uint64((1 << int(self.bits)) - 1)
        for step in range(min(every, steps)):
            # Only the last stretch can be short; its last step may use fewer lanes.
            live = len(states) if (len(states) - 1) * every + step < steps else len(states) - 1
            slot = x[:live] & mask
            symbols = self._symbols[slot.astype(np.int64)]
            out[:live, step] = symbols
            x[:live] = self.scaled[symbols] * (x[:live] >> self.bits) + slot - self.starts[symbols]
            need = x[:live] < LOW
            if live == len(states) and (live - 1) * every + step == steps - 1 and n % lanes:
                need[-1, n % lanes:] = False
            place = at[:live, None] + np.cumsum(need, axis=1) - 1
            x[:live] = np.where(need, (x[:live] << _WORD) | words[np.where(need, place, 0)], x[:live])
            at[:live] += need.sum(axis=1)
        return out.reshape(-1)[:n] if n else np.empty(0, np.uint32)
