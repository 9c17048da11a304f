"""A compressed full-text index over word sequences: suffix order, Burrows-Wheeler transform, wavelet matrix.

Small enough for one task: some hundred thousand words. Sequences are numbered symbols from 1; 0 ends each. Suffixes are
ordered by their first 64 symbols, which is all that patterns up to that length see. The transform is held as a wavelet
matrix, one bit vector per bit of the symbols with counts per 64 bits; a step of backward search is two ranks on it.
"""

from __future__ import annotations

import numpy as np

#: Symbols by which suffixes are ordered; patterns may be as long.
DEPTH = 64


def _ranked(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    fresh = np.empty(len(keys), np.int64)
    fresh[0] = 0
    ordered = keys[order]
    np.cumsum(ordered[1:] != ordered[:-1], out=fresh[1:])
    out = np.empty(len(keys), np.int64)
    out[order] = fresh
    return out


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([values[by:], np.zeros(min(by, len(values)), values.dtype)])


class FmIndex:
    """Index of sequences given one after the other in ``text``, each followed by 0; ``owner`` has a number for each
    position of ``text``, by which matches are told apart."""

    def __init__(self, text: np.ndarray, owner: np.ndarray):
        self.text, self.n = text, len(text)
        symbols = int(text.max()) + 1
        self.levels = max(1, int(symbols).bit_length())
        ranks, length = {1: text.astype(np.int64)}, 1
        while length < DEPTH:
            now = ranks[length]
            ranks[2 * length] = _ranked(now * (int(now.max()) + 1) + _shifted(now, length))
            length *= 2
        order = np.argsort(ranks[DEPTH], kind="stable")
        self.owner = owner[order]
        self.shared = self._shared(order, ranks)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self._wavelet(text[order - 1])
        self.base = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _shared(self, order: np.ndarray, ranks: dict[int, np.ndarray]) -> np.ndarray:
        """How many first symbols each suffix in order shares with the one before it, up to 64."""
        a, b = order[:-1].copy(), order[1:].copy()
        out = np.zeros(self.n, np.int64)
        length = DEPTH // 2
        full = ranks[DEPTH][a] == ranks[DEPTH][b]
        while length:
            ok = (a < self.n) & (b < self.n)
            same = np.zeros(len(a), bool)
            same[ok] = ranks[length][a[ok]] == ranks[length][b[ok]]
            step = same * length
            a, b = a + step, b + step
            out[1:] += step
            length //= 2
        out[1:][full] = DEPTH
        return out

    def _wavelet(self, symbols: np.ndarray) -> None:
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (symbols >> level) & 1 == 1
            padded = np.zeros((self.n // 64 + 1) * 64, bool)
            padded[: self.n] = bits
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))]))
            self.zeros.append(self.n - int(bits.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def _descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where places go when the matrix is followed down to their symbol."""
        for k, (words, counts, zeros) in enumerate(zip(self.words, self.counts, self.zeros, strict=True)):
            word = places >> 6
            below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = counts[word] + np.bitwise_count(words[word] & below)
            bit = (symbols >> (self.levels - 1 - k)) & 1
            places = np.where(bit == 1, zeros + ones, places - ones)
        return places

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges of the patterns with a symbol put before each; empty ones have low >= high."""
        m = len(symbols)
        ends = self._descend(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        start = self.before[symbols] - self.base[symbols]
        return start + ends[:m], start + ends[m:]

    def groups(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Each suffix's group of those that share ``length`` symbols, and where the groups begin (and the last ends)."""
        fresh = self.shared < length
        fresh[0] = True
        return np.cumsum(fresh) - 1, np.append(np.flatnonzero(fresh), self.n)

    def shorter(self, low: int, high: int) -> tuple[int, int, int]:
        """The range of the longest prefix of a pattern that has more matches, and its length."""
        length = int(max(self.shared[low], self.shared[high] if high < self.n else 0))
        while low > 0 and self.shared[low] >= length:
            low -= 1
        while high < self.n and self.shared[high] >= length:
            high += 1
        return length, low, high

    def statistics(self, streams: list[np.ndarray], most: int = DEPTH):
        """Matching statistics of sequences, from their ends: yields (streams, places, lengths, lows, highs).

        At each place of each stream, the longest match with the index that begins there, up to ``most`` symbols, and
        its suffix range. All streams advance together. Where a symbol does not extend a match, its pattern is shortened
        at the end until it does; symbols that the index hasn't (numbered 0 or beyond) match nothing.
        """
        group, begins = self.groups(most)
        streams_by_size = np.argsort([-len(s) for s in streams], kind="stable")
        sizes = np.array([len(streams[i]) for i in streams_by_size], np.int64)
        flat = np.concatenate([streams[i] for i in streams_by_size]) if len(streams) else np.zeros(0, np.int64)
        ends = np.cumsum(sizes)
        length = np.zeros(len(sizes), np.int64)
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.n, np.int64)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -step, side="left"))
            symbols = flat[ends[:active] - 1 - step]
            known = (symbols > 0) & (symbols < len(self.base))
            new_low, new_high = self.extend(np.where(known, symbols, 0), low[:active], high[:active])
            new_length = length[:active] + 1
            for i in np.flatnonzero(~known | (new_low >= new_high)).tolist():
                new_length[i], new_low[i], new_high[i] = self._shortened(
                    symbols[i] if known[i] else 0, int(length[i]), int(low[i]), int(high[i])
                )
            long = np.flatnonzero(new_length >= most)
            of = group[new_low[long]]
            new_length[long], new_low[long], new_high[long] = most, begins[of], begins[of + 1]
            length[:active], low[:active], high[:active] = new_length, new_low, new_high
            yield streams_by_size[:active], sizes[:active] - 1 - step, new_length, new_low, new_high

    def _shortened(self, symbol: int, length: int, low: int, high: int) -> tuple[int, int, int]:
        while symbol and length:
            length, low, high = self.shorter(low, high)
            a, b = self.extend(np.array([symbol]), np.array([low]), np.array([high]))
            if a[0] < b[0]:
                return length + 1, int(a[0]), int(b[0])
        return 0, 0, self.n
