"""A compressed FM-index over words: wavelet matrix, backward search, matching statistics.

Sequences are laid one after the other, each closed by a separator; the Burrows-Wheeler transform is
kept as a wavelet matrix of packed bit vectors with a count per 64 bits (ceil(log2 sigma) * 1.5 bits a
position), and sums of the weights where they are not all 1. The sequences, which are streamed against
the index, stay beside it in the smallest integers that hold their symbols. Positions only need to be in order up to the longest match asked for, so suffixes are sorted by their
first `depth` symbols.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


class Bits:
    """A packed bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.concatenate([bits, np.zeros(-n % 64 + 64, bool)]), bitorder="little")
        self.word = packed.view(U64)
        self.before = np.zeros(len(self.word), np.int32)
        np.cumsum(np.bitwise_count(self.word[:-1]), out=self.before[1:])
        self.zeros = n - int(self.before[-1])

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = at >> 6
        low = self.word[block] & ((U64(1) << (at & 63).astype(U64)) - U64(1))
        return self.before[block] + np.bitwise_count(low)


class FMIndex:
    """Index of sequences of symbols 1..sigma-1, given flat with their lengths; each counts as often as its weight."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray, depth: int):
        n_seq = len(lengths)
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)])
        size = int(self.first[-1])
        text = np.zeros(size, np.int64)  # 0: the separator
        keep = np.ones(size, bool)
        keep[self.first[1:] - 1] = False
        text[keep] = symbols
        self.size, self.lengths, self.text = size, lengths, text.astype(np.min_scalar_type(int(text.max()) if size else 0))
        rank, step = text.copy(), 1
        while True:  # prefix doubling
            pair = rank * (int(rank.max()) + 2)
            pair[:-step] += rank[step:] + 1
            order = np.argsort(pair, kind="stable")
            sorted_pair = pair[order]
            fresh = np.concatenate([[0], np.cumsum(sorted_pair[1:] != sorted_pair[:-1])])
            rank = np.empty(size, np.int64)
            rank[order] = fresh
            step *= 2
            if step >= depth or fresh[-1] == size - 1 or step >= size:
                break
        owner = np.repeat(np.arange(n_seq), lengths + 1)
        self.weight_to = None if (weights == 1).all() else np.concatenate([[0], np.cumsum(weights[owner][order])])
        bwt = text[order - 1]
        self.levels = max(1, int(text.max()).bit_length())
        self.matrix: list[Bits] = []
        column = bwt
        for level in range(self.levels - 1, -1, -1):
            bit = (column >> level & 1).astype(bool)
            self.matrix.append(Bits(bit))
            column = np.concatenate([column[~bit], column[bit]])
        counts = np.bincount(text, minlength=int(text.max()) + 2)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        # where each symbol's run begins in the bottom order of the wavelet matrix
        all_symbols = np.arange(len(counts))
        self.bottom = self._down(all_symbols, np.zeros(len(counts), np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in zip(range(self.levels - 1, -1, -1), self.matrix, strict=True):
            one = (symbol >> level & 1).astype(bool)
            r = bits.rank1(at)
            at = np.where(one, bits.zeros + r, at - r)
        return at

    def occ(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol stands before position `at` of the transform."""
        return self._down(symbol, at) - self.bottom[symbol]

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of a pattern one symbol longer to the left."""
        n = len(symbol)
        both = self.occ(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        return self.starts[symbol] + both[:n], self.starts[symbol] + both[n:]

    def weight(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return hi - lo if self.weight_to is None else self.weight_to[hi] - self.weight_to[lo]


def repeated_starts(index: FMIndex, window: int, least: int = 2) -> np.ndarray:
    """For each indexed position, whether the window starting there occurs at least `least` times in all.

    Each sequence is streamed against the index from its right end: backward search grows a match to
    the left until it would occur too rarely, which gives the longest repeated match that ends there.
    All windows inside it are repeated; the window that ends there but reaches past it is not, nor is
    any that holds it; the search goes on from the next end that is still open.
    """
    size = index.size
    found = np.zeros(size + 1, np.int64)
    run = np.flatnonzero(index.lengths >= window)
    base = index.first[run]
    end = base + index.lengths[run] - 1  # the end of the last open window
    while len(run):
        lo = np.zeros(len(run), np.int64)
        hi = np.full(len(run), size, np.int64)
        at = end.copy()  # the next symbol to the left
        live = np.arange(len(run))
        while len(live):
            symbol = index.text[at[live]].astype(np.int64)
            new_lo, new_hi = index.extend(symbol, lo[live], hi[live])
            good = index.weight(new_lo, new_hi) >= least
            live, new_lo, new_hi = live[good], new_lo[good], new_hi[good]
            lo[live], hi[live] = new_lo, new_hi
            at[live] -= 1
            live = live[at[live] >= base[live]]
        # at + 1 .. end is repeated, at .. end is not
        long = end - at >= window
        np.add.at(found, at[long] + 1, 1)
        np.add.at(found, end[long] - window + 2, -1)
        end = np.minimum(end - 1, at + window - 1)
        open_ = end - window + 1 >= base
        run, base, end = run[open_], base[open_], end[open_]
    return np.cumsum(found[:-1]) > 0
