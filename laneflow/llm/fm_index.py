"""FM-index of a sequence of small numbers: suffix order, wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in their order; a suffix that ends sorts before its continuations.

    Packs as many ranks into a key as fit until depth symbols are told apart; from then on only tied suffixes are
    sorted again, with doubled depth each time.
    """
    n = len(symbols)
    rank, known = symbols.astype(np.int64) + 1, 1
    while known < depth:
        bits = int(rank.max()).bit_length()
        many = min(max(2, 62 // bits), -(-depth // known))
        key = np.zeros(n, dtype=np.int64)
        for j in range(many):
            key <<= bits
            if j * known < n:
                key[: n - j * known] |= rank[j * known :]
        order = np.argsort(key, kind="stable")
        rank, known = _ranks(key, order), known * many
    order = np.argsort(rank, kind="stable") if depth <= 1 else order
    rank = _ranks(rank, order)
    while True:
        ranked = rank[order]
        same = np.zeros(n, dtype=bool)
        same[1:] = ranked[1:] == ranked[:-1]
        same[:-1] |= same[1:]
        at = np.flatnonzero(same)
        if not len(at):
            return order
        rows = order[at]
        after = rows + known
        later = np.where(after < n, rank[np.minimum(after, n - 1)], 0)
        key = (rank[rows] << 31) | later
        own = np.argsort(key, kind="stable")
        order[at] = rows = rows[own]
        key = key[own]
        # a rank is the place of the group's first suffix, plus one
        first = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0))
        rank[rows] = first + 1
        known *= 2


def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix the place of the first with its key, plus one."""
    ranked = key[order]
    first = np.maximum.accumulate(np.where(np.r_[True, ranked[1:] != ranked[:-1]], np.arange(len(key)), 0))
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = first + 1
    return rank


class FmIndex:
    """Finds phrases in a sequence of numbers from 0 to top; 0 stands in no phrase."""

    def __init__(self, symbols: np.ndarray, top: int, depth: int = 10, sample: int = 8):
        # one up, so that 0 can end the sequence and stands nowhere else
        symbols, top = np.append(symbols + 1, 0), top + 1
        order = suffix_order(symbols, depth)
        self.n, self.bwt = len(symbols), symbols[order - 1].astype(np.int32)
        self.counts = np.zeros(top + 2, dtype=np.int64)
        self.counts[1:] = np.cumsum(np.bincount(symbols, minlength=top + 1))
        self.levels, rest = [], self.bwt
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (rest >> bit) & 1 == 1
            zeros = np.zeros(self.n + 1, dtype=np.int32)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((bit, zeros))
            rest = np.concatenate([rest[~ones], rest[ones]])
        self.sampled = np.where(order % sample == 0, order, -1).astype(np.int32)

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        low = np.zeros(len(symbol), dtype=np.int64)
        for bit, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            low = np.where(one, zeros[-1] + low - zeros[low], zeros[low])
            place = np.where(one, zeros[-1] + place - zeros[place], zeros[place])
        return place - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all rows of a matrix at once; the range of suffixes that start with each."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, column] + 1
            low[live] = self.counts[symbol] + self.rank(symbol, low[live])
            high[live] = self.counts[symbol] + self.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        high = np.maximum(high, low)
        gone = np.ones(len(phrases), dtype=bool)
        gone[live] = False
        high[gone] = low[gone]
        return low, high

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Start of the suffix at each place: steps back to one whose position was kept."""
        steps, found = np.zeros(len(places), np.int64), np.full(len(places), -1, np.int64)
        live, at = np.arange(len(places)), places.copy()
        while len(live):
            known = self.sampled[at] >= 0
            done = live[known]
            found[done] = self.sampled[at[known]] + steps[done]
            live, at = live[~known], at[~known]
            symbol = self.bwt[at].astype(np.int64)
            at = self.counts[symbol] + self.rank(symbol, at)
            steps[live] += 1
        return found
