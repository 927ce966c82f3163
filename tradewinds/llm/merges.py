"""Byte-pair merges of many short words at once.

Each word is a row of symbols. In every round each row merges its best-ranked adjacent pair, the leftmost of
equals, which is what a queue of its pairs would give; rows without a pair leave. Only the two pairs beside
a merge are looked up anew.
"""

from __future__ import annotations

import numpy as np

#: Longer words are not for a row of a matrix.
LONGEST = 24
_NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank and product of pairs of ids, by open addressing."""

    def __init__(self, pairs: np.ndarray, products: np.ndarray, ranks: np.ndarray | None = None) -> None:
        """`pairs`: rows (left, right), best rank first; or with their `ranks`, where pairs may be equals."""
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        self.products = np.zeros(1 << self.bits, np.int32)
        keys = (pairs[:, 0].astype(np.int64) << 32) | pairs[:, 1]
        at, left = self._at(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] < 0
            self.keys[at[left[free]]] = keys[left[free]]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
        self.ranks[at] = np.arange(len(keys), dtype=np.int32) if ranks is None else ranks
        self.products[at] = products

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or `_NONE`) and product of each pair."""
        keys = (left.astype(np.int64) << 32) | right
        at = self._at(keys)
        here = self.keys[at]
        open_ = np.flatnonzero((here != keys) & (here >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            here = self.keys[at[open_]]
            open_ = open_[(here != keys[open_]) & (here >= 0)]
        return self.ranks[at], self.products[at]


def merged(table: PairTable, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All symbols left of the words end to end, and how many each has.

    `symbols` has a row per word, of which `lengths` are used.
    """
    out, counts = symbols.copy(), lengths.copy()
    if symbols.shape[1] > 1:
        inside = np.arange(1, symbols.shape[1]) < lengths[:, None]
        ranks, products = np.full(inside.shape, _NONE), np.zeros(inside.shape, np.int32)
        ranks[inside], products[inside] = table.look_up(symbols[:, :-1][inside], symbols[:, 1:][inside])
        rows, symbols, lengths = np.arange(len(symbols)), symbols.copy(), lengths.copy()
        while True:
            best = ranks.argmin(1)
            going = ranks[np.arange(len(ranks)), best] != _NONE
            if not going.all():
                done = rows[~going]
                out[done, :symbols.shape[1]], counts[done] = symbols[~going], lengths[~going]
                rows, symbols, lengths, best = rows[going], symbols[going], lengths[going], best[going]
                ranks, products = ranks[going], products[going]
            if not len(rows):
                break
            each = np.arange(len(rows))
            symbols[each, best] = products[each, best]
            lengths -= 1
            # What stands behind the merged pair moves up by one.
            width = symbols.shape[1] - 1
            behind = np.arange(width)
            symbols = np.take_along_axis(symbols, behind + (behind > best[:, None]), 1)
            if width == 1:
                out[rows, :1], counts[rows] = symbols, lengths
                break
            behind = behind[:-1]
            source = behind + (behind >= best[:, None])
            ranks, products = np.take_along_axis(ranks, source, 1), np.take_along_axis(products, source, 1)
            for at in (best - 1, best):
                some = (at >= 0) & (at + 1 < lengths)
                where, at_ = each[some], at[some]
                ranks[where, at_], products[where, at_] = table.look_up(symbols[where, at_], symbols[where, at_ + 1])
                # The last symbol has no pair to its right.
            beyond = (best == lengths - 1) & (best < width - 1)
            ranks[each[beyond], best[beyond]] = _NONE
    used = np.arange(out.shape[1]) < counts[:, None]
    return out[used], counts
