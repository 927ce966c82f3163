"""Ids of byte strings, remembered in arrays.

Tokenizers spend their time on words; most words of a text were met before. `WordTable` keeps the ids of
the words it has met: an open-addressing hash table of array positions, the words' bytes end to end in one
array and their ids in another. A block of text is looked up as a whole. Every word found is compared byte
by byte with the stored one, so equal hashes of different words never change an id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Bytes a table may take, counted with its spare room; then words not met since the last time are dropped.
TABLE_BYTES = 80_000_000
_LEAST_SLOTS = 1 << 16

#: For some of the asked words (their positions): all their ids end to end, and how many each has.
Learned = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every range, one range after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class _Grown:
    """An array that grows at its end, with spare room."""

    def __init__(self, dtype) -> None:
        self.room, self.size = np.empty(1024, dtype), 0

    def add(self, values: np.ndarray) -> int:
        """Append values; where they begin."""
        first, self.size = self.size, self.size + len(values)
        if self.size > len(self.room):
            larger = np.empty(self.size + self.size // 2, self.room.dtype)
            larger[:first] = self.room[:first]
            self.room = larger
        self.room[first:self.size] = values
        return first

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.size]


class WordTable:
    def __init__(self, learn: Callable[[np.ndarray, np.ndarray, np.ndarray], Learned], table_bytes: int | None = None) -> None:
        self.learn, self.table_bytes = learn, table_bytes
        self._empty()

    def _empty(self) -> None:
        self.slots = np.full(_LEAST_SLOTS, -1, np.int32)
        self.hash, self.start, self.length = _Grown(np.uint64), _Grown(np.int64), _Grown(np.int64)
        self.id_start, self.id_count, self.used = _Grown(np.int64), _Grown(np.int64), _Grown(bool)
        self.bytes, self.ids = _Grown(np.uint8), _Grown(np.uint32)

    def _arrays(self) -> list[_Grown]:
        return [self.hash, self.start, self.length, self.id_start, self.id_count, self.used, self.bytes, self.ids]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The position of the word with each hash, or -1."""
        mask = np.uint64(len(self.slots) - 1)
        at, found = (hashes & mask).astype(np.int64), np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            here = self.slots[at[open_]]
            open_, here = open_[here >= 0], here[here >= 0]
            same = self.hash.all[here] == hashes[open_]
            found[open_[same]] = here[same]
            open_ = open_[~same]
            at[open_] = (at[open_] + 1) & int(mask)
        return found

    def _place(self, words: np.ndarray) -> None:
        """Give the words slots."""
        mask = len(self.slots) - 1
        at = (self.hash.all[words] & np.uint64(mask)).astype(np.int64)
        while len(words):
            free = self.slots[at] < 0
            self.slots[at[free]] = words[free]
            left = self.slots[at] != words
            words, at = words[left], (at[left] + 1) & mask

    def _add(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Learn words and store them; their positions."""
        first = self.hash.size
        for which, ids, counts in self.learn(data, starts, ends):
            lengths = (ends - starts)[which]
            self.hash.add(hashes[which])
            self.length.add(lengths)
            self.start.add(self.bytes.add(data[ranges(starts[which], lengths)]) + np.cumsum(lengths) - lengths)
            self.id_count.add(counts)
            self.id_start.add(self.ids.add(ids) + np.cumsum(counts) - counts)
            self.used.add(np.zeros(len(which), bool))
        return np.arange(first, self.hash.size)

    def _insert(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        new = self._add(hashes, data, starts, ends)
        if 2 * self.hash.size > len(self.slots):
            slots = len(self.slots)
            while 2 * self.hash.size > slots:
                slots *= 4
            self.slots = np.full(slots, -1, np.int32)
            new = np.arange(self.hash.size)
        self._place(new)

    def _differ(self, found: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which of the words found have other bytes than the stored ones."""
        lengths = ends - starts
        other = self.length.all[found] != lengths
        same = np.flatnonzero(~other)
        unlike = data[ranges(starts[same], lengths[same])] != self.bytes.all[ranges(self.start.all[found[same]], lengths[same])]
        if unlike.any():
            other[same[np.add.reduceat(unlike, np.cumsum(lengths[same]) - lengths[same]) > 0]] = True
        return np.flatnonzero(other)

    def look_up(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words (none of them empty) of `data` end to end, and how many each word has."""
        if sum(x.room.nbytes for x in self._arrays()) + self.slots.nbytes > (self.table_bytes or TABLE_BYTES):
            self._forget()
        found = self._find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            _, first = np.unique(hashes[missing], return_index=True)
            first = missing[np.sort(first)]
            self._insert(hashes[first], data, starts[first], ends[first])
            found[missing] = self._find(hashes[missing])
        other = self._differ(found, data, starts, ends)
        if len(other):
            # Their hash belongs to another word: they are learned anew each time and get no slot.
            found[other] = [self._add(hashes[k:k + 1], data, starts[k:k + 1], ends[k:k + 1])[0] for k in other.tolist()]
        self.used.all[found] = True
        counts = self.id_count.all[found]
        return self.ids.all[ranges(self.id_start.all[found], counts)], counts

    def _forget(self) -> None:
        """Keep the words met since the last time, or none where these take more than half the room."""
        kept = np.flatnonzero(self.used.all)
        # Words without a slot are not found again.
        kept = kept[self._find(self.hash.all[kept]) == kept]
        hashes, lengths, counts = self.hash.all[kept], self.length.all[kept], self.id_count.all[kept]
        if 64 * len(kept) + lengths.sum() + 4 * counts.sum() > (self.table_bytes or TABLE_BYTES) // 2:
            self._empty()
            return
        data, ids = self.bytes.all[ranges(self.start.all[kept], lengths)], self.ids.all[ranges(self.id_start.all[kept], counts)]
        self._empty()
        self.hash.add(hashes)
        self.length.add(lengths)
        self.start.add(np.cumsum(lengths) - lengths)
        self.id_count.add(counts)
        self.id_start.add(np.cumsum(counts) - counts)
        self.used.add(np.zeros(len(kept), bool))
        self.bytes.add(data)
        self.ids.add(ids)
        slots = len(self.slots)
        while 2 * len(kept) > slots:
            slots *= 4
        self.slots = np.full(slots, -1, np.int32)
        self._place(np.arange(len(kept)))
