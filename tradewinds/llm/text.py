"""Words and word shingles of many texts at once, as the operators on whole texts share them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE_WORDS = 5
#: Texts are hashed together until they have so many bytes.
BLOCK_BYTES = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Letters (A-Z as a-z), digits and all bytes beyond ASCII stay, anything else counts as white space.
CLEAN = np.full(256, 32, np.uint8)
for _low, _high in ((48, 58), (97, 123), (128, 256)):
    CLEAN[_low:_high] = np.arange(_low, _high)
CLEAN[65:91] = np.arange(97, 123)
_BYTE_VALUES = np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_MULTIPLY = np.uint64(_BASE)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def blocks(texts: list[str | None], least: int | None = None) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as bytes, with the position of the first; `least` bytes (default `BLOCK_BYTES`) end a block."""
    least = least or BLOCK_BYTES
    first, block, size = 0, [], 0
    for k, text in enumerate(texts):
        block.append(as_bytes(text))
        size += len(block[-1])
        if size >= least:
            yield first, block
            first, block, size = k + 1, [], 0
    if block:
        yield first, block


def joined(block: list[bytes]) -> np.ndarray:
    """The bytes of all texts, each followed by white space."""
    return np.frombuffer(b"\n".join(block) + b"\n", np.uint8)


class Words:
    """Words (runs of bytes that are not ASCII white space, or the given ones) of a byte array, and their hashes.

    A hash is a polynomial over a word's bytes modulo 2**64, mixed; it depends on the word alone.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> None:
        if starts is None or ends is None:
            edge = np.diff(_SPACE[data].view(np.int8), prepend=np.int8(1))
            starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.starts, self.ends = starts, ends
        up, self._down = _powers.of(len(data) + 1)
        self._total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=self._total[1:])

    def hashes(self, first_bytes: int | None = None) -> np.ndarray:
        """A hash per word, or of the first bytes of each."""
        ends = self.ends if first_bytes is None else np.minimum(self.ends, self.starts + first_bytes)
        return _mixed((self._total[ends] - self._total[self.starts]) * self._down[self.starts])


def begins(block: list[bytes], starts: np.ndarray) -> np.ndarray:
    """Where the words of each text begin among words that start at the given bytes; the end is last."""
    return np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in block)]))


def word_hashes(block: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order (A-Z count as a-z), and where each text's begin."""
    words = Words(_LOWER[joined(block)])
    return words.hashes(), begins(block, words.starts)


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """One hash per position for the sequence of values that the parts have there."""
    value = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        value = (value ^ (value >> np.uint64(29))) * _MULTIPLY + part
    return _mixed(value)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every `size` words in a row; the whole sequence where there are fewer."""
    n = len(hashes)
    size = min(size, n)
    return chained([hashes[k:n - size + 1 + k] for k in range(size)]) if n else hashes


def shingle_sets(texts: list[str | None], size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For every text its distinct shingle hashes, sorted; empty without words."""
    for _, block in blocks(texts):
        hashes, at = word_hashes(block)
        whole = shingles(hashes, size)
        for begin, end in zip(at[:-1], at[1:]):
            if end - begin >= size:
                yield np.unique(whole[begin:end - size + 1])
            else:
                yield shingles(hashes[begin:end], size)
