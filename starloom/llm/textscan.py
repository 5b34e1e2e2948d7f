"""Words, lines and their 64-bit hashes in numpy, a few megabytes of text at a time.

A word is a run of bytes other than space, tab, newline, vertical tab, form feed
and carriage return; none of these occurs inside a UTF-8 sequence. A hash is a
polynomial in a random odd base over random values per byte, modulo 2**64, then
mixed with the length. Equal words have equal hashes in every batch and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
_random = np.random.default_rng(20240607)
_BASE = np.uint64(int(_random.integers(1 << 62)) * 2 + 1)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTERS = np.ones(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_ALNUM = _LETTERS.copy()
_ALNUM[0x30:0x3A] = False
# What separates words: white space, or all ASCII that is no letter (or digit). Other characters count as letters there.
SEPARATORS = {"blank": _BLANK, "letters": _LETTERS, "alnum": _ALNUM}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) <= n:
        for k, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Some bytes, and hashes of ranges of them."""

    def __init__(self, data: np.ndarray):
        self.data = data
        powers = _powers_to(len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * powers[0][: len(data)], out=self._sums[1:])

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        shifted = (self._sums[ends] - self._sums[starts]) * _powers_to(len(self.data))[1][starts]
        return mix(shifted + (ends - starts).astype(np.uint64))


class Words(Spans):
    """The words of some texts: hash, start, end (bytes in data) and, per text, the first word's place in bounds."""

    def __init__(self, texts: list[bytes], lower: bool = False, words: str = "blank"):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        data = np.frombuffer(b"".join(texts), np.uint8)
        super().__init__(_LOWER[data] if lower else data)
        n = len(data)
        word = np.zeros(n + 2, bool)
        word[1:-1] = ~SEPARATORS[words][data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        self.starts = np.flatnonzero(word[1:] & (~word[:-1] | edge))
        self.ends = np.flatnonzero(word[:-1] & (~word[1:] | edge))
        self.hashes = self.hash_spans(self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of size words inside a text, and the bounds of each text in them.

        A text of fewer words, but at least one, has one shingle: all its words.
        """
        counts = self.counts()
        amounts = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        bounds = np.concatenate(([0], np.cumsum(amounts)))
        first = np.repeat(self.bounds[:-1] - bounds[:-1], amounts) + np.arange(bounds[-1])
        short = np.repeat(np.minimum(counts, size), amounts)
        base, out = int(_BASE), np.zeros(len(first), np.uint64)
        padded = np.concatenate((self.hashes, np.zeros(size, np.uint64)))
        for k in range(size):
            out = out * np.uint64(base) + np.where(short > k, padded[first + k], np.uint64(0))
        return mix(out + short.astype(np.uint64)), bounds


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together hold about size bytes; a longer text stands alone."""
    first = held = 0
    for k, text in enumerate(texts):
        if k > first and held + len(text) > size:
            yield first, k
            first, held = k, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def hash_of(word: str | bytes) -> int:
    """The hash of one word, as Words gives it."""
    data = np.frombuffer(word.encode() if isinstance(word, str) else word, np.uint8)
    return int(Spans(data).hash_spans(np.array([0]), np.array([len(data)]))[0])


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of data one after the other."""
    ends = np.cumsum(lengths)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)]
