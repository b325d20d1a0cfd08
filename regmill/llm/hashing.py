"""Vectorised 64-bit hashes of words and word windows over blocks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit numbers (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blocks(sizes: list[int], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded bytes together, one text at least."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


class Shingler:
    """Sets of word windows of texts, as sorted distinct 64-bit hashes.

    A word's hash is a polynomial over its bytes, from prefix sums over the whole block; a window's hash chains
    its words' hashes. ASCII letters count as lower case; words end at space and the controls 9 to 13. A text
    with fewer words than a window is one window of its own length; without words the set is empty.
    """

    def __init__(self, width: int):
        self.width = width
        with np.errstate(over="ignore"):
            self.letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.base = 0x9E3779B97F4A7C15
        self.powers = self.inverses = np.empty(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, BLOCK_BYTES)
            steps = np.full(n, self.base, np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps[1:] = pow(self.base, -1, 1 << 64)
            self.inverses = np.multiply.accumulate(steps)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and the number of words of each text."""
        joined = b" ".join(texts).lower() + b" "
        codes = np.frombuffer(joined, np.uint8)
        self._grow(len(codes))
        space = (codes == 32) | ((codes >= 9) & (codes <= 13))
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edges = np.concatenate([[0], edges])
        starts, ends = edges[0::2], edges[1::2]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.letters[codes] * self.powers[: len(codes)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverses[starts])
        limits = np.cumsum([len(t) + 1 for t in texts])
        counts = np.diff(np.searchsorted(starts, limits), prepend=0)
        return hashes, counts

    def _chain(self, parts: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(parts[0]), len(parts), np.uint64)
        for part in parts:
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + part)
        return out

    def windows(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The windows of each text of a block, in order, with repetitions."""
        hashes, counts = self.words(texts)
        w = self.width
        n = len(hashes) - w + 1
        chained = self._chain([hashes[k : k + n] for k in range(w)]) if n > 0 else np.empty(0, np.uint64)
        at = 0
        for count in counts.tolist():
            if count >= w:
                yield chained[at : at + count - w + 1]
            elif count:
                yield self._chain([hashes[at + k : at + k + 1] for k in range(count)])
            else:
                yield hashes[:0]
            at += count

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for begin, end in blocks([len(t) for t in texts]):
            for found in self.windows(texts[begin:end]):
                found = np.sort(found)
                if len(found) > 1:
                    found = found[np.concatenate([[True], found[1:] != found[:-1]])]
                yield found
