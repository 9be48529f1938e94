"""Words and hashed word shingles of whole texts, vectorised over a batch of documents.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return;
A-Z count as a-z. A shingle is ``width`` consecutive words; a text with fewer words is one shingle, a text
without words (or null) has none. Shingles are 64-bit hashes: sets are compared by hash, so two different
shingles of one pair of documents are taken for the same with a chance of about 1e-13.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 18  # of text hashed together; some 40 times as much memory
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))


def _powers(step: int, n: int) -> np.ndarray:
    p = np.full(n, step, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


class _Powers:
    """Powers of the step and of its inverse, grown as longer chunks come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_STEP, n), _powers(pow(_STEP, -1, 1 << 64), n)
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` (lower-cased UTF-8) in order, and the number of words of each text."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _SPACE[joined]
    edge = np.diff(space.astype(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _POWERS.upto(len(joined) + 1)
    total = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[joined] * up[: len(joined)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, bounds), prepend=0)


def _shingle(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words) - width + 1
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out *= np.uint64(_STEP)
        out += words[k : n + k]
    return mix(out)


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    hashes, counts = word_hashes(texts)
    rolled = _shingle(hashes, width) if len(hashes) >= width else hashes[:0]
    at = 0
    for n in counts.tolist():
        if n >= width:
            yield np.unique(rolled[at : at + n - width + 1])
        elif n:
            # fewer words than a shingle: the whole sequence, told apart from longer ones by its length
            yield mix(_shingle(hashes[at : at + n], n) + np.uint64(n))
        else:
            yield hashes[:0]
        at += n


def shingle_sets(texts: list[str | None], width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order; chunks bound the memory."""
    chunk, size = [], 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass").lower()
        if chunk and size + len(raw) > CHUNK_BYTES:
            yield from _sets(chunk, width)
            chunk, size = [], 0
        chunk.append(raw)
        size += len(raw) + 1
    if chunk:
        yield from _sets(chunk, width)
