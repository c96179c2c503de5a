"""Vectorised word shingles of a batch of texts (numpy, used inside tasks).

A word is a maximal run of characters other than ASCII white space, lower-cased. A shingle is ``k``
consecutive words; a text of 1 to k - 1 words is one shingle of all its words; a text without words has none.
Words and shingles are 64-bit hashes computed for a whole batch at once: polynomial prefix sums over
the UTF-8 bytes give every word's hash, a second combination gives every shingle's.
"""

from __future__ import annotations

import numpy as np

K = 5
_R = np.uint64(0x9E3779B97F4A7C15)           # odd, so invertible modulo 2^64
_RINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240)).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self) -> None:
        self.fwd, self.inv = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.fwd) < n:
            m = 1 << max(16, (n - 1).bit_length())
            base = np.ones(m, np.uint64)
            self.fwd, self.inv = base.copy(), base.copy()
            self.fwd[1:], self.inv[1:] = _R, _RINV
            np.multiply.accumulate(self.fwd, out=self.fwd)
            np.multiply.accumulate(self.inv, out=self.inv)
        return self.fwd, self.inv


_POWERS = _Powers()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and their inverses, at least ``n`` of each."""
    return _POWERS.upto(n)


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial prefix sums over bytes and the inverse powers: (sums[e - 1] - sums[s - 1]) * inverse[s]
    is the same for equal bytes s..e wherever they stand."""
    fwd, inv = _POWERS.upto(len(data))
    return np.cumsum(_BYTE[data] * fwd[:len(data)], dtype=np.uint64), inv


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every text)."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    joined = b"\n" + b"\n".join(raw) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    prefix, inv = prefix_sums(data)
    words = mix64((prefix[end - 1] - prefix[start - 1]) * inv[start] + (end - start).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])              # the place of each text's closing newline
    return words, np.diff(np.searchsorted(start, np.concatenate(([0], ends))))


def shingle_hashes(texts: list[str | None], k: int = K, batch_bytes: int = 1 << 20):
    """Yield (index of first text, hashes, shingles per text) for runs of texts of bounded size."""
    at = 0
    while at < len(texts):
        stop, held = at, 0
        while stop < len(texts) and (stop == at or held + len(texts[stop] or "") <= batch_bytes):
            held += len(texts[stop] or "")
            stop += 1
        words, n = word_hashes(texts[at:stop])
        yield at, *_combine(words, n, k)
        at = stop


def _combine(words: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    first = np.repeat(np.cumsum(n) - n, counts)
    rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at, size = first + rank, np.repeat(np.minimum(n, k), counts)
    out = size.astype(np.uint64)
    for i in range(k):
        here = np.where(i < size, words[np.minimum(at + i, max(len(words) - 1, 0))], np.uint64(0)) if len(words) else out
        out = out * _R + here
    return mix64(out), counts


def sorted_sets(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text in ascending order, and how many."""
    ends = np.cumsum(counts)
    parts = [np.unique(hashes[e - c:e]) for e, c in zip(ends, counts)]
    return (np.concatenate(parts) if parts else hashes), np.array([len(p) for p in parts], np.int64)
