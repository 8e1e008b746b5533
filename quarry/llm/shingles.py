"""Vectorised word and shingle hashes for Arrow-batched operators.

A word's hash is a polynomial over random byte values modulo 2**64, taken from
one running sum over all bytes of a batch; a shingle's hash combines those of
its words.  Nothing here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)
_BYTES = np.random.default_rng(20240607).integers(1, 2**64, 256, dtype=np.uint64)
#: Bytes hashed at a time; a longer text goes in pieces cut between words.
PIECE = 1 << 21

_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 2**64)
        _powers = tuple(
            np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, b))), dtype=np.uint64)
            for b in (np.uint64(_BASE), np.uint64(inverse))
        )
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that sums of similar words spread evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal(text: str | None) -> bytes:
    """Words in ASCII lower case, parted by one space: ``bytes`` methods know
    exactly the ASCII white space and A-Z that the contract names."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def _hash_piece(piece: bytes, stem: int = 0) -> np.ndarray:
    buf = np.frombuffer(piece, dtype=np.uint8)
    up, down = _power_tables(max(PIECE + 1, len(buf) + 1))
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[buf] * up[: len(buf)], out=sums[1:])
    ends = np.flatnonzero(buf == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    value = lambda to: mixed((sums[to] - sums[starts]) * down[starts] + (to - starts).astype(np.uint64))
    if not stem:
        return value(ends)
    # a column more: the hash of each word's first characters
    chars = np.flatnonzero((buf & 0xC0) != 0x80)
    first = np.searchsorted(chars, starts)
    cut = np.minimum(chars[np.minimum(first + stem, len(chars) - 1)], ends)
    return np.stack((value(ends), value(cut)), axis=1)


def _pieces(body: bytes) -> Iterator[bytes]:
    at = 0
    while len(body) - at > PIECE:
        cut = body.rfind(b" ", at, at + PIECE)
        cut = body.find(b" ", at + PIECE) if cut < at else cut
        if cut < 0:
            break
        yield body[at : cut + 1]
        at = cut + 1
    yield body[at:] if at else body


def word_hashes(body: bytes, stem: int = 0) -> np.ndarray:
    """Hashes of the words of one normalised text that ends with a space; with
    ``stem``, a second column hashes each word's first ``stem`` characters."""
    if not body:
        return np.zeros((0, 2) if stem else 0, np.uint64)
    return np.concatenate([_hash_piece(p, stem) for p in _pieces(body)])


def batch_word_hashes(bodies: list[bytes], stem: int = 0) -> Iterator[np.ndarray]:
    """The same for many normalised texts (no space at the end), in order."""
    group: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        counts = [b.count(b" ") + 1 if b else 0 for b in group]
        joined = b" ".join(b for b in group if b) + b" "
        flat = word_hashes(joined if joined != b" " else b"", stem)
        at = 0
        for n in counts:
            yield flat[at : at + n]
            at += n

    for body in bodies:
        if group and size + len(body) > PIECE - 2:
            yield from flush()
            group, size = [], 0
        group.append(body)
        size += len(body) + 1
    if group:
        yield from flush()


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` words; of fewer words, one for all of them."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        h = np.full(1, n, dtype=np.uint64)
        for w in words:
            h = h * _STEP + w
        return mixed(h)
    h = words[: n - k + 1].copy()
    for i in range(1, k):
        h *= _STEP
        h += words[i : n - k + 1 + i]
    return mixed(h)


def shingle_set(body: bytes, k: int) -> set[bytes]:
    """The shingles themselves, for exact checks."""
    words = body.split(b" ") if body else []
    if not words:
        return set()
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


class Places:
    """Sorted hashes, found by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.uint64(64 - max(1, min(int(len(keys)).bit_length() - 1, 24)))
        edges = np.arange(1 << int(np.uint64(64) - self.bits), dtype=np.uint64) << self.bits
        self.starts = np.append(np.searchsorted(keys, edges), len(keys)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of wanted; the number of keys for what isn't there."""
        out = np.full(len(wanted), len(self.keys), np.int64)
        lead = (wanted >> self.bits).astype(np.int64)
        at, end = self.starts[lead].astype(np.int64), self.starts[lead + 1]
        open_ = np.flatnonzero(at < end)
        while len(open_):
            here = at[open_]
            hit = self.keys[here] == wanted[open_]
            out[open_[hit]] = here[hit]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return out
