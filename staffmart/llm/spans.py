"""Vectorised work on a block of UTF-8 text: spans of bytes and their 64-bit hashes.

A span's hash is a polynomial over random odd byte values modulo 2**64, finished by a mixer.
Prefix sums give every span of a block in a few passes over its bytes, without a Python object
per word.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_STEP = 1 << 22
_POWERS: dict[str, np.ndarray] = {}
_BYTES = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POWERS[key] = np.cumprod(a)
    return _POWERS["up"], _POWERS["down"]


def mix(v: np.ndarray) -> np.ndarray:
    v = v ^ (v >> np.uint64(31))
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(29)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(32)
    return v


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    terms = _BYTES[buf]
    terms *= up[:len(buf)]
    np.cumsum(terms, out=out[1:])
    return out


def hash_windows(sums: np.ndarray, width: int) -> np.ndarray:
    """:func:`hash_ranges` of every span of ``width`` bytes."""
    _, down = _powers(len(sums))
    h = sums[width:] - sums[:-width]
    h *= down[:len(h)]
    h += np.uint64(width * 0xD6E8FEB86659FD93 % 2**64)
    return mix(h)


def hash_ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of buf[start:end] from :func:`prefix_sums`; the length takes part."""
    _, down = _powers(len(sums))
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ascending spans, in steps of about 4 MB so that memory stays bounded."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _STEP, "right")))
        base = starts[at]
        sums = prefix_sums(buf[base:ends[to - 1]])
        out[at:to] = hash_ranges(sums, starts[at:to] - base, ends[at:to] - base)
        at = to
    return out


def byte_set(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


SPACES = byte_set(b"\x20\t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the bytes in ``inside``, not across rows: starts, ends, row of each."""
    if not len(buf):
        return (np.zeros(0, np.int64),) * 3
    w = inside[buf]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()
    last[:-1] &= ~w[1:]
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[full] = w[full]
    last[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = w[offsets[1:][offsets[1:] > offsets[:-1]] - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


class HashTable:
    """Sorted 64-bit keys with a value each; a small unsorted-in part is merged now and then.
    Cleared when it holds ``limit`` keys, so its memory is bounded."""

    def __init__(self, limit: int = 500_000):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]

    def __len__(self) -> int:
        return sum(len(k) for k, _ in self.parts)

    def find(self, keys: np.ndarray, missing: int = -1) -> np.ndarray:
        out = np.full(len(keys), missing, np.int64)
        for k, v in self.parts:
            if len(k):
                at = np.minimum(np.searchsorted(k, keys), len(k) - 1)
                hit = k[at] == keys
                out[hit] = v[at[hit]]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """``keys`` are new and distinct."""
        (big_k, big_v), (k, v) = self.parts
        k, v = np.concatenate((k, keys)), np.concatenate((v, values.astype(np.int64)))
        if 4 * len(k) > len(big_k):
            k, v = np.concatenate((big_k, k)), np.concatenate((big_v, v))
            big_k, big_v = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        order = np.argsort(k)
        k, v = k[order], v[order]
        self.parts = [(big_k, big_v), (k, v)] if len(big_k) else [(k, v), (big_k, big_v)]


LETTERS = byte_set(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def fold_case(buf: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and Latin-1 letters."""
    out = LOWER[buf]
    if len(out) > 1:
        upper = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        out[1:][upper] += 32
    return out
