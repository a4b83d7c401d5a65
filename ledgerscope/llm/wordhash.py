"""Hashes of the words of many texts at once, from their UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_M = 1 << 64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, _M)
_SEGMENT = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUE = np.random.default_rng(7).integers(1, _M, 256, dtype=np.uint64)
_VALUE_LOWER = _VALUE.copy()
_VALUE_LOWER[65:91] = _VALUE[97:123]

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, b in enumerate((_BASE, _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of values[start:end] for each pair; equal runs hash alike wherever they stand."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:], dtype=np.uint64)
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _segment(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of data, which ends with a space."""
    space = _SPACE[data]
    edge = np.diff(space, prepend=True)
    bounds = np.flatnonzero(edge)
    start, end = bounds[0::2], bounds[1::2]
    values = (_VALUE_LOWER if lower else _VALUE)[data]
    return start, range_hashes(values, start, end)


def word_hashes(texts: list[str | None], lower: bool = False) -> Iterator[np.ndarray]:
    """One array of word hashes for each text, in order; a null text has none."""
    n = len(texts)
    at = 0
    while at < n:
        end, size, parts = at, 0, []
        while end < n and (size == 0 or size < _SEGMENT):
            parts.append((texts[end] or "").encode("utf-8", "surrogatepass"))
            size += len(parts[-1]) + 1
            end += 1
        data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        owners = np.cumsum([0] + [len(p) + 1 for p in parts])
        starts, hashes, begin = [], [], 0
        while begin < len(data):  # a very long text goes in segments that end at a space
            stop = min(begin + 4 * _SEGMENT, len(data))
            while stop < len(data) and not _SPACE[data[stop - 1]]:
                stop += 1
            s, h = _segment(data[begin:stop], lower)
            starts.append(s + begin)
            hashes.append(h)
            begin = stop
        starts, hashes = np.concatenate(starts), np.concatenate(hashes)
        cuts = np.searchsorted(starts, owners)
        for i in range(end - at):
            yield hashes[cuts[i] : cuts[i + 1]]
        at = end


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of `size` words; of the whole sequence if it is shorter, none if it is empty."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    factor = 1
    for j in range(size):
        out += words[j : j + n] * np.uint64(factor)
        factor = factor * _BASE % _M
    return mixed(out + np.uint64(size))
