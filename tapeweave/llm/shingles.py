"""Word shingles of texts as 64-bit hashes, for many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

GROUP_BYTES = 1 << 19
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 & ~2 | 1 | 4
_PLACES = _rng.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)
_power = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spreads the bits of hashes (a finaliser of multiplications and shifts)."""
    h = h + np.uint64(seed)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power, _inverse
    if len(_power) < n:
        size = max(n, 2 * GROUP_BYTES)
        _power, _inverse = (np.full(size, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        _power[0] = _inverse[0] = 1
        _power, _inverse = np.cumprod(_power), np.cumprod(_inverse)
    return _power[:n], _inverse[:n]


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles of ``words`` words, as sorted int64 hashes.

    Words are runs of other characters than x20 and x09 to x0D, A-Z in lower
    case. Fewer words than ``words`` are one shingle; no words (null, empty) none.
    """
    run: list[bytes] = []
    size = 0
    for t in texts:
        run.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(run[-1]) + 1
        if size >= GROUP_BYTES:
            yield from _group(run, words)
            run, size = [], 0
    yield from _group(run, words)


def _group(run: list[bytes], words: int) -> Iterator[np.ndarray]:
    if not run:
        return
    data = np.frombuffer(b"\n".join([b"", *run, b""]), np.uint8)
    edges = np.cumsum([1, *(len(b) + 1 for b in run)])
    blank = _SPACE[data]
    power, inverse = _powers(len(data))
    total = np.cumsum(np.where(blank, np.uint64(0), _BYTE[data]) * power)
    begin = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    end = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    word = mix((total[end - 1] - total[begin - 1]) * inverse[begin] + (end - begin).astype(np.uint64))
    of = np.searchsorted(begin, edges)
    k = len(word) - words + 1
    full = np.zeros(max(k, 0), np.uint64)
    for i in range(words if k > 0 else 0):
        full += word[i:i + k] * _PLACES[i]
    full = mix(full).view(np.int64)
    for a, b in zip(of.tolist(), of[1:].tolist()):
        if b - a >= words:
            yield np.unique(full[a:b - words + 1])
        elif b > a:
            short = (word[a:b] * _PLACES[:b - a]).sum(dtype=np.uint64)
            yield mix(np.array([short]), 1 + b - a).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def signature(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    v = values.view(np.uint64)
    return tuple(int(mix(v, s).sum(dtype=np.uint64).view(np.int64)) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
