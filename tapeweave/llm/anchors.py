"""Minimizer anchors of byte texts: where equal windows must meet, whatever lies around them."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240517)
_BYTES = _rng.integers(0, 1 << 64, (2, 256), np.uint64)
_BASES = (0x9E3779B97F4A7C15 | 5, 0xD1342543DE82EF95 | 5)
_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    global _tables
    if not _tables or len(_tables[0][0]) < n:
        size = max(n, 1 << 22)
        _tables = []
        for base in _BASES:
            both = [np.full(size, x, np.uint64) for x in (base, pow(base, -1, 1 << 64))]
            for t in both:
                t[0] = 1
                np.cumprod(t, out=t)
            _tables.append(tuple(both))
    return _tables


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashes:
    """Hash of any substring of some bytes, from running sums."""

    def __init__(self, data: np.ndarray):
        self.sums = []
        for values, (power, inverse) in zip(_BYTES, _powers(len(data) + 1)):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * power[:len(data)], out=total[1:])
            self.sums.append((total, inverse))

    def of(self, which: int, start: np.ndarray, size) -> np.ndarray:
        total, inverse = self.sums[which]
        return mix((total[start + size] - total[start]) * inverse[start] + np.asarray(size).astype(np.uint64))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width``, by doubling."""
    done, least = 1, x
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    rest = width - done
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def anchors(data: np.ndarray, gram: int, window: int) -> dict[str, np.ndarray]:
    """Anchors of all windows of ``data``: for each the hash ``h`` of its gram, the hash ``g`` of all bytes of
    the windows that it owns, their first ``start``, their number ``n`` and the anchor's ``offset`` from it.

    A window belongs to its gram of the smallest hash (the leftmost of equal
    ones), so equal windows have equal anchors at equal offsets, and every
    window has one owner.
    """
    none = {k: np.zeros(0, np.int64) for k in ("h", "g", "start", "n", "offset")}
    if len(data) < window:
        return none
    hashes = Hashes(data)
    h = hashes.of(0, np.arange(len(data) - gram + 1), gram)
    width = window - gram + 1
    # the place is kept in the low bits, so the minimum brings it along
    bits = np.uint64(max(1, int(len(h)).bit_length()))
    packed = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    owner = (_sliding_least(packed, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    n = np.diff(np.append(start, len(owner)))
    at = owner[start]
    offset = at - start
    g = mix(hashes.of(1, start, n + window - 1) + offset.astype(np.uint64))
    return {"h": h[at].view(np.int64), "g": g.view(np.int64), "start": start, "n": n, "offset": offset}
