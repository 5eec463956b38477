"""Words of texts as places in one byte buffer, with a 64-bit hash each, by array work over slices.

No word becomes an object of its own, so a block of texts takes its bytes and a few numbers a word."""

from __future__ import annotations

import numpy as np

#: Bytes that are hashed at once; a longer word is hashed on its own.
PART_BYTES = 1 << 18

SEPARATES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: For ``bytes.translate``: every separator becomes a space.
TO_SPACES = bytes(0x20 if s else b for b, s in enumerate(SEPARATES.tolist()))

_BASE = 0xD6E8FEB86659FD93


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = powers(_BASE, PART_BYTES + 1), powers(pow(_BASE, -1, 1 << 64), PART_BYTES + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal numbers stay equal, others spread."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLAIN = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))
_PLAIN[SEPARATES] = 0
_LOWERED = _PLAIN.copy()
_LOWERED[0x41:0x5B] = _PLAIN[0x61:0x7B]


def words_in(buffer: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of ``buffer`` begin and end, and their hashes; ``lower``: A-Z count as a-z."""
    import xxhash

    value, n, pos = _LOWERED if lower else _PLAIN, len(buffer), 0
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while pos < n:
        stop = min(pos + PART_BYTES, n)
        b = np.frombuffer(buffer, np.uint8, stop - pos, pos)
        apart = SEPARATES[b]
        if stop < n and not SEPARATES[buffer[stop]]:
            cuts = np.flatnonzero(apart)
            if not len(cuts):  # one word that is longer than a slice
                while stop < n and not SEPARATES[buffer[stop]]:
                    rest = np.flatnonzero(SEPARATES[np.frombuffer(buffer, np.uint8, min(PART_BYTES, n - stop), stop)])
                    stop = stop + int(rest[0]) if len(rest) else min(stop + PART_BYTES, n)
                word = buffer[pos:stop].lower() if lower else buffer[pos:stop]
                found.append((np.array([pos]), np.array([stop]), np.array([xxhash.xxh64_intdigest(word)], np.uint64)))
                pos = stop
                continue
            stop = pos + int(cuts[-1]) + 1
            b, apart = b[: stop - pos], apart[: stop - pos]
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(value[b] * _UP[: len(b)], out=sums[1:])
        step = np.diff(np.concatenate([[True], apart, [True]]).astype(np.int8))
        begin, end = np.flatnonzero(step < 0), np.flatnonzero(step > 0)
        found.append((begin + pos, end + pos, mix((sums[end] - sums[begin]) * _DOWN[begin])))
        pos = stop
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


def numbered(buffer: bytes, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number for each word, the same for equal words only: words of one hash are compared."""
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    own = np.arange(len(hashes))
    head = first[number]
    rest = own[head != own]
    a, b, size = begin[rest], begin[head[rest]], (end - begin)[rest]
    same = bool((size == (end - begin)[head[rest]]).all())
    data = np.frombuffer(buffer, np.uint8)
    cuts = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + 1, PART_BYTES))
    for lo, hi in zip(cuts, [*cuts[1:], len(rest)], strict=True):
        if not same or lo == hi:
            continue
        n = size[lo:hi]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        same = bool((data[np.repeat(a[lo:hi], n) + inside] == data[np.repeat(b[lo:hi], n) + inside]).all())
    if same:
        return number.astype(np.int64)
    seen: dict[bytes, int] = {}  # two words of one hash
    return np.array([seen.setdefault(buffer[s:e], len(seen)) for s, e in zip(begin.tolist(), end.tolist(), strict=True)], np.int64)
