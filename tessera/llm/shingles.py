"""Word shingles of texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from tessera.llm.bytewords import mix, words_in

SHINGLE = 5

#: Bytes of texts that are read at once.
GROUP_BYTES = 1 << 20
_STEP = mix(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)


def _joined(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words from each place on."""
    k = max(0, len(words) - size + 1)
    total = np.full(k, size, np.uint64)
    for j in range(size):
        total += words[j : j + k] * _STEP[j]
    return mix(total)


def _sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    begin, _, words = words_in(b"\n".join(texts), lower=True)
    hashes = _joined(words, size)
    ends = np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts])).tolist()
    out, first = [], 0
    for e in ends:
        own = hashes[first : e - size + 1] if e - first >= size else _joined(words[first:e], e - first) if e > first else hashes[:0]
        out.append(np.unique(own))
        first = e
    return out


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``size``-word shingles, with A-Z lower-cased;
    fewer words count as one shingle, no words as none."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    n = 0
    for t in texts:
        group.append(t.encode("utf-8", "surrogatepass") if t else b"")
        n += len(group[-1])
        if n >= GROUP_BYTES:
            out += _sets(group, size)
            group, n = [], 0
    return out + (_sets(group, size) if group else [])
