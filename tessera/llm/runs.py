"""Periodic runs of words: the branching-tandem test on an enhanced suffix array.

A run is a stretch of words that repeats a period and that no neighbour extends.  Its last square
(two periods) at place ``i`` is branching: the suffixes at ``i`` and ``i + d`` agree in exactly ``d``
words, so both lie in the LCP interval of depth ``d``, in different children.  So for each split of an
LCP interval the suffixes of the smaller side are looked at: is the suffix ``d`` words before or after
it on the other side?  The inverse suffix array answers that; no tree is built.  A square is rotated to
the left as far as the period holds, and squares of one stretch merge into its run of least period.

Arrays hold the words of a block of documents; the document is the highest part of the first key, so
suffixes of different documents never agree in a word.  Ranks of substrings of 1, 2, 4, ... words come
from prefix doubling and are kept: they also answer how far two places agree, to the right and to the left.
A text of m words takes about 100 bytes a word while it is read, and 4 more for each doubling of its
longest repeat.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import words_of

#: A run has at least so many periods and words.
PERIODS, LENGTH = 4, 6
#: Words of a block of documents; suffixes that are tested at once.
BLOCK_WORDS, TESTS = 200_000, 1 << 20


def suffix_ranks(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array, and for each l the ranks of the substrings of 2 ** l words from each place (equal
    ranks: equal substrings of one document, of full length), with -1 behind the last."""
    n = len(ids)
    key = doc.astype(np.int64) * (int(ids.max()) + 1) + ids
    sa = np.argsort(key, kind="stable")
    head = np.concatenate([[True], key[sa][1:] != key[sa][:-1]])
    rank = np.full(n + 1, -1, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels = [rank.astype(np.int32)]
    alone = head & np.append(head[1:], True)
    todo, reach = sa[~alone], 1
    while len(todo):
        after = todo + reach
        inside = after < n
        after = np.minimum(after, n - 1)
        second = np.where(inside & (doc[after] == doc[todo]), rank[after], -1)
        key = rank[todo] * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        todo, key = todo[order], key[order]
        old = rank[todo]
        at = np.arange(len(todo))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
        head = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(head, at, 0))
        rank[todo] = old + first - group
        levels.append(rank.astype(np.int32))
        todo, reach = todo[~(head & np.append(head[1:], True))], 2 * reach
    sa[rank[:n]] = np.arange(n)
    return sa, levels


def agreeing(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words agree from the places ``a`` and ``b`` on."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        out += (levels[k][a + out] == levels[k][b + out]).astype(np.int64) << k
    return out


def agreeing_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words agree just before the places ``a`` < ``b``."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x = a - out - (1 << k)
        same = (x >= 0) & (levels[k][np.maximum(x, 0)] == levels[k][np.maximum(b - out - (1 << k), 0)])
        out += same.astype(np.int64) << k
    return out


def _splits(lcp: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node (a place of ``lcp``) the first place of the left side and the last one of the right
    side: between them and the node all values are above, and not below, its value."""
    mins = [lcp]
    longest = np.diff(np.flatnonzero(np.concatenate([[True], lcp <= 0, [True]]))).max()
    while 2 << (len(mins) - 1) <= longest:
        half = 1 << (len(mins) - 1)
        low = mins[-1].copy()
        np.minimum(low[:-half], mins[-1][half:], out=low[:-half])
        mins.append(low)
    n, value = len(lcp), lcp[nodes]
    left, right = nodes - 1, nodes.copy()
    for k in range(len(mins) - 1, -1, -1):
        x = left - (1 << k) + 1  # the values at x .. left
        go = (x >= 1) & (mins[k][np.maximum(x, 0)] > value)
        left = np.where(go, x - 1, left)
        y = right + 1  # the values at y .. y + 2 ** k - 1
        go = (y + (1 << k) <= n) & (mins[k][np.minimum(y, n - 1)] >= value)
        right = np.where(go, right + (1 << k), right)
    return left, right


def branching_squares(sa: np.ndarray, levels: list[np.ndarray], most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places i and periods d of all squares whose halves agree in exactly d words from i and i + d on;
    ``most``: longest period that is looked for, for each place."""
    n = len(sa)
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    lcp = np.zeros(n, np.int32)
    pair = 1 + np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]])
    lcp[pair] = agreeing(levels, sa[pair - 1], sa[pair])
    nodes = pair[lcp[pair] <= most[sa[pair]]]
    if not len(nodes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = _splits(lcp, nodes)
    fewer = nodes - left <= right - nodes + 1
    begin, end = np.where(fewer, left, nodes), np.where(fewer, nodes - 1, right)
    lo, hi = np.where(fewer, nodes, left), np.where(fewer, right, nodes - 1)
    depth, size = lcp[nodes].astype(np.int64), end - begin + 1
    starts, periods = [], []
    last = np.cumsum(size)
    at = 0
    while at < len(nodes):
        to = max(at + 1, int(np.searchsorted(last, (last[at - 1] if at else 0) + TESTS, "right")))
        for node, place in _slices(begin[at:to], end[at:to]):
            node = at + node
            i, d = sa[place], depth[node]
            for j in (i - d, i + d):
                r = isa[np.clip(j, 0, n - 1)]
                hit = (j >= 0) & (j < n) & (r >= lo[node]) & (r <= hi[node])
                starts.append(np.minimum(i, j)[hit])
                periods.append(d[hit])
        at = to
    return np.concatenate(starts), np.concatenate(periods)


def _slices(begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The numbers begin .. end of each node, with the node's number, ``TESTS`` at a time."""
    size = end - begin + 1
    if len(size) == 1:  # a node may hold more than that
        for s in range(int(begin[0]), int(end[0]) + 1, TESTS):
            x = np.arange(s, min(s + TESTS, int(end[0]) + 1))
            yield np.zeros(len(x), np.int64), x
        return
    node = np.repeat(np.arange(len(size)), size)
    yield node, np.arange(len(node)) - np.repeat(np.cumsum(size) - size - begin, size)


def runs_of(texts: list[np.ndarray], periods: int = PERIODS, length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """For each text (words as numbers) its runs: start, length, smallest period, in that order."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts])
    if not sizes.sum():
        return out
    ids, doc = np.concatenate(texts), np.repeat(np.arange(len(texts)), sizes)
    bounds = np.cumsum(sizes) - sizes
    sa, levels = suffix_ranks(ids, doc)
    i, d = branching_squares(sa, levels, (sizes // periods)[doc])
    more = agreeing_before(levels, i, i + d)
    size = 2 * d + more
    long = size >= np.maximum(length, periods * d)
    start, size, d = (i - more)[long], size[long], d[long]
    order = np.lexsort((d, size, start))
    start, size, d = start[order], size[order], d[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (size[1:] != size[:-1])  # a stretch has its least period only
    for s, z, p in zip(start[new].tolist(), size[new].tolist(), d[new].tolist(), strict=True):
        out[doc[s]].append((s - int(bounds[doc[s]]), z, p))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Mask of the ``n`` words that a run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, size, period in runs:
        edge[start + period] += 1
        edge[start + size] -= 1
    return np.cumsum(edge[:n]) > 0


def _blocks(batches: Iterator[pd.DataFrame], change: Callable | None, limit: int) -> Iterator[tuple[list[int], list[list[bytes]], list]]:
    """Rows, their words and runs, in blocks of about ``limit`` words."""
    rows, words, n = [], [], 0

    def done():
        numbers: dict[bytes, int] = {}
        for w in itertools.chain.from_iterable(words):
            numbers.setdefault(w, len(numbers))
        return rows, words, runs_of([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words])

    for pdf in batches:
        for row in pdf.itertuples(index=False):
            w = words_of(row.text)
            rows.append(row)
            words.append(change(row, w) if change else w)
            n += len(w)
            if n >= limit:
                yield done()
                rows, words, n = [], [], 0
    if rows:
        yield done()


RUNS = "array<struct<start:long,length:long,period:long>>"


def collapse(docs: DataFrame) -> DataFrame:
    """The documents with the column ``runs`` (start, length, smallest period, in words) and with
    ``text`` cut to the words that no run repeats, joined by one space where there is a run; texts
    without a run, empty and null ones stay as they are.  A column ``runs`` is replaced, other columns
    stay."""
    inner = docs.drop("runs")

    @F.pandas_udf(f"text string, runs {RUNS}")
    def run(text: pd.Series) -> pd.DataFrame:
        out = []
        for rows, words, runs in _blocks(iter([pd.DataFrame({"text": text})]), None, BLOCK_WORDS):
            for row, w, r in zip(rows, words, runs, strict=True):
                kept = b" ".join(itertools.compress(w, (~dropped(len(w), r)).tolist())).decode() if r else row.text
                out.append((kept, [{"start": s, "length": z, "period": p} for s, z, p in r]))
        return pd.DataFrame(out, columns=["text", "runs"])

    found = inner.withColumn("_runs", run("text"))
    return found.select(*[F.col("_runs.text") if c == "text" else F.col(f"`{c}`") for c in inner.columns], "_runs.runs")


DIGEST = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def made_periodic(doc_id: str, words: list[bytes]) -> list[bytes]:
    """The words as the digest reads them: in one document of ten, told by the crc32 of its id, the words
    from some place on repeat a period."""
    h, n = zlib.crc32(doc_id.encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text; other columns are ignored): number of runs, its longest one (ties:
    smallest start, then period) and checksums of all runs and of the words that stay.  A null text has no
    word; a null id counts as the empty text where ids are hashed; repeated rows stay rows of their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, words, runs in _blocks(batches, lambda row, w: made_periodic(row.ident, w), BLOCK_WORDS):
            out = []
            for row, w, r in zip(rows, words, runs, strict=True):
                best = min(r, key=lambda x: (-x[1], x[0], x[2])) if r else None
                kept = list(itertools.compress(w, (~dropped(len(w), r)).tolist())) if r else w
                listed = "".join(f"{s},{z},{p}\n" for s, z, p in r)
                out.append((int(row.ident) if row.ident else None, len(r), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()))
            frame = pd.DataFrame(out, columns=[x.split()[0] for x in DIGEST.split(", ")], dtype=object)
            yield frame.astype({c: "Int64" for c in frame.columns if not c.endswith("sha256")})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("ident"), "text")
    return rows.mapInPandas(run, DIGEST)
