"""Benchmark decontamination: every passage of every document queries a BM25 index of the test items.

The index holds BM25 weights divided by the item's own score, so one threshold fits all items.  Items
of like length are neighbours and make up blocks, of which each posting list knows its greatest
weight.  Block-max WAND runs over the whole lists of a passage's terms: its pivot jumps over every block
whose maxima can't reach the threshold.  The sums of the block maxima, which it asks for, are a lower
layer: they are added up for many passages at once in arrays.  Every item above the threshold is then
verified by the shingles of its question and its answer in the passage.

Counts, document frequencies and lengths of all items come from one Spark job, so weights and passages
are the same however the items are cut into parts; a part of the index has a bounded size, and there is
one at a time on the driver and on an executor.  Documents stay where they are, without a shuffle.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, ident_text, ids_of, unused, written

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach to be verified.
THRESHOLD = 0.5
SHINGLE, OVERLAP = 5, 0.75
#: Items of a block, and characters of the items in one part of the index.
BLOCK, PART_CHARS = 4, 4 << 20
#: Least words between the beginnings of passages, which are twice as long.
STEP = 64

_TOKEN = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case."""
    return _TOKEN.findall(text.lower()) if text else []


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence with a word is the answer, what stands before it the question; an item of
    one sentence is a question alone."""
    parts = [p for p in map(tokens, _SENTENCE.split(text)) if p]
    if not parts:
        return [], []
    return (sum(parts[:-1], []), parts[-1]) if len(parts) > 1 else (parts[0], [])


class Corpus(NamedTuple):
    """Number of items with a word, of their words, words of the longest one, and the items that each
    term is in."""

    items: int
    words: int
    longest: int
    df: dict[str, int]


class Index:
    """Inverted index of items (id, text) with normalised BM25 weights and block maxima."""

    def __init__(self, items: list[tuple[int | None, str]], block: int = BLOCK, corpus: Corpus | None = None):
        """``corpus``: what holds for all items, where these are a part of them."""
        words = [(i, t, tokens(t)) for i, t in items]
        self.items = sorted((x for x in words if x[2]), key=lambda x: (len(x[2]), x[0] is None, x[0] or 0, x[1]))
        if corpus is None:
            corpus = Corpus(len(self.items), sum(len(w) for _, _, w in self.items), max((len(w) for _, _, w in self.items), default=0), Counter(t for _, _, w in self.items for t in set(w)))
        n, df, mean = corpus.items, corpus.df, corpus.words / max(corpus.items, 1)
        self.longest = corpus.longest
        self.term: dict[str, int] = {t: k for k, t in enumerate(dict.fromkeys(t for _, _, w in self.items for t in w))}
        lists: list[list[tuple[int, float]]] = [[] for _ in self.term]
        for d, (_, _, w) in enumerate(self.items):
            tf = Counter(w)
            raw = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / mean)) for t, c in tf.items()}
            own = sum(raw.values())
            for t, x in raw.items():
                lists[self.term[t]].append((d, x / own))
        self.docs = [[d for d, _ in p] for p in lists]
        self.weights = [[x for _, x in p] for p in lists]
        self.block = block
        self.blocks = -(-len(self.items) // block)
        self.maxima: list[dict[int, float]] = []
        for p in lists:
            most: dict[int, float] = {}
            for d, x in p:
                most[d // block] = max(x, most.get(d // block, 0.0))
            self.maxima.append(most)
        # the maxima once more, list after list
        self._from = np.concatenate([[0], np.cumsum([len(m) for m in self.maxima], dtype=np.int64)])
        self._block = np.fromiter((b for m in self.maxima for b in m), np.int64)
        self._most = np.fromiter((x for m in self.maxima for x in m.values()), np.float64)
        self.top = np.array([max(x) for x in self.weights] or [0.0])
        self._shingles: dict[int, tuple[set, set, set]] = {}

    def live(self, passages: list[np.ndarray], threshold: float) -> list[list[int]]:
        """For each passage (its distinct terms) the blocks whose maxima reach the threshold."""
        terms = np.concatenate(passages)
        owner = np.repeat(np.arange(len(passages)), [len(p) for p in passages])
        n = self._from[terms + 1] - self._from[terms]
        at = np.repeat(self._from[terms] - np.cumsum(n) + n, n) + np.arange(n.sum())
        cell = np.repeat(owner, n) * self.blocks + self._block[at]
        sums = np.bincount(cell, self._most[at], len(passages) * self.blocks)
        out: list[list[int]] = [[] for _ in passages]
        for c in np.flatnonzero(sums >= threshold - 1e-6).tolist():
            out[c // self.blocks].append(c % self.blocks)
        return out

    def search(self, terms: list[int], threshold: float, live: list[int] | None = None) -> list[tuple[int, float]]:
        """Block-max WAND: the items whose weights for ``terms`` (distinct) reach the threshold; ``live``
        are the blocks whose maxima do (rising)."""
        docs, weights, block = self.docs, self.weights, self.block
        if live is None:
            live = self.live([np.array(terms, np.int64)], threshold)[0] if terms else []
        found, limit = [], threshold - 1e-9
        if not live:
            return found
        at = dict.fromkeys(terms, 0)
        queue: list[tuple[int, int]] = []
        next_live = 0  # place in ``live``

        def advance(t: int, to: int) -> None:
            """Put the list of ``t`` back at its first item from ``to`` on."""
            at[t] = k = bisect_left(docs[t], to, at[t])
            if k < len(docs[t]):
                heapq.heappush(queue, (docs[t][k], t))

        for t in terms:
            advance(t, live[0] * block)
        while queue:
            # lists in the order of their current item, until their greatest weights may suffice
            taken, bound, pivot = [], 0.0, None
            while queue:
                d, t = heapq.heappop(queue)
                taken.append((d, t))
                bound += self.top[t]
                if bound >= limit:
                    pivot = d
                    break
            if pivot is None:
                break
            while queue and queue[0][0] == pivot:
                taken.append(heapq.heappop(queue))
            next_live = bisect_left(live, pivot // block, next_live)
            if next_live == len(live):
                break
            if live[next_live] > pivot // block:  # nothing before the next live block can suffice
                for _, t in taken:
                    advance(t, live[next_live] * block)
                continue
            if taken[0][0] < pivot:
                for d, t in taken:
                    if d < pivot:
                        advance(t, pivot)
                    else:
                        heapq.heappush(queue, (d, t))
                continue
            score = sum(weights[t][at[t]] for _, t in taken)
            if score >= limit:
                found.append((pivot, score))
            for _, t in taken:
                advance(t, pivot + 1)
        return found

    def overlaps(self, d: int, passage: set[tuple[str, ...]], words: list[str]) -> tuple[float, float, float]:
        """Shares of the shingles of the question, the answer and the whole item found in a passage."""
        if d not in self._shingles:
            q, a = question_answer(self.items[d][1])
            self._shingles[d] = shingles(q), shingles(a), shingles(self.items[d][2])
        out = []
        for s in self._shingles[d]:
            short = next(iter(s), ()) if len(s) == 1 else ()
            if s and len(short) < SHINGLE and short:
                k = len(short)
                out.append(float(any(tuple(words[j : j + k]) == short for j in range(len(words) - k + 1))))
            else:
                out.append(len(s & passage) / len(s) if s else 1.0)
        return out[0], out[1], out[2]

    def leaks(self, words: list[str], threshold: float = THRESHOLD) -> list[tuple[int, float, float, float, float]]:
        """(item id, BM25 share, question, answer and whole overlap) of the items in a text, the best
        passage of each."""
        get, step = self.term.get, max(STEP, self.longest)
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return []
        sums = np.concatenate([[0.0], np.cumsum(self.top[ids[known]])])
        starts = np.arange(0, max(1, len(words) - step), step)
        lo, hi = np.searchsorted(known, starts), np.searchsorted(known, starts + 2 * step)
        best: dict[int, tuple] = {}
        passages = [(x, np.unique(ids[known[i:j]])) for x, i, j in zip(starts.tolist(), lo.tolist(), hi.tolist(), strict=True) if sums[j] - sums[i] >= threshold - 1e-6]
        for k in range(0, len(passages), 256):
            part = passages[k : k + 256]
            inside: dict[int, set] = {}
            for m, live in enumerate(self.live([t for _, t in part], threshold)):
                s, terms = part[m]
                for d, score in self.search(terms.tolist(), threshold, live) if live else ():
                    passage = words[s : s + 2 * step]
                    if m not in inside:
                        inside[m] = shingles(passage)
                    q, r, whole = self.overlaps(d, inside[m], passage)
                    if whole >= OVERLAP or (q >= OVERLAP and r >= OVERLAP):
                        row = (whole, score, q, r)
                        best[d] = max(best.get(d, row), row)
        return [(self.items[d][0], score, q, r, whole) for d, (whole, score, q, r) in sorted(best.items())]


RESULT = "doc_id long, item_id long, bm25 double, question_overlap double, answer_overlap double, overlap double"


def _indexes(items: DataFrame) -> tuple[int, Iterator[Index]]:
    """The number of parts of about PART_CHARS characters, and the index of one after the other, each
    with the counts of all items.  Items with a null text have no word; a null id is an id."""
    spark = items.sparkSession

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"words": [len(tokens(t)) for t in pdf["text"]], "terms": [list(set(tokens(t))) for t in pdf["text"]]})

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = texts.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    n = max(1, math.ceil(size / PART_CHARS))
    counted = written(texts.select("text").mapInPandas(read, "words long, terms array<string>").where("words > 0"), "decontam-items")
    all_items = counted.agg(F.count(F.lit(1)), F.sum("words"), F.max("words")).first()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = written(df, "decontam-terms") if n > 1 else df

    def build() -> Iterator[Index]:
        for k in range(n):
            part = texts.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
            rows = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
            terms = df
            if n > 1:  # the terms of this part: no more than its words
                own = spark.createDataFrame([(t,) for t in {t for _, x in rows for t in tokens(x)}], "term string")
                terms = df.join(own, "term")
            yield Index(rows, corpus=Corpus(all_items[0] or 0, all_items[1] or 0, all_items[2] or 0, {r["term"]: r["df"] for r in terms.collect()}))

    return n, build()


def _found(docs: DataFrame, items: DataFrame, threshold: float, columns: list[str], shape: str, rows) -> DataFrame:
    """What ``rows`` makes of the texts of ``docs`` with one index after the other."""
    parts, indexes = _indexes(items)
    out: list[DataFrame] = []
    for index in indexes:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield rows(pdf, shared.value, threshold)

        found = docs.select(*columns).mapInPandas(run, shape)
        if parts == 1:
            return found
        out.append(written(found, "decontam-found"))
        shared.destroy()
    return reduce(DataFrame.unionByName, out)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document (doc_id, text) and test item (item_id, text) found in it: doc_id,
    item_id, bm25 (share of the item's own score), question_overlap, answer_overlap, overlap.  An item
    counts as found if a passage holds three quarters of its shingles, or of its question's and of its
    answer's.  Null texts, texts and items without a word have no row; repeated rows have theirs each;
    documents and items without an id are searched like all others, with a null in the result."""

    def rows(pdf: pd.DataFrame, index: Index, threshold: float) -> pd.DataFrame:
        found = [(i, *x) for i, t in zip(pdf["ident"], pdf["text"], strict=True) for x in index.leaks(tokens(t), threshold)]
        frame = pd.DataFrame(found, columns=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap", "overlap"])
        return frame.assign(doc_id=ids_of(frame["doc_id"]), item_id=pd.array(frame["item_id"].tolist(), "Int64"))

    return _found(docs.select(ident_text().alias("ident"), "text"), items, threshold, ["ident", "text"], RESULT, rows)


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no test item is found, all columns as they are."""
    (hit,) = unused(docs.columns, "hit")
    parts, indexes = _indexes(items)
    if parts == 1:
        shared = docs.sparkSession.sparkContext.broadcast(next(indexes))

        @F.pandas_udf("boolean")
        def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for text in batches:
                yield pd.Series([not shared.value.leaks(tokens(t)) for t in text], dtype=bool)
            give_back()

        return docs.where(clean(F.col("text")))

    def rows(pdf: pd.DataFrame, index: Index, threshold: float) -> pd.DataFrame:
        return pd.DataFrame({"text": [t for t in pdf["text"] if t and index.leaks(tokens(t), threshold)]}, dtype=object)

    # the texts that hold an item: few, as long as the corpus is not made of tests
    bad = _found(docs.select("text"), items, THRESHOLD, ["text"], "text string", rows).distinct()
    return docs.join(bad.withColumnRenamed("text", hit), F.col("text") == F.col(hit), "left_anti")
