"""Substring deduplication by super-k-mer partitioning.

A window is ``width`` consecutive words of one document.  Consecutive windows that share a minimiser
(the smallest hash of their word triples) travel as one packed string to the minimiser's bucket, so
equal windows meet in one bucket without shipping each window on its own.  In the bucket, sorting
brings equal windows together and their words are compared, so counts are exact.

Two measures keep any bucket small.  Each task first finds the windows that repeat inside its own
block of documents and ships only the first of them, so a group of copies sends one string a block.
And word triples that are frequent in the corpus come last in the order of minimisers, so a common
passage inside otherwise different windows doesn't draw them all to one bucket.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytewords import TO_SPACES, mix, numbered, powers, words_in
from tessera.llm.common import WORDS, give_back, words_of

WIDTH = 35
#: Words of a minimiser.
TRIPLE = 3
#: Words of a block of documents, and of a bucket on average.
BLOCK_WORDS, BUCKET_WORDS = 1_000_000, 1_000_000
#: A triple is frequent if it is more than this share of all words; blocks report those they hold so often.
FREQUENT_SHARE, FREQUENT_IN_BLOCK = 1 / (1 << 20), 24

_P = 0x9E3779B97F4A7C15
_Q = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: Bytes that a block holds for each of its words.
WORD_BYTES = 6


class Words:
    """The words of many texts, the lines of ``buffer``.  ``bounds`` are the places where a text begins,
    and the end; words are numbered by place."""

    def __init__(self, buffer: bytes, width: int):
        self.buffer, self.width = buffer, width
        self.begin, self.end, self.word = words_in(buffer)
        n = self.n = len(self.begin)
        lines = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 0x0A)
        self.bounds = np.concatenate([[0], np.searchsorted(self.begin, lines), [n]])
        self._back = powers(_Q, n)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.word * powers(_P, n), out=self._sums[1:])
        self.text = np.repeat(np.arange(len(self.bounds) - 1, dtype=np.int32), np.diff(self.bounds))
        #: where windows begin
        self.at = np.flatnonzero(np.arange(n) + width <= self.bounds[1:][self.text]) if n else np.zeros(0, np.int64)

    def hashes(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each place on."""
        k = self.n - length + 1
        return (self._sums[length:] - self._sums[:k]) * self._back[:k] if k > 0 else np.zeros(0, np.uint64)

    def triples(self) -> np.ndarray:
        return mix(self.hashes(TRIPLE)) >> np.uint64(1)

    def minimisers(self, frequent: np.ndarray) -> np.ndarray:
        """Smallest triple of each window; ``frequent`` (sorted) ones come after all others."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        low = self.triples()
        if len(frequent):
            place = np.minimum(np.searchsorted(frequent, low), len(frequent) - 1)
            low |= (frequent[place] == low).astype(np.uint64) << np.uint64(63)
        span, have = self.width - TRIPLE + 1, 1
        while have < span:
            step = min(have, span - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        return low[self.at]

    def first_equal(self) -> np.ndarray:
        """For each window, the number of the first one with the same words."""
        keys = self.hashes(self.width)[self.at]
        order = np.argsort(keys, kind="stable")
        first = np.arange(len(order))
        if not len(order):
            return first
        new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        first[order] = head
        rest = order[~new]
        ids = numbered(self.buffer, self.begin, self.end, self.word) if len(rest) else self.text
        a, b = self.at[rest], self.at[first[rest]]
        same = np.ones(len(rest), bool)
        for k in range(self.width):
            same &= ids[a + k] == ids[b + k]
        for key in np.unique(keys[rest[~same]]):  # different words of one hash
            seen: dict[bytes, int] = {}
            for w in np.sort(order[np.searchsorted(keys[order], key) : np.searchsorted(keys[order], key, "right")]):
                first[w] = seen.setdefault(ids[self.at[w] : self.at[w] + self.width].tobytes(), w)
        return first


def covered(at: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that begin at ``at`` (rising) as spans: the windows that begin and end each span."""
    if not len(at):
        return at, at
    cut = (at[1:] > at[:-1] + width) | (text[1:] != text[:-1])
    return np.concatenate([[0], np.flatnonzero(cut) + 1]), np.concatenate([np.flatnonzero(cut), [len(at) - 1]])


def _blocks(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """Keys of the texts of a block of about ``limit`` words, and the texts as lines."""
    one, two, texts, n = [], [], [], 0

    def done():
        return np.array(one, np.int64), np.array(two, np.int64), b"\n".join(texts)

    for pdf in batches:
        for k1, k2, t in zip(pdf["_k1"], pdf["_k2"], pdf["text"], strict=True):
            if t:
                one.append(k1)
                two.append(k2)
                texts.append(t.encode("utf-8", "surrogatepass").translate(TO_SPACES))
                n += len(texts[-1])
            if n >= limit * WORD_BYTES:
                yield done()
                one, two, texts, n = [], [], [], 0
    if texts:
        yield done()


def _frequent(keyed: DataFrame, width: int, block: int) -> tuple[int, list[int]]:
    """Number of words and the frequent triples, of which there are at most 1 / FREQUENT_SHARE."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, texts in _blocks(batches, block):
            w = Words(texts, width)
            t, n = np.unique(w.triples(), return_counts=True)
            often = n >= FREQUENT_IN_BLOCK
            yield pd.DataFrame({"t": np.append(t[often].astype(np.int64), -1), "n": np.append(n[often], w.n)})
        give_back()

    sums = keyed.mapInPandas(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    sums = sums.where((F.col("t") == -1) | (F.col("n") >= 2 * FREQUENT_IN_BLOCK)).persist()
    total = sums.where("t = -1").agg(F.max("n")).first()[0] or 0
    found = [r["t"] for r in sums.where((F.col("t") >= 0) & (F.col("n") > total * FREQUENT_SHARE)).select("t").collect()]
    sums.unpersist()
    return total, sorted(found)


SHIPPED = "bucket int, local boolean, size long, body binary, places binary"
SPANS = "_k1 long, _k2 long, start int, stop int"


def repeated_spans(keyed: DataFrame, width: int = WIDTH, block: int = BLOCK_WORDS, bucket: int = BUCKET_WORDS) -> DataFrame:
    """Spans of words covered by a window that starts anywhere else too: _k1, _k2, start, stop, for
    documents (_k1, _k2, text); spans of a document may overlap or repeat."""
    total, found = _frequent(keyed, width, block)
    shared = keyed.sparkSession.sparkContext.broadcast(np.array(found, np.uint64))
    buckets = max(1, 3 * total // bucket)

    def ship(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for one, two, texts in _blocks(batches, block):
            w = Words(texts, width)
            if not len(w.at):
                continue
            first = w.first_equal()
            times = np.bincount(first, minlength=len(first))
            twice = np.flatnonzero(times[first] > 1)
            rows = []
            at, text = w.at[twice], w.text[w.at[twice]]
            lo, hi = covered(at, text, width)
            spans = np.column_stack([one[text[lo]], two[text[lo]], at[lo] - w.bounds[text[lo]], at[hi] + width - w.bounds[text[lo]]]) if len(at) else np.zeros((0, 4), np.int64)
            if len(spans):
                rows.append((int(np.uint64(one[0].view(np.uint64)) % np.uint64(buckets)), True, len(spans), None, pack(spans.astype(np.int64).tobytes())))
            low = w.minimisers(shared.value)
            sent = np.flatnonzero(first == np.arange(len(first)))
            at, low = w.at[sent], low[sent]
            text = w.text[at]
            cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (low[1:] != low[:-1]) | (text[1:] != text[:-1])) + 1
            lo, hi = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(at) - 1]])
            to = (low[lo] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            ends = np.flatnonzero(np.diff(to[order])) + 1
            begin, last = at[lo], at[hi] + width - 1
            for group in np.split(order, ends):
                t = text[lo[group]]
                body = b"\n".join([texts[s:e] for s, e in zip(w.begin[begin[group]].tolist(), w.end[last[group]].tolist(), strict=True)])
                places = np.column_stack([one[t], two[t], begin[group] - w.bounds[t]])
                rows.append((int(to[group[0]]), False, len(group), pack(body), pack(places.tobytes())))
            for k in range(0, len(rows), 64):
                yield pd.DataFrame(rows[k : k + 64], columns=["bucket", "local", "size", "body", "places"])
        give_back()

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        def load(x: bytes, columns: int) -> np.ndarray:
            return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.int64).reshape(-1, columns)

        spans = [load(x, 4) for x in pdf.loc[pdf["local"], "places"]]
        sent = pdf.loc[~pdf["local"]]
        if len(sent):
            places = np.concatenate([load(x, 3) for x in sent["places"]])
            w = Words(b"\n".join([zstandard.ZstdDecompressor().decompress(x) for x in sent["body"]]), width)
            first = w.first_equal()
            at = w.at[np.bincount(first, minlength=len(first))[first] > 1]
            run = w.text[at]
            lo, hi = covered(at, run, width)
            r = run[lo]
            shift = places[r, 2] - w.bounds[r]
            spans.append(np.column_stack([places[r, 0], places[r, 1], at[lo] + shift, at[hi] + width + shift]))
        out = np.concatenate(spans) if spans else np.zeros((0, 4), np.int64)
        give_back()
        return pd.DataFrame({"_k1": out[:, 0], "_k2": out[:, 1], "start": out[:, 2].astype(np.int32), "stop": out[:, 3].astype(np.int32)})

    return keyed.mapInPandas(ship, SHIPPED).groupBy("bucket").applyInPandas(count, SPANS)


def removed(n: int, spans) -> np.ndarray:
    """Mask of the ``n`` words that lie in a span."""
    edge = np.zeros(n + 1, np.int64)
    for s, e in spans:
        edge[s] += 1
        edge[e] -= 1
    return np.cumsum(edge[:n]) > 0


def _with_spans(docs: DataFrame, width: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = docs.withColumns({"_k1": F.xxhash64(ident, text), "_k2": F.xxhash64(text, ident, F.lit(1))})
    spans = repeated_spans(keyed.select("_k1", "_k2", "text"), width)
    gathered = spans.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("start", "stop")).alias("_spans"))
    return keyed.join(gathered, ["_k1", "_k2"], "left").drop("_k1", "_k2")


DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document (doc_id, text; other columns are ignored): doc_id, n_words, n_removed, kept_sha256
    of the words that stay.  A null text has no words; rows that repeat repeat each other's windows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, t, spans in zip(pdf["doc_id"], pdf["text"], pdf["_spans"], strict=True):
                w = words_of(t)
                gone = removed(len(w), [(s["start"], s["stop"]) for s in spans]) if spans is not None else np.zeros(len(w), bool)
                kept = [x for x, g in zip(w, gone.tolist(), strict=True) if not g] if gone.any() else w
                out.append((i, len(w), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
            frame = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])
            yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    return _with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), width).mapInPandas(run, DIGEST)


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space that follows each of them."""
    found = list(WORDS.finditer(text))
    gone = removed(len(found), spans)
    if not gone.any():
        return text
    out, last = [], 0
    for k, m in enumerate(found):
        if gone[k]:
            out.append(text[last : m.start()])
            last = found[k + 1].start() if k + 1 < len(found) else len(text)
    return "".join(out) + text[last:]


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with repeated passages cut out of ``text``; other columns stay as they are, rows
    left without a word go (also those that had none)."""
    names = [c for c in docs.columns]
    rest = defaultdict(str, {c: f"c{k}" for k, c in enumerate(names) if c not in ("doc_id", "text")})
    inner = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(rest[c]) for c in rest])

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, spans in batches:
            yield pd.Series([None if t is None else t if s is None else cut_text(t, [(x["start"], x["stop"]) for x in s]) for t, s in zip(text, spans, strict=True)], dtype=object)
        give_back()

    out = _with_spans(inner, width)
    out = out.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut("text", "_spans"))).drop("_spans")
    out = out.where(F.col("text").rlike(WORDS.pattern))
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col(rest[c]).alias(c) for c in names])
