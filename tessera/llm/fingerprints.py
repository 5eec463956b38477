"""Document fingerprints: bottom-k sketches of word shingles.

The sketch of a set of shingles is its ``SIZE`` smallest 64-bit hashes.  Sketches merge (the smallest
of both), so a text may be read in parts and documents may be added up to sources or corpora.  Two
sketches estimate resemblance, containment and the number of distinct shingles; below ``SIZE``
shingles a sketch is the set itself and all three are exact.

Hashing runs over byte arrays that hold many texts at once.  A text above ``PART_BYTES`` is read part
by part: sums, the open word and the last words are carried over, so its shingles are those of the
whole text while memory stays that of a part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER
from tessera.llm.shingles import SHINGLE, mix

#: Hashes of a sketch; bytes of text that are hashed at once.
SIZE, PART_BYTES = 64, 1 << 20
#: Bytes of text and number of the ranges of documents that are read in order by one task.
RANGE_BYTES, MAX_RANGES = 4 << 20, 1 << 14

_BASE = 0xD6E8FEB86659FD93
_UP = np.full(PART_BYTES + 1, _BASE, np.uint64)
_UP[0] = 1
_UP = np.multiply.accumulate(_UP)
_DOWN = np.full(PART_BYTES + 1, pow(_BASE, -1, 1 << 64), np.uint64)
_DOWN[0] = 1
_DOWN = np.multiply.accumulate(_DOWN)
_SEPARATES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_VALUE = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))
_VALUE[[ord(c) for c in UPPER]] = _VALUE[[ord(c) for c in LOWER]]
_VALUE[_SEPARATES] = 0
_STEP = mix(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words from each place on."""
    k = len(words) - size + 1
    total = np.full(max(k, 0), size, np.uint64)
    for j in range(size if k > 0 else 0):
        total += words[j : j + k] * _STEP[j]
    return mix(total)


def smallest(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest distinct hashes, sorted."""
    n = len(hashes)
    if n > 8 * size:
        low = hashes[hashes <= np.uint64((4 * size << 64) // n)]
        low = np.unique(low)
        if len(low) >= size:
            return low[:size]
    return np.unique(hashes)[:size]


def merge(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    return np.union1d(a, b)[:size]


class _Reader:
    """Word hashes of one text that comes in parts."""

    def __init__(self) -> None:
        self.sum, self.up, self.down = np.uint64(0), np.uint64(1), np.uint64(1)
        self.open: tuple[np.uint64, np.uint64] | None = None  # sum and inverse power where a word began

    def words(self, part: bytes, last: bool) -> np.ndarray:
        b = np.frombuffer(part, np.uint8)
        sums = np.concatenate([[self.sum], self.sum + np.cumsum(_VALUE[b] * (_UP[: len(b)] * self.up), dtype=np.uint64)])
        inside = ~_SEPARATES[b]
        before = np.concatenate([[self.open is not None], inside])
        after = np.concatenate([inside, [not last and bool(len(b)) and bool(inside[-1])]])
        begin, end = np.flatnonzero(after & ~before), np.flatnonzero(before & ~after)
        base, back = sums[begin], _DOWN[begin] * self.down
        if self.open is not None:
            base, back = np.append(self.open[0], base), np.append(self.open[1], back)
        # a word that goes on at the end of the part stays open
        self.open = (base[-1], back[-1]) if len(base) > len(end) else None
        self.sum, self.up, self.down = sums[-1], self.up * _UP[len(b)], self.down * _DOWN[len(b)]
        return mix((sums[end] - base[: len(end)]) * back[: len(end)])


def _sketch_long(text: bytes, size: int) -> np.ndarray:
    reader, out, held = _Reader(), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        for s in range(0, len(text), PART_BYTES):
            words = np.concatenate([held, reader.words(text[s : s + PART_BYTES], s + PART_BYTES >= len(text))])
            if len(words) >= SHINGLE:
                out = merge(out, smallest(_shingles(words, SHINGLE), size), size)
            # shorter texts keep all their words until the end
            held = words[max(0, len(words) - SHINGLE + 1) :] if len(words) >= SHINGLE or len(out) else words
    return out if len(out) or not len(held) else smallest(_shingles(held, len(held)), size)


def _sketch_group(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sketches of texts of ``PART_BYTES`` together."""
    b = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    n = len(b)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[b] * _UP[:n], dtype=np.uint64)])
    inside = ~_SEPARATES[b]
    cut = np.zeros(n + 1, bool)
    cut[0] = True
    cut[ends] = True
    before, after = np.concatenate([[False], inside]), np.concatenate([inside, [False]])
    begin, end = np.flatnonzero(after & (~before | cut)), np.flatnonzero(before & (~after | cut))
    words = mix((sums[end] - sums[begin]) * _DOWN[begin])
    hashes = _shingles(words, SHINGLE)
    last = np.searchsorted(begin, ends).tolist()
    out, first = [], 0
    for e in last:
        k = e - first
        out.append(smallest(hashes[first : e - SHINGLE + 1], size) if k >= SHINGLE else smallest(_shingles(words[first:e], k), size) if k else np.zeros(0, np.uint64))
        first = e
    return out


def sketches(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """The sketch of each text (UTF-8): its ``size`` smallest shingle hashes, sorted.  Shingles are five
    words, A-Z lower-cased; fewer words are one shingle, no word is an empty sketch."""
    out: list[np.ndarray] = []
    group, n = [], 0
    for t in texts:
        if n + len(t) > PART_BYTES and group:
            out += _sketch_group(group, size)
            group, n = [], 0
        if len(t) > PART_BYTES:
            out.append(_sketch_long(t, size))
        else:
            group.append(t)
            n += len(t)
    return out + (_sketch_group(group, size) if group else [])


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode("ascii")


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def distinct_shingles(a: np.ndarray, size: int = SIZE) -> float:
    """Estimated number of distinct shingles; exact below ``size``."""
    return float(len(a)) if len(a) < size else (size - 1) * 2.0**64 / (float(a[size - 1]) + 1.0)


def compared(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> tuple[float, float]:
    """Estimated resemblance of two sets, and the share of the first one's shingles that the second has
    too.  Two empty sketches are equal (1, 1); an empty one is contained in any."""
    if not len(a) or not len(b):
        return float(len(a) == len(b)), float(not len(a))
    x, y = set(a.tolist()), set(b.tolist())
    both = sorted(x | y)[:size]
    common = sum(h <= both[-1] for h in x & y) / len(both)
    union = distinct_shingles(np.array(both, np.uint64), size)
    return common, min(1.0, common * union / distinct_shingles(a, size))


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    return compared(a, b, size)[0]


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    return compared(a, b, size)[1]


# ---------------------------------------------------------------- documents and groups of them

FINGERPRINT = "fingerprint string, n_shingles double"


def fingerprint_documents(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with the columns ``fingerprint`` and ``n_shingles`` (estimated distinct shingles) of
    ``text``; a null text counts as empty.  Columns of these names are replaced."""

    @F.pandas_udf(FINGERPRINT)
    def run(text: pd.Series) -> pd.DataFrame:
        found = sketches([(t or "").encode() for t in text], size)
        return pd.DataFrame({"fingerprint": [encode(s) for s in found], "n_shingles": [distinct_shingles(s, size) for s in found]})

    out = docs.drop("fingerprint", "n_shingles").withColumn("_f", run("text"))
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c != "_f"], "_f.fingerprint", "_f.n_shingles")


def fingerprint_groups(docs: DataFrame, by: str, size: int = SIZE, salts: int = 32) -> DataFrame:
    """One fingerprint for each value of ``by`` (null is a value): by, fingerprint, n_shingles, n_docs.
    Tasks merge what they have read, then salted parts merge, so that a hot group is no single task's."""

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        return np.unique(np.concatenate(parts))[:size]

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, part in pdf.groupby("by", dropna=False, sort=False):
                s = merged(sketches([(t or "").encode() for t in part["text"]], size))
                rows.append((None if pd.isna(key) else key, s.tobytes(), len(part)))
            yield pd.DataFrame(rows, columns=["by", "sketch", "n_docs"])

    def again(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf["by"].iloc[0]
        s = merged([np.frombuffer(x, np.uint64) for x in pdf["sketch"]])
        return pd.DataFrame({"by": [key], "sketch": [s.tobytes()], "n_docs": [int(pdf["n_docs"].sum())]})

    shape = "by string, sketch binary, n_docs long"
    parts = docs.select(F.col(by).cast("string").alias("by"), "text").mapInPandas(first, shape)
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("sketch"), F.lit(salts))).groupBy("by", "salt").applyInPandas(again, shape)

    @F.pandas_udf(FINGERPRINT)
    def shown(sketch: pd.Series) -> pd.DataFrame:
        found = [np.frombuffer(x, np.uint64) for x in sketch]
        return pd.DataFrame({"fingerprint": [encode(s) for s in found], "n_shingles": [distinct_shingles(s, size) for s in found]})

    whole = parts.groupBy("by").applyInPandas(again, shape).withColumn("_f", shown("sketch"))
    return whole.select(F.col("by").alias(by), "_f.fingerprint", "_f.n_shingles", "n_docs")


# ---------------------------------------------------------------- each document beside the next one

EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_edited double, n_shingles double"
_LAST = (1 << 63) - 1


def _cuts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Where ranges of about ``RANGE_BYTES`` begin in the order (k, h), from a sample of rows that is
    drawn by hash and bounded by about 64 rows a range."""
    total = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    wanted = min(MAX_RANGES, int(total["bytes"] or 0) // RANGE_BYTES + 1)
    share = max(1, int(total["n"]) // (64 * wanted))
    if wanted == 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    drawn = rows.where(F.pmod(F.xxhash64("k", "h", F.lit(11)), F.lit(share)) == 0).select("k", "h", "size").toPandas()
    drawn = drawn.sort_values(["k", "h"])
    weight = drawn["size"].cumsum().to_numpy()
    if not len(weight):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(weight, np.arange(1, wanted) * (weight[-1] / wanted))
    cuts = drawn.iloc[np.unique(at[at < len(drawn)])].drop_duplicates(["k", "h"])
    return cuts["k"].to_numpy(np.int64), cuts["h"].to_numpy(np.int64)


def _range_of(cut_k: np.ndarray, cut_h: np.ndarray):
    """Number of the range of each row: how many cuts are not after it."""

    @F.pandas_udf("int")
    def number(k: pd.Series, h: pd.Series) -> pd.Series:
        k, h = k.to_numpy(np.int64), h.to_numpy(np.int64)
        lo, hi = np.searchsorted(cut_k, k, "left"), np.searchsorted(cut_k, k, "right")
        out = hi.copy()
        for i in np.flatnonzero(hi > lo):
            out[i] = lo[i] + np.searchsorted(cut_h[lo[i] : hi[i]], h[i], "right")
        return pd.Series(out.astype(np.int32))

    return number


def edited_fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Per document (doc_id, text; other columns are ignored) the fingerprint of its text and of its
    edited text, whose last half of the code points (rounded down) is replaced by the first as many of
    the next document; their likeness and the share of its shingles that the edit keeps.

    The next document is the one after it by descending doc_id (null ids come last, rows of one id follow
    the hash of their text), after the last one the first.  A null text counts as empty; a document that
    is alone is its own next one.  Repeated rows are documents of their own, an empty table has no row.

    Documents are cut into ranges of the order; a task reads a range in order and gets, as a guest, the
    first document of the range after it."""
    ident = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(F.bitwise_not(ident), F.lit(_LAST)).alias("k"), ident.isNull().alias("none"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    narrow = rows.select("k", "h", (F.octet_length("text") + 16).alias("size"))
    number = _range_of(*_cuts(narrow))
    # the first document of each range: a row a range
    heads = narrow.select(number("k", "h").alias("r"), F.struct("k", "h").alias("head")).groupBy("r").agg(F.min("head").alias("head")).collect()
    heads = sorted((x["r"], x["head"]["k"], x["head"]["h"]) for x in heads)
    lead = docs.sparkSession.createDataFrame([(*after[1:], x[0]) for x, after in zip(heads, heads[1:] + heads[:1], strict=True)], "k long, h long, r int")
    guests = rows.join(F.broadcast(lead), ["k", "h"]).groupBy("r").agg(F.min("text").alias("text"))
    placed = rows.select("k", "none", "text", "h", number("k", "h").alias("r"), F.lit(False).alias("guest")).unionByName(
        guests.select(F.lit(_LAST).alias("k"), F.lit(True).alias("none"), "text", F.lit(0).cast("long").alias("h"), "r", F.lit(True).alias("guest"))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []  # the last document, whose next one has not come yet
        for pdf in batches:
            for lo in range(0, len(pdf), 256):
                part = pdf.iloc[lo : lo + 256]
                held += zip(part["k"].tolist(), part["none"].tolist(), part["text"], part["r"].tolist(), part["guest"].tolist(), strict=True)
                pairs = [(a, b) for a, b in zip(held, held[1:], strict=False) if not a[4] and a[3] == b[3]]
                held = held[-1:]
                if pairs:
                    yield _compare(pairs, size)

    dealt = placed.repartition(max(1, len(heads)), "r").sortWithinPartitions("r", "guest", "k", "h", "text")
    return dealt.select("k", "none", "text", "r", "guest").mapInPandas(run, EDITED)


def _compare(pairs: list[tuple], size: int) -> pd.DataFrame:
    own, edits, place = [], [], []
    for n, (a, b) in enumerate(pairs):
        half = len(a[2]) // 2
        edits.append((a[2][: len(a[2]) - half] + b[2][:half]).encode())
        if not n or a is not pairs[n - 1][1]:  # documents that follow each other are read once
            own.append(a[2].encode())
        place.append(len(own) - 1)
        own.append(b[2].encode())
    plain, changed = sketches(own, size), sketches(edits, size)
    out = []
    for (a, _), edit, e, at in zip(pairs, edits, changed, place, strict=True):
        s = plain[at]
        near, kept = compared(s, e, size)
        out.append((None if a[1] else ~a[0], len(a[2]), hashlib.sha256(edit).hexdigest(), encode(s), encode(e), near, resemblance(s, plain[at + 1], size), kept, distinct_shingles(s, size)))
    frame = pd.DataFrame(out, columns=[x.split()[0] for x in EDITED.split(", ")])
    return frame.assign(doc_id=pd.array([x[0] for x in out], "Int64"))
