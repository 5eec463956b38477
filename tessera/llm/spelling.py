"""Spelling variants: words that differ by one inserted, deleted or replaced character.

The index is one of variable-length grams.  A gram of ``SHORTEST`` characters that is frequent among
the words is not in the gram dictionary on its own; it is extended, character by character, until it is
rare, the word ends, or it has the longest useful length.  So a word's gram at each place is as short as
a short list allows.  An edit can change only grams that cover its place, so ``c``, the most grams that
cover one place of a word, bounds the affected ones: of a word's grams all but ``c`` stay, and two near
words share a gram among the ``c + 1`` rarest of either.  Only these lists are merged.

Pairs of m and of m or m + 1 characters are found in class m, where grams have at most m // 2
characters, so that one half of the word, the one without the edit, always holds a whole gram.  The
place of a gram in the word is part of its key.  Pairs that meet in a list are compared exactly.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, written
from tessera.llm.shingles import mix

#: Characters of a gram.
SHORTEST, LONGEST = 2, 8
#: A gram is frequent in more than so many places, and in more than this share of all places, so the
#: dictionary has at most (LONGEST - SHORTEST + 1) / FREQUENT_SHARE entries.
FREQUENT, FREQUENT_SHARE = 64, 1 / (1 << 18)
#: Words with one list key in one block; longer lists are cut into blocks that meet in pairs.
BLOCK = 1000
#: Long lists that are broadcast (16 bytes each); more are joined.
SENT = 200_000
#: Pairs compared at once; distinct words counted, and grams gathered, before a task passes them on.
PAIRS, COUNTED, GATHERED = 1 << 19, 200_000, 4_000_000

_LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWERED = str.maketrans(UPPER, LOWER)
_P = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- words and their counts


def vocabulary(docs: DataFrame, least: int = 7, times: int = 2, change: Callable[[str, str], str] | None = None) -> DataFrame:
    """word, n: the words of at least ``least`` characters that occur ``times`` or more in ``text``.
    Words are runs of Latin letters, A-Z lower-cased; ``change`` may replace a document's word (given
    its id as text and the word).  A null text has none; a null id is the empty text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for pdf in batches:
            for ident, text in zip(pdf["ident"], pdf["text"], strict=True):
                for w, n in Counter(_LETTERS.findall(text.translate(_LOWERED) if text else "")).items():
                    if len(w) >= least:
                        w = change(ident, w) if change else w
                        if len(w) >= least:
                            held[w] += n
                if len(held) >= COUNTED:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held = Counter()
        yield pd.DataFrame({"word": list(held), "n": list(held.values())}, columns=["word", "n"]).astype({"n": np.int64})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("ident"), "text")
    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


# ---------------------------------------------------------------- grams


class _Codes:
    """The characters of many words in one array; words are taken out by length."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.start = np.cumsum(self.size) - self.size

    def of(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The first ``width`` characters of the words ``rows``, of at least so many."""
        return self.flat[self.start[rows][:, None] + np.arange(width)]

    def padded(self, back: bool = False) -> np.ndarray:
        """All words from the front, or from the back, a row each, with 0 after their end."""
        at = np.arange(int(self.size.max(initial=0)) + 1)
        place = self.start[:, None] + ((self.size[:, None] - 1 - at) if back else at)
        inside = at < self.size[:, None]
        return np.where(inside, self.flat[np.where(inside, place, 0)], 0) if len(self.flat) else np.zeros(place.shape, np.uint32)


def _grown(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    return (h + code.astype(np.uint64) + np.uint64(1)) * _P


def _longest(size: int) -> int:
    return min(LONGEST, size // 2)


def frequent_grams(vocab: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the frequent grams, over all places of all words of ``vocab``.
    Longer grams count in the words that are long enough to use them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[np.ndarray] = []
        total = 0

        def done():
            h, n = np.unique(np.concatenate(parts), return_counts=True)
            return pd.DataFrame({"h": h.view(np.int64), "n": n.astype(np.int64)})

        for pdf in batches:
            codes = _Codes(pdf["word"].tolist())
            for size in np.unique(codes.size).tolist():
                at = codes.of(np.flatnonzero(codes.size == size), size)
                h = np.zeros(at.shape, np.uint64)
                for q in range(1, _longest(size) + 1):
                    h = _grown(h[:, : size - q + 1], at[:, q - 1 :])
                    if q >= SHORTEST:
                        parts.append(mix(h).ravel())
                        total += h.size
            if total >= GATHERED:
                yield done()
                parts, total = [], 0
        if parts:
            yield done()

    places = vocab.select(F.sum(F.length("word")).alias("s")).first()["s"] or 0
    least = max(FREQUENT, int(places * FREQUENT_SHARE))
    found = vocab.select("word").mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > least).toPandas()
    h, n = found["h"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def rare_grams(at: np.ndarray, longest: int, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For words of one length (a row of character codes each) the hashes of their grams at each place,
    and which of them are among the rarest that must be merged."""
    hashes, counts = known

    def times(h: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        return np.where(hashes[place] == h, counts[place], 0) if len(hashes) else np.zeros(h.shape, np.int64)

    size = at.shape[1]
    n = size - SHORTEST + 1
    h = np.zeros((len(at), n), np.uint64)
    for q in range(SHORTEST):
        h = _grown(h, at[:, q : q + n])
    long = np.full(h.shape, SHORTEST)
    freq = times(mix(h))
    for q in range(SHORTEST, longest):
        more = (freq > 0) & (long == q)
        more[:, max(0, size - q) :] = False  # the word ends
        row, col = np.nonzero(more)
        if not len(row):
            break
        h[row, col] = _grown(h[row, col], at[row, col + q])
        long[row, col] += 1
        freq[row, col] = times(mix(h[row, col]))
    cover = np.zeros((len(at), size + 1), np.int64)
    rows = np.arange(len(at))
    for p in range(n):
        cover[:, p] += 1
        np.subtract.at(cover, (rows, p + long[:, p]), 1)
    affected = np.cumsum(cover, 1).max(1)
    h = mix(h)
    place = np.broadcast_to(np.arange(n), h.shape)
    rank = np.empty(h.shape, np.int64)
    np.put_along_axis(rank, np.lexsort((place, h, freq), axis=1), place, 1)
    return h, rank <= affected[:, None]


def list_entries(words: list[str], known: tuple[np.ndarray, np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lists that the words belong to: row of the word, key of the list, whether the word is the
    longer kind of its class."""
    codes = _Codes(words)
    out = []
    for size in np.unique(codes.size).tolist():
        rows = np.flatnonzero(codes.size == size)
        at = codes.of(rows, size)
        for cls in (size, size - 1):
            if cls < least:
                continue
            h, use = rare_grams(at, _longest(cls), known)
            word, place = np.nonzero(use)
            gram = h[word, place]
            # right of an edit, the grams of the longer word stand one place further
            for shift in (0, 1) if cls < size else (0,):
                ok = place >= shift
                key = mix(gram[ok] + mix((place[ok] - shift).astype(np.uint64) * np.uint64(1 << 20) + np.uint64(cls)))
                out.append((rows[word[ok]], key, np.full(len(key), cls < size)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    return tuple(np.concatenate([x[k] for x in out]) for k in range(3))


# ---------------------------------------------------------------- pairs


def near(size: np.ndarray, front: np.ndarray, back: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words ``a`` and ``b`` differ by exactly one edit; the words are given by their lengths and
    their padded rows from either end."""
    most = np.maximum(size[a], size[b])
    agree = []
    for rows in (front, back):
        same = rows[a] == rows[b]
        same[:, -1] = False
        agree.append(np.argmin(same, axis=1))
    # the words agree before and after the edit; equal words agree all the way
    return (np.abs(size[a] - size[b]) <= 1) & (agree[0] + agree[1] >= most - 1) & (agree[0] < most)


def near_pairs(words: list[str], key: np.ndarray, long: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of entries that are neighbours by key; ``side`` (0, 1) of both must differ where it is
    not below 0."""
    codes = _Codes(words)
    letters = np.zeros(len(words), np.uint64)
    np.bitwise_or.at(letters, np.repeat(np.arange(len(words)), codes.size), np.uint64(1) << (mix(codes.flat.astype(np.uint64)) & np.uint64(63)))
    n = len(key)
    new = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), n) if n else np.zeros(1, np.int64)
    rest = np.repeat(new[1:], np.diff(new)) - np.arange(n) - 1
    ends = np.cumsum(rest)
    front, back = codes.padded(), codes.padded(back=True)
    found, at = [], 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        size = rest[at:to]
        a = np.repeat(np.arange(at, to), size)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size)
        ok = np.bitwise_count(letters[a] ^ letters[b]) <= 2
        a, b = a[ok], b[ok]
        ok = ~(long[a] & long[b]) & ((side[a] < 0) | (side[a] != side[b]))
        a, b = a[ok], b[ok]
        if len(a):
            ok = near(codes.size, front, back, a, b)
            found.append((a[ok], b[ok]))
        at = to
    return (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))


def linked_words(vocab: DataFrame, least: int = 7) -> DataFrame:
    """All near pairs of the distinct words of ``vocab`` (word, n) of at least ``least`` characters,
    which must be 2 * SHORTEST or more; once in each direction: word, other, other_n."""
    spark = vocab.sparkSession
    known = spark.sparkContext.broadcast(frequent_grams(vocab))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            row, key, long = list_entries(pdf["word"].tolist(), known.value, least)
            for lo in range(0, len(row), 50_000):
                part = slice(lo, lo + 50_000)
                yield pd.DataFrame({"key": key[part].view(np.int64), "long": long[part], "word": pdf["word"].to_numpy()[row[part]], "n": pdf["n"].to_numpy()[row[part]]})

    listed = vocab.select("word", "n").mapInPandas(entries, "key long, long boolean, word string, n long")
    # long lists are cut into blocks; each pair of blocks is a list of its own
    hot = written(listed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > BLOCK), "spelling-hot")
    few = hot.count() <= SENT
    cut = listed.join(F.broadcast(hot) if few else hot, "key", "left").withColumn("cut", F.coalesce(F.ceil(F.col("c") / BLOCK), F.lit(1)).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("word"), F.col("cut")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    block = F.when(F.col("cut") == 1, F.col("key")).otherwise(F.xxhash64("key", i, j))
    side = F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")).cast("byte")
    dealt = cut.select(block.alias("key"), "long", side.alias("side"), "word", "n").repartition(tasks, "key").sortWithinPartitions("key")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(pdf: pd.DataFrame) -> pd.DataFrame:
            word, n = pdf["word"].to_numpy(), pdf["n"].to_numpy()
            a, b = near_pairs(word.tolist(), pdf["key"].to_numpy(), pdf["long"].to_numpy(bool), pdf["side"].to_numpy())
            turn = word[a] > word[b]
            a, b = np.where(turn, b, a), np.where(turn, a, b)
            return pd.DataFrame({"word": word[a], "n": n[a], "other": word[b], "other_n": n[b]}).drop_duplicates(["word", "other"])

        held: list[pd.DataFrame] = []
        for pdf in batches:
            key = pdf["key"].to_numpy()
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if last or (held and held[0]["key"].iloc[0] != key[0]):
                yield found(pd.concat([*held, pdf.iloc[:last]]))
                held = []
            held.append(pdf.iloc[last:])
        if held:
            yield found(pd.concat(held))

    pairs = dealt.mapInPandas(merge, "word string, n long, other string, other_n long").distinct()
    both = F.array(F.struct("word", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.inline(both))


def followed(links: DataFrame) -> DataFrame:
    """word, root for the links (word, form), which have no circle: the last word that is reached.
    Every round doubles the steps."""
    step = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = step.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        # the distinct targets are looked up, so that a frequent one is no hot key
        jump = step.select("root").distinct().join(on, F.col("root") == F.col("_w")).select(F.col("root").alias("_w"), "_r")
        after = written(step.join(jump, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "spelling-roots")
        step = after.select("word", "root")
        if after.where("moved").isEmpty():
            return step


def variants(vocab: DataFrame, least: int = 7, factor: int = 10) -> DataFrame:
    """For the distinct words of ``vocab`` (word, n): form, the near word of largest n (ties: the
    smallest in code-point order) if that is at least ``factor`` (2 or more) times the word's n; root, where the
    forms lead to; n, n_near (number of near words) and form_n.  An empty vocabulary has no row."""
    vocab = written(vocab.select("word", "n").repartition(int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word"), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    nearest = linked_words(vocab, least).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows = vocab.join(nearest, "word", "left")
    good = -F.col("best.less") >= factor * F.col("n")
    rows = rows.select("word", F.when(good, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, -F.col("best.less")).alias("form_n"))
    rows = written(rows, "spelling-forms")
    roots = followed(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def deleted(ident: str, word: str, share: int = 31) -> str:
    """One (id, word) in ``share``, told by crc32, loses a character."""
    h = zlib.crc32(f"{ident}:{word}".encode())
    if h % share:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def variant_words(docs: DataFrame) -> DataFrame:
    """The variants of the words of ``docs`` (doc_id, text; other columns are ignored), where ``deleted``
    has made some; repeated rows count as often as they are there."""
    return variants(vocabulary(docs, change=deleted))
