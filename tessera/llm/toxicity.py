"""Toxicity by a weighted lexicon.

Texts are folded (lower case, homoglyphs and digit substitutions to plain letters, words apart by one
space), the lexicon is matched by an Aho-Corasick automaton, hits inside exception phrases do not
count, and the sum of weights is divided by the logarithm of the length.  A logistic curve turns it
into a score.  Weights and curve come from a bounded sample of labelled texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ident_text, ids_of, split_of, written

#: Expected number of distinct labelled texts in the sample, of each class.
SAMPLE = 8000
#: Toxic texts of the sample that an entry needs.
LEAST_TEXTS = 3
#: Least log-odds of an entry; less so many standard errors, they must still be half of that.
LEAST_ODDS, ERRORS = 4.0, 2.0
#: Lengths of the word beginnings that may become entries, besides whole words.
STEMS = (4, 5, 6, 7)

# Words of the base lexicon, benign phrases, look-alikes and substitutions.
BASE = ("idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "dumbass", "imbecile", "bastard")
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "trash bag", "trash collection", "clown fish", "class clown costume", "pond scum", "sore loser rule")
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m", "т": "t", "һ": "h", "ԁ": "d", "ո": "n", "ѡ": "w",
    "α": "a", "ο": "o", "ι": "i", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "κ": "k", "ϲ": "c", "ı": "i", "ɡ": "g", "ⅼ": "l", "ⅰ": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

_FOLD = {ord(k): v for k, v in LOOKALIKES.items()}
_FOLD |= {0xFF21 + k: chr(97 + k) for k in range(26)} | {0xFF41 + k: chr(97 + k) for k in range(26)} | {0xFF10 + k: str(k) for k in range(10)}
_FOLD |= dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))
_ODD = re.compile("[" + "".join(map(chr, _FOLD)) + "]")
_DIGITS = str.maketrans(DIGITS)
_MIXED = re.compile(r"[^\s.,;:?\"()]*[013457@$!|][^\s.,;:?\"()]*")
_APART = re.compile(r"[\W\d_]+")
_LETTERS = re.compile(r"[^\W\d_]")


def _plain(m: re.Match) -> str:
    token = m.group().rstrip("@$!|*#%&")
    return token.translate(_DIGITS) if len(_LETTERS.findall(token)) >= 2 else token


def fold(text: str | None) -> str:
    """Folded words, each with a space before and after; nothing but a space for no words."""
    if not text:
        return " "
    t = text.lower()
    if not t.isascii() and _ODD.search(t):
        t = t.translate(_FOLD)
    if _MIXED.search(t):
        t = _MIXED.sub(_plain, t)
    return f" {_APART.sub(' ', t).strip()} " if t else " "


class Matcher:
    """Sum of the weights of a folded text's hits over the logarithm of its length."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
        self.automaton.make_automaton()

    def mass(self, folded: str) -> float:
        hits: dict[int, float] = {}
        exempt: list[tuple[int, int]] = []
        for end, (n, weight) in self.automaton.iter(folded):
            start = end - n + 1
            if weight is None:
                exempt.append((start, end))
            else:  # one hit a word: the heaviest
                hits[start] = max(weight, hits.get(start, 0.0))
        total, upto, k = 0.0, -1, 0
        exempt.sort()
        for s in sorted(hits):
            while k < len(exempt) and exempt[k][0] <= s:
                upto, k = max(upto, exempt[k][1]), k + 1
            if s >= upto:
                total += hits[s]
        return total / math.log2(2 + folded.count(" "))


def features(folded: str) -> set[str]:
    """Whole words (a space on both sides) and word beginnings (a space before)."""
    found = set()
    for w in set(folded.split()):
        if len(w) > 2:
            found.add(f" {w} ")
            found.update(f" {w[:n]}" for n in STEMS if len(w) >= n)
    return found


def choose(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """The lexicon from (feature, toxic texts, clean texts): log-odds weights of precise features, the
    most frequent first and of equals the longest; none that begins a chosen one or begins with it."""
    odds = lambda n, m: math.log((n + 0.5) / (toxic + 1)) - math.log((m + 0.5) / (clean + 1))
    seen = {f: (n, m) for f, n, m in counts}
    lexicon = {}
    for w in BASE:
        n, m = seen.get(f" {w} ", (0, 0))
        if n + m < LEAST_TEXTS or n * clean >= m * toxic:
            lexicon[f" {w} "] = max(odds(n, m), 2.0)
    begun: set[str] = set()
    for f in lexicon:
        begun.update(f[:k] for k in range(1, len(f) + 1))
    for f, n, m in sorted(counts, key=lambda x: (-x[1], -len(x[0]), x[0])):
        if n < LEAST_TEXTS or f in begun or any(f[:k] in lexicon for k in range(2, len(f))):
            continue
        error = math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5))
        if odds(n, m) >= LEAST_ODDS and odds(n, m) - ERRORS * error >= LEAST_ODDS / 2:
            lexicon[f] = odds(n, m)
            begun.update(f[:k] for k in range(1, len(f) + 1))
    return lexicon


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """(intercept, slope) of a ridge logistic regression by Newton steps."""
    a = np.column_stack([np.ones_like(x), x])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        g = a.T @ (weight * (p - y)) + ridge * beta
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _drawn(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` distinct labelled texts of each class, by hash: an id of each, its hash, label
    and weight, which is one over the sampling rate of its class."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.join(one, "doc_id").groupBy("hash").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    texts = written(texts, "toxicity-texts")
    n = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    u = F.pmod(F.xxhash64("hash", F.lit(13)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rate = F.lit(0.0)
    for label in (0, 1):
        rate = F.when(F.col("toxic") == label, F.lit(min(1.0, sample / max(n.get(label, 0), 1)))).otherwise(rate)
    return texts.withColumn("weight", rate).where(u < F.col("weight")).withColumn("weight", 1 / F.col("weight"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], tuple[float, float]]:
    """Lexicon and curve from labelled texts.  The sample is bounded (about ``sample`` texts of each
    class), so its ids are broadcast and only its texts are shuffled, besides ids and hashes; the driver
    gets the counts of precise features and three numbers for each sampled text.  The curve is that of
    all labelled texts: each sampled one stands for as many as its class's sampling rate says."""
    spark = docs.sparkSession
    full = docs.select("doc_id", "text").where(F.col("text").isNotNull()).withColumn("hash", F.xxhash64("text"))
    drawn = full.join(F.broadcast(_drawn(full.select("doc_id", "hash"), labels, sample)), ["doc_id", "hash"])
    texts = drawn.groupBy("text").agg(F.max("toxic").alias("toxic"), F.max("weight").alias("weight"))  # copies would make chance words look precise

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = (Counter(), Counter())
        for pdf in batches:
            for label, text in zip(pdf["toxic"], pdf["text"], strict=True):
                by[int(label == 1)].update(features(fold(text)))
        if by[0] or by[1]:
            keys = list(by[0].keys() | by[1].keys())
            yield pd.DataFrame({"f": keys, "n": [by[1][k] for k in keys], "m": [by[0][k] for k in keys]})

    sums = texts.mapInPandas(count, "f string, n long, m long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    toxic, clean = texts.agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)), F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1))).first()
    toxic, clean = toxic or 0, clean or 0
    # all that may become entries: precise features of the bounded sample, and the base words
    odds = F.log((F.col("n") + 0.5) / (toxic + 1)) - F.log((F.col("m") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("n") + 0.5) + 1 / (F.col("m") + 0.5))
    precise = (F.col("n") >= LEAST_TEXTS) & (odds >= LEAST_ODDS - 1e-6) & (odds - ERRORS * error >= LEAST_ODDS / 2 - 1e-6)
    counts = sums.where(precise | F.col("f").isin([f" {w} " for w in BASE])).collect()
    lexicon = choose([(r["f"], r["n"], r["m"]) for r in counts], toxic, clean)
    shared = spark.sparkContext.broadcast(lexicon)

    def masses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(shared.value)
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "weight": pdf["weight"], "x": [matcher.mass(fold(t)) for t in pdf["text"]]})

    got = texts.mapInPandas(masses, "toxic int, weight double, x double").collect()
    if not toxic or not clean:
        return lexicon, (-2.0, 4.0)
    x, y = np.array([r["x"] for r in got]), np.array([float(r["toxic"] == 1) for r in got])
    return lexicon, logistic(x, y, np.array([r["weight"] for r in got]))


RESULT = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, lexicon: dict[str, float], curve: tuple[float, float], exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    """Score every text of (doc_id, text; other columns are ignored): doc_id, held_out (crc32 of the
    id mod 5 is 0), score in 0 to 1, predicted.  Null and empty texts get the score of no hit."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, curve))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, (a, b) = shared.value
        matcher = Matcher(terms, exceptions)
        for pdf in batches:
            p = [1 / (1 + math.exp(-max(-700.0, min(700.0, a + b * matcher.mass(fold(t)))))) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": ids_of(pdf["ident"]), "held_out": pdf["held_out"].to_numpy(), "score": p, "predicted": [int(v >= 0.5) for v in p]})

    rows = docs.select(ident_text().alias("ident"), (split_of(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    return rows.mapInPandas(run, RESULT)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled documents whose crc32 of the id mod 5 is not 0, score all of them."""
    learn = split_of(F.col("doc_id"), 5) != 0
    return score(docs, *train(docs.select("doc_id", "text").where(learn), labels.select("doc_id", "toxic").where(learn)))
