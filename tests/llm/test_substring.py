import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import substring as S
from tessera.llm.common import words_of


def brute(rows, width):
    seen = Counter()
    words = [words_of(t) for _, t in rows]
    for w in words:
        for k in range(len(w) - width + 1):
            seen[tuple(w[k : k + width])] += 1
    out = Counter()
    for (i, _), w in zip(rows, words, strict=True):
        gone = {k + j for k in range(len(w) - width + 1) if seen[tuple(w[k : k + width])] > 1 for j in range(width)}
        out[i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()] += 1
    return out


def corpus(n=150, seed=0):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "of", "a", "é", "x\x85y"]) if r.random() < 0.5 else f"w{r.randrange(4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(n):
        w = [word() for _ in range(r.randrange(0, 200))]
        if i % 3 == 0:
            k = r.randrange(len(w) + 1)
            w[k:k] = passage[r.randrange(10) : r.randrange(30, 60)]
        rows.append((i, " ".join(w) if i % 4 else "\n ".join(w) + "\t"))
    rows += [(1000 + k, rows[7 * k % n][1]) for k in range(20)] + [rows[5], rows[5], (None, rows[6][1]), (None, None), (2000, None), (2001, "")]
    rows.append((3000, "again and again " * 700))
    near = rows[8][1].split() + [f"n{k}" for k in range(80)]
    for k in range(30):  # a large group of near copies
        w = list(near)
        w[r.randrange(len(w))] = f"edit{k}"
        rows.append((4000 + k, " ".join(w)))
    return rows


@pytest.mark.parametrize("block,bucket,share", [(1_000_000, 2_000_000, 1 / 2**20), (700, 900, 1 / 500)])
def test_digest_against_brute_force(spark, monkeypatch, block, bucket, share):
    rows = corpus()
    for name, v in (("BLOCK_WORDS", block), ("BUCKET_WORDS", bucket), ("FREQUENT_SHARE", share), ("FREQUENT_IN_BLOCK", 2)):
        monkeypatch.setattr(S, name, v)
    monkeypatch.setattr(S.repeated_spans, "__defaults__", (35, block, bucket))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, _k1 string").repartition(5)
    got = Counter(tuple(r) for r in S.digest(df).collect())
    assert got == brute(rows, 35)


def test_hash_collisions_are_told_apart(monkeypatch):
    w = S.Words(b"a b c\nx y z\na b c\nx y z", 3)
    monkeypatch.setattr(w, "hashes", lambda n: np.zeros(w.n - n + 1, np.uint64))
    assert w.first_equal().tolist() == [0, 1, 0, 1]


def test_cut_text():
    assert S.cut_text("a b\n c  d e", [(1, 3)]) == "a d e"
    assert S.cut_text(" a b ", [(1, 2)]) == " a "
    assert S.cut_text("a b", []) == "a b"


def test_remove_repeats(spark):
    rows = corpus(60, 1)
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, c0 int")
    out = S.remove_repeats(df).collect()
    want = brute(rows, 35)
    left = Counter((r["doc_id"], hashlib.sha256(b" ".join(words_of(r["text"]))).hexdigest()) for r in out)
    assert left == Counter({(i, h): c for (i, n, g, h), c in want.items() if n > g})
    assert {r["c0"] for r in out} == {7} and S.remove_repeats(df).columns == df.columns


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.digest(df).count() == 0 and S.remove_repeats(df).count() == 0
