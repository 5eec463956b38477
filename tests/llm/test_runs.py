"""Periodic runs against the definition."""

import hashlib
import random
import zlib

import numpy as np

from tessera.llm import runs


def plain_runs(w, periods=4, length=6):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            e = i + q
            if e - s >= max(length, periods * q):
                found.setdefault((s, e), q)
    # the smallest period of a stretch, by the definition
    for (s, e), q in found.items():
        assert all(any(w[k] != w[k + p] for k in range(s, e - p)) for p in range(1, q))
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda x: (x[0], x[2]))


def texts(seed, count):
    r = random.Random(seed)
    for _ in range(count):
        kind, n = r.randrange(4), r.randrange(0, 60)
        if kind == 0:
            yield [r.randrange(2) for _ in range(n)]
        elif kind == 1:
            yield [r.randrange(6) for _ in range(n)]
        elif kind == 2:
            p = [r.randrange(3) for _ in range(r.randrange(1, 7))]
            yield [r.randrange(3) for _ in range(r.randrange(4))] + (p * 12)[: r.randrange(50)] + [r.randrange(3) for _ in range(r.randrange(4))]
        else:
            yield [7] * n


def test_runs_of_small_texts():
    many = list(texts(1, 1500))
    got = runs.runs_of([np.array(t, np.int64) for t in many])
    assert got == [plain_runs(t) for t in many]
    for periods, length in ((2, 2), (3, 4)):
        some = many[:400]
        assert runs.runs_of([np.array(t, np.int64) for t in some], periods, length) == [plain_runs(t, periods, length) for t in some]


def test_tests_in_slices(monkeypatch):
    many = [np.array(t, np.int64) for t in texts(2, 200)]
    want = runs.runs_of(many)
    monkeypatch.setattr(runs, "TESTS", 5)
    assert runs.runs_of(many) == want


def test_long_texts():
    r = np.random.default_rng(1)
    base = r.integers(0, 1000, 5000)
    text = np.concatenate([base, np.tile(r.integers(0, 1000, 1500), 5), base, np.full(3000, 5)])
    got = runs.runs_of([text, text[::-1].copy()])
    assert (5000, 7500, 1500) in got[0] and (17500, 3000, 1) in got[0] and len(got[0]) == len(got[1]) == 2


def plain_digest(i, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str("" if i is None else i).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    r = plain_runs(w)
    gone = {k for s, z, q in r for k in range(s + q, s + z)}
    best = sorted(r, key=lambda x: (-x[1], x[0], x[2]))[0] if r else (None,) * 3
    return (i, len(r), *best, 1000 * best[1] // best[2] if r else None, hashlib.sha256("".join(f"{s},{z},{q}\n" for s, z, q in r).encode()).hexdigest(), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())


def test_digest(spark):
    r = random.Random(3)
    rows = [(k, " ".join(r.choice("a b c été".split()) for _ in range(r.randrange(80)))) for k in range(300)]
    rows += [(None, "x y x y x y x y"), (None, None), (3, None), (4, ""), (4, " \n"), (5, "a\ta a\na a a a"), (5, "a\ta a\na a a a"), ((1 << 60) + 1, "z " * 9)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, runs string").repartition(3)
    got = sorted(repr(tuple(x)) for x in runs.digest(df).collect())
    assert got == sorted(repr(plain_digest(i, t)) for i, t in rows)
    assert runs.digest(df.limit(0)).collect() == []


def test_collapse(spark):
    df = spark.createDataFrame([(1, "a b a b a b a b c", 0), (2, "no  run", 0), (3, None, 0), (4, "", 0)], "doc_id long, text string, runs int")
    got = {r["doc_id"]: r for r in runs.collapse(df).collect()}
    assert got[1]["text"] == "a b c" and [tuple(x) for x in got[1]["runs"]] == [(0, 8, 2)]
    assert got[2]["text"] == "no  run" and got[3]["text"] is None and got[4]["text"] == "" and got[3]["runs"] == []
