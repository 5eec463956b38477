import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import neardup as N
from tessera.llm.common import words_of
from tessera.llm.shingles import shingle_sets


def shingles(text):
    w = [x.lower() for x in words_of(text)]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            u = len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * u:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(i, low.get(find(k), i))
    return Counter((i, len(s), low[find(k)], i == low[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed, n=60):
    r = random.Random(seed)
    text = lambda k: " ".join(r.choice(["The", "of", "A"]) if r.random() < 0.3 else f"w{r.randrange(3000)}" for _ in range(k))
    rows = [(i, text(r.choice([1, 3, 4, 5, 6, 9, 30, 120]))) for i in range(n)]

    def edited(t, edits):
        w = t.split()
        for _ in range(edits):
            w[r.randrange(len(w))] = f"e{r.randrange(9999)}"
        return " ".join(w)

    base, long = text(150), text(400)
    rows += [(200 + k, edited(base, r.randrange(0, 9))) for k in range(60)]  # a family around the limit
    rows += [(400 + k, edited(long, r.randrange(4, 18))) for k in range(30)]
    chain = text(60)
    for k in range(25):  # neighbours alike, ends different
        chain = edited(chain, 1)
        rows.append((600 - k, chain))
    rows += [(700, rows[6][1].upper()), (701, "a b"), (702, "A  B"), (703, "a b c"), (704, ""), (705, "\t\n"), (706, "x " * 50)]
    return rows


def test_sets_against_plain_shingles():
    texts = [t for _, t in corpus(3)] + [None, "é É ß a a a a a a a"]
    for t, s in zip(texts, shingle_sets(texts), strict=True):
        assert len(s) == len(shingles(t)) and (np.diff(s.astype(object)) > 0).all()


@pytest.mark.parametrize("seed,fan,block", [(0, 2000, 8 << 20), (1, 5, 3000)])
def test_components_against_brute_force(spark, monkeypatch, seed, fan, block):
    monkeypatch.setattr(N, "FAN", fan)
    monkeypatch.setattr(N, "BLOCK_BYTES", block)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(4)
    assert Counter(tuple(r) for r in N.near_duplicates(df).collect()) == brute(rows)


def test_residual_buckets_alone_find_all_links(spark, monkeypatch):
    # stars that confirm nothing leave every link to the comparison inside buckets
    real, calls = N.confirm, []

    def confirm(edges, sets):
        calls.append(1)
        return real(edges.limit(0) if len(calls) == 1 else edges, sets)

    monkeypatch.setattr(N, "confirm", confirm)
    monkeypatch.setattr(DataFrameType, "join", join_without_anti)
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in N.near_duplicates(df).collect()) == brute(rows)


from pyspark.sql.classic.dataframe import DataFrame as DataFrameType  # noqa: E402

_JOIN = DataFrameType.join


def join_without_anti(self, other, on=None, how=None):
    return self if how == "left_anti" and on == ["a", "b"] else _JOIN(self, other, on, how)


def test_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "only here and now then"), (None, None), (2, None), (3, ""), (3, "z")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string")
    out = Counter(tuple(r) for r in N.near_duplicates(df).collect())
    assert out == Counter({(1, 2, 1, True): 2, (None, 2, 1, False): 1, (None, 1, None, True): 1, (None, 0, None, True): 1, (2, 0, 2, True): 1, (3, 0, 3, True): 1, (3, 1, 3, True): 1})
    assert N.near_duplicates(df.limit(0)).count() == 0
    kept = N.keep_first(df)
    assert kept.columns == df.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter({None: 2, 1: 1, 2: 1, 3: 2})


def test_only_linked_rows_go(spark):
    """Other texts under one id stay, copies without an id go; which row stays doesn't depend on chance."""
    one, two, three = ("first text of five words and more", "second one has other words in it", "a third text that is like none")
    rows = [(1, one), (1, two), (1, one), (2, two), (None, three), (None, three), (None, one), (3, three + " x"), ((1 << 60) + 1, "x y z u v w"), ((1 << 60), "x y z u v w")]
    df = spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, text string, row string, ident int").repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in N.keep_first(df).collect())
    assert got == Counter([(1, one), (1, two), (3, three + " x"), (1 << 60, "x y z u v w")])


def test_blocks_are_bounded_by_members(spark, monkeypatch):
    # 12,000 small sets in one bucket: 32 shingles each are 1.5 MB, far below BLOCK_BYTES
    members = spark.range(12_000).selectExpr("1L as key", "id", "id as component", "32L as n")
    blocks = N._blocked(members).groupBy("i", "j").count().collect()
    assert max(r["count"] for r in blocks) <= 4400 and {r["i"] for r in blocks} == set(range(6))
    seen = N._blocked(members).where("id in (5, 9)").groupBy("i", "j").count().where("count = 2").count()
    assert seen >= 1  # any two meet
    monkeypatch.setattr(N, "BLOCK_MEMBERS", 3)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in N.near_duplicates(df).collect()) == brute(rows)


def test_components_of_odd_graphs(spark):
    r = random.Random(8)
    chain = [(k, k + 1) for k in range(100, 180)]
    r.shuffle(ids := list(range(1000, 1080)))
    twisted = list(zip(ids, ids[1:]))
    star = [(5000, k) for k in range(4000, 4060)] + [(k, 6000) for k in range(6001, 6030)]
    loose = [(r.randrange(9000, 9100), r.randrange(9000, 9100)) for _ in range(60)]
    edges = chain + twisted + star + loose + chain[:5] + [(7, 7)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    got = {x["id"]: x["component"] for x in N.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == {x: find(x) for x in list(up)}
    assert N.components(spark.createDataFrame([], "a long, b long")).collect() == []
