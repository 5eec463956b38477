"""Golden values and properties for operators whose result is random, learned or UDF-based."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import aggregates as D
from tessera.operators import joins as C
from tessera.operators import privacy as P
from tessera.operators import text as X
from tessera.operators import windows as W


def test_bleu_tokenize(spark):
    df = spark.createDataFrame([("Test0, 1 two, 3",)], "s string")
    toks = df.select(X.bleu_tokenize("s").alias("t")).first().t
    assert toks == ["Test0", ",", "1", "two", ",", "3"]


def test_bleu_equal_corpus_is_100(spark):
    rows = [(i, "the cat sat on the mat number %d today" % i) for i in range(5)]
    df = spark.createDataFrame(rows, "pair int, s string").select(
        "pair", F.split("s", " ").alias("ref"), F.split("s", " ").alias("hyp")
    )
    b = X.bleu(df, "pair", "ref", "hyp").first().bleu
    assert abs(b * 100 - 100.0) < 1e-9


def test_alnum_split_and_join(spark):
    df = spark.createDataFrame([("test? testing 123.",), ("",), (" a b ",)], "s string")
    out = df.select(X.alnum_tokens("s").alias("t")).collect()
    assert out[0].t == ["test", "? ", "testing", "123", "."]
    assert out[1].t == []
    assert out[2].t == [" ", "a", "b", " "]
    j = df.select(X.join_tokens(X.alnum_tokens("s")).alias("j")).collect()
    assert j[0].j == "test? testing 123."


def test_escape_unescape_round_trip(spark):
    alphabet = F.array(*[F.lit(c) for c in "abc\\_u;0123456789 "])
    df = spark.createDataFrame([("ab_c",), ("a\\b",), ("aé",)], "s string")
    esc = df.select(X.escape_token("s", alphabet).alias("e"))
    got = [r.e for r in esc.collect()]
    assert got == ["ab\\uc_", "a\\\\b_", "a\\233;_"]
    back = esc.select(X.unescape_token(F.expr("substring(e, 1, length(e) - 1)")).alias("u")).collect()
    assert [r.u for r in back] == ["ab_c", "a\\b", "aé"]


def test_lcs_against_brute_force(spark):
    import itertools

    def brute(a, b):
        best = 0
        for r in range(len(a) + 1):
            for comb in itertools.combinations(a, r):
                it = iter(b)
                if all(x in it for x in comb):
                    best = max(best, r)
        return best

    pairs = [(["a", "b", "c", "d"], ["b", "d", "a"]), (["x"], ["y"]), (["a", "a", "b"], ["a", "b", "a", "b"]), ([], ["a"])]
    df = spark.createDataFrame([*pairs, (None, ["a"])], "x array<string>, y array<string>")
    got = [r.lcs for r in df.select(X.lcs_length("x", "y").alias("lcs")).collect()]
    assert got == [brute(a, b) for a, b in pairs] + [0]


def test_lcs_of_long_rows():
    import random

    r = random.Random(2)
    for n, m, letters in ((200, 300, 3), (65, 64, 2), (500, 128, 40), (1000, 1000, 900)):
        a, b = [r.randrange(letters) for _ in range(n)], [r.randrange(letters) for _ in range(m)]
        row = [0] * (m + 1)
        for x in a:
            above = row
            row = [0]
            for k, y in enumerate(b):
                row.append(above[k] + 1 if x == y else max(above[k + 1], row[-1]))
        assert X.common_subsequence(a, b) == row[-1]


def test_shard_blocks(spark):
    # 10 rows, 3 cores, 2 rows per core: blocks of 6 rows; the second block (4 rows) is cut at 0, 1, 2, 4
    df = spark.range(10).withColumnRenamed("id", "k")
    rows = W.shard_blocks(df, ["k"], 3, 2).orderBy("k").collect()
    got = [(r.k, r.block, r.core) for r in rows]
    assert got == [(0, 0, 0), (1, 0, 0), (2, 0, 1), (3, 0, 1), (4, 0, 2), (5, 0, 2),
                   (6, 1, 0), (7, 1, 1), (8, 1, 2), (9, 1, 2)]


def test_clipped_sums(spark):
    df = spark.createDataFrame([([-6.0, 8.0],), ([4.0, -3.0],)], "v array<double>")
    s = D.clipped_sum(df, "v", clip=5.0).first().sum_vec
    assert s == pytest.approx([-3.0 + 4.0, 4.0 - 3.0])
    a = D.clipped_avg(df, "v", clip=10.0, denominator=2.0).first().avg_vec
    assert a == pytest.approx([-1.0, 2.5])


def test_sums_of_uneven_and_wide_vectors(spark, monkeypatch):
    rows = [([1.0, 2.0, 3.0],), ([10.0],), ([],), (None,), ([None, 5.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    for width in (200, 2):
        monkeypatch.setattr(D, "WIDTH", width)
        r = D.vector_sum_avg(df, "v").first()
        assert r.sum_vec == [11.0, 7.0, 3.0] and r.avg_vec == [x / 5 for x in r.sum_vec]
        assert D.vector_sum_avg(df.limit(0), "v").first().sum_vec == []
        nested = {x.part: x.sum_vec for x in D.nested_sums(df, "v", {"a": (0, 2, 100.0), "b": (2, 3, 1.0)}).collect()}
        assert nested == {"a": [11.0, 7.0], "b": [1.0]}
    assert "Generate" not in D.clipped_sum(df, "v", 1.0)._jdf.queryExecution().optimizedPlan().toString() or D.WIDTH < 3


def test_nested_sums(spark):
    df = spark.createDataFrame([([5.0, 5.0, 5.0],), ([1.0, 1.0, 1.0],)], "v array<double>")
    out = {r.part: r.sum_vec for r in D.nested_sums(df, "v", {"a": (0, 1, 1.0), "b": (1, 2, 100.0)}).collect()}
    assert out["a"] == pytest.approx([2.0])
    assert out["b"] == pytest.approx([6.0, 6.0])


def test_quorum_majority(spark):
    df = spark.createDataFrame([(1, 7), (1, 7), (1, 9), (1, 7), (2, 1), (2, 2)], "req int, pred int")
    got = {r.req: (r.majority, r.has_majority) for r in D.quorum(df, "req", "pred").collect()}
    assert got == {1: (7, True), 2: (None, False)}


def test_route_weights_repair(spark):
    df = spark.createDataFrame([({"a": 15, "b": 30, "c": 35, "d": 20},), ({"x": 10, "y": 20},)], "m map<string,int>")
    rows = df.select(S.route_weights("m").alias("r")).collect()
    assert dict(rows[0].r) == {"a": 15, "b": 30, "c": 35, "d": 20}
    assert dict(rows[1].r) == {"x": 80, "y": 20}


def test_zscore_sample(spark):
    # affinities cat 3.35, dog 6.35 give z cat 16.25, z dog 15.125 and a cat lover
    df = spark.createDataFrame([(3.35, 6.35)], "a double, b double")
    z_cat, z_dog, cls = S.zscore_class(F.col("a"), F.col("b"), (0.1, 0.20), (0.3, 0.40))
    r = df.select(z_cat.alias("zc"), z_dog.alias("zd"), cls.alias("c")).first()
    assert r.zc == pytest.approx(16.25) and r.zd == pytest.approx(15.125) and r.c == "cat_lover"


def test_sampled_gaussian_golden(spark):
    runs = [(0.1, 2.0, 5.0, 10), *((0.01, 2.5, a, 50) for a in (1.5, 2.5, 5.0, 50.0, 100.0)), (0.0, 10.0, 20.0, 1), (1.0, 10.0, 20.0, 1)]
    df = spark.createDataFrame(runs, "q double, noise double, order double, steps int").coalesce(1)
    cost = P.rdp_sampled_gaussian(F.col("q"), F.col("noise"), F.col("order")) * F.col("steps")
    vals = [r.v for r in df.select(cost.alias("v")).collect()]
    assert vals == pytest.approx([0.07737, 0.00065, 0.001085, 0.00218075, 0.023846, 167.416307, 0.0, 0.1], abs=1e-5)


def test_privacy_spent_golden(spark):
    orders = list(range(2, 33))
    ledger = spark.createDataFrame([(0.01, 4.0, 10000)], "q double, noise double, steps long")
    rdp = P.rdp_ledger(ledger, orders)
    r = P.privacy_spent(rdp, target_delta=1e-5).first()
    assert r.eps == pytest.approx(1.258575, abs=1e-5) and r.best_order == 20
    d = P.privacy_spent(rdp, target_eps=1.258575).first()
    assert d.delta == pytest.approx(1e-5, rel=1e-3) and d.best_order == 20


def test_composition_golden(spark):
    orders = [1.25, 1.5, 1.75, 2., 2.5, 3., 4., 5., 6., 7., 8., 10., 12., 14., 16., 20., 24., 28., 32., 64., 256.]
    ledger = spark.createDataFrame([(1e-4, 0.4, 40000), (0.1, 2.0, 100)], "q double, noise double, steps long")
    r = P.privacy_spent(P.rdp_ledger(ledger, orders), target_delta=1e-5).first()
    assert r.eps == pytest.approx(8.509656, abs=1e-5) and r.best_order == 2.5


def test_rdp_gaussian_properties(spark):
    df = spark.createDataFrame([(lq,) for lq in [-50.0, -20.0, -5.0, -1.0]], "logq double")
    vals = [r.v for r in df.select(P.rdp_gaussian(F.col("logq"), 5.0, F.lit(10.0)).alias("v")).collect()]
    # never above the data-independent bound, and growing with q
    assert all(v <= 10.0 / 25.0 + 1e-12 for v in vals)
    assert vals == sorted(vals)


def test_logq_gaussian_falls_with_gap():
    a = P.logq_gaussian_py([10, 5, 0], 2.0)
    b = P.logq_gaussian_py([30, 5, 0], 2.0)
    assert b < a <= math.log(1 - 1 / 3)
    assert P.log_erfc(30.0) == pytest.approx(-900 - math.log(30) - 0.5 * math.log(math.pi), rel=1e-3)


def test_asof_forward_matches_searchsorted(spark):
    import bisect

    incs = [3.0, 0.0, 2.0, 5.0, 1.0]
    run, acc = [], 0.0
    for x in incs:
        acc += x
        run.append(acc)
    curve = spark.createDataFrame([(i, run[i], run[i - 1] if i else None) for i in range(5)], "pos long, y double, before double")
    got = {r.x: r.pos for r in C.asof_forward_grid(curve, "y", "before", 14, 1.0).collect()}
    want = {float(k): (bisect.bisect_left(run, k) if bisect.bisect_left(run, k) < 5 else None) for k in range(14)}
    assert got == want
    grid = spark.createDataFrame([(float(k),) for k in range(14)], "x double")
    got2 = {r.x: r.pos for r in C.asof_forward(grid, curve, "x", "y").collect()}
    assert got2 == want


def test_length_buckets():
    lo, hi = X.bucket_bounds(24, 4, 2)
    assert lo == [0, 4, 8, 16] and hi == [4, 8, 16, 25]


def test_hash_split_disjoint_complete(spark):
    from tessera.operators.filters import hash_split

    df = spark.range(1000).withColumnRenamed("id", "k")
    s = hash_split(df, "k", [0.7, 0.3], seed=1)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 1000 and set(counts) == {0, 1}
    assert 600 < counts[0] < 800


# Local-sensitivity arrays of the smooth-sensitivity analysis (published test cases).
LS_GNMAX_RIGHT = [3.13503646e-17, 1.60178280e-08, 5.90681786e-03] + [5.99981308e+00] * 7
LS_GNMAX_LEFT = [0.0] * 298 + [2.77693450548e-7, 2.10853979548e-6] + [2.73113623988e-6] * 1700
LS_THRESHOLD_16 = [0] * 3 + [
    1.48454129e-04, 1.47826870e-02, 3.94153241e-02, 6.45775697e-02, 9.01543247e-02, 1.16054002e-01,
    1.42180452e-01, 1.42180452e-01, 1.48454129e-04, 1.47826870e-02, 3.94153241e-02, 6.45775697e-02,
    9.01543266e-02, 1.16054000e-01, 1.42180452e-01, 1.68302106e-01, 1.93127860e-01] + [0] * 10
LS_THRESHOLD_2 = [
    1.60212079e-01, 2.07021132e-01, 2.07021132e-01, 1.93127860e-01, 1.68302106e-01, 1.42180452e-01,
    1.16054002e-01, 9.01543247e-02, 6.45775697e-02, 3.94153241e-02, 1.47826870e-02, 1.48454129e-04] + [0] * 18


@pytest.mark.parametrize(
    "votes,teachers,sigma,order,expected",
    [([10, 0, 0], 10, 0.5, 1.5, LS_GNMAX_RIGHT), ([1000, 500, 300, 200, 0], 2000, 250.0, 10.0, LS_GNMAX_LEFT)],
)
def test_local_sensitivity_gnmax_golden(spark, votes, teachers, sigma, order, expected):
    df = spark.createDataFrame([(0, votes)], "k long, votes array<long>")
    rows = P.local_sensitivity_gnmax(df, "k", "votes", teachers, sigma, order).orderBy("d").collect()
    assert [r.ls for r in rows] == pytest.approx(expected, rel=1e-6, abs=1e-16)


@pytest.mark.parametrize("t,expected", [(16.0, LS_THRESHOLD_16), (2.0, LS_THRESHOLD_2)])
def test_local_sensitivity_threshold_golden(spark, t, expected):
    df = spark.createDataFrame([(0, [20, 10, 0])], "k long, votes array<long>")
    rows = P.local_sensitivity_threshold(df, "k", "votes", 30, t, 2.0, 10.0).orderBy("d").collect()
    assert [r.ls for r in rows] == pytest.approx(expected, rel=1e-6, abs=1e-12)
