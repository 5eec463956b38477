"""The partition-parallel helpers agree with their single-task definitions, including the
multi-chunk paths that large inputs take and a group that holds most rows."""

import itertools

import pytest
from pyspark.sql import functions as F

from tessera.operators.indexing import with_group_index, with_row_index
from tessera.operators.windows import running_min, running_sums


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """No coalescing: the helpers must hold with many range partitions, as on a cluster."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _skewed(spark, n=3000):
    # group 0 holds two thirds of the rows
    rows = [(i, 0 if i % 3 else 1 + i % 7, float((i * 37) % 101)) for i in range(n)]
    return spark.createDataFrame(rows, "k long, g long, x double").repartition(8)


def test_row_index_is_consecutive(spark):
    df = _skewed(spark)
    got = sorted((r.k, r.i) for r in with_row_index(df, ["k"], "i").collect())
    assert got == [(k, k) for k in range(3000)]


def test_group_index_with_hot_group(spark):
    df = _skewed(spark)
    got = {(r.g, r.k): r.i for r in with_group_index(df, ["g"], ["k"], "i").collect()}
    rows = sorted((r.g, r.k) for r in df.collect())
    want = {}
    for g, grp in itertools.groupby(rows, key=lambda t: t[0]):
        for i, (_, k) in enumerate(grp):
            want[(g, k)] = i
    assert got == want


def test_running_sums_multi_chunk(spark):
    df = _skewed(spark)
    out = running_sums(df, ["k"], {"s": F.col("x")}, by=["g"], before={"s": "s_before"}).collect()
    assert running_sums(df, ["k"], {"s": F.col("x")}, by=["g"]).drop("i").exceptAll(spark.createDataFrame(out).select("k", "g", "x", "s")).isEmpty()
    got = {(r.g, r.k): (r.i, r.s) for r in out}
    last: dict = {}
    for r in sorted(out, key=lambda r: (r.g, r.k)):
        assert r.s_before == last.get(r.g)
        last[r.g] = r.s
    rows = sorted((r.g, r.k, r.x) for r in df.collect())
    for g, grp in itertools.groupby(rows, key=lambda t: t[0]):
        acc = 0.0
        for i, (_, k, x) in enumerate(grp):
            acc += x
            assert got[(g, k)][0] == i
            assert abs(got[(g, k)][1] - acc) < 1e-6


def test_running_min_over_range_chunks(spark):
    df = _skewed(spark)
    out = running_min(df, ["k"], {"m": F.col("x")}, by=["g"], inclusive=False).collect()
    got = {(r.g, r.k): r.m for r in out}
    rows = sorted((r.g, r.k, r.x) for r in df.collect())
    for g, grp in itertools.groupby(rows, key=lambda t: t[0]):
        best = None
        for _, k, x in grp:
            assert got[(g, k)] == best
            best = x if best is None else min(best, x)


def test_row_index_spans_many_partitions(spark):
    df = _skewed(spark)
    idx = with_row_index(df, ["k"], "i")
    parts = idx.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1
