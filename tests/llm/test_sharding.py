import zlib
from collections import Counter

import pytest

from tessera.llm import sharding

SF = "/root/testdata/sf0.01"


def check(rows, docs, n_shards, tolerance):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    size, slots = Counter(), {}
    for r in rows:
        assert 0 <= r["shard"] < n_shards and r["law"] == "bytes" and r["grown_shard"] is None
        size[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    share = sum(size.values()) / n_shards
    assert max(abs(size[k] - share) for k in range(n_shards)) <= tolerance * share + max(n for _, n, _ in want)
    return size


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 16, 0.05)


def test_hot_group_and_odd_rows(spark):
    docs = [(i, "the same text " * 20) for i in range(3000)] + [(9000 + i, f"text {i} " * 25) for i in range(6000)]
    docs += [(None, None), (None, None), (5, ""), (5, ""), (6, "ß" * 5), (7, "x" * 20_000)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, shard int, _h int")
    rows = sharding.shard(df, n_shards=4).collect()
    check(rows, docs, 4, 0.05)


def test_small_groups_stay_whole(spark):
    docs = [(10 * g + k, f"group {g} " * 30) for g in range(2000) for k in range(3)]
    rows = sharding.shard(spark.createDataFrame(docs, "doc_id long, text string"), n_shards=4).collect()
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"] // 10, set()).add(r["shard"])
    assert all(len(s) == 1 for s in of.values())


def test_coarse_sample_is_subdivided(spark):
    docs = [(i, f"t{i} " * (1 + i % 50)) for i in range(4000)]
    rows = sharding.shard(spark.createDataFrame(docs, "doc_id long, text string"), n_shards=4, sample=40).collect()
    check(rows, docs, 4, 0.1)


@pytest.mark.parametrize("docs", [[], [(1, "a")], [(1, None)]])
def test_tiny(spark, docs):
    rows = sharding.shard(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(rows) == len(docs)


def test_native_plan(spark):
    plan = sharding.shard(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
