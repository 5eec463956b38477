from collections import Counter

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F
from test_decontam import brute as leak
from test_neardup import brute as groups
from test_quality import brute as counts
from test_substring import brute as repeats

from tessera.llm import packing, quality
from tessera.llm.common import words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        docs = C.written(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(stages):
    assert len(C.STAGES) == 5
    for df in stages[1:5]:
        assert df.dtypes == stages[0].dtypes


def test_quality(stages):
    kept = {r["doc_id"] for r in quality.quality_report(stages[0]).where("kept").collect()}
    before, after = rows(stages[0]), rows(stages[1])
    assert Counter(after) == Counter(x for x in before if x[0] in kept) and len(after) < len(before)
    assert not any(counts(t)[5] for _, t in after)


def test_near_duplicates(stages):
    before = rows(stages[1])
    first = {i for i, _, low, _ in groups(before) if i == low}
    assert Counter(rows(stages[2])) == Counter(x for x in before if x[0] in first)


def test_repeated_passages(stages):
    want = Counter({(i, h) for (i, n, g, h) in repeats(rows(stages[2]), 35) if n > g})
    digest = stages[3].select("doc_id", F.col("text")).collect()
    import hashlib

    assert Counter((r["doc_id"], hashlib.sha256(b" ".join(words_of(r["text"]))).hexdigest()) for r in digest) == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())


def test_decontamination(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = rows(stages[3])
    assert Counter(rows(stages[4])) == Counter(x for x in before if not any(leak(x[1], t) >= 0.75 for t in items))


def test_packing_and_run(spark, stages):
    enc = packing.Encoder(C.tokenizer_path())
    sizes = Counter({i: len(enc.encode(t)) // 4 + 1 for i, t in rows(stages[4])})
    got = Counter()
    for r in stages[5].collect():
        got[r["doc_id"]] += r["length"]
    assert got == sizes
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, C.run(spark, SF).select(*columns).collect())) == Counter(map(tuple, stages[5].select(*columns).collect()))
