"""Queries whose time or memory grew faster than their input: files without the driver, counts inside
rows, compact state, one pass over texts."""

import glob
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import text as X
from tessera.operators import windows as W
from tessera.sources import io as A
from tessera.sources import messagelog as L
from tessera.streaming import streams as M


@pytest.fixture
def docs(spark, tmp_path):
    rows = [(i, f"{'der die das' if i % 2 else 'the and of'} word{i % 7} x{i}", "de" if i % 2 else "en", "s", 20) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_text_files_take_no_folder_each(spark, tmp_path):
    """One folder a task; rows of a key share its file, a null text is an empty line."""
    path = f"{tmp_path}/files"
    rows = [(k, f"a{k}\nb") for k in range(30)] + [(30, None), (31, "é"), (31, "x")]
    A.write_text_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id"), "doc_id", "text", path)
    assert len(glob.glob(f"{path}/*")) == 3
    whole = {r.id: r.text for r in A.read_docs(spark, path).select(F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("int").alias("id"), "text").collect()}
    both = whole.pop(31)
    assert sorted(both.splitlines()) == ["x", "é"]
    assert whole == {**{k: f"a{k}\nb\n" for k in range(30)}, 30: "\n"}
    assert A.read_docs(spark, path, "lines").count() == 63
    assert A.read_files_base64(spark, path, "*.txt").count() == 32


def test_ngrams_are_counted_inside_rows_and_over_shared_keys(spark):
    rows = [(1, ["a", "b", "a", "b"]), (2, ["a"]), (2, ["a", "c"]), (3, []), (4, None), (None, ["z"]), (None, ["z", "z"])]
    df = spark.createDataFrame(rows, "k long, w array<string>")
    expected = Counter()
    for k, w in rows:
        for o in (1, 2, 3):
            for i in range(len(w or []) - o + 1):
                expected[k, o, " ".join(w[i : i + o])] += 1
    out = X.ngram_counts(df, "k", "w", 3)
    got = [(r.k, r.order, r.ngram, r.n) for r in out.collect()]
    assert sorted(got, key=str) == sorted(((*k, n) for k, n in expected.items()), key=str)
    counted = df.select("k", F.inline(X._counted(X.ngrams("w", 1)))).where("k = 1").collect()
    assert [(r.ngram, r.n) for r in counted] == [("a", 2), ("b", 2)]


def test_ngram_counts_of_documents_are_grouped_by_key(spark, tmp_path):
    """The summary is one of the count table: rows that share an id, null too, are counted together."""
    rows = [(1, "A b a, b"), (1, "a b"), (2, "x"), (3, None), (4, "--"), (None, "z z"), (None, "z y"), (5, "É 1 é 1")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for k, text in rows:
        words = re.findall(r"\w+", (text or "").lower())
        counts.update((k, o, " ".join(words[i : i + o])) for o in range(1, 5) for i in range(len(words) - o + 1))
    expected = {}
    for (k, o, _), n in counts.items():
        expected.setdefault((k, o), []).append(n)
    out = entry.queries()["agg_ngram_counts"](spark, str(tmp_path))
    got = [tuple(r) for r in out.select("doc_id", "order", "n_distinct", "n_total", "max_count").collect()]
    assert sorted(got, key=str) == sorted(((k, o, len(n), sum(n), max(n)) for (k, o), n in expected.items()), key=str)
    plain = entry.oracle_sql()["agg_ngram_counts"].replace("FROM documents", f"FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(got, key=str) == sorted(duckdb.sql(f"SELECT doc_id, \"order\", n_distinct, n_total, max_count FROM ({plain})").fetchall(), key=str)


def test_ngram_table_in_parts(monkeypatch):
    """Counted as strings: tokens that are null or hold a blank, too; small parts add up to the whole."""
    plain = [["a", "b", "a", "b", "a"], [], None, ["", ""], ["é"] * 9, ["a", "b"]]
    for extra in ([], [["a", None, "a", None, None], ["a b", "c", "a", "b c"]]):
        segments = pa.array(plain + extra, pa.list_(pa.string()))
        expected = Counter()
        for k, w in enumerate(segments.to_pylist()):
            expected.update((o, k, " ".join(x for x in w[i : i + o] if x is not None)) for o in (1, 2, 3) for i in range(len(w or []) - o + 1))
        for bytes_ in (1 << 24, 3):
            monkeypatch.setattr(X, "BATCH_BYTES", bytes_)
            parts = list(X._ngram_table(segments, 3))
            rows = [((o, k, g), n) for o, of, grams, times in parts for k, g, n in zip(of.tolist(), grams.to_pylist(), times.tolist())]
            assert len(rows) == len(expected) and dict(rows) == expected
            assert extra or bytes_ > 3 or len(parts) > 3


def test_ngram_stats_in_blocks(spark, monkeypatch):
    segments = pa.array([["a", "b", "a"], [], None, ["c"], ["a", None, "a", None], ["d"] * 9], pa.list_(pa.string()))
    whole = X._ngram_stats(segments, 2)
    monkeypatch.setattr(X, "BLOCK_TOKENS", 3)
    blocks = list(X._blocks(segments))
    assert len(blocks) > 1 and all(len(b) == 1 or len(b.flatten()) <= 3 for b in blocks)
    parts = [X._ngram_stats(b, 2) for b in blocks]
    for k in range(2):
        assert np.concatenate([p[k] for p in parts]).tolist() == whole[k].tolist()
    assert whole[0].tolist() == [[2, 3, 2], [0, 0, 0], [0, 0, 0], [1, 1, 1], [2, 4, 2], [1, 9, 9]]


def test_waiting_rows_are_24_bytes():
    """The chain of due rows, over two calls, equals the plain one; the state is one compact array."""

    class State:
        value, mark, timer = None, 0, None
        exists = property(lambda self: self.value is not None)
        get = property(lambda self: self.value)
        getCurrentWatermarkMs = lambda self: self.mark

        def update(self, v):
            self.value = v

        def setTimeoutTimestamp(self, t):
            self.timer = t

    r = np.random.default_rng(4)
    pdf = pd.DataFrame({"name": "n", "at": r.integers(0, 90_000, 500), "step": np.arange(500), "value": r.random(500)})
    state, run = State(), M._log_when_due(7_000)
    assert len(next(run(("n",), iter([pdf[:200], pdf[200:]]), state))) == 0
    assert len(state.value[1]) == 24 * 500
    got = []
    for mark in (40, 200):
        state.mark = mark
        got += next(run(("n",), iter([]), state))["global_step"].tolist()
    last, expected = None, []
    for at, step in sorted(zip(pdf["at"].tolist(), pdf["step"].tolist())):
        if last is None or at >= last + 7_000:
            last = at
            expected.append(step)
    assert got == expected and state.value[1] == b""


def test_a_stream_reads_small_segments_together(spark, tmp_path):
    path = f"{tmp_path}/log"
    m = spark.range(40).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.col("id").cast("string").alias("value"))
    L.write_log(m, path, rows=4)
    stream = L._LogStream({"path": path})
    assert [(s.first, s.last, len(s.files)) for s in stream.partitions({}, stream.latestOffset())] == [(0, 39, 10)]
    assert [(s.first, s.last) for s in stream.partitions({"t": {"0": 6}}, {"t": {"0": 30}})] == [(6, 29)]
    log = L.MessageLog(path)
    assert [(s.first, s.last) for s in log.slices(("t", 0), 2, 21, span=9)] == [(2, 7), (8, 15), (16, 21)]


def test_windows_as_rows(spark):
    df = spark.createDataFrame([(1, list("abcdefghij")), (2, ["a"] * 3), (3, None)], "k long, w array<string>")
    rows = W.shifted_window_rows(df, ["k"], "w", 3)
    old = df.select("k", F.posexplode(W.shifted_windows("w", 3)).alias("p", "s")).select("k", (F.col("p") + 1).alias("start"), "s.*")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, old.collect())) and rows.count() == 7
    # windows are cut as rows are made, not gathered in an array of the whole row
    assert "transform" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_char_windows_as_rows(spark):
    texts = [(k, "".join(chr(97 + i % 26) if i % 5 else "é" for i in range(n))) for k, n in enumerate((0, 10, 11, 12, 500, 1003))]
    df = spark.createDataFrame([*texts, (99, None)], "k long, t string")
    for length, step in ((10, 3), (4, 7), (40, 20)):
        old = df.select("k", F.explode(W.char_sequences("t", length, step)).alias("s")).select("k", "s.*")
        got = W.char_sequence_rows(df, ["k"], "t", length, step).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, old.collect())) and got


def test_texts_are_read_once(spark, docs, monkeypatch):
    """What the folds of a selection and the lookups of a vocabulary read is a written table."""
    from tessera.plans import ml as K
    from tessera.plans import q_joins, q_ml

    class Model:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(0.0)).withColumn("probability", F.col("features"))

    monkeypatch.setattr(K, "kept_best", lambda selection, path: Model())
    for df in (q_ml._chosen(spark, docs, lambda d: None, "m"), q_joins.q_vocab_encode(spark, docs)):
        assert "documents.parquet" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() > 0
