"""Message log, fixed records by byte ranges, metric streams with timers."""

import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F

from tessera.sources import messagelog as L
from tessera.sources.fixedrecords import FixedRecordSource
from tessera.sources.io import read_fixed_records
from tessera.streaming import streams as M


def rows_of(df):
    return sorted((r.topic, r.partition, r.offset, r.value, r.range_idx) for r in df.collect())


@pytest.fixture()
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(t, p, o, f"{t}-{p}-{o}") for t in ("a b/c", "z") for p in (0, 1) for o in range(25 if p else 7)]
    L.write_log(spark.createDataFrame(rows, "topic string, partition int, offset long, value string"), path, rows=4)
    return path, rows


def test_offset_ranges(spark, log):
    path, rows = log
    ranges = {"a b/c": [(0, 4), (5, -1)], "z": {1: [(6, 6), (23, 90)], 0: [(-0, -1)]}}
    want = []
    for t, p, o, v in rows:
        if t == "a b/c":
            want.append((t, p, o, v, 0 if o <= 4 else 1))
        elif p == 0:
            want.append((t, p, o, v, 4))
        elif o == 6 or o >= 23:
            want.append((t, p, o, v, 2 if o == 6 else 3))
    df = L.read_log(spark, path, ranges)
    assert rows_of(df) == sorted(want)
    assert rows_of(L.read_log(spark, path)) == sorted((*r, 0 if r[0] == "a b/c" else 1) for r in rows)
    assert rows_of(L.read_log(spark, path, {"none": [(0, -1)]})) == []
    # one input partition a segment that the range touches
    assert L.read_log(spark, path, {"z": {1: [(3, 8)]}}).rdd.getNumPartitions() == 3
    with pytest.raises(Exception, match="offsets are 0 or more"):
        L.read_log(spark, path, {"z": [(-3, 5)]}).collect()


def test_empty_log(spark, tmp_path):
    assert rows_of(L.read_log(spark, str(tmp_path / "nothing"))) == []


def test_stream_goes_on_at_stored_offsets(spark, log, tmp_path):
    path, rows = log
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def drain():
        q = L.stream_log(spark, path, ["z"]).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
        q.trigger(availableNow=True).start().awaitTermination()
        return sorted((r.topic, r.partition, r.offset) for r in spark.read.parquet(out).collect())

    want = sorted(r[:3] for r in rows if r[0] == "z")
    assert drain() == want
    assert drain() == want
    more = [("z", 0, 7, "x"), ("z", 0, 8, "y"), ("z", 2, 0, "new"), ("a b/c", 0, 7, "other")]
    L.write_log(spark.createDataFrame(more, "topic string, partition int, offset long, value string"), path, rows=4)
    assert drain() == sorted(want + [("z", 0, 7), ("z", 0, 8), ("z", 2, 0)])


def test_a_message_needs_a_topic(spark, tmp_path):
    df = spark.createDataFrame([(None, 0, 0, "x")], "topic string, partition int, offset long, value string")
    with pytest.raises(Exception, match="a message needs a topic"):
        L.write_log(df, str(tmp_path / "bad"))


def record_file(folder, name, n, magic=2051, size=16, extra=b""):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(struct.pack(">ii", magic, n) + bytes((k * 7 + j) % 256 for k in range(n) for j in range(size)) + extra)


def test_one_file_in_many_ranges(spark, tmp_path):
    record_file(tmp_path / "r", "a.bin", 1000)
    record_file(tmp_path / "r", "b.bin", 0)
    (tmp_path / "r" / "_SUCCESS").write_bytes(b"")
    df = read_fixed_records(spark, str(tmp_path / "r"), 16, 8, 2051, split_bytes=16 * 64)
    assert df.rdd.getNumPartitions() == 17
    got = df.orderBy("record").collect()
    assert [r.record for r in got] == list(range(1000)) and all(r.path.endswith("a.bin") for r in got)
    assert got[999].pixels == [(999 * 7 + j) % 256 / 255.0 for j in range(16)]
    tasks = df.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks == 16
    one = read_fixed_records(spark, str(tmp_path / "r" / "a.bin"), 16, 8, 2051)
    assert one.count() == 1000 and one.rdd.getNumPartitions() == 1


def test_bad_record_files(spark, tmp_path):
    record_file(tmp_path / "t", "a.bin", 10, extra=b"xyz")
    with pytest.raises(Exception, match="truncated record"):
        read_fixed_records(spark, str(tmp_path / "t"), 16, 8, 2051).collect()
    assert read_fixed_records(spark, str(tmp_path / "t"), 16, 8, 2051, trailer_len=3).count() == 10
    record_file(tmp_path / "m", "a.bin", 0, magic=7)
    with pytest.raises(Exception, match="invalid magic number 7"):
        read_fixed_records(spark, str(tmp_path / "m"), 16, 8, 2051).collect()
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="truncated record"):
        read_fixed_records(spark, str(tmp_path / "s"), 16, 8, 2051).collect()
    with pytest.raises(Exception, match="records need a byte"):
        spark.dataSource.register(FixedRecordSource)
        spark.read.format("fixed_records").options(recordBytes=0, headerBytes=8, magic=1).load(str(tmp_path / "s")).collect()


T0 = dt.datetime(2024, 1, 1)


def stream_rows(spark, path, files):
    """Each file is a micro-batch."""
    for k, rows in enumerate(files):
        part = spark.createDataFrame([(n, T0 + dt.timedelta(seconds=s), i, float(i)) for n, s, i in rows], "name string, ts timestamp, step long, value double")
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("name string, ts timestamp, step long, value double").option("maxFilesPerTrigger", 1).parquet(path)


def test_metric_rows_by_seconds(spark, tmp_path):
    files = [[("a", 0, 1), ("a", 9, 2), ("b", 4, 3), (None, 5, 4)], [("a", 12, 6), ("a", 10, 5), ("a", 31, 7)], [("a", 25, 8), ("b", 40, 9), ("a", 41, 10)], [("z", 500, 99)]]
    s = stream_rows(spark, str(tmp_path / "in"), files)
    out = M.drain_to_parquet(M.metric_stream(s, "step", "value", every_secs=10, ts="ts", name="name", late="20 seconds"), spark, "metric-test")
    got = sorted((r.name, (r.at - T0).total_seconds(), r.global_step, r.value) for r in out.collect())
    # a: 0, then 10 (12 and 9 are too early), then 25 that came late, then 41; z waits for a later row
    assert got == [("a", 0.0, 1, 1.0), ("a", 10.0, 5, 5.0), ("a", 25.0, 8, 8.0), ("a", 41.0, 10, 10.0), ("b", 4.0, 3, 3.0), ("b", 40.0, 9, 9.0)]


def test_exactly_one_of_steps_and_seconds(spark, tmp_path):
    s = stream_rows(spark, str(tmp_path / "in"), [[("a", 0, 1)]])
    for kw in ({}, {"every_n": 5, "every_secs": 1.0}):
        with pytest.raises(ValueError, match="exactly one"):
            M.metric_stream(s, "step", "value", **kw)


def test_running_state_over_micro_batches(spark, tmp_path):
    files = [[("a", 0, 1), ("b", 1, 2)], [("a", 2, 3)], [("c", 3, 4), ("a", 4, 5)]]
    s = stream_rows(spark, str(tmp_path / "in"), files)
    out = M.drain_to_parquet(M.running_state(s, "name", "value"), spark, "state-test", key=["name"])
    assert sorted((r.name, r.n, r.total, r.total_sq) for r in out.collect()) == [("a", 3, 9.0, 35.0), ("b", 1, 2.0, 4.0), ("c", 1, 4.0, 16.0)]
