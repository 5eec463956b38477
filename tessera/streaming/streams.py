"""Structured Streaming forms of the batch operators (inventory section M).

Streams read files incrementally (``readStream``) and write to file sinks or ``foreachBatch``
under the shared checkpoint folder; ``trigger(availableNow=True)`` drains what is there, which is
how the tests compare a stream with its batch result.  Messages by offset come from the log of
``sources.messagelog``; ``kafka_range`` is the same for a broker (its connector package is not part of
this environment)."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.operators.indexing import with_row_index
from tessera.session import scratch_path


def kafka_range(spark: SparkSession, servers: str, specs: Mapping[str, Mapping[int, tuple[int, int]]]) -> DataFrame:
    """Batch read of topic partitions between first and last offsets (inclusive; -1 = to the
    end).  Spark's ending offsets are exclusive, hence last + 1."""
    start = {t: {str(p): a for p, (a, _) in parts.items()} for t, parts in specs.items()}
    end = {t: {str(p): (-1 if b == -1 else b + 1) for p, (_, b) in parts.items()} for t, parts in specs.items()}
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(specs))
        .option("startingOffsets", json.dumps(start))
        .option("endingOffsets", json.dumps(end))
        .load()
        .select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    )


def repeat_batch(df: DataFrame, order: Sequence[str], epochs: int, k: int, value: str) -> DataFrame:
    """Repeat the input ``epochs`` times and group it in batches of ``k`` rows (the last batch
    may be short).  The epoch list is a parameter (broadcast)."""
    rep = df.crossJoin(F.broadcast(df.sparkSession.range(epochs).withColumnRenamed("id", "epoch")))
    idx = with_row_index(rep, ["epoch", *order], "_i")
    b = idx.withColumn("batch", F.floor(F.col("_i") / k).cast("long"))
    return b.groupBy("batch").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", value))), lambda s: s[value]).alias("values")
    )


def input_batches(df: DataFrame, order: Sequence[str], k: int, drop_remainder: bool, seed: int | None = None) -> DataFrame:
    """Shuffle (seeded hash order; ``None`` keeps the input order), then batch ids of ``k`` rows;
    with ``drop_remainder`` a short last batch is dropped."""
    keyed = df
    key = list(order)
    if seed is not None:
        keyed = df.withColumn("_h", F.xxhash64(*[F.col(c) for c in order], F.lit(seed)))
        key = ["_h", *order]
    idx = with_row_index(keyed, key, "_i", total_name="_n")
    b = idx.withColumn("batch", F.floor(F.col("_i") / k).cast("long"))
    if drop_remainder:
        b = b.filter(F.col("batch") < F.floor(F.col("_n") / k))
    return b.drop("_i", "_n", *(["_h"] if seed is not None else []))


def file_stream(spark: SparkSession, folder: str, name: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Incremental read of one parquet table file of a folder; ``files_per_trigger`` limits a batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def drain_to_parquet(stream: DataFrame, spark: SparkSession, name: str, key: Sequence[str] = ()) -> DataFrame:
    """Run a streaming query until the available input is processed, into a parquet sink in the
    shared folder; return the sink as a table.  Without ``key`` rows are appended (exactly once through the
    checkpoint).  With the ``key`` of an aggregate, a micro-batch writes only the groups that it has
    changed, into a folder of its own that a second attempt overwrites; the table shows the last state
    of each group."""
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    if not key:
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.parquet(out)

    def sink(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    q = stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    rest = [c for c in stream.columns if c not in key]
    states = spark.read.schema(stream.schema.add("batch", "long")).parquet(out)
    last = states.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_s"))
    return last.select(*key, *[F.col(f"_s.{c}").alias(c) for c in rest])


def score_stream(stream: DataFrame, schema: str) -> DataFrame:
    """Score JSON messages as they arrive: parse, score with column expressions, emit JSON."""
    parsed = stream.withColumn("_m", F.from_json("props", schema))
    scored = parsed.select("event_id", F.col("_m.k").alias("k"), (F.col("_m.k") * 2 + F.col("value")).alias("score"))
    return scored.select("event_id", F.to_json(F.struct("k", "score")).alias("response"))


def running_state(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Accumulator kept across micro-batches: count, sum and sum of squares per key (state store)."""
    return stream.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.sum(F.col(value) * F.col(value)).alias("total_sq")
    )


METRIC_ROWS = "name string, value double, global_step long, at timestamp"
_WAITING = "last long, waiting binary"
#: A waiting row; the state holds them as the bytes of one array, 24 a row.
_ROW = np.dtype([("at", "<i8"), ("step", "<i8"), ("value", "<f8")])


def _log_when_due(micros: int):
    """Per name: rows wait in the state until the watermark has passed them, so that they are seen in the
    order of their time; a timer at the first waiting row brings the name up again.  A row is logged if
    it is the name's first one or at least ``micros`` after the last one logged."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, b"")
        parts = [np.frombuffer(held, _ROW)]
        for pdf in batches:
            # rows that count for the watermark only are left out here, not by a filter that goes before it
            pdf = pdf[pdf["name"].notna() & pdf["at"].notna() & pdf["step"].notna()].astype({"at": "int64", "step": "int64"})
            part = np.empty(len(pdf), _ROW)
            for c in _ROW.names:
                part[c] = pdf[c]
            parts.append(part)
        passed = state.getCurrentWatermarkMs()
        waiting = np.concatenate(parts)
        waiting = waiting[np.lexsort((waiting["step"], waiting["at"]))]
        due = int(np.searchsorted(waiting["at"], passed * 1000))
        logged, k = [], 0
        while k < due:
            # of the rows that have passed, the next one that is late enough
            k = k if last is None else max(k, int(np.searchsorted(waiting["at"][:due], last + micros)))
            if k < due:
                last = int(waiting["at"][k])
                logged.append(k)
                k += 1
        rows, waiting = waiting[logged], waiting[due:]
        state.update((last, waiting.tobytes()))
        if len(waiting):
            state.setTimeoutTimestamp(max(int(waiting["at"][0]) // 1000, passed + 1))
        yield pd.DataFrame({
            "name": pd.Series([key[0]] * len(rows), dtype=object), "value": pd.Series(rows["value"], dtype="float64"),
            "global_step": pd.Series(rows["step"], dtype="int64"), "at": pd.to_datetime(pd.Series(rows["at"], dtype="int64"), unit="us"),
        })

    return run


def metric_stream(stream: DataFrame, step: str, value: str, every_n: int | None = None, every_secs: float | None = None,
                  ts: str | None = None, name: str | None = None, late: str = "0 seconds") -> DataFrame:
    """Metric rows (name, value, global_step) every ``every_n`` steps or every ``every_secs`` seconds of
    event time; exactly one of the two is given.

    By seconds, each value of ``name`` has its own clock: its first row is logged, then the first row at
    least so many seconds after the last one logged.  Rows may be out of order by ``late``; a row is due
    when the watermark has passed it, so the last rows of a stream come out once a later row (of any
    name) has arrived.  Rows without a name, time or step are left out."""
    if (every_n is None) == (every_secs is None):
        raise ValueError("give exactly one of every_n and every_secs")
    if every_n is not None:
        return stream.filter(F.col(step) % every_n == 0).select(
            F.lit("value").alias("name"), F.col(value).alias("value"), F.col(step).cast("long").alias("global_step")
        )
    if ts is None or name is None:
        raise ValueError("every_secs needs the columns of the time and the name")
    clocked = stream.withColumn(ts, F.col(ts).cast("timestamp"))  # the type that watermarks take
    rows = clocked.withWatermark(ts, late).select(
        F.col(name).alias("name"), F.unix_micros(ts).alias("at"), F.col(step).cast("long").alias("step"), F.col(value).cast("double").alias("value"), ts
    )
    return rows.groupBy("name").applyInPandasWithState(
        _log_when_due(round(every_secs * 1_000_000)), METRIC_ROWS, _WAITING, "append", GroupStateTimeout.EventTimeTimeout
    )
