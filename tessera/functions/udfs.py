"""UDF, UDAF and batch-scoring surface (inventory section N).

Fitted parameters are small tables (here nearest-centroid classifiers whose size is
classes x dimensions) shipped to the executors as broadcast variables; scoring runs in
Arrow-batched iterator pandas UDFs or ``mapInPandas``.  The private-query aggregate follows the
initial / accumulate / merge / result protocol as a per-partition partial aggregate
(``mapInPandas``) followed by a shuffle on the group key, so no group is ever gathered whole."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Most entries (classes times dimensions) of a parameter table that is collected and broadcast.
MOST_PARAMETERS = 4_000_000


def fit_centroids(df: DataFrame, vec: str, label: str) -> np.ndarray:
    """Per-class mean vectors: a classes x dimensions parameter table, computed by Spark, whose size is
    checked before it is collected.  Classes and dimensions that have no value are nan."""
    size = df.agg(F.max(F.col(label).cast("int")).alias("c"), F.max(F.size(vec)).alias("d")).first()
    n_c, dim = (size["c"] if size["c"] is not None else -1) + 1, max(size["d"] or 0, 0)
    if n_c * dim > MOST_PARAMETERS:
        raise ValueError(f"{n_c} classes of {dim} dimensions are more than {MOST_PARAMETERS} parameters")
    out = np.full((n_c, dim), np.nan)
    means = [F.avg(F.get(vec, F.lit(k)).cast("double")) for k in range(dim)]
    rows = df.groupBy(F.col(label).cast("int").alias("c")).agg(F.array(*means).alias("m")) if dim else df.limit(0).select(F.lit(0).alias("c"))
    for r in rows.where("c is not null").collect():
        out[r.c] = [np.nan if x is None else x for x in r.m]
    return out


def _nearest(centroids: np.ndarray, vecs) -> tuple[np.ndarray, np.ndarray]:
    x = np.vstack([np.asarray(v, dtype=np.float64) for v in vecs]) if len(vecs) else np.zeros((0, centroids.shape[1]))
    d = ((x[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    d = np.where(np.isnan(d), np.inf, d)
    return d.argmin(axis=1), d


def model_udf(spark: SparkSession, centroids: np.ndarray):
    """A scoring UDF returning [label, distance] as strings (spread to columns by the caller)."""
    bc = spark.sparkContext.broadcast(centroids)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = bc.value
        for s in batches:
            lab, d = _nearest(c, list(s))
            yield pd.Series([[str(int(a)), f"{float(d[i, a]):.6f}"] for i, a in enumerate(lab)])

    return score


def predict_columns(df: DataFrame, key: str, vec: str, centroids: np.ndarray, names: Sequence[str]) -> DataFrame:
    """Batch prediction with one probability column per class (softmax of minus the distance)."""
    bc = df.sparkSession.sparkContext.broadcast(centroids)
    n = centroids.shape[0]
    schema = T.StructType(
        [T.StructField(key, T.LongType()), T.StructField("label", T.StringType()), T.StructField("label_id", T.IntegerType())]
        + [T.StructField(f"prob_{i}", T.DoubleType()) for i in range(n)]
    )

    def run(it):
        c = bc.value
        for pdf in it:
            lab, d = _nearest(c, list(pdf[vec]))
            z = -d
            z = z - z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p = p / p.sum(axis=1, keepdims=True)
            out = pd.DataFrame({key: pdf[key].astype("int64"), "label": [names[int(a)] for a in lab], "label_id": lab.astype("int32")})
            for i in range(n):
                out[f"prob_{i}"] = p[:, i]
            yield out

    return df.select(key, vec).mapInPandas(run, schema)


def request_chain(df: DataFrame, body: str, schema: str, observation: Observation | None = None) -> DataFrame:
    """Parse, score and format requests as one projection; an ``Observation`` records the row
    counts of the stages for the run's metrics."""
    parsed = df.withColumn("_req", F.from_json(body, schema))
    scored = parsed.withColumn("score", F.col("_req.k") * 2.0)
    out = scored.select(*[c for c in df.columns if c != body], F.to_json(F.struct(F.col("_req.k").alias("k"), "score")).alias("response"))
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("response").isNull()).alias("failed"))
    return out


def timed_chain(df: DataFrame, stages: Sequence[tuple[str, Callable[[pd.DataFrame], pd.DataFrame]]], schema: str, observation: Observation) -> DataFrame:
    """Requests through a chain of stages (name, function of a frame) on Arrow batches, the last of which
    gives the columns of ``schema``.  Tasks time every call; the times ride with the rows to the end of the
    plan, where ``observation`` adds them up: for each stage ``<name>_calls``, ``<name>_rows`` and
    ``<name>_seconds``.  A task that is run again counts once, as its rows do."""
    names = [name for name, _ in stages]
    timed = T.StructType([*T.StructType.fromDDL(schema).fields, *[T.StructField(f"_{n}_{x}", T.DoubleType()) for n in names for x in ("rows", "seconds")]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            spent = {}
            for name, stage in stages:
                began = time.perf_counter()
                frame = stage(frame)
                spent[f"_{name}_seconds"] = time.perf_counter() - began
                spent[f"_{name}_rows"] = float(len(frame))
            out = frame.reset_index(drop=True)
            for name, value in spent.items():  # on the first row of the batch
                out[name] = pd.Series([value], dtype="float64").reindex(out.index)
            yield out

    out = df.mapInPandas(run, timed)
    counted = [
        x for n in names for x in (F.count(f"_{n}_seconds").alias(f"{n}_calls"), F.sum(f"_{n}_rows").cast("long").alias(f"{n}_rows"), F.sum(f"_{n}_seconds").alias(f"{n}_seconds"))
    ]
    return out.observe(observation, *counted).drop(*[f"_{n}_{x}" for n in names for x in ("rows", "seconds")])


def stage_times(spark: SparkSession, observation: Observation, names: Sequence[str]) -> DataFrame:
    """One row a stage: stage, position, calls, rows, seconds.  The observed query must have run."""
    seen = observation.get
    rows = [(n, k, int(seen[f"{n}_calls"]), int(seen[f"{n}_rows"] or 0), float(seen[f"{n}_seconds"] or 0.0)) for k, n in enumerate(names)]
    return spark.createDataFrame(rows, "stage string, position int, calls long, rows long, seconds double")


#: Partial sums a task holds before it passes them on.
HELD_BYTES = 64 << 20


def private_query(df: DataFrame, key: str, vec: str, clip: float, denominator: float | None = None) -> DataFrame:
    """Clipped-sum private query as a distributed UDAF: each task accumulates a partial sum per key
    (initial state + accumulate) and passes them on when they take ``HELD_BYTES``; partials are merged by
    a shuffle on the key and the result step divides by ``denominator`` when given.  Rows of a key must
    have vectors of one length; null keys form a group, null vectors count as no row."""
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("partial", T.ArrayType(T.DoubleType()))])

    def accumulate(it):
        state: dict[object, np.ndarray] = {}
        held = 0

        def done():
            return pd.DataFrame({key: pd.array(list(state), "Int64"), "partial": [a.tolist() for a in state.values()]})

        for pdf in it:
            for k, part in pdf[pdf[vec].notna()].groupby(key, dropna=False, sort=False):
                x = np.vstack(part[vec].to_list()).astype(np.float64)
                norm = np.sqrt((x * x).sum(axis=1))
                add = (x * np.minimum(1.0, clip / np.maximum(norm, np.finfo(float).tiny))[:, None]).sum(axis=0)
                k = None if pd.isna(k) else int(k)
                if k in state:
                    state[k] = state[k] + add
                else:
                    state[k] = add
                    held += add.nbytes + 200
            if held > HELD_BYTES:
                yield done()
                state, held = {}, 0
        if state:
            yield done()

    partials = df.select(F.col(key).cast("long").alias(key), vec).mapInPandas(accumulate, schema)
    ex = partials.select(key, F.posexplode("partial").alias("pos", "x"))
    merged = ex.groupBy(key, "pos").agg(F.sum("x").alias("v"))
    res = merged.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("result"))
    if denominator:
        res = res.withColumn("result", F.transform("result", lambda x: x / denominator))
    return res


def map_reduce(df: DataFrame, expr: str, name: str = "total") -> DataFrame:
    """Row function then an associative reduce: a projection and a global sum."""
    return df.select(F.expr(expr).alias("_m")).agg(F.sum("_m").alias(name))
