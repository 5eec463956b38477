"""Queries for section N (UDF, UDAF and batch scoring)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tessera.functions import udfs as U
from tessera.plans.catalog import register
from tessera.session import scratch_path, table


def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


_CENTROID_SQL = """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos FROM embeddings),
            c AS (SELECT label AS c, pos, avg(x) AS m FROM x GROUP BY label, pos),
            d AS (SELECT vec_id, c, sum((x - m) * (x - m)) AS dist FROM x JOIN c USING (pos) GROUP BY vec_id, c)"""


@register(
    "udf_model_array",
    _CENTROID_SQL + " SELECT vec_id, CAST(arg_min(c, (dist, c)) AS VARCHAR) AS label, printf('%.6f', min(dist)) AS distance FROM d GROUP BY vec_id",
)
def q_model_array(spark, sf_dir):
    """Nearest-centroid model as an iterator pandas UDF; its array output spread to columns."""
    e = _emb(spark, sf_dir)
    udf = U.model_udf(spark, U.fit_centroids(e, "embedding", "label"))
    s = e.select("vec_id", udf("embedding").alias("out"))
    return s.select("vec_id", F.col("out")[0].alias("label"), F.col("out")[1].alias("distance"))


@register(
    "udf_predict_columns",
    _CENTROID_SQL + " SELECT vec_id, CAST(arg_min(c, (dist, c)) AS VARCHAR) AS label, CAST(arg_min(c, (dist, c)) AS INTEGER) AS label_id FROM d GROUP BY vec_id",
)
def q_predict_columns(spark, sf_dir):
    e = _emb(spark, sf_dir)
    cent = U.fit_centroids(e, "embedding", "label")
    p = U.predict_columns(e, "vec_id", "embedding", cent, [str(i) for i in range(cent.shape[0])])
    return p.select("vec_id", "label", "label_id")


@register(
    "udf_predict_probabilities",
    _CENTROID_SQL
    + """, p AS (SELECT vec_id, c, dist, exp(-(dist - min(dist) OVER (PARTITION BY vec_id))) AS e FROM d),
            q AS (SELECT vec_id, c, dist, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM p)
       SELECT vec_id, CAST(arg_min(c, (dist, c)) AS VARCHAR) AS label, CAST(arg_min(c, (dist, c)) AS INTEGER) AS label_id, """
    + ", ".join(f"round(max(p) FILTER (WHERE c = {i}), 6) AS prob_{i}" for i in range(10))
    + " FROM q GROUP BY vec_id",
)
def q_predict_probs(spark, sf_dir):
    e = _emb(spark, sf_dir)
    cent = U.fit_centroids(e, "embedding", "label")
    p = U.predict_columns(e, "vec_id", "embedding", cent, [str(i) for i in range(cent.shape[0])])
    return p.select("vec_id", "label", "label_id", *[F.round(f"prob_{i}", 6).alias(f"prob_{i}") for i in range(cent.shape[0])])


@register(
    "udf_request_chain",
    """SELECT event_id, to_json({'k': CAST(json_extract_string(props, '$.k') AS INTEGER),
                                 'score': CAST(json_extract_string(props, '$.k') AS INTEGER) * 2.0}) AS response FROM events""",
)
def q_request_chain(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return U.request_chain(ev, "props", "k int", Observation("request_chain"))


def _parse(pdf):
    found = [json.loads(x) if x else {} for x in pdf["props"]]
    return pd.DataFrame({"event_id": pdf["event_id"], "k": pd.array([x.get("k") for x in found], "Int64")})


def _score(pdf):
    return pdf.assign(score=pdf["k"].astype("Float64") * 2.0)


def _format(pdf):
    made = [json.dumps({"k": int(k), "score": float(s)}, separators=(",", ":")) if not pd.isna(k) else "{}" for k, s in zip(pdf["k"], pdf["score"])]
    return pd.DataFrame({"event_id": pdf["event_id"], "response": made})


@register(
    "udf_request_stages",
    """SELECT s AS stage, CAST(i AS INTEGER) AS position, count(*) AS rows, true AS timed
       FROM events, (VALUES ('transform_request', 0), ('invoke', 1), ('transform_response', 2)) v(s, i) GROUP BY s, i""",
)
def q_request_stages(spark, sf_dir):
    """Rows and time of each stage of the request chain; ``timed`` tells whether it took time at all."""
    stages = [("transform_request", _parse), ("invoke", _score), ("transform_response", _format)]
    seen = Observation("request_stages")
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    U.timed_chain(ev, stages, "event_id long, response string", seen).write.parquet(scratch_path(spark, "responses"))
    times = U.stage_times(spark, seen, [n for n, _ in stages])
    return times.select("stage", "position", "rows", (F.col("seconds") > 0).alias("timed"))


@register(
    "udaf_private_query",
    """WITH n AS (SELECT vec_id, label, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM embeddings),
            x AS (SELECT label, unnest(embedding)::DOUBLE * CASE WHEN norm > 1.0 THEN 1.0 / norm ELSE 1.0 END AS x,
                         unnest(range(len(embedding))) AS pos FROM n)
       SELECT CAST(label AS BIGINT) AS label, list(round(v, 6) ORDER BY pos) AS result FROM (
         SELECT label, pos, sum(x) AS v FROM x GROUP BY label, pos) GROUP BY label""",
)
def q_private_query(spark, sf_dir):
    r = U.private_query(_emb(spark, sf_dir), "label", "embedding", 1.0)
    return r.select("label", F.transform("result", lambda x: F.round(x, 6)).alias("result"))


@register("udf_row_map_reduce", "SELECT sum(l_quantity * l_quantity) AS total FROM lineitem")
def q_map_reduce(spark, sf_dir):
    return U.map_reduce(table(spark, sf_dir, "lineitem"), "l_quantity * l_quantity")
