"""Inputs that the operators expect, derived by Spark from the test tables (so that every query's
work grows with the tables).  The same derivations are written in SQL in the oracle statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax
from tessera.session import table

# The five event types in sorted order (the class order of vote arrays).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# Number of voters over the embedding and the slice width of each.
N_VOTERS = 6
SLICE = 10


def event_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes matrix: one row per user, event counts per type (five classes)."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("user_id").agg(
        F.array(*[F.count_if(F.col("event_type") == t) for t in EVENT_TYPES]).alias("votes")
    )


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference items: tags (type and a value band), weight and integer score per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "user_id",
        F.array(F.col("event_type"), F.when(F.col("value") > 50, "high").otherwise("low")).alias("tags"),
        (F.col("value") / 100.0).alias("weight"),
        F.get_json_object("props", "$.k").cast("int").alias("user_score"),
    )


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table (vec_id, model, pred): model m predicts the argmax of embedding slice m."""
    emb = table(spark, sf_dir, "embeddings")
    preds = F.transform(
        F.sequence(F.lit(0), F.lit(N_VOTERS - 1)),
        lambda m: F.struct(m.alias("model"), argmax(F.slice("embedding", m * SLICE + 1, SLICE)).alias("pred")),
    )
    return emb.select("vec_id", F.inline(preds))


def model_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vote arrays of the embedding voters: ten classes per vector."""
    p = model_predictions(spark, sf_dir)
    return p.groupBy("vec_id").agg(
        F.array(*[F.count_if(F.col("pred") == i) for i in range(10)]).alias("votes")
    )


# The languages of the documents, and the characters whose shares tell them apart.
LANGUAGES = ["de", "en", "es", "fr"]
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêçñáíó "


def letter_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the share of each of LETTERS in the lower-case text, and the language as a number."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t"), (F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("lang")) - 1).alias("label"))
    size = F.greatest(F.length("t"), F.lit(1))
    share = [(F.length("t") - F.length(F.replace("t", F.lit(c)))) / size for c in LETTERS]
    return d.where("label >= 0").select("doc_id", F.array(*share).alias("shares"), F.col("label").cast("double").alias("label"))


# SQL forms of the derivations, for the oracle statements.
SQL_EVENT_VOTES = (
    "(SELECT user_id, ["
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}')" for t in EVENT_TYPES)
    + "]::BIGINT[] AS votes FROM events GROUP BY user_id)"
)

SQL_EVENT_ITEMS = (
    "(SELECT event_id, user_id, [event_type, CASE WHEN value > 50 THEN 'high' ELSE 'low' END] AS tags, "
    "value / 100.0 AS weight, CAST(json_extract_string(props, '$.k') AS INTEGER) AS user_score FROM events)"
)

SQL_MODEL_PREDICTIONS = (
    "(SELECT vec_id, m AS model, "
    f"CAST(list_position(embedding[m*{SLICE}+1:m*{SLICE}+{SLICE}], list_max(embedding[m*{SLICE}+1:m*{SLICE}+{SLICE}])) - 1 AS INTEGER) AS pred "
    f"FROM embeddings, range(0, {N_VOTERS}) r(m))"
)

SQL_MODEL_VOTES = (
    "(SELECT vec_id, ["
    + ", ".join(f"count(*) FILTER (WHERE pred = {i})" for i in range(10))
    + f"]::BIGINT[] AS votes FROM {SQL_MODEL_PREDICTIONS} GROUP BY vec_id)"
)
