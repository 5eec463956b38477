"""Queries for sections G (sorts, limits, top-k) and H (set operations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.arrays import argmax, top_k
from tessera.operators import joins as C
from tessera.operators.indexing import with_row_index
from tessera.plans.catalog import register
from tessera.session import table


def length_order(df, key, text):
    """Sort texts by blank-separated word count, longest first (stable: ties keep input order),
    and keep the input position beside the sorted position so the order can be restored."""
    d = df.select(key, F.size(F.filter(F.split(F.col(text), r"\s+"), lambda t: t != "")).alias("n_words"))
    return with_row_index(d, [F.desc("n_words"), F.col(key)], "sorted_pos")


@register(
    "sort_by_length_restore",
    """SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '')) AS n_words,
              row_number() OVER (ORDER BY len(list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '')) DESC, doc_id) - 1 AS sorted_pos
       FROM documents""",
)
def q_length_order(spark, sf_dir):
    return length_order(table(spark, sf_dir, "documents"), "doc_id", "text")


@register(
    "top_k_scores",
    """SELECT vec_id, rank, class_idx, score FROM (
         SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, i) AS rank, CAST(i - 1 AS INTEGER) AS class_idx, round(x, 6) AS score
         FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))
       WHERE rank <= 3""",
)
def q_top_k(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", top_k("embedding", 3).alias("best"))
    return e.select("vec_id", F.posexplode("best").alias("rank", "b")).select(
        "vec_id", (F.col("rank") + 1).cast("long").alias("rank"), F.col("b.idx").cast("int").alias("class_idx"),
        F.round("b.score", 6).alias("score"),
    )


@register(
    "argmax_class",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS cls FROM embeddings",
)
def q_argmax(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", argmax("embedding").alias("cls"))


@register(
    "latest_artifact",
    """SELECT user_id, arg_max(event_id, ts) AS latest_event, max(ts) AS latest_ts FROM events
       WHERE event_type LIKE 'c%' OR event_type LIKE 'p%' GROUP BY user_id""",
)
def q_latest(spark, sf_dir):
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").rlike("^(c|p)"))
    return ev.groupBy("user_id").agg(F.max_by("event_id", "ts").alias("latest_event"), F.max("ts").alias("latest_ts"))


@register(
    "limit_preview",
    "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20",
)
def q_preview(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return p.orderBy(F.desc("p_retailprice"), "p_partkey").limit(20)


def shuffle_records(df, seed: int = 0):
    """Random order of all records: a seeded hash key, then a global sort (range-partitioned)."""
    keyed = df.withColumn("_shuffle_key", F.xxhash64(*[F.col(c) for c in df.columns], F.lit(seed)))
    return keyed.orderBy("_shuffle_key").drop("_shuffle_key")


@register("shuffle_records", "SELECT doc_id, source FROM documents")
def q_shuffle(spark, sf_dir):
    """The shuffled table holds the same multiset of rows (the order is the feature)."""
    return shuffle_records(table(spark, sf_dir, "documents").select("doc_id", "source"), seed=3)


# ---------------------------------------------------------------------------- set operations
@register(
    "union_files",
    """SELECT 0 AS source_idx, c_custkey AS key, c_name AS name FROM customer
       UNION ALL SELECT 1 AS source_idx, s_suppkey AS key, s_name AS name FROM supplier""",
)
def q_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return C.concat_sources([c, s])


@register("distinct_items", "SELECT DISTINCT user_id, event_type FROM events")
def q_distinct(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_type").distinct()


def _bigrams(df, key):
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0)
    from tessera.operators.text import ngrams

    # materialise the token array first: the n-gram lambda reads it once per position
    return df.select(w.alias("t")).select(F.explode(ngrams("t", 2)).alias("ngram"))


@register(
    "intersect_ngrams",
    """SELECT ngram FROM (
         SELECT unnest(list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i + 1], ' '))) AS ngram
         FROM (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM documents) WHERE len(t) >= 2)
       INTERSECT
       SELECT ngram FROM (
         SELECT unnest(list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i + 1], ' '))) AS ngram
         FROM (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM benchmark) WHERE len(t) >= 2)""",
)
def q_intersect(spark, sf_dir):
    a = _bigrams(table(spark, sf_dir, "documents"), "doc_id")
    b = _bigrams(table(spark, sf_dir, "benchmark"), "item_id")
    return C.common_ngrams(a, b)


@register(
    "except_completed",
    "SELECT o_custkey AS custkey FROM orders EXCEPT SELECT c_custkey AS custkey FROM customer WHERE c_acctbal > 0",
)
def q_except(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    b = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("custkey"))
    return C.remaining(a, b)
