"""Queries for section D (aggregations other than the text ones)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as D
from tessera.plans.catalog import register
from tessera.plans.derived import (
    EVENT_TYPES,
    SQL_EVENT_ITEMS,
    SQL_EVENT_VOTES,
    SQL_MODEL_PREDICTIONS,
    SQL_MODEL_VOTES,
    event_items,
    event_votes,
    model_predictions,
    model_votes,
)
from tessera.session import table


def r6(c):
    return F.round(c, 6)


def rvec(c):
    return F.transform(c, lambda x: F.round(x, 6))


@register(
    "agg_group_stats",
    """SELECT o_orderpriority, count(*) AS n, CAST(avg(o_totalprice) AS DECIMAL(12,2)) AS avg_value,
              max(o_totalprice) AS max_value FROM orders GROUP BY o_orderpriority""",
)
def q_group_stats(spark, sf_dir):
    return D.group_stats(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")


@register(
    "agg_group_having",
    """SELECT c_nationkey, count(*) AS n, CAST(avg(c_acctbal) AS DECIMAL(12,2)) AS avg_value,
              max(c_acctbal) AS max_value FROM customer GROUP BY c_nationkey HAVING count(*) > 55""",
)
def q_group_having(spark, sf_dir):
    return D.group_having(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", 55)


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _describe_sql():
    parts = []
    for c in _DESC_COLS:
        for s, e in [
            ("count", f"CAST(count({c}) AS DOUBLE)"),
            ("mean", f"avg({c})"),
            ("stddev", f"stddev_samp({c})"),
            ("min", f"min({c})"),
            ("max", f"max({c})"),
        ]:
            parts.append(f"SELECT '{c}' AS column_name, '{s}' AS statistic, round({e}, 4) + 0.0 AS value FROM lineitem")
    return " UNION ALL ".join(parts)


@register("agg_describe", _describe_sql())
def q_describe(spark, sf_dir):
    d = D.describe(table(spark, sf_dir, "lineitem"), _DESC_COLS)
    return d.select("column_name", "statistic", F.round("value", 4).alias("value"))


@register(
    "agg_row_count",
    "SELECT count(*) AS n_before, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_after FROM orders",
)
def q_row_count(spark, sf_dir):
    return D.count_pair(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F")


@register(
    "agg_class_share",
    """SELECT toxic, count(*) AS n,
              round(sum(count(*) FILTER (WHERE toxic = 1)) OVER () * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
       FROM labels GROUP BY toxic""",
)
def q_class_share(spark, sf_dir):
    s = D.class_share(table(spark, sf_dir, "labels"), "toxic", 1)
    return s.select("toxic", "n", r6("share_pct").alias("share_pct"))


@register(
    "agg_histogram_filled",
    """SELECT r.cls, coalesce(c.n, 0) AS n FROM range(0, 12) r(cls)
       LEFT JOIN (SELECT CAST(label AS BIGINT) AS cls, count(*) AS n FROM embeddings GROUP BY 1) c ON r.cls = c.cls""",
)
def q_histogram(spark, sf_dir):
    return D.histogram(table(spark, sf_dir, "embeddings"), "label", 12)


@register(
    "agg_affinity_sum",
    f"""SELECT user_id, round(coalesce(sum(CASE WHEN list_contains(tags, 'click') THEN weight * user_score END), 0.0), 6)
               AS affinity FROM {SQL_EVENT_ITEMS} GROUP BY user_id""",
)
def q_affinity(spark, sf_dir):
    a = D.affinity(event_items(spark, sf_dir), "user_id", "tags", "weight", "user_score", "click", "affinity")
    return a.select("user_id", r6("affinity").alias("affinity"))


@register(
    "agg_quorum",
    f"""WITH c AS (SELECT vec_id, pred, count(*) AS n FROM {SQL_MODEL_PREDICTIONS} GROUP BY 1, 2),
            t AS (SELECT vec_id, max(n) AS topn, sum(n) AS n_votes FROM c GROUP BY 1)
       SELECT t.vec_id, CASE WHEN t.topn * 2 > t.n_votes THEN (SELECT min(pred) FROM c WHERE c.vec_id = t.vec_id AND c.n = t.topn) END AS majority,
              t.topn * 2 > t.n_votes AS has_majority, CAST(t.n_votes AS BIGINT) AS n_votes FROM t""",
)
def q_quorum(spark, sf_dir):
    return D.quorum(model_predictions(spark, sf_dir), "vec_id", "pred")


@register(
    "agg_plurality",
    """SELECT user_id, event_type AS winner, n AS votes FROM (
         SELECT user_id, event_type, count(*) AS n,
                row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rk
         FROM events GROUP BY 1, 2) WHERE rk = 1""",
)
def q_plurality(spark, sf_dir):
    return D.plurality(table(spark, sf_dir, "events"), "user_id", "event_type")


@register(
    "agg_prediction_summary",
    """SELECT l_orderkey, round(avg(l_extendedprice), 6) AS avg_pred, max(l_extendedprice) AS max_pred,
              min(l_extendedprice) AS min_pred, round(stddev_samp(l_extendedprice), 6) AS std_pred
       FROM lineitem GROUP BY l_orderkey""",
)
def q_summary(spark, sf_dir):
    s = D.summary(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_extendedprice")
    return s.select("l_orderkey", r6("avg_pred").alias("avg_pred"), "max_pred", "min_pred", r6("std_pred").alias("std_pred"))


@register(
    "agg_votes_pivot",
    "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)
    + " FROM events GROUP BY user_id",
)
def q_votes_pivot(spark, sf_dir):
    return D.votes_matrix(table(spark, sf_dir, "events"), "user_id", "event_type", EVENT_TYPES)


@register(
    "agg_noisy_max",
    f"SELECT user_id, CAST(list_position(votes, list_max(votes)) - 1 AS INTEGER) AS label FROM {SQL_EVENT_VOTES}",
)
def q_noisy_max0(spark, sf_dir):
    """Noisy maximum at noise scale 0 (equals the plurality)."""
    return D.noisy_max(event_votes(spark, sf_dir), "user_id", "votes", 0.0)


@register("agg_noisy_max_laplace")
def q_noisy_max(spark, sf_dir):
    """Noisy maximum with Laplace scale 2 (hash-seeded draws, stable across partitionings)."""
    return D.noisy_max(event_votes(spark, sf_dir), "user_id", "votes", 2.0, seed=7)


_NORM = "sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))"


def _vec_sum_sql(factor: str, value: str = "v") -> str:
    return f"""SELECT list(round({value}, 6) ORDER BY pos) AS sum_vec FROM (
        SELECT pos, sum(x * f) AS v FROM (
          SELECT unnest(embedding)::DOUBLE AS x, unnest(generate_series(0, len(embedding) - 1)) AS pos, {factor} AS f
          FROM (SELECT embedding, {_NORM} AS norm FROM embeddings)) GROUP BY pos)"""


@register("agg_clipped_vector_sum", _vec_sum_sql("CASE WHEN norm > 1.0 THEN 1.0 / norm ELSE 1.0 END"))
def q_clipped_sum(spark, sf_dir):
    s = D.clipped_sum(table(spark, sf_dir, "embeddings"), "embedding", clip=1.0)
    return s.select(rvec("sum_vec").alias("sum_vec"))


@register(
    "agg_clipped_vector_avg",
    _vec_sum_sql("CASE WHEN norm > 0.8 THEN 0.8 / norm ELSE 1.0 END", "v / 100.0").replace("AS sum_vec", "AS avg_vec"),
)
def q_clipped_avg(spark, sf_dir):
    s = D.clipped_avg(table(spark, sf_dir, "embeddings"), "embedding", clip=0.8, denominator=100.0)
    return s.select(rvec("avg_vec").alias("avg_vec"))


@register(
    "agg_plain_vector_sum_avg",
    f"""SELECT list(round(v, 6) ORDER BY pos) AS sum_vec, list(round(v / n, 6) ORDER BY pos) AS avg_vec FROM (
        SELECT pos, sum(x) AS v, any_value(n) AS n FROM (
          SELECT unnest(embedding)::DOUBLE AS x, unnest(generate_series(0, len(embedding) - 1)) AS pos,
                 (SELECT count(*) FROM embeddings) AS n FROM embeddings) GROUP BY pos)""",
)
def q_vector_sum_avg(spark, sf_dir):
    s = D.vector_sum_avg(table(spark, sf_dir, "embeddings"), "embedding")
    return s.select(rvec("sum_vec").alias("sum_vec"), rvec("avg_vec").alias("avg_vec"))


_NESTED = {"head": (0, 32, 0.6), "tail": (32, 32, 0.4)}


def _nested_sql():
    parts = []
    for name, (start, length, clip) in _NESTED.items():
        sl = f"embedding[{start + 1}:{start + length}]"
        norm = f"sqrt(list_sum(list_transform({sl}, lambda x: x::DOUBLE * x::DOUBLE)))"
        parts.append(
            f"""SELECT '{name}' AS part, pos, sum(x * f) AS v FROM (
                  SELECT unnest({sl})::DOUBLE AS x, unnest(generate_series(0, {length - 1})) AS pos,
                         CASE WHEN {norm} > {clip} THEN {clip} / {norm} ELSE 1.0 END AS f FROM embeddings)
                GROUP BY pos"""
        )
    return f"SELECT part, list(round(v, 6) ORDER BY pos) AS sum_vec FROM ({' UNION ALL '.join(parts)}) GROUP BY part"


@register("agg_nested_queries", _nested_sql())
def q_nested(spark, sf_dir):
    s = D.nested_sums(table(spark, sf_dir, "embeddings"), "embedding", _NESTED)
    return s.select("part", rvec("sum_vec").alias("sum_vec"))


@register(
    "agg_bin_counts",
    f"""SELECT r.bin, coalesce(c.n, 0) AS n FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 10)) r LEFT JOIN (
          SELECT CAST(least(floor(list_max(votes) * 10 / list_sum(votes)), 9) AS INTEGER) AS bin, count(*) AS n
          FROM {SQL_EVENT_VOTES} GROUP BY 1) c ON r.bin = c.bin""",
)
def q_bin_counts(spark, sf_dir):
    return D.bin_counts(event_votes(spark, sf_dir), "votes", 10)


@register(
    "agg_validate_equal_totals",
    f"SELECT CAST(min(list_sum(votes)) AS BIGINT) AS total FROM {SQL_MODEL_VOTES}",
)
def q_check_totals(spark, sf_dir):
    return D.check_totals(model_votes(spark, sf_dir), "votes")


@register(
    "agg_fingerprint",
    """SELECT count(*) AS n, arg_min(o_totalprice, o_orderkey) AS first_value, arg_max(o_totalprice, o_orderkey) AS last_value,
              round(sum(o_totalprice), 2) AS sum_value FROM orders""",
)
def q_fingerprint(spark, sf_dir):
    f = D.fingerprint(table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice")
    return f.select("n", "first_value", "last_value", F.round("sum_value", 2).alias("sum_value"))


@register(
    "agg_conditional_fraction",
    """SELECT round(estimate, 6) AS estimate, round(abs(estimate - pi()) / pi() * 100.0, 6) AS error_pct FROM (
         SELECT avg(CASE WHEN x * x + y * y <= 1.0 THEN 1.0 ELSE 0.0 END) * 4.0 AS estimate FROM (
           SELECT ((l_partkey * 7919 + l_suppkey * 104729 + l_linenumber) % 10007) / 10007.0 AS x,
                  ((l_orderkey * 15485863 + l_linenumber * 7) % 10009) / 10009.0 AS y FROM lineitem))""",
)
def q_mc_fraction(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pts = li.select(
        (F.pmod(F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729 + F.col("l_linenumber"), F.lit(10007)) / 10007.0).alias("x"),
        (F.pmod(F.col("l_orderkey") * 15485863 + F.col("l_linenumber") * 7, F.lit(10009)) / 10009.0).alias("y"),
    )
    m = D.mc_fraction(pts, "x", "y")
    return m.select(r6("estimate").alias("estimate"), r6("error_pct").alias("error_pct"))


@register(
    "agg_weighted_mean",
    """SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS weighted_mean
       FROM lineitem GROUP BY l_returnflag""",
)
def q_weighted_mean(spark, sf_dir):
    w = D.weighted_mean(table(spark, sf_dir, "lineitem"), "l_discount", "l_quantity", ["l_returnflag"])
    return w.select("l_returnflag", r6("weighted_mean").alias("weighted_mean"))
