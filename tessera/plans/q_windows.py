"""Queries for section F (window operators).  Per-query costs are dyadic rationals so running
sums are exact whatever the order of addition."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.arrays import discounted_max
from tessera.operators import windows as W
from tessera.plans.catalog import register
from tessera.session import table

# The order grid of the running-cost examples and the delta of the epsilon bound.
GRID = [1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 16.0, 32.0, 64.0]
DELTA = 1e-8

_GRID_SQL = "(VALUES " + ", ".join(f"({g})" for g in GRID) + ") g(alpha)"
_COST_SQL = "alpha * ((CAST(floor(o_totalprice) AS BIGINT) % 8) / 4096.0) / 2"


def _running_costs(spark, sf_dir):
    """o_orderkey and the running cost of every order of the grid, as one array."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", ((F.floor("o_totalprice").cast("long") % 8) / 4096.0).alias("x"))
    return W.running_cost(o, ["o_orderkey"], [(g, F.lit(g) * F.col("x") / 2) for g in GRID], ["o_orderkey"])


@register(
    "win_running_cost",
    f"""SELECT alpha, o_orderkey, round(sum({_COST_SQL}) OVER (PARTITION BY alpha ORDER BY o_orderkey
               ROWS UNBOUNDED PRECEDING), 6) AS cost_cum FROM orders, {_GRID_SQL}""",
)
def q_running_cost(spark, sf_dir):
    r = _running_costs(spark, sf_dir).select("o_orderkey", F.inline("cum"))
    return r.select(F.col("grid").alias("alpha"), "o_orderkey", F.round("cum", 6).alias("cost_cum"))


@register(
    "win_running_variance",
    """SELECT o_orderkey, round(s2 / k - power(s1 / k, 2), 6) AS var_seen,
              round(CASE WHEN k > 1 THEN s2 / (k - 1) - power(s1 / (k - 1), 2) END, 6) AS var_ref,
              round(sqrt(greatest(k * (s2 / k - power(s1 / k, 2)), 0.0)), 6) AS std_sum
       FROM (SELECT o_orderkey,
                    sum(x) OVER w AS s1, sum(x * x) OVER w AS s2, row_number() OVER w AS k
             FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS DOUBLE) AS x FROM orders)
             WINDOW w AS (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING))""",
)
def q_running_variance(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 1000).cast("double").alias("x"))
    r = W.running_variance(o, ["o_orderkey"], "x")
    return r.select(
        "o_orderkey",
        F.round("var_seen", 6).alias("var_seen"),
        F.round("var_ref", 6).alias("var_ref"),
        F.round("std_sum", 6).alias("std_sum"),
    )


_BEST_SQL = f"""
    WITH c AS (SELECT alpha, o_orderkey, sum({_COST_SQL}) OVER (PARTITION BY alpha ORDER BY o_orderkey
                      ROWS UNBOUNDED PRECEDING) AS cum FROM orders, {_GRID_SQL}),
         e AS (SELECT alpha, o_orderkey, cum, cum - ln({DELTA}) / (alpha - 1) AS eps FROM c),
         b AS (SELECT o_orderkey, min(eps) AS eps, arg_min(alpha, (eps, alpha)) AS best_order,
                      arg_min(cum, (eps, alpha)) AS cost_at_best FROM e GROUP BY o_orderkey)
"""


@register(
    "win_running_argmin",
    _BEST_SQL + "SELECT o_orderkey, round(eps, 6) AS eps, best_order FROM b",
)
def q_running_argmin(spark, sf_dir):
    b = W.running_best_order(_running_costs(spark, sf_dir), "cum", DELTA)
    return b.select("o_orderkey", F.round("eps", 6).alias("eps"), "best_order")


@register(
    "win_cost_partition",
    _BEST_SQL
    + f"""SELECT o_orderkey, round(cost_at_best / eps, 6) AS share_steps,
                 round((-ln({DELTA}) / (best_order - 1)) / eps, 6) AS share_delta FROM b""",
)
def q_cost_partition(spark, sf_dir):
    p = W.cost_partition(W.running_best_order(_running_costs(spark, sf_dir), "cum", DELTA), DELTA)
    return p.select("o_orderkey", F.round("share_steps", 6).alias("share_steps"), F.round("share_delta", 6).alias("share_delta"))


@register(
    "win_throughput",
    """WITH s AS (SELECT event_id AS step, epoch_us(ts) / 1e6 AS sec FROM events WHERE event_id > 50),
            z AS (SELECT min(step) AS s0 FROM s),
            t AS (SELECT s.step, s.sec, z.s0, (SELECT sec FROM s WHERE step = z.s0) AS t0 FROM s, z WHERE (s.step - z.s0) % 100 = 0)
       SELECT a.step, round(32 * 100 / (a.sec - b.sec), 6) AS current_examples_per_sec,
              round(32 * (a.step - a.s0) / (a.sec - a.t0), 6) AS average_examples_per_sec
       FROM t a JOIN t b ON b.step + 100 = a.step""",
)
def q_throughput(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("step"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("sec")
    )
    t = W.throughput(ev, "step", "sec", 100, 50, 32)
    return t.select(
        "step",
        F.round("current_examples_per_sec", 6).alias("current_examples_per_sec"),
        F.round("average_examples_per_sec", 6).alias("average_examples_per_sec"),
    )


@register(
    "win_best_so_far",
    """SELECT user_id, event_id, min(value) OVER (PARTITION BY user_id ORDER BY event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before,
              coalesce(value < min(value) OVER (PARTITION BY user_id ORDER BY event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS improved FROM events""",
)
def q_best_so_far(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return W.best_so_far(ev, "event_id", "value", ["user_id"]).select("user_id", "event_id", "best_before", "improved")


def _rounds(spark, sf_dir):
    from tessera.operators.indexing import with_group_index

    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    # rounds numbered per user from 1 (a group index: parallel even for one dominant user)
    return with_group_index(ev, ["user_id"], ["event_id"], "round", start=1).drop("event_id")


_ROUNDS_SQL = "(SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS round FROM events)"


@register(
    "win_early_stop",
    f"""WITH r AS {_ROUNDS_SQL},
            b AS (SELECT user_id, round, value,
                         arg_min(round, (value, round)) OVER (PARTITION BY user_id ORDER BY round ROWS UNBOUNDED PRECEDING) AS best_round
                  FROM r)
       SELECT user_id, min(CASE WHEN round - best_round >= 10 THEN round END) AS stop_round,
              arg_min(round, (value, round)) AS best_round FROM b GROUP BY user_id""",
)
def q_early_stop(spark, sf_dir):
    return W.early_stop(_rounds(spark, sf_dir), "round", "value", 10, ["user_id"])


@register(
    "win_best_epoch",
    f"""SELECT user_id, arg_min(round, (value, round)) AS round, min(value) AS value,
              arg_min(event_type, (value, round)) AS event_type FROM {_ROUNDS_SQL} GROUP BY user_id""",
)
def q_best_epoch(spark, sf_dir):
    return W.best_epoch(_rounds(spark, sf_dir), "round", "value", ["event_type"], ["user_id"])


@register(
    "win_stop_threshold",
    f"SELECT user_id, min(CASE WHEN value >= 95 THEN round END) AS stop_step FROM {_ROUNDS_SQL} GROUP BY user_id",
)
def q_stop_threshold(spark, sf_dir):
    return W.stop_step(_rounds(spark, sf_dir), "round", "value", 95.0, ["user_id"])


@register(
    "win_contiguous_partition",
    """SELECT o_orderkey, CAST(floor(rn / floor(n / 7)) AS INTEGER) AS part FROM (
         SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders)
       WHERE floor(rn / floor(n / 7)) < 7""",
)
def q_contiguous(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return W.partition_dataset(o, ["o_orderkey"], 7)


@register(
    "win_shard_blocks",
    """WITH i AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i, count(*) OVER () AS n FROM customer),
            b AS (SELECT c_custkey, i, least(8, n) AS c, floor(i / (least(8, n) * 64)) AS blk, n FROM i),
            m AS (SELECT c_custkey, blk, c, i - blk * c * 64 AS pos, least(c * 64, n - blk * c * 64) AS m FROM b)
       SELECT c_custkey, CAST(blk AS BIGINT) AS block, CAST(ceil((pos + 1) * c / m) - 1 AS INTEGER) AS core FROM m""",
)
def q_shard_blocks(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return W.shard_blocks(c, ["c_custkey"], 8, 64)


@register(
    "win_next_token_pairs",
    """SELECT doc_id, s AS start, w[s:s + 7] AS input, w[s + 1:s + 8] AS target FROM (
         SELECT doc_id, w, unnest(range(1, len(w) - 7)) AS s FROM (
           SELECT doc_id, string_split(text, ' ') AS w FROM documents) WHERE len(w) > 8)""",
)
def q_next_token_pairs(spark, sf_dir):
    """The training windows of all positions of all documents."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("w")).filter(F.size("w") > 8)
    return W.shifted_window_rows(d, ["doc_id"], "w", 8)


@register(
    "win_char_sequences",
    """SELECT doc_id, s AS start, substring(text, s + 1, 40) AS chars, substring(text, s + 41, 1) AS next_char FROM (
         SELECT doc_id, text, unnest(range(0, length(text) - 40, 20)) AS s FROM documents WHERE length(text) > 40)""",
)
def q_char_sequences(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text").filter(F.length("text") > 40)
    return W.char_sequence_rows(d, ["doc_id"], "text", 40, 20)


@register(
    "win_discounted_max",
    """SELECT vec_id, round(list_max(list_transform(embedding, lambda x, d: exp(-0.1 * (d - 1)) * x::DOUBLE)), 6) AS dmax
       FROM embeddings""",
)
def q_discounted_max(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(discounted_max("embedding", 0.1), 6).alias("dmax"))
