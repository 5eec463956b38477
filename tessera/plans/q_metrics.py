"""Queries for section E (evaluation metrics).  Score vectors are the first ten embedding values
(ten classes, the ``label`` column is the truth)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.arrays import argmax
from tessera.operators import evaluation as E
from tessera.plans.catalog import register
from tessera.plans.derived import SQL_MODEL_VOTES, model_votes
from tessera.session import table

_SCORES_SQL = "(SELECT vec_id, list_transform(embedding[1:10], lambda x: x::DOUBLE * 10) AS s, label FROM embeddings)"
_ARGMAX_SQL = "CAST(list_position(s, list_max(s)) - 1 AS INTEGER)"


def _scores(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double") * 10).alias("s"), "label")


def r6(c):
    return F.round(c, 6)


@register("metric_accuracy", f"SELECT round(avg(CAST({_ARGMAX_SQL} = label AS DOUBLE)), 6) AS accuracy FROM {_SCORES_SQL}")
def q_accuracy(spark, sf_dir):
    return E.accuracy(_scores(spark, sf_dir), "s", "label", scores=True).select(r6("accuracy").alias("accuracy"))


@register(
    "metric_macro_precision",
    f"""WITH p AS (SELECT {_ARGMAX_SQL} AS pred, label FROM {_SCORES_SQL}),
            c AS (SELECT pred AS cls, count(*) AS predicted, count(*) FILTER (WHERE pred = label) AS tp FROM p GROUP BY pred)
       SELECT round(avg(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END), 6) AS macro_precision
       FROM range(0, 10) r(cls) LEFT JOIN c USING (cls)""",
)
def q_macro_precision(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return E.macro_precision(s, argmax("s"), "label", 10).select(r6("macro_precision").alias("macro_precision"))


@register(
    "metric_top_k_accuracy",
    f"""SELECT round(avg(CAST(len(list_filter(s, lambda x: x > s[label + 1])) < 5 AS DOUBLE)), 6) AS top5_accuracy FROM {_SCORES_SQL}""",
)
def q_topk(spark, sf_dir):
    return E.topk_accuracy(_scores(spark, sf_dir), "s", "label", 5).select(r6("top5_accuracy").alias("top5_accuracy"))


_PAIR_LEN_SQL = """(SELECT list_transform(string_split(x.text, ' '), lambda w: CAST(length(w) % 10 AS BIGINT)) AS l,
                           list_transform(string_split(y.text, ' '), lambda w: CAST(length(w) % 10 AS BIGINT)) AS p
                    FROM conversations x JOIN conversations y ON x.conv_id = y.conv_id AND y.turn = x.turn + 1)"""


def _pair_lens(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    wl = lambda col: F.transform(F.split(col, " "), lambda w: (F.length(w) % 10).cast("long"))
    a = c.select("conv_id", "turn", wl("text").alias("l"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), wl("text").alias("p"))
    return a.join(b, ["conv_id", "turn"])


@register(
    "metric_padded_accuracy",
    f"""WITH z AS (SELECT l, p, greatest(len(l), len(p)) AS m FROM {_PAIR_LEN_SQL}),
            t AS (SELECT unnest(list_concat(p, list_transform(range(m - len(p)), lambda i: CAST(0 AS BIGINT)))) AS pp,
                         unnest(list_concat(l, list_transform(range(m - len(l)), lambda i: CAST(0 AS BIGINT)))) AS ll FROM z)
       SELECT round(sum(CASE WHEN pp = ll AND ll <> 0 THEN 1.0 ELSE 0.0 END) / sum(CASE WHEN ll <> 0 THEN 1.0 ELSE 0.0 END), 6) AS padded_accuracy FROM t""",
)
def q_padded_accuracy(spark, sf_dir):
    return E.padded_accuracy(_pair_lens(spark, sf_dir), "p", "l").select(r6("padded_accuracy").alias("padded_accuracy"))


@register(
    "metric_sequence_accuracy",
    f"""WITH z AS (SELECT l, p, greatest(len(l), len(p)) AS m FROM {_PAIR_LEN_SQL}),
            q AS (SELECT list_concat(p, list_transform(range(m - len(p)), lambda i: CAST(0 AS BIGINT))) AS pp,
                         list_concat(l, list_transform(range(m - len(l)), lambda i: CAST(0 AS BIGINT))) AS ll FROM z)
       SELECT round(avg(CASE WHEN len(list_filter(range(1, len(ll) + 1), lambda i: ll[i] <> 0 AND pp[i] <> ll[i])) = 0 THEN 1.0 ELSE 0.0 END), 6)
              AS sequence_accuracy FROM q""",
)
def q_sequence_accuracy(spark, sf_dir):
    return E.sequence_accuracy(_pair_lens(spark, sf_dir), "p", "l").select(r6("sequence_accuracy").alias("sequence_accuracy"))


def _xent_sql(smoothing: float, vocab: int = 10):
    import math

    conf = 1.0 - smoothing
    low = (1.0 - conf) / (vocab - 1)
    norm = -(conf * math.log(conf) + (vocab - 1) * low * math.log(low + 1e-20))
    return (
        f"(list_max(s) + ln(list_sum(list_transform(s, lambda x: exp(x - list_max(s)))))"
        f" - (list_sum(s) * {low!r} + s[label + 1] * {conf - low!r}) - {norm!r})"
    )


@register(
    "metric_cross_entropy",
    f"""SELECT round(sum({_xent_sql(0.1)} * CASE WHEN label <> 0 THEN 1.0 ELSE 0.0 END)
                     / sum(CASE WHEN label <> 0 THEN 1.0 ELSE 0.0 END), 6) AS cross_entropy FROM {_SCORES_SQL}""",
)
def q_xent(spark, sf_dir):
    return E.cross_entropy(_scores(spark, sf_dir), "s", "label", 0.1, 10).select(r6("cross_entropy").alias("cross_entropy"))


@register(
    "metric_neg_log_perplexity",
    f"""SELECT round(sum(-{_xent_sql(0.0)} * CASE WHEN label <> 0 THEN 1.0 ELSE 0.0 END)
                     / sum(CASE WHEN label <> 0 THEN 1.0 ELSE 0.0 END), 6) AS neg_log_perplexity FROM {_SCORES_SQL}""",
)
def q_nlp(spark, sf_dir):
    return E.neg_log_perplexity(_scores(spark, sf_dir), "s", "label", 10).select(r6("neg_log_perplexity").alias("neg_log_perplexity"))


@register(
    "metric_mean_nll",
    f"""SELECT round(avg(list_max(s) + ln(list_sum(list_transform(s, lambda x: exp(x - list_max(s))))) - s[label + 1]), 6) AS mean_nll,
              count(*) FILTER (WHERE {_ARGMAX_SQL} = label) AS correct, count(*) AS total FROM {_SCORES_SQL}""",
)
def q_nll(spark, sf_dir):
    m = E.mean_nll(_scores(spark, sf_dir), "s", "label")
    return m.select(r6("mean_nll").alias("mean_nll"), "correct", "total")


@register(
    "metric_auc",
    """WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS score, quality AS label FROM labels JOIN documents USING (doc_id)),
            r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM d)
       SELECT round((sum(rk) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                    / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1)), 6) AS auc FROM r""",
)
def q_auc(spark, sf_dir):
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("n_chars").cast("double").alias("score"), F.col("quality").alias("label")
    )
    return E.auc(d, "score", "label").select(r6("auc").alias("auc"))


@register(
    "metric_regression",
    """SELECT round(sqrt(avg((p - y) * (p - y))), 4) AS rmse, round(avg(abs(p - y)), 4) AS mae,
              round(1 - sum((p - y) * (p - y)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6) AS r2
       FROM (SELECT l_quantity * 1500.0 AS p, l_extendedprice AS y FROM lineitem)""",
)
def q_regression(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") * 1500.0).alias("p"), F.col("l_extendedprice").alias("y"))
    r = E.regression_metrics(li, "p", "y")
    return r.select(F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), r6("r2").alias("r2"))


@register(
    "metric_aggregated_labels",
    f"""SELECT round(avg(CAST(CAST(list_position(votes, list_max(votes)) - 1 AS INTEGER) = label AS DOUBLE)), 6) AS accuracy
        FROM {SQL_MODEL_VOTES} v JOIN embeddings e USING (vec_id)""",
)
def q_ensemble_accuracy(spark, sf_dir):
    v = model_votes(spark, sf_dir)
    truth = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return E.ensemble_accuracy(v, "vec_id", "votes", truth, "label").select(r6("accuracy").alias("accuracy"))
