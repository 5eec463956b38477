"""Model evaluation metrics (inventory section E) as aggregates over prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax, let
from tessera.operators.windows import running_sums


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def accuracy(df: DataFrame, pred: str | Column, label: str, scores: bool = False) -> DataFrame:
    """Share of rows whose prediction equals the label; with ``scores`` the prediction is the
    argmax of a score vector."""
    p = argmax(pred) if scores else _c(pred)
    return df.agg(F.avg((p == F.col(label)).cast("double")).alias("accuracy"))


def macro_precision(df: DataFrame, pred: str | Column, label: str, n_classes: int) -> DataFrame:
    """Mean over all classes of TP / predicted, 0 for classes never predicted."""
    p = _c(pred)
    per = df.groupBy(p.alias("cls")).agg(
        F.count(F.lit(1)).alias("predicted"), F.count_if(p == F.col(label)).alias("tp")
    )
    classes = df.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("cls"))
    full = F.broadcast(classes).join(per, "cls", "left")
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    return full.agg(F.avg(prec).alias("macro_precision"))


def in_top_k(scores: str | Column, label: str | Column, k: int) -> Column:
    """True when fewer than ``k`` scores are strictly greater than the label's score."""
    s = _c(scores)
    return let(
        F.try_element_at(s, _c(label) + 1),
        lambda ls: F.size(F.filter(s, lambda x: x > ls)) < k,
    )


def topk_accuracy(df: DataFrame, scores: str, label: str, k: int) -> DataFrame:
    return df.agg(F.avg(in_top_k(scores, label, k).cast("double")).alias(f"top{k}_accuracy"))


def padded_accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Token accuracy over padded pairs, pad id 0 in the label carries no weight."""
    m = F.greatest(F.size(pred), F.size(label))
    pad = lambda c: F.concat(F.col(c).cast("array<long>"), F.array_repeat(F.lit(0).cast("long"), m - F.size(c)))
    z = df.select(F.arrays_zip(pad(pred).alias("p"), pad(label).alias("l")).alias("z"))
    ex = z.select(F.explode("z").alias("t")).select(
        ((F.col("t.p") == F.col("t.l")).cast("double")).alias("hit"), (F.col("t.l") != 0).cast("double").alias("w")
    )
    return ex.agg((F.sum(F.col("hit") * F.col("w")) / F.sum("w")).alias("padded_accuracy"))


def sequence_accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    """1 for a row only when every non-pad label token is predicted right; mean over rows."""
    m = F.greatest(F.size(pred), F.size(label))
    pad = lambda c: F.concat(F.col(c).cast("array<long>"), F.array_repeat(F.lit(0).cast("long"), m - F.size(c)))
    ok = F.forall(F.arrays_zip(pad(pred).alias("p"), pad(label).alias("l")), lambda t: (t["l"] == 0) | (t["p"] == t["l"]))
    return df.agg(F.avg(ok.cast("double")).alias("sequence_accuracy"))


def _lse(logits: Column) -> Column:
    """log-sum-exp, shifted by the maximum."""
    return let(
        F.array_max(logits),
        lambda mx: mx + F.log(F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - mx))),
    )


def smoothed_xent(logits: str | Column, label: str | Column, smoothing: float, vocab: int) -> Column:
    """Per-row cross-entropy against label-smoothed targets minus its lowest possible value."""
    z = _c(logits)
    conf = 1.0 - smoothing
    low = (1.0 - conf) / (vocab - 1)
    import math

    norm = -(conf * math.log(conf) + (vocab - 1) * low * math.log(low + 1e-20)) if conf > 0 else 0.0
    tz = F.aggregate(
        z, F.lit(0.0), lambda a, x: a + x.cast("double") * F.lit(low)
    ) + F.try_element_at(z, _c(label) + 1).cast("double") * F.lit(conf - low)
    return _lse(z) - tz - F.lit(norm)


def cross_entropy(df: DataFrame, logits: str, label: str, smoothing: float, vocab: int) -> DataFrame:
    """Weighted mean of the smoothed loss; label 0 is padding (weight 0)."""
    w = (F.col(label) != 0).cast("double")
    x = smoothed_xent(logits, label, smoothing, vocab)
    return df.agg((F.sum(x * w) / F.sum(w)).alias("cross_entropy"))


def neg_log_perplexity(df: DataFrame, logits: str, label: str, vocab: int) -> DataFrame:
    w = (F.col(label) != 0).cast("double")
    x = smoothed_xent(logits, label, 0.0, vocab)
    return df.agg((F.sum(-x * w) / F.sum(w)).alias("neg_log_perplexity"))


def mean_nll(df: DataFrame, logits: str, label: str) -> DataFrame:
    """Summed -ln softmax(label) over the set divided by its size, and correct / total."""
    z = F.col(logits)
    nll = _lse(z) - F.try_element_at(z, F.col(label) + 1).cast("double")
    return df.agg(
        F.avg(nll).alias("mean_nll"),
        F.count_if(argmax(z) == F.col(label)).alias("correct"),
        F.count(F.lit(1)).alias("total"),
    )


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve: P(score of a positive > score of a negative), ties counting one
    half.  Rows are reduced to one row per distinct score, then a chunked running count of
    negatives below each score; no single-partition rank window over the rows."""
    per = df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    run = running_sums(per, ["s"], {"neg_le": F.col("neg").cast("double")})
    contrib = F.col("pos") * (F.col("neg_le") - F.col("neg") + 0.5 * F.col("neg"))
    return run.agg((F.sum(contrib) / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def regression_metrics(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """RMSE, MAE and R^2 in one pass (R^2 from the sums of squares)."""
    e = F.col(pred) - F.col(actual)
    y = F.col(actual)
    return df.agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.sum(e * e) / (F.sum(y * y) - F.sum(y) * F.sum(y) / F.count(F.lit(1)))).alias("r2"),
    )


def ensemble_accuracy(votes: DataFrame, key: str, votes_col: str, truth: DataFrame, label: str) -> DataFrame:
    """Accuracy of the plurality label of each row's votes against the true label."""
    pl = votes.select(key, argmax(votes_col).alias("_agg"))
    return pl.join(truth.select(key, label), key).agg(F.avg((F.col("_agg") == F.col(label)).cast("double")).alias("accuracy"))


def per_class_counts(df: DataFrame, pred: str, label: str, classes: Sequence[int]) -> DataFrame:
    return df.groupBy(label, pred).count()
