"""Aggregations (inventory section D): group reports, class shares, votes, vector sums, bins.

Every aggregate is a ``groupBy().agg()`` (partial aggregation before the shuffle) or a global
``agg()``; small result tables (one row per class, per bin or per vector position) are the only
things ever combined without a shuffle-partitioned join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax, l2_norm


# ---------------------------------------------------------------------------- group reports
def group_stats(df: DataFrame, key: str, val: str) -> DataFrame:
    """Count, average as decimal(12,2) and maximum per key, ordered by count descending."""
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(val).cast("decimal(12,2)").alias("avg_value"),
            F.max(val).alias("max_value"),
        )
        .orderBy(F.desc("n"), key)
    )


def group_having(df: DataFrame, key: str, val: str, min_n: int) -> DataFrame:
    """Same report over another key, ordered by average descending, keeping groups with n > min_n."""
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(val).cast("decimal(12,2)").alias("avg_value"),
            F.max(val).alias("max_value"),
        )
        .filter(F.col("n") > min_n)
        .orderBy(F.desc("avg_value"), key)
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, stddev (sample), min, max of the chosen columns in one pass, reshaped to one
    row per (column, statistic)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).cast("double").alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    stats = ["count", "mean", "stddev", "min", "max"]
    pairs = ", ".join(f"'{c}', '{s}', `{c}__{s}`" for c in cols for s in stats)
    return wide.selectExpr(f"stack({len(cols) * len(stats)}, {pairs}) AS (column_name, statistic, value)")


def count_pair(df: DataFrame, pred: Column) -> DataFrame:
    """Counts before and after a filter, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(pred).alias("n_after"))


def class_share(df: DataFrame, col: str, cls) -> DataFrame:
    """Rows per class and, on every row, the share of class ``cls`` in percent."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # window over the grouped result: one row per class
    w = Window.partitionBy()
    return counts.select(
        col,
        "n",
        (F.sum(F.when(F.col(col) == F.lit(cls), F.col("n")).otherwise(0)).over(w) * 100.0 / F.sum("n").over(w)).alias(
            "share_pct"
        ),
    )


def histogram(df: DataFrame, col: str, n: int) -> DataFrame:
    """Count per class 0..n-1, zero for absent classes (numpy ``bincount(minlength=n)``).  The
    class list is ``spark.range(n)``: its size is the parameter, so broadcasting it is safe."""
    counts = df.groupBy(F.col(col).cast("long").alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    classes = df.sparkSession.range(n).withColumnRenamed("id", "cls")
    return F.broadcast(classes).join(counts, "cls", "left").select(
        "cls", F.coalesce(F.col("n"), F.lit(0)).alias("n")
    )


def affinity(df: DataFrame, key: str, tags: str, weight: str, score: str, tag: str, name: str) -> DataFrame:
    """Per key, sum of weight * score over items whose tag array holds ``tag``."""
    return df.groupBy(key).agg(
        F.coalesce(
            F.sum(F.when(F.array_contains(F.col(tags), tag), F.col(weight) * F.col(score))), F.lit(0.0)
        ).alias(name)
    )


def quorum(df: DataFrame, key: str, pred: str) -> DataFrame:
    """Majority prediction per key: the value held by more than half of the rows; null with
    ``has_majority`` false when none."""
    per_value = df.groupBy(key, pred).agg(F.count(F.lit(1)).alias("_n"))
    return per_value.groupBy(key).agg(
        F.max_by(F.col(pred), F.col("_n")).alias("_top"),
        F.max("_n").alias("_topn"),
        F.sum("_n").alias("n_votes"),
    ).select(
        key,
        F.when(F.col("_topn") * 2 > F.col("n_votes"), F.col("_top")).alias("majority"),
        (F.col("_topn") * 2 > F.col("n_votes")).alias("has_majority"),
        "n_votes",
    )


def plurality(df: DataFrame, key: str, label: str) -> DataFrame:
    """Most frequent label per key; the smallest label wins ties (argmax takes the first index)."""
    per_label = df.groupBy(key, label).agg(F.count(F.lit(1)).alias("_n"))
    return per_label.groupBy(key).agg(
        F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias("winner"),
        F.max("_n").alias("votes"),
    )


def summary(df: DataFrame, key: str, pred: str) -> DataFrame:
    """avg, max, min and sample standard deviation of the predictions of each key."""
    return df.groupBy(key).agg(
        F.avg(pred).alias("avg_pred"),
        F.max(pred).alias("max_pred"),
        F.min(pred).alias("min_pred"),
        F.stddev_samp(pred).alias("std_pred"),
    )


def votes_matrix(df: DataFrame, sample: str, label: str, values: Sequence) -> DataFrame:
    """One row per sample, one count column per class (listed values avoid a distinct pass)."""
    return df.groupBy(sample).pivot(label, list(values)).count().na.fill(0)


def votes_array(df: DataFrame, sample: str, label: str, values: Sequence, name: str = "votes") -> DataFrame:
    """Vote counts per sample as one array (class order = ``values``)."""
    return df.groupBy(sample).agg(
        F.array(*[F.count_if(F.col(label) == F.lit(v)) for v in values]).alias(name)
    )


def uniform_hash(*cols: Column, seed: int = 0) -> Column:
    """A uniform value in [0, 1) from a hash of the given columns: reproducible and independent of
    partitioning, unlike ``rand(seed)``."""
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 52)).cast("double") / float(1 << 52)


def noisy_max(df: DataFrame, key: str, votes: str, scale: float, seed: int = 0) -> DataFrame:
    """Argmax of vote counts plus one Laplace(0, scale) draw per class (first index on ties).  The
    draw is the inverse CDF -scale*sign(u)*ln(1-2|u|) of u uniform in (-0.5, 0.5); scale 0 is the
    plain plurality."""
    if scale == 0:
        noisy = F.transform(F.col(votes), lambda v: v.cast("double"))
    else:
        noisy = F.transform(
            F.col(votes),
            lambda v, i: v.cast("double")
            + F.lit(-scale)
            * F.signum(uniform_hash(F.col(key), i, seed=seed) - 0.5)
            * F.log(1.0 - 2.0 * F.abs(uniform_hash(F.col(key), i, seed=seed) - 0.5)),
        )
    return df.select(key, argmax(noisy).alias("label"))


# ---------------------------------------------------------------------------- vectors
def _clip_factor(vec: Column, clip: float | None) -> Column:
    if clip is None:
        return F.lit(1.0)
    norm = l2_norm(vec)
    return F.when(norm > F.lit(clip), F.lit(clip) / norm).otherwise(F.lit(1.0))


#: Positions that are summed by one row of the aggregate.
WIDTH = 200


def _sum_vectors(df: DataFrame, parts: Mapping[str, tuple[Column, Column]], noise: Column | None = None) -> DataFrame:
    """part, sum_vec, n: the element-wise sum of each part (an array and a factor for each row) over all
    rows, and their number.  Every position is a sum of its own in one aggregate, so rows are read once
    and a task passes on one row.  Vectors wider than ``WIDTH`` are cut into pieces of that many
    positions first, a row a piece.  Shorter arrays count as ending early."""
    cols = [c for name, (vec, factor) in parts.items() for c in (vec.alias(f"_v_{name}"), factor.alias(f"_f_{name}"))]
    rows = df.select(*cols)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.size(f"_v_{p}")).alias(f"_s_{p}") for p in parts]).first()
    size = {p: max(0, sizes[f"_s_{p}"] or 0) for p in parts}
    pieces = max(1, *(-(-k // WIDTH) for k in size.values()))
    if pieces == 1:
        rows = rows.withColumn("_piece", F.lit(0))
    else:
        rows = rows.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    span = range(min(WIDTH, max(size.values())))
    sums = [F.sum(F.get(f"_v_{p}", F.col("_piece") * WIDTH + k) * F.col(f"_f_{p}")).alias(f"_{p}_{k}") for p in parts for k in span]
    keys = [] if pieces == 1 else ["_piece"]
    wide = rows.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("_n"))
    one = F.struct(*([F.col("_piece")] if keys else [F.lit(0).alias("_piece")]), *[F.array(*[F.col(f"_{p}_{k}") for k in span]).cast("array<double>").alias(p) for p in parts])
    joined = wide.agg(F.array_sort(F.collect_list(one)).alias("_a"))  # a row a piece

    def whole(p: str) -> Column:
        return F.slice(F.flatten(F.transform("_a", lambda x: x[p])), 1, size[p])

    out = joined.select(F.inline(F.array(*[F.struct(F.lit(p).alias("part"), whole(p).alias("sum_vec"), F.lit(sizes["n"]).alias("n")) for p in parts])))
    # a position without a number is none
    sums_of = F.transform("sum_vec", lambda x: F.coalesce(x, F.lit(0.0)) + (noise if noise is not None else F.lit(0.0)))
    return out.select("part", sums_of.alias("sum_vec"), "n")


def clipped_sum(df: DataFrame, vec: str, clip: float | None, stddev: float = 0.0, seed: int = 0) -> DataFrame:
    """Clip every record to L2 norm ``clip`` and add element-wise; optional Gaussian noise on the
    summed vector (one row per dimension)."""
    noise = F.randn(seed) * stddev if stddev else None
    return _sum_vectors(df, {"v": (F.col(vec), _clip_factor(F.col(vec), clip))}, noise).select("sum_vec")


def clipped_avg(
    df: DataFrame, vec: str, clip: float | None, denominator: float, stddev: float = 0.0, seed: int = 0
) -> DataFrame:
    """The clipped (and noised) sum divided by a fixed denominator, not by the row count."""
    s = clipped_sum(df, vec, clip, stddev, seed)
    return s.select(F.transform("sum_vec", lambda x: x / F.lit(float(denominator))).alias("avg_vec"))


def vector_sum_avg(df: DataFrame, vec: str) -> DataFrame:
    """Sum and true average, no clipping or noise."""
    s = _sum_vectors(df, {"v": (F.col(vec), F.lit(1.0))})
    return s.select("sum_vec", F.transform("sum_vec", lambda x: x / F.col("n")).alias("avg_vec"))


def nested_sums(df: DataFrame, vec: str, spec: Mapping[str, tuple[int, int, float]]) -> DataFrame:
    """Several clipped sums at once, each over its own slice ``(start, length)`` of the record with
    its own clip: part, sum_vec; one aggregate over one scan for all of them."""
    slices = {name: (F.slice(F.col(vec), start + 1, length), clip) for name, (start, length, clip) in spec.items()}
    return _sum_vectors(df, {name: (sl, _clip_factor(sl, clip)) for name, (sl, clip) in slices.items()}).select("part", "sum_vec")


# ---------------------------------------------------------------------------- bins
def bin_of(max_vote: Column, total: Column, bins: int) -> Column:
    """floor(max_vote * bins / total); a unanimous row (max_vote == total) would be bin ``bins``,
    which the reference rejects by assertion: it is clamped into the last bin."""
    return F.least(F.floor(max_vote * F.lit(bins) / total), F.lit(bins - 1)).cast("int")


def bin_counts(df: DataFrame, votes: str, bins: int) -> DataFrame:
    """Rows per agreement bin, zero for empty bins."""
    b = df.select(bin_of(F.array_max(votes), F.aggregate(votes, F.lit(0).cast("long"), lambda a, x: a + x), bins).alias("bin"))
    counts = b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return F.broadcast(all_bins).join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def bin_mean(df: DataFrame, bin_col: str, val: str, name: str = "mean_value") -> DataFrame:
    return df.groupBy(bin_col).agg(F.avg(val).alias(name), F.count(F.lit(1)).alias("n"))


def bin_sum(df: DataFrame, bin_col: str, val: str, name: str = "sum_value") -> DataFrame:
    return df.groupBy(bin_col).agg(F.sum(val).alias(name), F.count(F.lit(1)).alias("n"))


def check_totals(df: DataFrame, votes: str) -> DataFrame:
    """The common vote total of every row; the query fails at run time when totals differ."""
    tot = F.aggregate(votes, F.lit(0).cast("long"), lambda a, x: a + x)
    agg = df.agg(F.min(tot).alias("lo"), F.max(tot).alias("hi"))
    return agg.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo"))
        .otherwise(F.raise_error(F.lit("vote totals differ between rows")).cast("long"))
        .alias("total")
    )


def fingerprint(df: DataFrame, order: str, val: str) -> DataFrame:
    """Cheap equality proxy: row count, first and last value by ``order``, and the sum."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(val, order).alias("first_value"),
        F.max_by(val, order).alias("last_value"),
        F.sum(val).alias("sum_value"),
    )


def mc_fraction(df: DataFrame, x: str, y: str) -> DataFrame:
    """Fraction of points inside the unit quarter circle, times 4, with its error in percent
    against pi."""
    inside = (F.col(x) * F.col(x) + F.col(y) * F.col(y)) <= 1.0
    return df.agg((F.avg(F.when(inside, 1.0).otherwise(0.0)) * 4.0).alias("estimate")).select(
        "estimate", (F.abs(F.col("estimate") - F.lit(math.pi)) / F.lit(math.pi) * 100.0).alias("error_pct")
    )


def weighted_mean(df: DataFrame, score: str, weight: str, group: Sequence[str] = ()) -> DataFrame:
    """sum(score * weight) / sum(weight); weight-0 rows (padding) drop out."""
    return df.groupBy(*group).agg(
        (F.sum(F.col(score) * F.col(weight)) / F.sum(weight)).alias("weighted_mean")
    )
