"""Projections, filters and predicates (inventory section B)."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.indexing import with_row_index


def filter_range(
    df: DataFrame,
    between: Mapping[str, tuple[float, float]] | None = None,
    greater: Mapping[str, float] | None = None,
) -> DataFrame:
    """Conjunctive range predicate; written as plain comparisons so the parquet scan receives
    them as pushed filters."""
    preds: list[Column] = []
    for c, (lo, hi) in (between or {}).items():
        preds += [F.col(c) >= F.lit(lo), F.col(c) <= F.lit(hi)]
    for c, v in (greater or {}).items():
        preds.append(F.col(c) > F.lit(v))
    if not preds:
        return df
    return df.filter(functools.reduce(operator.and_, preds))


def all_not_null(cols: Iterable[str]) -> Column:
    return functools.reduce(operator.and_, [F.col(c).isNotNull() for c in cols])


def filter_all_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose listed columns are all non-null (AND folded over the list)."""
    return df.filter(all_not_null(cols))


def case_in_list(col: str | Column, allow: Sequence[str], other: str = "Other") -> Column:
    """Fold categories outside ``allow`` into ``other``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(list(allow)), c).otherwise(F.lit(other))


def impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls per column by a constant (``coalesce``; keeps codegen, no Python)."""
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )


def derive_with_fallback(
    value: str | Column,
    guard: str | Column,
    keep_above: float = 100.0,
    fallback: float = 350.0,
    per_unit: float = 380.0,
) -> Column:
    """Three-branch derivation: keep the value when it is above ``keep_above``; otherwise
    ``fallback`` when the guard is missing or zero; otherwise ``per_unit * guard``."""
    v = F.col(value) if isinstance(value, str) else value
    g = F.col(guard) if isinstance(guard, str) else guard
    return (
        F.when(v > F.lit(keep_above), v.cast("double"))
        .when(g.isNull() | (g == 0), F.lit(fallback))
        .otherwise(F.lit(per_unit) * g)
    )


def sql_over_view(spark: SparkSession, df: DataFrame, view: str, query: str) -> DataFrame:
    """Register ``df`` as a temporary view and run ``query`` against it."""
    df.createOrReplaceTempView(view)
    return spark.sql(query)


def coerce_dropna(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """Cast text columns to numbers (bad values become null), then drop rows holding any null."""
    out = df.select(
        *[F.expr(f"try_cast(`{c}` AS {to})").alias(c) if c in cols else F.col(c) for c in df.columns]
    )
    return out.na.drop(how="any")


def drop_unused(df: DataFrame, used: Sequence[str], label: str | None = None) -> DataFrame:
    """All columns minus the used ones minus the label (column-set difference)."""
    gone = set(used) | ({label} if label else set())
    return df.select(*[c for c in df.columns if c not in gone])


def filter_max_length(df: DataFrame, a: str, b: str, n: int) -> DataFrame:
    """Keep pairs whose two arrays are both at most ``n`` long."""
    return df.filter((F.size(a) <= n) & (F.size(b) <= n))


def filter_ext(df: DataFrame, col: str, exts: Sequence[str]) -> DataFrame:
    """Case-insensitive suffix filter (file extensions)."""
    low = F.lower(F.col(col))
    return df.filter(functools.reduce(operator.or_, [low.endswith(e.lower()) for e in exts]))


def filter_contains(df: DataFrame, col: str, part: str) -> DataFrame:
    """Substring filter (links whose path holds a part)."""
    return df.filter(F.col(col).contains(part))


def has_tag(col: str | Column, tag: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.array_contains(c, tag)


def head_subset(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` (distributed top-n: TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def index_subset(
    df: DataFrame, order: Sequence[str], positions: DataFrame, n: int, pos_col: str = "pos"
) -> DataFrame:
    """Rows at the positions listed in ``positions`` (cut to its first ``n`` entries), matched by a
    semi join on the row index; a shorter input than asked raises (the reference asserts it)."""
    wanted = positions.orderBy(pos_col).limit(n)
    have = wanted.count()
    if have < n:
        raise ValueError(f"index list holds {have} positions, {n} asked")
    indexed = with_row_index(df, order, "_pos")
    return indexed.join(wanted.select(F.col(pos_col).alias("_pos")), "_pos", "left_semi").drop("_pos")


def split_tail(
    df: DataFrame, order: Sequence[str], n_test: int | None = None, train_frac: float | None = None
) -> DataFrame:
    """Deterministic split: the last ``n_test`` rows, or all after the first ``train_frac``, are
    test rows.  Adds ``split`` = 'train' / 'test'."""
    idx = with_row_index(df, order, "_i", total_name="_n")
    if n_test is not None:
        is_test = F.col("_i") >= F.col("_n") - F.lit(n_test)
    else:
        is_test = F.col("_i") >= F.floor(F.col("_n") * F.lit(train_frac))
    return idx.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("_i", "_n")


def hash_split(df: DataFrame, key: str, weights: Sequence[float], seed: int = 0) -> DataFrame:
    """Stable weighted split: bucket ``pmod(xxhash64(key, seed), 10000)`` against cumulative
    weights; independent of partitioning.  Adds ``split`` = 0, 1, ..."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        acc += w / total
        bounds.append(int(round(acc * 10000)))
    b = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10000))
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        expr = F.when(b < bounds[i], F.lit(i)).otherwise(expr)
    return df.withColumn("split", expr.cast("int"))


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Spark's sampling split (depends on partitioning; use ``hash_split`` for stable results)."""
    return df.randomSplit(list(weights), seed)
