"""Positional helpers: a consecutive global row index without a single-partition window.

Spark numbers rows globally only through ``row_number()`` over an unpartitioned window, which pulls
every row into one task.  ``with_row_index`` instead

1. range-partitions on the (total) order key and sorts inside each partition,
2. takes the in-partition position from ``monotonically_increasing_id`` (partition id in the high
   bits, record number in the low 33 bits) and materialises this once with a reliable
   ``checkpoint`` in the shared folder: the counting branch and the numbering branch must see the
   very same partitions, and two independent range shuffles (different samples, different
   coalescing) would not guarantee that,
3. counts rows per partition (one row per partition, a size bounded by the partition count, so it
   is broadcast safely) and turns the counts into starting offsets.

The order key must be a total order (unique); callers pass a tie-breaking key when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = (1 << 33) - 1


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_row_index(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "row_idx",
    start: int = 0,
    total_name: str | None = None,
) -> DataFrame:
    """Append a consecutive index (``start``, ``start+1``, ...) following ``order``.

    With ``total_name`` the total row count is attached as well (from the same per-partition
    counts, no extra pass)."""
    cols = _order_cols(order)
    staged = (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
        .withColumn("_local", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
    )
    from tessera.session import cut_lineage

    staged = cut_lineage(staged)
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # the counts table holds one row per partition: its window runs on a tiny input
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"),
    )
    out = staged.join(F.broadcast(offsets), "_pid").withColumn(
        name, (F.col("_off") + F.col("_local") + F.lit(start)).cast("long")
    )
    if total_name:
        out = out.withColumn(total_name, F.col("_total"))
    return out.drop("_mid", "_pid", "_local", "_off", "_total")


def with_group_index(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str = "row_idx", start: int = 0
) -> DataFrame:
    """A consecutive index inside each ``by`` group (like ``row_number() OVER (PARTITION BY by
    ORDER BY order)`` minus one) that stays parallel when one group holds most rows: the global
    index over (by, order) minus the index of the group's first row."""
    idx = with_row_index(df, [*by, *order], "_gidx")
    starts = idx.groupBy(*by).agg(F.min("_gidx").alias("_g0"))
    return (
        idx.join(starts, list(by))
        .withColumn(name, F.col("_gidx") - F.col("_g0") + F.lit(start))
        .drop("_gidx", "_g0")
    )
