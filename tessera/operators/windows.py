"""Window operators (inventory section F): running sums and variances, running best order, budget
partition, throughput, best-so-far, early stop, contiguous partitions, shard blocks, windows over
sequences.

Running totals over one global order are the scale hazard: a window without PARTITION BY runs in
one task.  ``running_sums`` computes a two-level prefix sum instead: the partitions of a range
partitioning, written once, are the chunks; a window sums inside each chunk, and the totals of the chunks
before are added.  Only the group that a chunk begins in the middle of needs such a total, so their table has at
most one row a chunk and is broadcast; the rows themselves travel twice, whatever the number of sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.indexing import with_row_index
from tessera.session import cut_lineage



def running_sums(
    df: DataFrame,
    order: Sequence[str],
    values: dict[str, Column],
    by: Sequence[str] = (),
    index_name: str = "i",
    before: dict[str, str] | None = None,
) -> DataFrame:
    """Add running sums (inclusive) of each ``values`` expression in ``order`` within ``by``
    groups, plus a 0-based row index ``index_name`` within the group; ``before`` names columns for the sum
    at the row before (null on the first one), the very same number as there.

    ``order`` must be a total order within a group.  A group may span chunks, so a single hot group is
    still processed by many tasks."""
    names, before = list(values), before or {}
    staged = df.select("*", *[e.alias(f"_v_{n}") for n, e in values.items()])
    # range bounds from a sample: written once, so that both uses below see the same chunks
    staged = cut_lineage(staged.repartitionByRange(*by, *order).withColumn("_chunk", F.spark_partition_id()))
    w = Window.partitionBy("_chunk", *by).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    local = staged.select("*", F.row_number().over(w).alias("_l_"), *[F.sum(f"_v_{n}").over(upto).alias(f"_l_{n}") for n in names])
    # the last running sum of a chunk, not a sum in another order, where sums must be equal to the bit
    totals = (local if before else staged).groupBy("_chunk", *by).agg(
        F.count(F.lit(1)).alias("_t_"), *[(F.max_by(f"_l_{n}", "_l_") if before else F.sum(f"_v_{n}")).alias(f"_t_{n}") for n in names]
    )
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_chunk", *by, *[F.sum(f"_t_{n}").over(earlier).alias(f"_o_{n}") for n in ["", *names]]).where(F.col("_o_").isNotNull())
    offsets = offsets.select(F.col("_chunk").alias("_c"), *[F.col(b).alias(f"_b{k}") for k, b in enumerate(by)], "_o_", *[f"_o_{n}" for n in names])
    same = F.col("_chunk") == F.col("_c")
    for k, b in enumerate(by):
        same &= F.col(b).eqNullSafe(F.col(f"_b{k}"))
    if before:
        local = local.select("*", *[F.lag(f"_l_{n}").over(w).alias(f"_p_{n}") for n in before])
    out = local.join(F.broadcast(offsets), same, "left")  # at most one row a chunk

    def shifted(n: str, value: Column) -> Column:
        return F.when(F.col(f"_o_{n}").isNull(), value).when(value.isNull(), F.col(f"_o_{n}")).otherwise(value + F.col(f"_o_{n}"))

    made = {index_name: F.col("_l_").cast("long") - 1 + F.coalesce("_o_", F.lit(0))}
    made |= {n: shifted(n, F.col(f"_l_{n}")) for n in names}
    made |= {name: shifted(n, F.col(f"_p_{n}")) for n, name in before.items()}
    return out.select(*[F.col(c) for c in df.columns if c not in made], *[e.alias(n) for n, e in made.items()])


def cross_grid(df: DataFrame, grid: DataFrame) -> DataFrame:
    """Every row against a small parameter grid.  The grid is a parameter list (its size is known
    to the caller), so it is broadcast; the big side is not shuffled."""
    return df.crossJoin(F.broadcast(grid))


def running_cost(df: DataFrame, order: Sequence[str], costs: Sequence[tuple[float, Column]], keep: Sequence[str], name: str = "cum") -> DataFrame:
    """Running sums of several costs in query order, one for each value of a grid: ``costs`` lists the
    grid value and its cost.  All of them ride in one row through one sort; the result has the columns
    ``keep`` and the array ``name`` of (grid, cum) in the order listed."""
    run = running_sums(df, order, {f"_cost{k}": c for k, (_, c) in enumerate(costs)})
    pairs = [F.struct(F.lit(float(g)).alias("grid"), F.col(f"_cost{k}").alias("cum")) for k, (g, _) in enumerate(costs)]
    return run.select(*keep, F.array(*pairs).alias(name))


def running_variance(df: DataFrame, order: Sequence[str], x: str, by: Sequence[str] = ()) -> DataFrame:
    """Running variance sum(x^2)/k - (sum(x)/k)^2 with k = rows seen (``var_seen``) and with the
    reference's divisor k-1 (``var_ref``, null on the first row), plus the standard deviation of
    the running sum sqrt(k * var_seen)."""
    r = running_sums(df, order, {"_s1": F.col(x), "_s2": F.col(x) * F.col(x)}, by=by)
    k = F.col("i") + 1
    return (
        r.withColumn("var_seen", F.col("_s2") / k - F.pow(F.col("_s1") / k, 2))
        .withColumn(
            "var_ref",
            F.when(F.col("i") > 0, F.col("_s2") / F.col("i") - F.pow(F.col("_s1") / F.col("i"), 2)),
        )
        .withColumn("std_sum", F.sqrt(F.greatest(k * F.col("var_seen"), F.lit(0.0))))
        .drop("_s1", "_s2")
    )


def running_best_order(df: DataFrame, cums: str, delta: float) -> DataFrame:
    """Per query (a row with its array of (grid, cum)): epsilon = min over orders of
    cum - ln(delta)/(order-1), the order reaching it (smallest on ties) and its cost."""
    import math

    each = F.transform(cums, lambda x: F.struct((x["cum"] - F.lit(math.log(delta)) / (x["grid"] - 1)).alias("eps"), x["grid"].alias("order"), x["cum"].alias("cost")))
    best = df.withColumn("_best", F.array_min(each)).drop(cums)
    return best.select(
        *[c for c in best.columns if c != "_best"], F.col("_best.eps").alias("eps"), F.col("_best.order").alias("best_order"), F.col("_best.cost").alias("cost_at_best")
    )


def cost_partition(best: DataFrame, delta: float) -> DataFrame:
    """Split of epsilon into its step part and its delta part; the two add to 1."""
    import math

    d = F.lit(-math.log(delta)) / (F.col("best_order") - 1)
    return best.withColumn("share_steps", F.col("cost_at_best") / F.col("eps")).withColumn(
        "share_delta", d / F.col("eps")
    )


def throughput(df: DataFrame, step: str, seconds: str, every_n: int, warm_steps: int, batch: int) -> DataFrame:
    """Examples per second at the timer triggers: the first step after ``warm_steps`` starts the
    clock, then every ``every_n`` steps a row reports the interval rate (``current``) and the rate
    since the first trigger (``average``).  Steps are consecutive integers; ``seconds`` is the
    cumulative wall-clock time at each step.

    The previous trigger is found by an equi join on ``step - every_n`` (no global window), and the
    clock start is a one-row aggregate."""
    live = df.filter(F.col(step) > warm_steps).select(step, seconds)
    start = live.agg(F.min(step).alias("_s0"))
    start = start.join(live.withColumnRenamed(step, "_s0").withColumnRenamed(seconds, "_t0"), "_s0")
    trig = live.crossJoin(F.broadcast(start)).filter((F.col(step) - F.col("_s0")) % every_n == 0)
    prev = trig.select((F.col(step) + every_n).alias(step), F.col(seconds).alias("_pt"))
    t = trig.join(prev, step)
    return t.select(
        step,
        (F.lit(batch) * every_n / (F.col(seconds) - F.col("_pt"))).alias("current_examples_per_sec"),
        (F.lit(batch) * (F.col(step) - F.col("_s0")) / (F.col(seconds) - F.col("_t0"))).alias("average_examples_per_sec"),
    )


def running_min(
    df: DataFrame,
    order: Sequence[str],
    values: dict[str, Column],
    by: Sequence[str] = (),
    inclusive: bool = True,
) -> DataFrame:
    """Running minimum (of numbers or structs) in ``order`` within ``by`` groups, up to and
    including the row or strictly before it.

    Two levels again, but the chunks need no row numbers: a range partitioning on (by, order)
    cuts the ordered rows into contiguous chunks (its partition id), minima are taken inside each
    (group, chunk) and combined with the prefix minimum of the preceding chunks of the group.  A
    group holding most rows spans many chunks and so many tasks."""
    cols = [*by, *order]
    from tessera.session import cut_lineage

    idx = df.repartitionByRange(*cols).withColumn("_chunk", F.spark_partition_id())
    names = list(values)
    for n, e in values.items():
        idx = idx.withColumn(f"_v_{n}", e)
    # both branches below must see the same chunk ids: materialise them once
    idx = cut_lineage(idx)
    end = 0 if inclusive else -1
    w_local = Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    local = idx.select("*", *[F.min(f"_v_{n}").over(w_local).alias(f"_l_{n}") for n in names])
    totals = idx.groupBy(*by, "_chunk").agg(*[F.min(f"_v_{n}").alias(f"_t_{n}") for n in names])
    w_prev = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_chunk", *[F.min(f"_t_{n}").over(w_prev).alias(f"_o_{n}") for n in names])
    out = local.join(offsets, [*by, "_chunk"])
    for n in names:
        # least() skips nulls: the first rows of a group keep a null "before" value
        out = out.withColumn(n, F.least(F.col(f"_l_{n}"), F.col(f"_o_{n}")))
    return out.drop("_chunk", *[f"_{p}_{n}" for n in names for p in "vlo"])


def best_so_far(df: DataFrame, order: str, loss: str, by: Sequence[str] = ()) -> DataFrame:
    """Best loss before each row and whether this row strictly improves on it."""
    r = running_min(df, [order], {"best_before": F.col(loss)}, by, inclusive=False)
    return r.withColumn("improved", F.col("best_before").isNull() | (F.col(loss) < F.col("best_before")))


def early_stop(df: DataFrame, order: str, loss: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """First round at which the best round so far is at least ``k`` rounds old (no strict
    improvement for ``k`` rounds); null when training never stops.  The best round so far is the
    running minimum of (loss, round), so ties keep the earlier round."""
    r = running_min(df, [order], {"_best": F.struct(F.col(loss).alias("l"), F.col(order).alias("r"))}, by)
    marked = r.withColumn("_best_round", F.col("_best.r"))
    return marked.groupBy(*by).agg(
        F.min(F.when(F.col(order) - F.col("_best_round") >= k, F.col(order))).alias("stop_round"),
        F.min_by(F.col(order), F.struct(F.col(loss), F.col(order))).alias("best_round"),
    )


def best_epoch(df: DataFrame, epoch: str, loss: str, keep: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row with least loss (first epoch on ties) with its other metrics."""
    key = F.struct(F.col(loss), F.col(epoch))
    return df.groupBy(*by).agg(
        F.min_by(F.struct(F.col(epoch), F.col(loss), *[F.col(c) for c in keep]), key).alias("_b")
    ).select(*by, "_b.*")


def stop_step(df: DataFrame, step: str, metric: str, threshold: float | None, by: Sequence[str] = ()) -> DataFrame:
    """First step whose metric reaches the threshold; a null threshold never stops."""
    if threshold is None:
        return df.groupBy(*by).agg(F.lit(None).cast("long").alias("stop_step"))
    return df.groupBy(*by).agg(F.min(F.when(F.col(metric) >= threshold, F.col(step))).alias("stop_step"))


def partition_dataset(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Cut rows into ``n`` equal contiguous parts of floor(rows / n); the remainder is dropped."""
    idx = with_row_index(df, order, "_i", total_name="_n")
    size = F.floor(F.col("_n") / n)
    return (
        idx.withColumn("part", F.floor(F.col("_i") / size).cast("int"))
        .filter(F.col("part") < n)
        .drop("_i", "_n")
    )


def shard_blocks(df: DataFrame, order: Sequence[str], cores: int, rows_per_core: int) -> DataFrame:
    """Blocks of cores*rows_per_core rows, each cut evenly over the cores: a block of m rows gives
    core j the rows [int(j*m/c), int((j+1)*m/c)), c = min(cores, total rows)."""
    idx = with_row_index(df, order, "_i", total_name="_n")
    c = F.least(F.lit(cores), F.col("_n"))
    block_len = c * rows_per_core
    blk = F.floor(F.col("_i") / block_len)
    m = F.least(block_len, F.col("_n") - blk * block_len)  # rows in this block
    pos = F.col("_i") - blk * block_len
    # core j holds positions p with floor(j*m/c) <= p < floor((j+1)*m/c): j = the largest j with
    # floor(j*m/c) <= p, i.e. ceil((p+1)*c/m) - 1
    core = F.ceil((pos + 1) * c / m) - 1
    return idx.withColumn("block", blk.cast("long")).withColumn("core", core.cast("int")).drop("_i", "_n")


def shifted_windows(col: str | Column, length: int) -> Column:
    """All windows of ``length`` with the window shifted by one as target: array of (input, target)."""
    c = F.col(col) if isinstance(col, str) else col
    starts = F.sequence(F.lit(1), F.greatest(F.size(c) - length, F.lit(1)))
    wins = F.transform(
        starts,
        lambda s: F.struct(F.slice(c, s, length).alias("input"), F.slice(c, s + 1, length).alias("target")),
    )
    return F.when(F.size(c) > length, wins)


def shifted_window_rows(df: DataFrame, keys: Sequence[str], col: str, length: int) -> DataFrame:
    """``shifted_windows`` as rows (keys, start from 1, input, target).  Only the starts are exploded: a
    window is cut when its row is made, so no array of all windows of a row is built."""
    long = df.where(F.size(col) > length)
    starts = long.select(*keys, col, F.explode(F.sequence(F.lit(1), F.size(col) - length)).alias("_s"))
    return starts.select(*keys, F.col("_s").cast("long").alias("start"), F.slice(col, F.col("_s"), length).alias("input"),
                         F.slice(col, F.col("_s") + 1, length).alias("target"))


#: Windows cut from one piece of a text: a place in a string is found by walking there from its begin.
PIECE_WINDOWS = 32


def char_sequence_rows(df: DataFrame, keys: Sequence[str], col: str, length: int, step: int) -> DataFrame:
    """``char_sequences`` as rows (keys, start, chars, next_char).  A text is first cut into pieces of some
    windows, so that a window is a short walk from the begin of its piece, not of the text."""
    n, span = F.length(col), step * PIECE_WINDOWS
    pieces = df.where(n > length).select(*keys, F.explode(F.transform(
        F.sequence(F.lit(0), n - length - 1, F.lit(span)),
        lambda s: F.struct(s.alias("at"), F.substring(F.col(col), s + 1, F.lit(span - step + length + 1)).alias("piece")),
    )).alias("_p")).select(*keys, "_p.at", "_p.piece")
    starts = pieces.select(*keys, "at", "piece", F.explode(F.sequence(F.lit(0), F.length("piece") - length - 1, F.lit(step))).alias("_s"))
    return starts.select(*keys, (F.col("at") + F.col("_s")).cast("long").alias("start"), F.substring("piece", F.col("_s") + 1, F.lit(length)).alias("chars"),
                         F.substring("piece", F.col("_s") + 1 + length, F.lit(1)).alias("next_char"))


def char_sequences(col: str | Column, length: int, step: int) -> Column:
    """Windows of ``length`` characters every ``step`` characters with the next character as label."""
    c = F.col(col) if isinstance(col, str) else col
    n = F.length(c)
    starts = F.sequence(F.lit(0), n - length - 1, F.lit(step))
    seqs = F.transform(
        starts,
        lambda s: F.struct(
            s.alias("start"),
            F.substring(c, s + 1, F.lit(length)).alias("chars"),
            F.substring(c, s + 1 + length, F.lit(1)).alias("next_char"),
        ),
    )
    return F.when(n > length, seqs)
