"""Joins (inventory section C) and set operations (section H).

Broadcast is used only where the small side has a size fixed by parameters (a grid, a class list)
or by the schema of a fixed dimension; other joins are left to the planner, whose adaptive
execution switches to a broadcast at run time when the measured side is small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.indexing import with_row_index


# ---------------------------------------------------------------------------- positional
def zip_rows(
    left: DataFrame,
    right: DataFrame,
    order_l: Sequence[str],
    order_r: Sequence[str],
    strict: bool = True,
) -> DataFrame:
    """Pair row i of ``left`` with row i of ``right`` (both numbered by their own order).  With
    ``strict`` unequal lengths fail at run time; otherwise the longer side is cut."""
    li = with_row_index(left, order_l, "_pos", total_name="_nl")
    ri = with_row_index(right, order_r, "_pos", total_name="_nr")
    joined = li.join(ri, "_pos", "inner")
    if strict:
        joined = joined.withColumn(
            "_chk",
            F.when(F.col("_nl") == F.col("_nr"), F.lit(True)).otherwise(
                F.raise_error(F.lit("inputs differ in length")).cast("boolean")
            ),
        ).filter("_chk").drop("_chk")
    return joined.drop("_nl", "_nr").withColumnRenamed("_pos", "pos")


def pair_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text",
               src_role: str | None = "user", role: str = "role") -> DataFrame:
    """Pair each turn with the reply that follows it (self equi join on (conv, turn + 1))."""
    src = df if src_role is None else df.filter(F.col(role) == src_role)
    a = src.select(conv, turn, F.col(text).alias("source"))
    b = df.select(conv, (F.col(turn) - 1).alias(turn), F.col(text).alias("target"))
    return a.join(b, [conv, turn], "inner")


# ---------------------------------------------------------------------------- lookups
def lookup_chain(df: DataFrame, key: str, first: DataFrame, first_key: str, mid: str,
                 second: DataFrame, second_key: str, name: str, first_only: bool = False,
                 broadcast_dims: bool = False) -> DataFrame:
    """Two-step dimension lookup: key -> mid (first table) -> display name (second table);
    optionally only the first comma-separated synonym."""
    f = first.select(F.col(first_key).alias(key), F.col(mid).alias("_mid"))
    s = second.select(F.col(second_key).alias("_mid"), F.col(name).alias("_name"))
    if broadcast_dims:
        f, s = F.broadcast(f), F.broadcast(s)
    out = df.join(f, key, "left").join(s, "_mid", "left")
    nm = F.split(F.col("_name"), ",").getItem(0) if first_only else F.col("_name")
    return out.withColumn(name, nm).drop("_mid", "_name")


def label_index(df: DataFrame, col: str, labels: DataFrame, label_col: str, idx_col: str, default: int = -1) -> DataFrame:
    """Label text to its index through a lookup table; unknown labels get ``default``."""
    lk = labels.select(F.col(label_col).alias(col), F.col(idx_col).alias("_idx"))
    return df.join(lk, col, "left").withColumn("label_idx", F.coalesce(F.col("_idx"), F.lit(default))).drop("_idx")


#: Rows whose words are looked up together.
BLOCK_ROWS = 500


def _looked_up(df: DataFrame, key: str, words: str, table: DataFrame, run: Callable, shape: str) -> DataFrame:
    """Rows in blocks, each beside the entries of ``table`` (word, value) for its distinct words: ``run``
    gets the two frames of a block.  A word travels once a block, not once an occurrence, and a frequent
    word meets the table once a block; a row travels once."""
    rows = df.select(F.col(key).alias("key"), F.col(words).alias("words"))
    blocks = max(1, rows.count() // BLOCK_ROWS)
    marked = rows.withColumn("block", F.pmod(F.xxhash64("key", F.size("words")), F.lit(blocks)))
    need = marked.select(F.col("block").alias("of"), F.explode("words").alias("word")).distinct()
    found = need.join(table.select("word", "value"), "word").select("of", "word", "value")
    return marked.groupBy("block").cogroup(found.groupBy("of")).applyInPandas(run, shape)


def encode_words(df: DataFrame, key: str, words: str, vocab: DataFrame, word_col: str = "word",
                 id_col: str = "id") -> DataFrame:
    """Token arrays to vocabulary ids, order kept: one row a row.  A row without tokens has an empty
    array; a word missing from the vocabulary is an error."""
    kind = df.schema[key].dataType.simpleString()

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        ids = dict(zip(known["word"], known["value"].tolist()))
        try:
            out = [[ids[w] for w in ws if w is not None] if ws is not None else [] for ws in rows["words"]]
        except KeyError as e:
            raise ValueError(f"not in the vocabulary: {e.args[0]}") from None
        return pd.DataFrame({key: rows["key"], "ids": out})

    table = vocab.select(F.col(word_col).alias("word"), F.col(id_col).cast("long").alias("value"))
    return _looked_up(df, key, words, table, run, f"`{key}` {kind}, ids array<bigint>")


def unkify(df: DataFrame, key: str, words: str, vocab: DataFrame, word_col: str = "word",
           unk: str = "*UNK*") -> DataFrame:
    """Replace words outside the vocabulary by ``unk`` and rejoin the string with single blanks; a
    row without words gives the empty string."""
    kind = df.schema[key].dataType.simpleString()

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        words = set(known["word"])
        return pd.DataFrame({key: rows["key"], "text": [" ".join([w if w in words else unk for w in ws if w is not None]) if ws is not None else "" for ws in rows["words"]]})

    table = vocab.select(F.col(word_col).alias("word"), F.lit(True).alias("value")).distinct()
    return _looked_up(df, key, words, table, run, f"`{key}` {kind}, text string")


def pending(todo: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work list minus completed items (anti join)."""
    return todo.join(done, list(keys), "left_anti")


# ---------------------------------------------------------------------------- ranges
def assign_bucket(df: DataFrame, value: Column, bounds: Sequence[tuple[int, int]], name: str = "bucket") -> DataFrame:
    """Bucket id of the first (min, max) with min <= value < max.  The bucket list is a parameter:
    for sorted contiguous bounds it is an array search inside one expression, otherwise a scan of
    the (min, max) pairs; both stay in generated code, no join."""
    lo = [a for a, _ in bounds]
    hi = [b for _, b in bounds]
    if all(hi[i] == lo[i + 1] for i in range(len(bounds) - 1)) and lo == sorted(lo):
        from tessera.operators.text import bucket_of

        return df.withColumn(name, bucket_of(value, lo, hi))
    pairs = F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi")) for a, b in bounds])
    hits = F.filter(
        F.transform(pairs, lambda p, i: F.when((value >= p["lo"]) & (value < p["hi"]), i)), lambda x: x.isNotNull()
    )
    return df.withColumn(name, F.try_element_at(hits, F.lit(1)).cast("int"))


def asof_forward(grid: DataFrame, curve: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """For each grid point x, the position of the first curve row whose running value ``y`` is
    >= x (null when none): ``searchsorted(y, x, side='left')``.

    Grid points and curve rows are ordered by value together (grid points first at equal values), so
    a grid point takes the next curve row's position.  The order is cut into contiguous chunks, the
    partitions of a range partitioning that is written once; the answer comes from the point's own
    chunk or else from the first later chunk with a curve row (a table of one row a chunk).  ``by``
    separates independent curves."""
    from tessera.session import cut_lineage

    g = grid.select(*by, F.col(x).cast("double").alias("_v"), F.lit(0).alias("_kind"),
                    F.col(x).alias("_x"), F.lit(None).cast("long").alias("_pos"))
    c = curve.select(*by, F.col(y).cast("double").alias("_v"), F.lit(1).alias("_kind"),
                     F.lit(None).cast(grid.schema[x].dataType).alias("_x"), F.col("pos").cast("long").alias("_pos"))
    order = [*by, "_v", "_kind", "_pos"]
    u = cut_lineage(g.unionByName(c).repartitionByRange(*order).withColumn("_chunk", F.spark_partition_id()))
    # a running frame over the reversed order ends at the current row, so it is evaluated incrementally
    inside = Window.partitionBy(*by, "_chunk").orderBy(*[F.desc(k) for k in order[len(by):]]).rowsBetween(Window.unboundedPreceding, 0)
    near = u.withColumn("pos", F.last("_pos", ignorenulls=True).over(inside)).filter(F.col("_kind") == 0)
    firsts = u.filter(F.col("_kind") == 1).groupBy(*by, "_chunk").agg(F.min("_pos").alias("_first"))
    open_chunks = near.filter(F.col("pos").isNull()).select(*by, "_chunk").distinct().withColumnRenamed("_chunk", "_own")
    later = open_chunks.join(firsts, list(by)) if by else open_chunks.crossJoin(F.broadcast(firsts))  # chunks, not rows
    later = later.filter(F.col("_chunk") > F.col("_own")).groupBy(*by, "_own").agg(F.min("_first").alias("_next"))
    out = near.join(later.withColumnRenamed("_own", "_chunk"), [*by, "_chunk"], "left")
    return out.select(*by, F.col("_x").alias(x), F.coalesce("pos", "_next").alias("pos"))


def asof_forward_grid(curve: DataFrame, y: str, before: str, n_points: int, step: float) -> DataFrame:
    """``asof_forward`` for the regular grid x_k = k * step, k = 0..n_points-1, without any window.

    ``y`` is a running sum of non-negative values and ``before`` its value one row earlier (null on the
    first row), the same number as there, so that every grid point falls to one row.  Curve row ``pos``
    answers exactly the grid points in (before, y] (row 0 also every point below), so each row emits
    those grid indices and a join on k attaches them: the emitted rows number at most the grid size,
    whatever the curve length."""
    k_lo = F.when(F.col(before).isNull(), F.lit(0)).otherwise(F.floor(F.col(before) / step) + 1)
    k_hi = F.least(F.floor(F.col(y) / step), F.lit(n_points - 1))
    hits = curve.filter(k_lo <= k_hi).select(
        "pos", F.explode(F.sequence(k_lo.cast("long"), k_hi.cast("long"))).alias("k")
    )
    grid = curve.sparkSession.range(n_points).withColumnRenamed("id", "k")
    return grid.join(hits, "k", "left").select((F.col("k") * step).alias("x"), "pos")


def join_answers(dfs: Sequence[DataFrame], key: str) -> DataFrame:
    """Join the answers of several estimators on the request id into one row (chained equi joins)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.join(d, key, "inner")
    return out


def baseline_diff(votes: DataFrame, base: DataFrame, key: str, col: str) -> DataFrame:
    """Element-wise votes minus baseline for equally shaped tables; a shape mismatch fails."""
    b = base.select(F.col(key), F.col(col).alias("_b"))
    j = votes.join(b, key, "full_outer")
    ok = F.col(col).isNotNull() & F.col("_b").isNotNull() & (F.size(col) == F.size("_b"))
    diff = F.when(ok, F.zip_with(col, "_b", lambda v, x: v - x)).otherwise(
        F.raise_error(F.lit("votes and baseline differ in shape"))
    )
    return j.select(key, diff.alias("diff"))


# ---------------------------------------------------------------------------- set operations
def concat_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """Concatenate inputs in listed order with a source index (``unionByName``)."""
    out = None
    for i, d in enumerate(dfs):
        d = d.withColumn("source_idx", F.lit(i))
        out = d if out is None else out.unionByName(d)
    return out


def common_ngrams(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def remaining(a: DataFrame, b: DataFrame) -> DataFrame:
    """Items of ``a`` missing in ``b``, as a set."""
    return a.subtract(b)
