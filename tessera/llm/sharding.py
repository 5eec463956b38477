"""Balanced shards by sampled splitters, with DataFrame functions only.

Records are ordered by (hash of the text, hash of the id), so equal texts are neighbours.  A sample
drawn with probability in proportion to the size gives quantile boundaries; they cut the order into
many narrow ranges.  The ranges are measured exactly, overfull ones are subdivided by a sample of
their own, and consecutive ranges make up a shard of nearly equal bytes.
"""

from __future__ import annotations

import math
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

N_SHARDS = 16
#: Ranges for each shard; a shard misses its share of the bytes by about half a range at each end.
RANGES = 64
#: Expected size of the sample, which the driver sorts.
SAMPLE = 1 << 16
#: A group of equal texts stays in one range unless it is larger than a shard over this.
WHOLE = 16

_MIN, _MAX = -(1 << 63) + 1, (1 << 63) - 1
Key = tuple[int, int]


def _values(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A small table of whole numbers as an inline VALUES relation."""
    body = ", ".join("(" + ", ".join(f"{x}L" for x in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def _longs(values: list[int]) -> Column:
    """A constant array, folded into the plan once."""
    return F.expr(f"array({','.join(f'{x}L' for x in values)})")


def range_of(splitters: list[Key]) -> Column:
    """Number of splitters at or below the key (_h, _g): a binary search inside the row."""
    if not splitters:
        return F.lit(0)
    depth = math.ceil(math.log2(len(splitters) + 1))
    padded = splitters + [(_MAX, _MAX)] * ((1 << depth) - 1 - len(splitters))
    hs, gs = _longs([h for h, _ in padded]), _longs([g for _, g in padded])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(depth))])

    def probe(pos: Column, step: Column) -> Column:
        h, g = F.element_at(hs, pos + step), F.element_at(gs, pos + step)
        return F.when((F.col("_h") > h) | ((F.col("_h") == h) & (F.col("_g") >= g)), pos + step).otherwise(pos)

    return F.least(F.aggregate(steps, F.lit(0), probe), F.lit(len(splitters)))


def _sample(keyed: DataFrame, per_byte: float, salt: int) -> list[tuple[int, int, float]]:
    """Keys with their weight: a record is drawn with probability size * per_byte."""
    u = F.pmod(F.xxhash64("_h", "_g", F.lit(salt)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = keyed.where(u < F.col("size") * F.lit(per_byte))
    rows = drawn.select("_h", "_g", F.greatest(F.col("size").cast("double"), F.lit(1 / per_byte)).alias("w")).collect()
    return sorted((r["_h"], r["_g"], r["w"]) for r in rows)


def _quantiles(sample: list[tuple[int, int, float]], pieces: int, whole: float) -> list[Key]:
    """Boundaries that cut the sample into ``pieces`` of equal weight; one that falls inside a group
    of equal texts lighter than ``whole`` moves to the beginning of the group."""
    group: dict[int, float] = {}
    for h, _, w in sample:
        group[h] = group.get(h, 0.0) + w
    total = sum(group.values())
    found, seen, k = [], 0.0, 1
    for h, g, w in sample:
        if k < pieces and seen + w / 2 >= total * k / pieces:
            found.append((h, g if group[h] >= whole else _MIN))
            k = int((seen + w / 2) * pieces / total) + 1
        seen += w
    return sorted(set(found))


def _measure(keyed: DataFrame, splitters: list[Key]) -> dict[int, tuple[int, int, int]]:
    """Exact (bytes, rows, texts) of each range."""
    by = keyed.groupBy(range_of(splitters).alias("r")).agg(
        F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), (F.min("_h") != F.max("_h")).alias("many")
    )
    return {r["r"]: (r["b"], r["n"], int(r["many"])) for r in by.collect()}


def shard(docs: DataFrame, n_shards: int = N_SHARDS, ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """Put records (doc_id, text; other columns are ignored) into ``n_shards`` of nearly equal bytes.

    Returns doc_id, size (UTF-8 bytes and one; a null text has none), text_crc32, law ('bytes'),
    shard, slot (gapless from 0 in the shard), grown_shard (null: not part of this law).  Equal texts
    stay in one range unless their group is larger than a sixteenth of a shard; then it is cut by id.
    Rows equal in id and text have one key and stay together.  An empty table gives no rows."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = written(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_h"),
            F.xxhash64(F.col("doc_id"), F.lit(7)).alias("_g"),
        ),
        "shard-keys",
    )
    total = keyed.agg(F.sum("size")).first()[0] or 0
    out = [F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.lit("bytes").alias("law")]
    if not total:
        return keyed.select(*out, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    share = total / (n_shards * ranges)
    whole = total / n_shards / WHOLE
    splitters = _quantiles(_sample(keyed, sample / total, 0), n_shards * ranges, whole)
    measured = _measure(keyed, splitters)
    for salt in range(1, 9):  # each pass cuts the overfull ranges; ends when none can be cut further
        over = [r for r, (b, n, many) in measured.items() if n > 1 and b > (2 * share if many else max(2 * share, whole))]
        if not over:
            break
        b_over = sum(measured[r][0] for r in over)
        inside = keyed.where(range_of(splitters).isin(over))
        extra, by_range = set(), {r: [] for r in over}
        for h, g, w in _sample(inside, sample / b_over, salt):
            by_range[bisect_right(splitters, (h, g))].append((h, g, w))
        for r, drawn in by_range.items():
            extra |= set(_quantiles(drawn, math.ceil(measured[r][0] / share), whole))
        if extra <= set(splitters):
            break
        splitters = sorted(set(splitters) | extra)
        measured = _measure(keyed, splitters)
    rows, before, slots = [], 0, {}
    for r in sorted(measured):
        b, n, _ = measured[r]
        k = min(n_shards - 1, int((before + b / 2) * n_shards / total))
        rows.append((r, k, slots.get(k, 0)))
        slots[k] = slots.get(k, 0) + n
        before += b
    plan = _values(spark, ["_r", "_shard", "_slots"], rows)
    numbered = keyed.withColumn("_r", range_of(splitters).cast("long")).withColumn(
        "_n", F.row_number().over(Window.partitionBy("_r").orderBy("_h", "_g", "doc_id", "size")) - 1
    )
    # bound of the broadcast: the ranges, at most n_shards * ranges and the subdivisions
    return numbered.join(F.broadcast(plan), "_r").select(
        *out,
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_slots") + F.col("_n")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
