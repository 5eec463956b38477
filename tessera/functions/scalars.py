"""Column functions for strings, URLs, JSON, maps and scoring (inventory section I); HTML has its own
module."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------------------- URLs and names
def form_field(url: str | Column, name: str) -> Column:
    """Value of field ``name`` in the query string: URL-decode, split on '&', keep ``name=``."""
    q = F.url_decode(F.regexp_extract(_c(url), r"\?([^#]*)", 1))
    hits = F.filter(F.split(q, "&"), lambda kv: kv.startswith(name + "="))
    return F.substring(F.try_element_at(hits, F.lit(1)), len(name) + 2, 1 << 30)


def basename(path: str | Column) -> Column:
    return F.try_element_at(F.split(_c(path), "/"), F.lit(-1))


def percent(p: str | Column) -> Column:
    """Probability as text 'dd.dd%'."""
    return F.format_string("%.2f%%", _c(p) * 100.0)


def name_seed(col: str | Column) -> Column:
    """int(md5 hex digest) mod (2^32 - 1): as 2^32 = 1 modulo 2^32 - 1, the sum of the four 32-bit
    words of the digest has the same remainder."""
    h = F.md5(_c(col))
    words = [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    total = words[0] + words[1] + words[2] + words[3]
    return F.pmod(total, F.lit(4294967295))


def hash_bucket(col: str | Column, n: int) -> Column:
    """Category to one of ``n`` buckets by a stable hash (Spark's xxhash64; values differ from other
    engines' hash functions)."""
    return F.pmod(F.xxhash64(_c(col)), F.lit(n)).cast("int")


# ---------------------------------------------------------------------------- JSON
def prune_json(col: str | Column, schema: str, drop: Sequence[str]) -> Column:
    """Parse with a declared schema, drop named (possibly nested) fields, write compact JSON in
    the remaining key order."""
    s = F.from_json(_c(col), schema)
    for f in drop:
        s = s.dropFields(f)
    return F.to_json(s)


def json_get(col: str | Column, path: str) -> Column:
    return F.get_json_object(_c(col), path)


# ---------------------------------------------------------------------------- scores
def zscore_class(a_cat: Column, a_dog: Column, cat: tuple[float, float], dog: tuple[float, float]):
    """z = (A - mean) / std for both scores; the class comes from the larger |z| and its sign
    (equal sizes go to dog)."""
    z_cat = (a_cat - cat[0]) / cat[1]
    z_dog = (a_dog - dog[0]) / dog[1]
    cls = (
        F.when((F.abs(z_cat) > F.abs(z_dog)) & (z_cat >= 0), "cat_lover")
        .when(F.abs(z_cat) > F.abs(z_dog), "cat_hater")
        .when(z_dog >= 0, "dog_lover")
        .otherwise("dog_hater")
    )
    return z_cat, z_dog, cls


def minmax(df: DataFrame, col: str, lo: float = -1.0, hi: float = 1.0, name: str | None = None) -> DataFrame:
    """Scale to [lo, hi] by the global minimum and maximum (one aggregate row joined back); a
    constant column gives ``lo``."""
    stats = df.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    span = F.col("_mx") - F.col("_mn")
    scaled = F.when(span == 0, F.lit(lo)).otherwise((F.col(col) - F.col("_mn")) / span * (hi - lo) + lo)
    return df.crossJoin(F.broadcast(stats)).withColumn(name or col, scaled).drop("_mn", "_mx")


def linear_score(df: DataFrame, key: str, numeric: Mapping[str, float], categorical: Mapping[tuple[str, str], float],
                 intercept: float) -> DataFrame:
    """Regression score: intercept + sum of numeric coefficient * value + the coefficient of each
    categorical value; unseen categories add 0.  The coefficient table is a model parameter (one
    entry per known category), so it becomes a map literal looked up inside the projection: no
    join and no shuffle."""
    num = F.lit(float(intercept))
    for c, w in numeric.items():
        num = num + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
    coef = F.create_map(*[x for (f, v), w in categorical.items() for x in (F.lit(f"{f}={v}"), F.lit(float(w)))])
    cat = F.lit(0.0)
    for f in sorted({f for f, _ in categorical}):
        cat = cat + F.coalesce(F.try_element_at(coef, F.concat(F.lit(f + "="), F.col(f).cast("string"))), F.lit(0.0))
    return df.select(key, (num + cat).alias("score"))


# ---------------------------------------------------------------------------- maps
def route_weights(m: str | Column) -> Column:
    """Repair a route map so the weights add to 100: the rest goes to the first key (by name)."""
    c = _c(m)
    total = F.aggregate(F.map_values(c), F.lit(0).cast("long"), lambda a, x: a + x)
    keys = F.array_sort(F.map_keys(c))
    first = F.try_element_at(keys, F.lit(1))
    return F.transform_values(c, lambda k, v: F.when(k == first, v + (F.lit(100) - total)).otherwise(v))


def kv_list(m: str | Column) -> Column:
    """Map to a list of (name, value) structs sorted by name; an empty list for a null map."""
    c = _c(m)
    return F.coalesce(F.array_sort(F.map_entries(c)), F.array())
