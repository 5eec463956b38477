"""Array and vector column functions (higher-order functions, evaluated in the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable (otherwise a lambda that
    refers to an expression evaluates it once per element)."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def array_sum(col: str | Column) -> Column:
    return F.aggregate(_c(col), F.lit(0.0), lambda a, x: a + x.cast("double"))


def l2_norm(col: str | Column) -> Column:
    return F.sqrt(F.aggregate(_c(col), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def argmax(col: str | Column) -> Column:
    """0-based index of the largest element, first index on ties (null for an empty array)."""
    c = _c(col)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def pad_left(col: str | Column, n: int, pad=0) -> Column:
    """Pad with ``pad`` on the left and keep the last ``n`` elements (Keras ``pad_sequences``
    defaults: pre-padding, pre-truncation)."""
    c = _c(col)
    return F.slice(F.concat(F.array_repeat(F.lit(pad).cast("long"), n), c.cast("array<long>")), -n, n)


def pad_right_to(col: str | Column, length: Column | int, pad=0) -> Column:
    c = _c(col)
    ln = length if isinstance(length, Column) else F.lit(length)
    return F.concat(c, F.array_repeat(F.lit(pad).cast("long"), F.greatest(ln - F.size(c), F.lit(0))))


def pad_pair(a: str | Column, b: str | Column, pad=0) -> tuple[Column, Column]:
    """Pad two arrays on the right with ``pad`` to their common longest length."""
    m = F.greatest(F.size(_c(a)), F.size(_c(b)))
    return pad_right_to(_c(a).cast("array<long>"), m, pad), pad_right_to(_c(b).cast("array<long>"), m, pad)


def trim_eos(col: str | Column, eos: int = 1) -> Column:
    """Cut at the first end id (exclusive); unchanged when absent."""
    c = _c(col)
    p = F.array_position(c, F.lit(eos))
    return F.when(p > 0, F.slice(c, 1, p - 1)).otherwise(c)


def one_hot(col: str | Column, n: int) -> Column:
    c = _c(col)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == c).cast("int"))


def zip_boxes(ymin: str | Column, xmin: str | Column, ymax: str | Column, xmax: str | Column) -> Column:
    """Four coordinate arrays to an array of (ymin, xmin, ymax, xmax) structs."""
    return F.arrays_zip(
        _c(ymin).alias("ymin"), _c(xmin).alias("xmin"), _c(ymax).alias("ymax"), _c(xmax).alias("xmax")
    )


def scale_vec(col: str | Column, kind: str, mean: float = 0.0, std: float = 1.0) -> Column:
    """Pixel scalings: 'unit' x/255, 'signed' x/127.5-1, 'standard' (x/255-mean)/std."""
    c = _c(col)
    if kind == "unit":
        return F.transform(c, lambda x: x.cast("double") / 255.0)
    if kind == "signed":
        return F.transform(c, lambda x: x.cast("double") / 127.5 - 1.0)
    if kind == "standard":
        return F.transform(c, lambda x: (x.cast("double") / 255.0 - F.lit(mean)) / F.lit(std))
    raise ValueError(kind)


def whiten(col: str | Column) -> Column:
    """Per-row mean removal and division by max(population std, 1/sqrt(n))."""
    c = _c(col)
    n = F.size(c).cast("double")

    def body(mean):
        var = F.aggregate(c, F.lit(0.0), lambda a, x: a + (x.cast("double") - mean) * (x.cast("double") - mean)) / n
        return let(
            F.greatest(F.sqrt(var), F.lit(1.0) / F.sqrt(n)),
            lambda adj: F.transform(c, lambda x: (x.cast("double") - mean) / adj),
        )

    return let(array_sum(c) / n, body)


def softmax_t(col: str | Column, t: float) -> Column:
    """exp(ln(p)/T) normalised; temperature 0 is read as 1."""
    c = _c(col)
    temp = 1.0 if t == 0 else float(t)
    e = F.transform(c, lambda p: F.exp(F.log(p.cast("double")) / F.lit(temp)))
    return let(e, lambda ev: let(F.aggregate(ev, F.lit(0.0), lambda a, x: a + x), lambda s: F.transform(ev, lambda x: x / s)))


def draw_index(probs: str | Column, u: Column) -> Column:
    """Index drawn from a probability array given a uniform ``u``: the first index whose running sum
    exceeds ``u``, else the last one.  One pass: the fold carries the sum and the index found."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("hit"))

    def step(acc, x):
        total = acc["sum"] + x.cast("double")
        return F.struct(total.alias("sum"), (acc["i"] + 1).alias("i"), F.coalesce(acc["hit"], F.when(total > u, acc["i"])).alias("hit"))

    return F.aggregate(_c(probs), start, step, lambda acc: F.coalesce(acc["hit"], acc["i"] - 1))


def uniform_md5(*cols: Column, seed: int = 0) -> Column:
    """A uniform value in [0, 1) from the md5 of the columns as text and the seed: the first 32 bits of
    the digest, the same in any engine that has md5."""
    text = F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def discounted_max(col: str | Column, beta: float) -> Column:
    """max over d of exp(-beta*d) * a[d] (d = 0-based position)."""
    c = _c(col)
    return F.array_max(F.transform(c, lambda x, d: F.exp(F.lit(-beta) * d) * x.cast("double")))


def top_k(scores: str | Column, k: int, names: Column | None = None) -> Column:
    """The ``k`` best (index, score) pairs, best first; ties by lower index."""
    c = _c(scores)
    pairs = F.transform(c, lambda x, i: F.struct((-x.cast("double")).alias("neg"), i.alias("idx")))
    best = F.slice(F.array_sort(pairs), 1, k)
    if names is None:
        return F.transform(best, lambda s: F.struct(s["idx"].alias("idx"), (-s["neg"]).alias("score")))
    return F.transform(
        best,
        lambda s: F.struct(s["idx"].alias("idx"), F.try_element_at(names, s["idx"] + 1).alias("name"), (-s["neg"]).alias("score")),
    )


def length_norm(score: str | Column, length: str | Column, alpha: float) -> Column:
    """Score divided by ((5 + len) / 6) ^ alpha (beam-search length normalisation)."""
    return _c(score) / F.pow((F.lit(5.0) + _c(length)) / 6.0, F.lit(alpha))
