"""Near-duplicate documents by one-permutation MinHash.

Documents of equal shingle sets form a class.  A class has one signature: the hash range is cut into
bins, a bin holds the smallest hash in it, and an empty bin borrows from the first occupied bin of its
own random sequence (optimal densification).  Bands of the signature are bucket keys.  Each bucket
proposes a star, its smallest member with every other, and the stars are confirmed on full sets.

A star can miss a link between two members that its centre is not linked with.  So buckets whose
members are still in different components are compared inside tasks, in blocks of bounded size, on
sets cut to 32 bits; only the pairs that may be links come out, and they are confirmed as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytewords import mix
from tessera.llm.common import give_back, ident_text, ids_of, unused, written
from tessera.llm.shingles import shingle_sets

#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair at 0.75 shares no band with a probability of about (1 - 0.75 ** ROWS) ** BANDS = 3e-7.
BANDS, ROWS = 40, 4
#: Edges that one copy of a star's centre is compared with; bytes and number of the sets in a block.
FAN, BLOCK_BYTES, BLOCK_MEMBERS = 2000, 8 << 20, 2000
#: Bits of the filter that spares documents without a candidate a second pass.
FILTER_BITS = 1 << 25

_BINS = BANDS * ROWS
_BOUNDS = np.array([(j << 64) // _BINS for j in range(_BINS)], np.uint64)
_BORROW = np.argsort(np.random.default_rng(7).random((_BINS, _BINS)), axis=1)


def bands(s: np.ndarray) -> np.ndarray:
    """Bucket keys of a sorted set of hashes."""
    at = np.searchsorted(s, _BOUNDS)
    full = np.append(at[1:], len(s)) > at
    sig = np.zeros(_BINS, np.uint64)
    sig[full] = s[at[full]]
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _BORROW[empty]
        sig[empty] = sig[order[np.arange(len(empty)), full[order].argmax(1)]]
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = mix(keys * np.uint64(31) + sig.reshape(BANDS, ROWS)[:, k])
    return keys


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _parts(pdf: pd.DataFrame, rows: int = 500) -> Iterator[pd.DataFrame]:
    for k in range(0, len(pdf), rows):
        yield pdf.iloc[k : k + rows]


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for p in _parts(pdf):
            sets = shingle_sets(p["text"].tolist())
            yield pd.DataFrame({
                "doc_id": ids_of(p["ident"]), "row": p["row"].to_numpy(), "n": [len(s) for s in sets],
                "s1": [int(np.add.reduce(s).view(np.int64)) if len(s) else 0 for s in sets],
                "s2": [int(np.add.reduce(mix(s)).view(np.int64)) if len(s) else 0 for s in sets],
                "bands": [bands(s).view(np.int64) if len(s) else None for s in sets],
            })
    give_back()


def _row_hash() -> Column:
    return F.xxhash64(ident_text(), F.coalesce("text", F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    """ident (the id as text, empty if null), text and row, the hash of both."""
    return docs.select(ident_text().alias("ident"), "text", _row_hash().alias("row"))


def _filter_of(ids: DataFrame) -> np.ndarray:
    """Bloom filter with one hash over the ids; its size does not depend on theirs."""
    span = 1 << 16

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(span, np.uint8)
        bits[pdf["p"].to_numpy() % span] = 1
        return pd.DataFrame({"k": [int(pdf["p"].iloc[0]) // span], "bits": [np.packbits(bits).tobytes()]})

    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).alias("p")
    rows = ids.select(place).distinct().groupBy(F.floor(F.col("p") / span)).applyInPandas(fill, "k long, bits binary").collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        out[r["k"] * span // 8 : (r["k"] + 1) * span // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _sets(keyed: DataFrame, need: DataFrame) -> DataFrame:
    """id, n, s1 and the set as 64-bit numbers (full) and as their upper halves (low) of the classes
    ``need`` (id, row, s1), from the one document that stands for each."""
    shared = keyed.sparkSession.sparkContext.broadcast(_filter_of(need.select(F.col("row").alias("id"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for pdf in batches:
            p = pdf["p"].to_numpy()
            may = pdf[(bits[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1].drop_duplicates("row")
            for part in _parts(may):
                sets = shingle_sets(part["text"].tolist())
                yield pd.DataFrame({"row": part["row"].to_numpy(), "n": [len(s) for s in sets], "s1": [int(np.add.reduce(s).view(np.int64)) if len(s) else 0 for s in sets], "full": [s.tobytes() for s in sets], "low": [(s >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets]})
        give_back()

    rows = keyed.select("text", "row", F.pmod(F.xxhash64("row"), F.lit(FILTER_BITS)).alias("p"))
    found = rows.mapInPandas(run, "row long, n int, s1 long, full binary, low binary")
    return found.join(need, ["row", "s1"]).dropDuplicates(["id"]).select("id", "n", "s1", "full", "low")


def confirm(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges (a, b) that are links.  Each centre's set travels once for every FAN edges, so a
    centre with many members is shared out over tasks."""
    count = edges.groupBy("a").agg(F.count(F.lit(1)).alias("c"))
    e = edges.join(count, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("c") / FAN)).alias("salt"))
    need = e.select(F.col("b").alias("id"), "a", "salt", F.lit(1).alias("member")).unionByName(
        e.select(F.col("a").alias("id"), "a", "salt", F.lit(0).alias("member")).distinct()
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        star, centres = None, []
        for pdf in batches:
            out = []
            for i, a, salt, member, full in zip(pdf["id"], pdf["a"], pdf["salt"], pdf["member"], pdf["full"], strict=True):
                s = np.frombuffer(full, np.uint64)
                if not member:
                    centres = centres + [s] if star == (a, salt) else [s]
                    star = (a, salt)
                elif any(linked(c, s) for c in centres):
                    out.append((a, i))
            yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    placed = need.join(sets.select("id", "full"), "id").repartition("a", "salt").sortWithinPartitions("a", "salt", "member")
    return placed.mapInPandas(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of the nodes of ``edges`` (a, b).

    In each round a node takes the smallest of itself and its neighbours as its label, and then the
    label's own label; the edges between labels that differ are the next round's graph, which shrinks fast.
    The labels of the rounds are applied one after the other."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    graph = written(edges.select("a", "b").unionByName(turned).where("a <> b").distinct(), "component-edges")
    rounds: list[DataFrame] = []
    while not rounds or not graph.isEmpty():
        low = written(graph.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")), "component-labels")
        # the distinct labels are looked up, not their members, as a large component is one label
        jump = low.select("l").distinct().join(low.select(F.col("a").alias("l"), F.col("l").alias("m")), "l")
        rounds.append(written(low.join(jump, "l", "left").select(F.col("a").alias("id"), F.least("l", "m").alias("label")), "component-labels"))
        left = graph.join(rounds[-1].toDF("a", "x"), "a").select("x", "b").distinct()
        right = left.join(rounds[-1].toDF("b", "y"), "b").where("x <> y")
        graph = written(right.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "component-edges")
    out = rounds[0]
    for after in rounds[1:]:
        out = out.join(after.toDF("label", "next"), "label", "left").select("id", F.coalesce("next", "label").alias("label"))
    return out.select("id", F.col("label").alias("component"))


def _blocked(members: DataFrame) -> DataFrame:
    """The members of buckets with several components, once for each pair (i, j) of blocks they are in."""
    blocks = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("c")).where("lo <> hi")
    cut = F.greatest(F.ceil(F.col("size") * 4 / BLOCK_BYTES), F.ceil(F.col("c") / BLOCK_MEMBERS)).cast("int")
    m = members.join(blocks.select("key", cut.alias("cut")), "key").withColumn("own", F.pmod(F.hash("id"), F.col("cut")))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    return m.select("key", "id", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _unlinked_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components in one bucket that may be links, from blocks of bounded size."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, comp, own = pdf["id"].to_numpy(), pdf["component"].to_numpy(), pdf["own"].to_numpy()
        sets = [np.unique(np.frombuffer(x, np.uint32)) for x in pdf["low"]]
        size = np.array([len(s) for s in sets])
        flat, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        value, place, times = np.unique(flat, return_inverse=True, return_counts=True)
        column = np.cumsum(times > 1) - 1
        use = (times > 1)[place]
        doc, column, wide = doc[use], column[place[use]], int((times > 1).sum())
        both = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        doc, column = doc[order], column[order]
        step = max(1, (16 << 20) // max(len(sets), 1))
        for lo in range(0, wide, step):
            s, e = np.searchsorted(column, (lo, lo + step))
            x = np.zeros((len(sets), min(step, wide - lo)), np.float32)
            x[doc[s:e], column[s:e] - lo] = 1
            both += x @ x.T
        apart = pdf["i"].iloc[0] != pdf["j"].iloc[0]  # pairs inside a block have their own group
        pairs = []
        for lo in range(0, len(sets), 256):
            r = slice(lo, lo + 256)
            # sets cut to 32 bits may be a few too small, so the limit is a little lower
            near = (both[r] + 2) * 100 >= PERCENT * (size[r, None] + size[None, :] - both[r] - 2)
            near &= comp[r, None] != comp[None, :]
            if apart:
                near &= own[r, None] != own[None, :]
            x, y = np.nonzero(np.triu(near, lo + 1))
            pairs.append((x + lo, y))
        a, b = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        return pd.DataFrame({"a": np.minimum(ids[a], ids[b]), "b": np.maximum(ids[a], ids[b])})

    rows = _blocked(members).join(sets.select("id", "low"), "id")
    return rows.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").where("a <> b").distinct()


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` (doc_id, row, n, s1, s2), and their classes of equal shingle sets (n, s1, s2)
    with the number of their component and its smallest doc_id, null if none has one."""
    keyed = _keyed(docs)
    rows = written(keyed.mapInPandas(_sketch, "doc_id long, row long, n long, s1 long, s2 long, bands array<long>"), "neardup-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    classes = rows.where("n > 0").groupBy("n", "s1", "s2").agg(first.alias("first"), F.first("bands").alias("bands"))
    classes = classes.select("n", "s1", "s2", F.col("first.doc_id").alias("low"), F.col("first.row").alias("row"), "bands")
    # numbered in the order of their documents, so that the centre of a star is its first document, which
    # later copies were most likely made from; written with the number, so that it stays the same
    order = [F.col("low").asc_nulls_last(), F.col("row")]
    classes = classes.repartitionByRange(*order).sortWithinPartitions(*order)
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "neardup-classes")
    keys = classes.select("id", "n", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("centre")).where("c > 1").drop("c")
    members = written(keys.join(buckets, "key"), "neardup-members")
    edges = written(members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), "neardup-edges")
    need = classes.join(members.select("id").distinct(), "id").select("id", "row", "s1")
    sets = written(_sets(keyed, need), "neardup-sets")
    links = written(confirm(edges, sets), "neardup-links")
    comp = components(links)
    held = members.select("key", "id", "n").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    more = _unlinked_pairs(held, sets).join(edges, ["a", "b"], "left_anti")
    found = written(confirm(written(more, "neardup-pairs"), sets), "neardup-links")
    if not found.isEmpty():
        comp = components(reduce(DataFrame.unionByName, [links, found]))
    # the smallest document of each component, over the classes that have a link
    linked = comp.join(classes.select("id", "low"), "id")
    lowest = linked.groupBy("component").agg(F.min("low").alias("lowest"))
    linked = linked.join(lowest, "component").select("id", "component", "lowest")
    out = classes.select("n", "s1", "s2", "id", "low").join(linked, "id", "left")
    return rows.drop("bands"), out.select("n", "s1", "s2", F.coalesce("component", "id").alias("component"), F.coalesce("lowest", "low").alias("lowest"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, text; other columns are ignored): doc_id, n_shingles,
    component_id, kept.  Null and empty texts and texts without a word have no shingle and are linked
    with nothing.  Rows of one id are documents of their own; rows without an id take the smallest id of
    their component, or none."""
    rows, classes = _classed(docs)
    out = rows.join(classes, ["n", "s1", "s2"], "left").withColumn("label", F.coalesce("lowest", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("label").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("label")).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group of near copies: the one of smallest id (null last), then
    of smallest hash of its text; of rows that are equal in id and text one stays.  Only rows that are
    linked go, also those without an id or with the id of another text; rows without a shingle stay.  All
    columns as they are."""
    rows, classes = _classed(docs.select("doc_id", "text"))
    ident = F.coalesce("doc_id", F.lit(-1)).alias("ident")
    grouped = rows.where("n > 0").join(classes, ["n", "s1", "s2"]).select("component", "doc_id", "row", ident)
    grouped = written(grouped, "neardup-grouped")
    best = grouped.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best"))
    best = written(best.select(F.col("best.row").alias("row"), F.coalesce("best.doc_id", F.lit(-1)).alias("ident")), "neardup-best")
    gone = grouped.select("row", "ident").distinct().join(best, ["row", "ident"], "left_anti")
    many = grouped.groupBy("row", "ident").agg(F.count(F.lit(1)).alias("c")).where("c > 1").join(best, ["row", "ident"], "left_semi").select("row", "ident")
    r, k = unused(docs.columns, "row", "ident")
    marked = docs.withColumns({r: _row_hash(), k: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))})
    once = marked.join(gone.unionByName(many).toDF(r, k), [r, k], "left_anti")
    twice = marked.join(many.toDF(r, k), [r, k], "left_semi").dropDuplicates([r, k])
    return once.unionByName(twice).select(*[F.col(f"`{c}`") for c in docs.columns])
