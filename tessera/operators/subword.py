"""Subword vocabularies: training, size search, encoding and decoding (inventory section J).

Training round (repeated ``rounds`` times):

1. every distinct token (with its corpus count) is escaped and split greedily against the current
   vocabulary: the substrings of a token are joined with the vocabulary, the longest entry at each place
   is kept and the walk over the places is a fold inside the row; from each split start, all substrings
   to the end of the token receive the token's count;
2. substrings below ``min_count`` are dropped.  From the longest down, a substring whose count is still
   >= ``min_count`` is kept, and what is kept of it and of its extensions is taken off its prefix of one
   character less.  (A kept string takes its count off all its prefixes; as these are prefixes of each
   other, the sums can travel one character at a time.)  Strings of four and more characters are dealt by
   their first four and walked in sorted order, which needs the open prefixes only; the three lengths
   left are an aggregate each.  So the plan is as short for long tokens as for short ones;
3. the new list is the reserved tokens, then kept substrings and every alphabet character sorted by
   (count, text) descending.

Vocabularies are tables (id, subtoken) all through; nothing of a round is collected but the length of
the vocabulary's longest entry."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.indexing import with_row_index
from tessera.operators.text import ESCAPE_CHARS, RESERVED_TOKENS, alnum_tokens, escape_token, join_tokens, let, unescape_token
from tessera.session import cut_lineage


def alphabet_of(token_counts: DataFrame, token: str = "token", reserved: Sequence[str] = RESERVED_TOKENS) -> list[str]:
    """Characters of all tokens, of the reserved tokens and of escapes, sorted (a set bounded by the
    character repertoire)."""
    fixed = "".join(reserved) + ESCAPE_CHARS
    found = token_counts.select(F.explode(F.split(F.col(token), "")).alias("c")).distinct().agg(
        F.array_sort(F.array_union(F.collect_set("c"), F.split(F.lit(fixed), ""))).alias("a")
    )
    return [c for c in found.first()["a"] if c]


def _constants(values: Sequence[str]):
    return F.array(*[F.lit(v) for v in values])


def _pieces(longest: Column, size: Column) -> Column:
    """The greedy walk over a token of ``size`` characters: ``longest`` is an array of (s, k, id), the
    entries that begin at each place; result: those (s, k, id) that the walk takes."""
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<s:int,k:int,id:int>>").alias("taken"))

    def step(acc, place):
        best = F.array_max(F.transform(F.filter(longest, lambda x: x["s"] == place), lambda x: F.struct(x["k"], x["id"])))
        stuck = F.raise_error(F.lit("cannot split a token into subtokens")).cast("int")
        moved = let(best, lambda b: F.struct(
            (place + F.coalesce(b["k"], stuck)).alias("next"),
            F.concat(acc["taken"], F.array(F.struct(place.alias("s"), b["k"].alias("k"), b["id"].alias("id")))).alias("taken"),
        ))
        return F.when(place == acc["next"], moved).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), size), start, step, lambda acc: acc["taken"])


def _substrings(tokens: DataFrame, most: int | None = None) -> DataFrame:
    """t, s (place from 1), k (length) and sub for all substrings of the distinct tokens ``t``."""
    places = tokens.select("t", F.explode(F.sequence(F.lit(1), F.length("t"))).alias("s"))
    room = F.length("t") - F.col("s") + 1
    ends = F.explode(F.sequence(F.lit(1), room if most is None else F.least(room, F.lit(most)))).alias("k")
    return places.select("t", "s", ends).select("t", "s", "k", F.substr("t", F.col("s"), F.col("k")).alias("sub"))


#: A vocabulary up to this size is sent to every task; above it, substrings travel to their entries.
BROADCAST_ENTRIES = 200_000


def split_tokens(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """t and pieces (s, k, id) of each distinct escaped token ``t``: the greedy split into entries of
    ``vocab`` (id, subtoken).  A token that can't be split is an error."""
    sizes = vocab.agg(F.max(F.length("subtoken")).alias("m"), F.count(F.lit(1)).alias("n")).first()
    entries = vocab.select(F.col("subtoken").alias("sub"), F.col("id").cast("int").alias("id"))
    entries = F.broadcast(entries) if sizes["n"] <= BROADCAST_ENTRIES else entries.hint("merge")
    # dealt by the token, so that its substrings are put together where they were cut
    dealt = tokens.select("t").repartition("t")
    found = _substrings(dealt, sizes["m"] or 1).join(entries, "sub").groupBy("t").agg(F.collect_list(F.struct("s", "k", "id")).alias("_e"))
    # tokens are as many as the text has: none of their tables may be sent to every task
    whole = dealt.join(found.hint("merge"), "t", "left")
    return whole.select("t", _pieces(F.coalesce("_e", F.array().cast("array<struct<s:int,k:int,id:int>>")), F.length("t")).alias("pieces"))


def _escaped(token_counts: DataFrame, alphabet: Sequence[str]) -> DataFrame:
    return token_counts.select(escape_token("token", _constants(alphabet)).alias("t"), "n")


def _substring_counts(escaped: DataFrame, vocab: DataFrame) -> DataFrame:
    """Count of every substring that begins where the split of a token begins an entry."""
    split = split_tokens(escaped.select("t"), vocab)
    starts = escaped.join(split.hint("merge"), "t").select("t", "n", F.explode(F.transform("pieces", lambda p: p["s"])).alias("s"))
    ends = F.explode(F.sequence(F.lit(1), F.length("t") - F.col("s") + 1)).alias("k")
    subs = starts.select("t", "n", "s", ends).select(F.substr("t", F.col("s"), F.col("k")).alias("sub"), "n")
    return subs.groupBy("sub").agg(F.sum("n").alias("count"))


#: Strings of this length and longer are decided subtree by subtree, shorter ones length by length.
SUBTREE = 4

_LEFT = "sub string, count long, taken long, kept boolean"


def _decide_subtrees(min_count: int):
    """The decisions on sorted strings of SUBTREE and more characters, all strings of a subtree in one
    partition: a walk with the open prefixes of the current string on a stack.  Yields the kept strings,
    and for the prefix above each subtree what has been taken off it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[list] = []  # string, count, taken
        out: list[tuple] = []

        def close() -> None:
            sub, count, taken = stack.pop()
            good = count - taken >= min_count
            if good:
                out.append((sub, count - taken, 0, True))
            up = count if good else taken
            if stack:
                stack[-1][2] += up
            elif up:
                out.append((sub[: SUBTREE - 1], 0, up, False))

        def frame() -> pd.DataFrame:
            rows, out[:] = list(out), []
            return pd.DataFrame(rows, columns=["sub", "count", "taken", "kept"])

        for pdf in batches:
            for sub, count in zip(pdf["sub"], pdf["count"].tolist(), strict=True):
                while stack and not sub.startswith(stack[-1][0]):
                    close()
                if stack and stack[-1][0] == sub:
                    stack[-1][1] += count
                else:
                    stack.append([sub, count, 0])
            if out:
                yield frame()
        while stack:
            close()
        if out:
            yield frame()

    return run


def reduce_counts(counts: DataFrame, min_count: int) -> DataFrame:
    """The substrings (sub, count) that are kept, with what their kept extensions leave of the count:
    sub, count, for two and more characters; and all single characters, whatever is left of them.
    ``counts`` must hold every prefix of its strings."""
    rows = cut_lineage(counts.where((F.col("count") >= min_count) | (F.length("sub") == 1)))
    size = F.length("sub")
    zero, no = F.lit(0).cast("long").alias("taken"), F.lit(False).alias("kept")
    # a subtree is one partition's, but it streams through the task in order: only open prefixes are held
    long = rows.where(size >= SUBTREE).select("sub", F.col("count").cast("long").alias("count"))
    dealt = long.repartition(F.substring("sub", 1, SUBTREE)).sortWithinPartitions("sub")
    state = cut_lineage(dealt.mapInPandas(_decide_subtrees(min_count), _LEFT))
    done = [state.where("kept").select("sub", "count")]
    state = state.where("not kept")
    for k in range(SUBTREE - 1, 0, -1):
        level = rows.where(size == k).select("sub", "count", zero, no).unionByName(state)
        sums = level.groupBy("sub").agg(F.sum("count").alias("count"), F.sum("taken").alias("taken"))
        left = F.col("count") - F.col("taken")
        if k == 1:
            done.append(sums.select("sub", left.alias("count")))
            break
        good = left >= min_count
        done.append(sums.where(good).select("sub", left.alias("count")))
        # a kept string and its extensions take its whole count off the prefix
        up = F.when(good, F.col("count")).otherwise(F.col("taken")).alias("taken")
        state = sums.select(F.substring("sub", 1, k - 1).alias("sub"), F.lit(0).cast("long").alias("count"), up, no)
    return reduce(DataFrame.unionByName, done)


def vocab_frame(spark: SparkSession, vocab: Sequence[str]) -> DataFrame:
    """A given list of subtokens as a table: the id is the position."""
    return spark.createDataFrame(list(enumerate(vocab)), "id int, subtoken string")


def subword_round(escaped: DataFrame, vocab: DataFrame, alphabet: DataFrame, min_count: int, reserved: Sequence[str]) -> DataFrame:
    spark = escaped.sparkSession
    left = reduce_counts(_substring_counts(escaped, vocab).where(F.col("count") >= 1), min_count)
    # every character of the alphabet is an entry, also those that occur nowhere
    both = left.unionByName(alphabet.select(F.col("subtoken").alias("sub"), F.lit(0).cast("long").alias("count")))
    merged = both.groupBy("sub").agg(F.sum("count").alias("count")).where(~F.col("sub").isin(list(reserved)) if reserved else F.lit(True))
    ranked = with_row_index(merged.select(F.col("sub").alias("subtoken"), "count"), [F.desc("count"), F.desc("subtoken")], "_i")
    learned = ranked.select((F.col("_i") + len(reserved)).cast("int").alias("id"), "subtoken")
    return vocab_frame(spark, reserved).unionByName(learned) if reserved else learned


def subword_vocab(token_counts: DataFrame, min_count: int, rounds: int = 4,
                  reserved: Sequence[str] = RESERVED_TOKENS) -> DataFrame:
    """Learn a subword vocabulary from (token, n) counts: id, subtoken, in the order of the list."""
    spark = token_counts.sparkSession
    characters = alphabet_of(token_counts, "token", reserved)
    escaped = cut_lineage(_escaped(token_counts.select("token", "n"), characters))
    alphabet = vocab_frame(spark, characters)
    vocab = vocab_frame(spark, [*reserved, *characters])
    for _ in range(rounds):
        vocab = cut_lineage(subword_round(escaped, vocab, alphabet, min_count, reserved))
    return vocab


def subword_search(token_counts: DataFrame, target: int, threshold: int, lo: int = 1, hi: int = 1000,
                   reserved: Sequence[str] = RESERVED_TOKENS) -> DataFrame:
    """The vocabulary within ``threshold`` of ``target`` entries, or else the closest of those tried
    while the interval of minimum counts is halved."""
    token_counts = cut_lineage(token_counts.select("token", "n"))
    tried: list[tuple[int, DataFrame]] = []
    while lo <= hi:
        count = (lo + hi) // 2
        vocab = subword_vocab(token_counts, count, reserved=reserved)
        size = vocab.count()
        tried.append((abs(size - target), vocab))
        if abs(size - target) < threshold or count < 2:
            break
        lo, hi = (count + 1, hi) if size > target else (lo, count - 1)
    return min(tried, key=lambda x: x[0])[1]


def subword_encode(df: DataFrame, key: str, text: str, vocab: DataFrame, add_eos: bool = False) -> DataFrame:
    """Text to subtoken ids: alphanumeric split, escape, greedy split of each distinct token, joined
    back by position.  A text without a token has no ids (but the end id, if asked for)."""
    characters = vocab.select(F.explode(F.split("subtoken", "")).alias("c")).distinct()
    alphabet = [r["c"] for r in characters.collect()]  # bounded by the character repertoire
    toks = df.select(key, F.posexplode_outer(alnum_tokens(text)).alias("pos", "token"))
    distinct = toks.where(F.col("token").isNotNull()).select("token").distinct()
    entries = cut_lineage(distinct.select("token", escape_token("token", _constants([c for c in alphabet if c])).alias("t")))
    split = split_tokens(entries.select("t").distinct(), vocab)
    ids = entries.join(split.hint("merge"), "t").select("token", F.transform("pieces", lambda p: p["id"]).alias("ids"))
    j = toks.join(ids.hint("merge"), "token", "left")
    parts = F.filter(F.array_sort(F.collect_list(F.struct("pos", "ids"))), lambda x: x["ids"].isNotNull())
    enc = j.groupBy(key).agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
    return enc.withColumn("ids", F.concat("ids", F.array(F.lit(1)))) if add_eos else enc


def subword_decode(df: DataFrame, key: str, ids: str, vocab: DataFrame, out: str = "text") -> DataFrame:
    """Ids back to text, one row for each value of ``key``: ids outside the vocabulary are dropped,
    subtokens joined, split on '_', each piece unescaped, tokens joined (blank only between alphanumeric
    tokens).  Null ids give the empty text."""
    each = df.select(key, F.posexplode_outer(ids).alias("_p", "id"))
    named = each.join(vocab.select("id", "subtoken"), "id", "left")
    listed = F.array_sort(F.collect_list(F.when(F.col("subtoken").isNotNull(), F.struct("_p", "subtoken"))))
    joined = named.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: x["subtoken"]), "").alias("_s"))
    parts = F.filter(F.split("_s", "_"), lambda s: s != "")
    return joined.select(key, join_tokens(F.transform(parts, unescape_token)).alias(out))
