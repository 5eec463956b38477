"""Subword vocabularies against the small plain form: strings in dictionaries, longest first."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import subword as SW
from tessera.operators.text import RESERVED_TOKENS, escape_token


def split(vocab, token):
    pattern = re.compile("|".join(map(re.escape, sorted(vocab, key=len, reverse=True))), re.DOTALL)
    found = pattern.findall(token)
    assert sum(map(len, found)) == len(token)
    return found


def plain_round(escaped, vocab, alphabet, least, reserved):
    counts = Counter()
    for t, n in escaped:
        s = 0
        for piece in split(vocab, t):
            for e in range(s + 1, len(t) + 1):
                counts[t[s:e]] += n
            s += len(piece)
    kept = {}
    for size in range(max(map(len, counts)), 1, -1):
        for x in [x for x in counts if len(x) == size]:
            if counts[x] >= least:
                kept[x] = counts[x]
                for e in range(1, size):
                    counts[x[:e]] -= counts[x]
    for a in alphabet:
        kept[a] = counts.get(a, 0)
    order = sorted(((n, x) for x, n in kept.items() if x not in reserved), reverse=True)
    return [*reserved, *(x for _, x in order)]


def token_counts(seed):
    r = random.Random(seed)
    parts = ["an", "ana", "tion", "re", "x", "é", "_", "\\", "o", "ß9", "the"]
    words = Counter("".join(r.choice(parts) for _ in range(r.randrange(1, 5))) for _ in range(400))
    words["the"] += 500  # a hot prefix
    return sorted(words.items())


@pytest.mark.parametrize("least,reserved", [(1, []), (5, RESERVED_TOKENS), (60, RESERVED_TOKENS)])
def test_vocabulary_equals_plain_form(spark, least, reserved):
    counts = token_counts(least)
    df = spark.createDataFrame(counts, "token string, n long")
    alphabet = SW.alphabet_of(df, "token", reserved)
    escaped = [(r.t, r.n) for r in SW._escaped(df, alphabet).collect()]
    vocab = [*reserved, *alphabet]
    for _ in range(2):
        vocab = plain_round(escaped, vocab, alphabet, least, reserved)
    got = SW.subword_vocab(df, least, rounds=2, reserved=reserved).orderBy("id").collect()
    assert [r.id for r in got] == list(range(len(got)))
    assert [r.subtoken for r in got] == vocab


def test_no_rows_of_a_round_are_collected(spark, monkeypatch):
    """Collected are only the characters and one number a round."""
    df = spark.createDataFrame(token_counts(7), "token string, n long")
    sizes = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (sizes.append(len(out := collect(self))), out)[1])
    SW.subword_vocab(df, 3, rounds=1)
    assert max(sizes, default=0) <= 1


def test_search_takes_the_closest(spark):
    df = spark.createDataFrame(token_counts(3), "token string, n long")
    sizes = {c: SW.subword_vocab(df, c).count() for c in (4, 8, 16)}
    found = SW.subword_search(df, sizes[8], 1, 1, 15)
    assert found.count() == sizes[8]


def test_prefix_counts_and_round_trip(spark):
    tc = spark.createDataFrame([("abc", 5)], "token string, n long")
    alphabet = SW.alphabet_of(tc, "token", [])
    vocab = SW.vocab_frame(spark, alphabet)
    counts = {r.sub: r["count"] for r in SW._substring_counts(SW._escaped(tc, alphabet), vocab).collect()}
    assert counts == {s: 5 for s in ["a", "ab", "abc", "abc_", "b", "bc", "bc_", "c", "c_", "_"]}
    df = spark.createDataFrame([(0, "testing 123"), (1, ""), (2, None)], "k long, s string")
    voc = SW.vocab_frame(spark, ["123_", "test", "ing_"])
    enc = SW.subword_encode(df, "k", "s", voc)
    assert {r.k: r.ids for r in enc.collect()} == {0: [1, 2, 0], 1: [], 2: []}
    assert {r.k: r.text for r in SW.subword_decode(enc, "k", "ids", voc).collect()} == {0: "testing 123", 1: "", 2: ""}
    unknown = spark.createDataFrame([(0, [1, 2, 99, 0, -4])], "k long, ids array<int>")
    assert SW.subword_decode(unknown, "k", "ids", voc).first().text == "testing 123"


def test_a_token_that_cannot_be_split_fails(spark):
    df = spark.createDataFrame([(0, "tests")], "k long, s string")
    with pytest.raises(Exception, match="cannot split"):
        SW.subword_encode(df, "k", "s", SW.vocab_frame(spark, ["test", "_"])).collect()


def test_greedy_split_takes_the_longest(spark):
    tokens = spark.createDataFrame([("abcab",), ("aab",)], "t string")
    voc = SW.vocab_frame(spark, ["a", "b", "c", "ab", "abc", "abca", "bb"])
    got = {r.t: [(p.s, p.k) for p in r.pieces] for r in SW.split_tokens(tokens, voc).collect()}
    assert got == {"abcab": [(1, 4), (5, 1)], "aab": [(1, 1), (2, 2)]}
    assert spark.createDataFrame([("a\nb",)], "s string").select(escape_token("s", F.array(F.lit("a"), F.lit("b"), F.lit("\n")))).first()[0] == "a\\10;b_"


def test_plans_do_not_grow_with_tokens(spark):
    """A long token makes no longer plan, and no table of tokens is sent to every task."""
    long = "ab" * 40
    df = spark.createDataFrame([(long[:k], 5) for k in range(1, len(long) + 1)] + [("b", 9)], "sub string, count long")
    kept = SW.reduce_counts(df, 3)
    assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 12
    got = {r.sub: r["count"] for r in kept.collect()}
    assert got == {long: 5, "a": 0, "b": 9}
    voc = SW.vocab_frame(spark, ["a", "b", "ab"])
    split = SW.split_tokens(spark.createDataFrame([("abb",), ("b",)], "t string"), voc)
    assert split._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") <= 1
    assert {r.t: [p.k for p in r.pieces] for r in split.collect()} == {"abb": [2, 1], "b": [1]}


def test_entries_above_the_broadcast_bound_split_the_same(spark, monkeypatch):
    tokens = spark.createDataFrame([("abcab",), ("aab",)], "t string")
    voc = SW.vocab_frame(spark, ["a", "b", "c", "ab", "abc", "bb"])
    small = {r.t: [(p.s, p.k) for p in r.pieces] for r in SW.split_tokens(tokens, voc).collect()}
    monkeypatch.setattr(SW, "BROADCAST_ENTRIES", 2)
    assert {r.t: [(p.s, p.k) for p in r.pieces] for r in SW.split_tokens(tokens, voc).collect()} == small
