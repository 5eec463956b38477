import itertools
import math
from collections import Counter

import pytest

from tessera.llm import quality as Q
from tessera.llm.common import WORDS

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    w = WORDS.findall(text)
    tri = Counter(zip(w, w[1:], w[2:]))
    inside = {k + j for k, t in enumerate(zip(w, w[1:], w[2:])) if tri[t] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    n = len(w)
    return n, sum(map(len, w)), sum(text.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside), n < 50 or 100 * len(inside) > 50 * n


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_and_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = {r["doc_id"]: r for r in Q.quality_report(docs).collect()}
    assert out.keys() == texts.keys()
    for i, r in out.items():
        assert tuple(r[c] for c in COLUMNS) == brute(texts[i])
        assert 0 <= r["quality"] <= 1 and r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if not out[r["doc_id"]]["base_failed"]]
    good = [out[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1]
    bad = [out[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    assert sum(good) / len(good) >= 0.97 and sum(bad) / max(len(bad), 1) <= 0.3, (sum(good), len(good), sum(bad), len(bad))
    assert Q.keep_good(docs).count() == sum(r["kept"] for r in out.values())


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, " \t\n"), (3, "a b c a b c\n\na b c\n \na b c"), (4, "word " * 30_000), (5, "x#*|<é\x85y z"), (6, "a b")]
    df = spark.createDataFrame([(*r, True, 1) for r in rows], "doc_id long, text string, kept boolean, _f int")
    out = Counter(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in Q.quality_report(df).collect())
    assert out == Counter((i, *brute(t)) for i, t in rows)
    assert Q.quality_report(df.limit(0)).count() == 0 and Q.keep_good(df.limit(0)).dtypes == df.dtypes
    good = spark.createDataFrame([(7, "The house of the man is old and it was built for the king. " * 3 + " ".join(f"Word{k} and more." for k in range(40)), True, 5)], df.schema)
    assert [tuple(r) for r in Q.keep_good(good).select("doc_id", "kept", "_f").collect()] == [(7, True, 5)]


def em(patterns, names, rounds=60):
    """Expectation-maximisation written out over the pattern counts."""
    m = Q.initial(names)
    for _ in range(rounds):
        total, good, seen = 0.0, 0.0, Counter()
        for pat, n in patterns.items():
            odds = m["prior"] / (1 - m["prior"])
            for x, v in zip(names, pat):
                ratio = m[f"{x}|good|{v}"] / m[f"{x}|bad|{v}"]
                odds *= min(ratio, 1) if v < 0 else max(ratio, 1) if v > 0 else ratio
            p = odds / (1 + odds)
            total, good = total + n, good + n * p
            for x, v in zip(names, pat):
                seen[x, "good", v] += n * p
                seen[x, "bad", v] += n * (1 - p)
        new = {"prior": (good + 16) / (total + 20)}
        for x in names:
            for (kind, v), b in Q.BEGIN.items():
                new[f"{x}|{kind}|{v}"] = (seen[x, kind, v] + 20 * b) / ((good if kind == "good" else total - good) + 20)
        moved = max(abs(new[k] - m[k]) for k in m)
        m = new
        if moved < 1e-4:
            break
    return m


def test_em_against_brute_force(spark):
    names = ["a", "b", "c"]
    patterns = {p: 1 + 7 * k % 23 for k, p in enumerate(itertools.product((-1, 0, 1), repeat=3))}
    patterns[1, 1, 1] = 400
    patterns[-1, -1, 0] = 90
    rows = [p for p, n in patterns.items() for _ in range(n)]
    got, want = Q.fit(spark.createDataFrame(rows, names)), em(patterns, names)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-6) for k in want)


def test_native_plan(spark):
    plan = Q.quality_report(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("text", ["a b c d " * 40, "\n".join(["one line of text here"] * 30)])
def test_repetition_fails(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert Q.quality_report(df).first()["base_failed"]
