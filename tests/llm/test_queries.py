"""Registered queries over a whole table of the test data, against plain forms."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from test_fingerprints import plain as plain_fingerprints
from test_runs import plain_digest
from test_spelling import one_edit

from tessera.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_fingerprints(spark, rows):
    got = Q.op11_fingerprints(spark, SF).collect()
    assert sorted(repr(tuple(r)[:7]) for r in got) == plain_fingerprints(rows)
    by = defaultdict(set)
    texts = dict(rows)
    for r in got:
        by[texts[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(x) == 1 for x in by.values())
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.8 * len(got)


def test_runs(spark, rows):
    got = {r["doc_id"]: tuple(r) for r in Q.op12_runs(spark, SF).collect()}
    assert set(got) == {i for i, _ in rows}
    short = [(i, t) for i, t in rows if len(t) < 6000]  # the plain form is quadratic
    assert len(short) > 100 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in short)
    for i, t in short:
        assert got[i] == plain_digest(i, t)


def test_spelling(spark, rows):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode())
            k = h % len(w)
            w = w if h % 31 else w[:k] + w[k + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    holes = defaultdict(set)  # words that share what is left without a character
    for w in counts:
        holes[w].add(w)
        for k in range(len(w)):
            holes[w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and one_edit(a, b)}
    got = {r["word"]: r for r in Q.op13_spelling(spark, SF).collect()}
    assert set(got) == set(counts) and len(counts) > 1000
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
        r = got[w]
        assert (r["form"], r["n"], r["n_near"], r["form_n"]) == (form[w], n, len(near[w]), counts[form[w]] if form[w] else None)
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        assert got[w]["root"] == root
