"""Bottom-k fingerprints against sets of shingles, and the edited query against a plain loop."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import fingerprints as fp


def plain_shingles(text):
    w = [x.lower() for x in text.encode().split()]
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def made(n, seed=1, size=60):
    r = random.Random(seed)
    words = ["ab", "Ça", "été", "x", "YZ", "naïve", "q r", "日本"]
    return ["".join(r.choice(words) + r.choice([" ", "\n", "  ", "\t"]) for _ in range(r.randrange(size))) for _ in range(n)]


def test_small_sets_are_exact():
    texts = [*made(40), "", " \n", "one", "one two three four", "a b c d e"]
    big = 1 << 20
    found = fp.sketches([t.encode() for t in texts], big)
    for t, s in zip(texts, found, strict=True):
        assert len(s) == len(plain_shingles(t))
        assert fp.distinct_shingles(s, big) == len(s)
    for a, x in list(zip(texts, found, strict=True))[::5]:
        for b, y in zip(texts, found, strict=True):
            p, q = plain_shingles(a), plain_shingles(b)
            assert fp.resemblance(x, y, big) == (len(p & q) / len(p | q) if p | q else 1.0)
            assert fp.containment(x, y, big) == pytest.approx(len(p & q) / len(p) if p else 1.0)


def test_parts_of_long_texts(monkeypatch):
    texts = [t.encode() for t in made(30, 2, 200)] + [b"w" * 500, b" " * 200, b"a " * 3 + b"b" * 100, b"a b c d e" * 1]
    whole = fp.sketches(texts)
    monkeypatch.setattr(fp, "PART_BYTES", 32)
    parts = fp.sketches(texts)
    assert [s.tolist() for s in whole] == [s.tolist() for s in parts]


def test_estimates_and_merging():
    r = np.random.default_rng(3)
    words = [f"w{k}" for k in r.integers(0, 10**9, 12000)]
    a, b = " ".join(words[:8000]), " ".join(words[4000:])
    x, y = fp.sketches([a.encode(), b.encode()], 1024)
    assert abs(fp.resemblance(x, y, 1024) - 1 / 3) < 0.06
    assert abs(fp.containment(x, y, 1024) - 0.5) < 0.08
    assert abs(fp.distinct_shingles(x, 1024) / 8000 - 1) < 0.12
    one, two = fp.sketches([" ".join(words[:4004]).encode(), " ".join(words[4000:8000]).encode()], 1024)
    assert fp.merge(one, two, 1024).tolist() == x.tolist()
    assert fp.decode(fp.encode(x)).tolist() == x.tolist()


def plain(rows):
    import xxhash

    def h(t):
        v = xxhash.xxh64_intdigest(t.encode(), 42)
        return v - (1 << 64) if v >> 63 else v

    docs = sorted([(i, t or "") for i, t in rows], key=lambda x: (x[0] is None, -(x[0] or 0), h(x[1]), x[1]))
    out = []
    for k, (i, t) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][1]
        half = len(t) // 2
        edit = t[: len(t) - half] + nxt[:half]
        s, e, n = fp.sketches([t.encode(), edit.encode(), nxt.encode()])
        out.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest(), fp.encode(s), fp.encode(e), fp.resemblance(s, e), fp.resemblance(s, n)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("range_bytes", [1 << 22, 2000])
def test_edited(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(fp, "RANGE_BYTES", range_bytes)
    big = (1 << 60) + 1  # not a double
    rows = [(k * 3, t) for k, t in enumerate(made(120, 4))]
    rows += [(big, "big one"), (big + 1, "big two"), (None, "no id"), (None, None), (-7, "a b"), (9, "again"), (9, "again"), (9, "other"), (12, None), (12, "")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, k int, r string").repartition(5)
    got = fp.edited_fingerprints(df).collect()
    assert sorted(repr(tuple(x)[:7]) for x in got) == plain(rows)


def test_edited_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fp.edited_fingerprints(empty).collect() == []
    one = fp.edited_fingerprints(spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["n_chars"] == 15


def test_groups_and_documents(spark):
    texts = made(60, 5, 40)
    rows = [(k, t, ["a", "b", None][k % 3], "clash") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, fingerprint string").repartition(4)
    got = {r["source"]: r for r in fp.fingerprint_groups(df, "source").collect()}
    for s in ("a", "b", None):
        want = fp.sketches([t.encode() for _, t, src, _ in rows if src == s])
        want = np.unique(np.concatenate(want))[: fp.SIZE]
        assert got[s]["fingerprint"] == fp.encode(want) and got[s]["n_docs"] == 20
    out = fp.fingerprint_documents(df)
    assert out.columns == ["doc_id", "text", "source", "fingerprint", "n_shingles"]
    assert {r["doc_id"]: r["fingerprint"] for r in out.collect()} == {k: fp.encode(fp.sketches([t.encode()])[0]) for k, t in enumerate(texts)}
