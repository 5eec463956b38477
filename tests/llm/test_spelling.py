"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]


def plain(counts):
    words = sorted(counts)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def vocabulary(seed, count, letters="abcdé"):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.choice([7, 7, 8, 8, 9, 10, 12, 17]))) for _ in range(count)}
    for w in sorted(words)[: count // 2]:
        k = r.randrange(len(w))
        words.add(r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1 :]]))
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "prefixed" + "a" * 3, "日本語の文字です", "日本語の文字でし", "日本語の文字でしす"}
    counts = {w: r.choice([2, 3, 20, 35, 400, 5000]) for w in sorted(words) if len(w) >= 7}
    return counts | {"zzzzzzz": 2, "zzzzzzzz": 35, "zzzzzzzzz": 5000}  # a chain of forms


@pytest.mark.parametrize("frequent,block", [(64, 1000), (2, 5), (0, 3)])
def test_variants(spark, monkeypatch, frequent, block):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    monkeypatch.setattr(spelling, "BLOCK", block)
    counts = vocabulary(frequent, 700)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling.variants(df).collect())
    assert got == plain(counts)
    assert sum(r[1] is not None for r in got) > 50 and any(r[2] not in (r[0], r[1]) for r in got)


def test_hot_list(spark, monkeypatch):
    """A third of the words share all but their last characters."""
    monkeypatch.setattr(spelling, "BLOCK", 20)
    monkeypatch.setattr(spelling, "SENT", 0)
    monkeypatch.setattr(spelling, "FREQUENT", 3)
    letters = "abcdefghij"
    counts = {f"common{x}{y}{z}": 2 + (x == y == z) * 100 for x in letters[:5] for y in letters for z in letters[:6]}
    counts |= vocabulary(9, 300)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in spelling.variants(df).collect()) == plain(counts)


def test_affected_grams_bound():
    """Near words share a list, whatever the gram dictionary is."""
    r = np.random.default_rng(5)
    words = sorted(vocabulary(5, 400))
    codes = spelling._Codes(words)
    rows = codes.size, codes.padded(), codes.padded(back=True)
    for share in (0.0, 0.3, 1.0):
        seen = set()
        for w in words:
            for q in range(2, 9):
                for p in range(len(w) - q + 1):
                    h = np.zeros(1, np.uint64)
                    for c in w[p : p + q]:
                        h = spelling._grown(h, np.array([ord(c)]))
                    seen.add(int(spelling.mix(h)[0]))
        known = np.array(sorted(x for x in sorted(seen) if r.random() < share), np.uint64)
        row, key, long = spelling.list_entries(words, (known, np.full(len(known), 9)), 7)
        lists = [set() for _ in words]
        for i, k, x in zip(row.tolist(), key.tolist(), long.tolist(), strict=True):
            lists[i].add((k, x))
        for a in range(len(words)):
            for b in range(a):
                if one_edit(words[a], words[b]):
                    assert any((k, x) in lists[b] for k, _ in lists[a] for x in (False, True)) and {k for k, _ in lists[a]} & {k for k, _ in lists[b]}
                    assert spelling.near(*rows, np.array([a]), np.array([b]))[0]


def test_documents(spark):
    r = random.Random(4)
    base = ["Straßenbahn", "government", "goverment", "Événement", "évènement", "naturel×ment", "sixsix", "aaaaaaaa", "aaaaaaa"]
    rows = [(k, " ".join(r.choice(base) + r.choice([" ", ", ", "1", "œ"]) for _ in range(r.randrange(40)))) for k in range(200)]
    rows += [(None, "government government"), (None, None), (3, ""), (4, "nothing-Nothing nothing"), (7, rows[7][1])]
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string").repartition(3)
    got = sorted(tuple(x) for x in spelling.variant_words(df).collect())
    assert got == plain({w: n for w, n in counts.items() if n >= 2})
    assert spelling.variant_words(df.limit(0)).collect() == []
