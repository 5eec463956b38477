import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import ppm as P
from tessera.llm.common import words_of

SF = "/root/testdata/sf0.01"


def plain_tables(texts, order):
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        x = bytes([255]) * order + t + b"\xff"
        for e in range(order, len(x)):
            for k in range(order + 1):
                grams[k][x[e - k : e + 1]] += 1
    return grams


def plain_log10(grams, context, byte):
    """Prediction by partial matching, method D with exclusion, one byte."""
    followers = [defaultdict(dict) for _ in grams]
    for k, g in enumerate(grams):
        for s, n in g.items():
            followers[k][s[:-1]][s[-1]] = n
    excluded, log = set(), 0.0
    for k in range(len(grams) - 1, -1, -1):
        seen = followers[k].get(context[len(context) - k :])
        if seen is None:
            continue
        left = {s: n for s, n in seen.items() if s not in excluded}
        total = sum(left.values())
        if byte in left:
            return log + math.log10((left[byte] - 0.5) / total)
        if left:
            log += math.log10(len(left) / 2 / total)
        excluded |= seen.keys()
    return log - math.log10(256 - len(excluded))


def model_of(grams):
    tables = []
    for g in grams:
        code = np.array([int.from_bytes(s, "big") for s in g], np.uint64)
        by = np.argsort(code)
        tables.append((code[by], np.array(list(g.values()))[by]))
    return P.Model(tables)


@pytest.mark.parametrize("least", [1, 3])
def test_prediction_against_plain_form(least):
    r = random.Random(least)
    texts = ["".join(r.choices("abcde é", k=r.randrange(30))).encode() for _ in range(60)]
    grams = [Counter({s: n for s, n in g.items() if n >= least or len(s) == 1}) for g in plain_tables(texts, P.ORDER)]
    model = model_of(grams)
    for _ in range(30):
        context = bytes(r.choices(b"abcdex\xff", k=P.ORDER))
        code = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        got = model.log10(code)
        assert (10.0**got).sum() == pytest.approx(1.0)  # a probability distribution
        assert got[[97, 120, 255]] == pytest.approx([plain_log10(grams, context, s) for s in (97, 120, 255)])


def test_strings():
    code, starts = P.strings([b"ab", b"", b"c"], 2)
    assert [int(x).to_bytes(3, "big") for x in code] == [b"\xff\xffa", b"\xffab", b"ab\xff", b"\xff\xff\xff", b"\xff\xffc", b"\xffc\xff"]
    assert starts.tolist() == [0, 3, 4]


def brute(rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    tokens = lambda t: [*words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), None]
    train = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((i, held(i), len(w), sum(train[x] > 0 for x in w), n, base))
    return out


def order(x):
    return (x[0] is None, x[0], x[2], x[5])


@pytest.mark.parametrize("block,bucket,share", [(1_000_000, 8_000_000, 1e-5), (900, 700, 1e-3)])
def test_base_score_against_brute_force(spark, monkeypatch, block, bucket, share):
    for name, v in (("BLOCK_WORDS", block), ("BUCKET_WORDS", bucket), ("FREQUENT_SHARE", share)):
        monkeypatch.setattr(P, name, v)
    r = random.Random(4)
    rows = [(i, " ".join(r.choices(["The", "the", "é", *(f"w{r.randrange(500)}" for _ in range(9))], k=r.randrange(60)))) for i in range(150)]
    rows += [(7, rows[7][1]), (None, "The end"), (None, None), (500, None), (501, ""), (502, "\t"), (503, "long text " * 9000)]
    df = spark.createDataFrame([(*x, 0.0, "z") for x in rows], "doc_id long, text string, score double, word string").repartition(3)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in P.score_documents(df).collect()), key=order)
    for a, b in zip(got, sorted(brute(rows), key=order), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])


def test_scores_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    out = {r["doc_id"]: r for r in P.score_documents(docs, entries=1 << 21).collect()}
    train = [P.lowered(t) for i, t in rows if not out[i]["held_out"]]
    tables = []
    for k in range(P.ORDER + 1):
        code, n = np.unique(np.concatenate([P.strings([t])[0] for t in train]) & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True)
        tables.append((code, n))
    assert sum(len(c) for c, _ in tables) <= 1 << 21
    for i, t in rows[:40]:
        assert out[i]["score"] == pytest.approx(P.Model(tables).score([P.lowered(t)])[0])
    held = [r for r in out.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # better than the words alone
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 3


def test_few_entries_and_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abab abab"), (2, "abab")], "doc_id long, text string")
    out = P.score_documents(df, entries=3).collect()
    assert all(math.isfinite(r["score"]) for r in out)
    held = [i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    got = P.score_documents(spark.createDataFrame([(held[0], "ab"), (held[1], None)], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx({held[0]: -3 * math.log10(256), held[1]: -math.log10(256)})
    assert all(r["base_score"] == pytest.approx(0) and r["n_known"] == 0 for r in got)
    assert P.score_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("block,bucket", [(6_000_000, 16_000_000), (900, 700)])
def test_whole_model_in_buckets(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(P, "STRING_CHARS", block)
    monkeypatch.setattr(P, "BUCKET_CHARS", bucket)
    r = random.Random(8)
    rows = [(i, "".join(r.choices(["The ", "of", "é", "x", "\n", "aba", "rest "], k=r.randrange(40)))) for i in range(150)]
    rows += [(7, rows[7][1]), (None, "The end"), (None, None), (500, None), (501, "")]
    out = P.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    model = model_of(plain_tables([P.lowered(t) for i, t in rows if not held(i)], P.ORDER))
    want = sorted(((i is None, i or 0, held(i), float(model.score([P.lowered(t)])[0])) for i, t in rows))
    got = sorted((x["doc_id"] is None, x["doc_id"] or 0, x["held_out"], x["score"]) for x in out)
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3])


def test_default_model_has_every_string(spark):
    # 1,243,709 strings at sf0.01: more than a model of 2^20 entries holds
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    out = {r["doc_id"]: r for r in P.score_documents(docs).collect()}
    code, _ = P.strings([P.lowered(t) for i, t in rows if not out[i]["held_out"]])
    tables = [np.unique(code & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True) for k in range(P.ORDER + 1)]
    assert sum(len(c) for c, _ in tables) > 1 << 20
    model = P.Model(tables)
    for i, t in rows:
        assert out[i]["score"] == pytest.approx(model.score([P.lowered(t)])[0])


def test_spool_in_memory_and_in_the_shared_folder(tmp_path, monkeypatch):
    for limit in (1 << 20, 10):
        monkeypatch.setattr(P, "SPOOL_BYTES", limit)
        spool = P.Spool(f"file://{tmp_path}/spool-{limit}")
        sent = [(k, bytes([k]) * (k % 7)) for k in range(40)]
        for _ in range(2):  # one bucket after the other
            for block, codes in sent:
                spool.add(block, codes)
            assert sorted(spool.drain()) == sorted(sent)
        folder = tmp_path / f"spool-{limit}"
        assert not folder.exists() or not list(folder.iterdir())
