import random
import zlib

import pytest

from tessera.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_fold():
    assert T.fold("You 1D10T, m0r0n!") == " you idiot moron "
    assert T.fold("іdіоt scum*** ｌｏｓｅｒ wo​rd") == " idiot scum loser word "
    assert T.fold("w0rthle55 $tupid tr4$h 1999 3") == " worthless stupid trash "
    assert T.fold("äß Éa$$$ the&&&") == " äß éa the "
    assert T.fold(None) == T.fold("") == " "


def test_matcher_against_brute_force():
    m = T.Matcher({" idiot ": 3.0, " lowei": 2.0, " trash ": 1.0})
    plain = lambda t: sum(3.0 * (w == "idiot") + 2.0 * w.startswith("lowei") + (w == "trash") for w in t.split())
    for t in ("idiot idiot", "loweisch und idiotic", "a trash heap", "", "idiot loweix trash lowe"):
        f = T.fold(t)
        assert m.mass(f) * T.math.log2(2 + f.count(" ")) == pytest.approx(plain(t))
    assert m.mass(T.fold("a trash can here")) == 0
    assert m.mass(T.fold("a trash can, trash")) > 0


def test_choose_prefers_stem_of_a_family():
    counts = [(" lowe", 30, 0), (" lowei", 30, 0), (" loweix", 3, 0), (" loweix ", 3, 0), (" rude", 20, 0), (" rude ", 20, 0), (" the ", 30, 900)]
    got = T.choose(counts, 60, 1000)
    assert " lowei" in got and " rude " in got
    assert not {" lowe", " loweix", " loweix ", " rude", " the "} & set(got)


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = {r["doc_id"]: r for r in T.score_documents(docs, labels).collect()}
    assert len(out) == docs.count()
    tp = fp = fn = 0
    for r in labels.collect():
        got = out[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert got["predicted"] == int(got["score"] >= 0.5)
        if got["held_out"]:
            tp += got["predicted"] and r["toxic"]
            fp += got["predicted"] and not r["toxic"]
            fn += r["toxic"] and not got["predicted"]
    assert tp / (tp + fn) >= 0.8 and tp / (tp + fp) >= 0.95, (tp, fp, fn)  # 340 toxic texts to learn from


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (1, None, 9), (None, "scum", 9), (2, "", 9), (3, "you IDI0T " * 9000, 9)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, 1, None), (1, 1, 0), (None, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    out = T.score_documents(docs, labels).collect()
    assert len(out) == 5 and {r["predicted"] for r in out if r["doc_id"] == 3} == {1}
    assert {r["predicted"] for r in out if r["doc_id"] in (1, 2)} == {0}
    assert T.score_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_small_sample_scores_like_a_large_one(spark):
    r = random.Random(5)
    word = lambda: f"{r.choice('bcdfg')}a{r.choice('lmnpr')}o{r.choice('stvwz')}{r.choice('aeiou')}"
    rows = []
    for i in range(4400):  # ten clean ones for a toxic one, hits in some of both
        toxic = int(i % 11 == 0)
        words = [word() for _ in range(r.choice([15, 30, 60]))] + ["idiot"] * (r.random() < (0.8 if toxic else 0.1))
        rows += [(i, " ".join(words), toxic)]
    rows += [(10_000 + k, rows[1][1], 0) for k in range(600)]  # copies count once, however many are drawn
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    of = lambda curve, x: 1 / (1 + T.math.exp(-curve[0] - curve[1] * x))
    (terms, small), (_, large) = T.train(df, df, sample=400), T.train(df, df)
    weak = T.Matcher(terms).mass(" " + "word " * 30 + "idiot ")
    for x in (0.0, weak / 2, weak):
        assert of(small, x) == pytest.approx(of(large, x), abs=0.12), (x, small, large)
    assert abs(small[0] - large[0]) < 0.7  # 2.3 if the classes of the sample count alike


def naive_mass(folded, lexicon, exceptions=T.EXCEPTIONS):
    exempt = [(k, k + len(p) + 1) for p in exceptions for k in range(len(folded)) if folded.startswith(f" {p} ", k)]
    total = 0.0
    for k in range(len(folded)):
        found = [w for t, w in lexicon.items() if folded.startswith(t, k)]
        if found and not any(a <= k < b for a, b in exempt):
            total += max(found)
    return total / T.math.log2(2 + folded.count(" "))


def test_mass_against_naive_search():
    r = random.Random(2)
    lexicon = {" trash ": 2.0, " tra": 1.0, " clown ": 3.0, " scum ": 1.5, " id": 0.5, " idiot ": 2.5}
    words = ["trash", "can", "bin", "clown", "fish", "pond", "scum", "idiot", "idle", "class", "costume", "x"]
    matcher = T.Matcher(lexicon)
    for _ in range(300):
        folded = T.fold(" ".join(r.choice(words) for _ in range(r.randrange(30))))
        assert matcher.mass(folded) == pytest.approx(naive_mass(folded, lexicon))


def test_long_texts_of_hits_and_exceptions_take_linear_time():
    import time

    matcher = T.Matcher({" trash ": 2.0})
    folded = T.fold("trash can trash " * 11_000)
    began = time.process_time()
    assert matcher.mass(folded) > 0 and len(folded) > 176_000
    assert time.process_time() - began < 0.5


def test_scores_are_the_curve_of_the_masses(spark):
    """The score of every text by naive search; the curve is where the likelihood of the labels is greatest."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    learn = lambda df: df.where("crc32(cast(doc_id as string)) % 5 <> 0")
    lexicon, (a, b) = T.train(learn(docs), learn(labels))
    out = {r["doc_id"]: r["score"] for r in T.score_documents(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, t in texts.items():
        assert out[i] == pytest.approx(1 / (1 + T.math.exp(-a - b * naive_mass(T.fold(t), lexicon))), rel=1e-9)
    by = {}
    for r in learn(labels).collect():
        if r["toxic"] is not None and r["doc_id"] in texts:
            by[texts[r["doc_id"]]] = max(r["toxic"], by.get(texts[r["doc_id"]], 0))
    x, y = [T.Matcher(lexicon).mass(T.fold(t)) for t in by], list(by.values())
    left = [1 / (1 + T.math.exp(-a - b * v)) - w for v, w in zip(x, y, strict=True)]
    assert abs(sum(left) + 1e-2 * a) < 1e-5 and abs(sum(v * e for v, e in zip(x, left, strict=True)) + 1e-2 * b) < 1e-5
