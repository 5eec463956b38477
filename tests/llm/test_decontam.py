import random
from collections import Counter

import pytest

from tessera.llm import decontam as D

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("block", [1, 3, 64])
def test_wand_equals_full_scoring(block):
    r = random.Random(block)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(r.choices(vocabulary, weights=range(60, 0, -1), k=r.randrange(1, 15)))) for k in range(120)]
    index = D.Index(items, block)
    for _ in range(200):
        terms = sorted({index.term[w] for w in r.sample(vocabulary, r.randrange(1, 25)) if w in index.term})
        score = Counter()
        for t in terms:
            for d, x in zip(index.docs[t], index.weights[t], strict=True):
                score[d] += x
        for limit in (0.3, 0.7):
            want = {d: s for d, s in score.items() if s >= limit - 1e-9}
            assert dict(index.search(terms, limit)) == pytest.approx(want)


def brute(text, item):
    """Whether any stretch of the text holds three quarters of the item's 5-word shingles."""
    w, s = D.tokens(text), D.shingles(D.tokens(item))
    return len(s & D.shingles(w)) / len(s) if s else 0


def test_documents_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = Counter((r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect())
    want = Counter((d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if brute(d["text"], i["text"]) >= 0.75)
    assert want and got == want
    left = {r["doc_id"] for r in D.remove_contaminated(docs, items).collect()}
    assert left == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


ITEM = "What is the tall red house near the old river bank for? It is a quiet place to read long books."


def test_planted(spark):
    words = " ".join(f"f{k}" for k in range(900))
    for name, text, hit in [
        ("copy", f"{words} {ITEM} {words}", True),
        ("case and marks", f"{words} {ITEM.upper().replace(' ', ' ** ')} {words}", True),
        ("one word changed", f"{words} {ITEM.replace('books', 'papers')}", True),
        ("question alone", f"{words} {ITEM.split('?')[0]} {words}", False),
        ("words in another order", f"{' '.join(sorted(ITEM.split()))}", False),
        ("clean", words, False),
    ]:
        assert bool(D.Index([(1, ITEM), (2, "other words of another item entirely")]).leaks(D.tokens(text))) == hit, name


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, ITEM, 1), (2, "", 2), (3, (ITEM + " and so on ") * 2000, 3)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, ITEM), (7, ITEM), (None, ITEM), (8, None), (9, ""), (10, "?!")], "item_id long, text string")
    out = Counter((r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect())
    assert out == {(None, 7): 2, (3, 7): 2, (None, None): 1, (3, None): 1}  # an item without an id counts too
    assert D.contaminated(docs.limit(0), items).count() == 0 and D.contaminated(docs, items.limit(0)).count() == 0
    kept = D.remove_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 2]


def test_parts_of_the_index(spark, monkeypatch):
    """Parts change nothing, the BM25 shares included."""
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    found = lambda: sorted((r["doc_id"], r["item_id"], round(r["bm25"], 9), r["overlap"]) for r in D.contaminated(docs, items).collect())
    whole, left = found(), {r["doc_id"] for r in D.remove_contaminated(docs, items).collect()}
    monkeypatch.setattr(D, "PART_CHARS", 4000)
    assert found() == whole
    assert {r["doc_id"] for r in D.remove_contaminated(docs, items).collect()} == left


def test_wand_finds_what_adding_up_finds():
    r = random.Random(1)
    items = [(k, " ".join(r.choice("a b c d e f g h i j k l m n o p q r s t".split()) for _ in range(r.randrange(3, 40)))) for k in range(300)]
    index = D.Index(items)
    for _ in range(60):
        terms = sorted(r.sample(range(len(index.term)), r.randrange(1, 12)))
        for threshold in (0.2, 0.5, 0.8):
            sums = Counter()
            for t in terms:
                for d, x in zip(index.docs[t], index.weights[t], strict=True):
                    sums[d] += x
            want = {d: x for d, x in sums.items() if x >= threshold - 1e-9}
            got = dict(index.search(terms, threshold))
            assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-9 for d in got)
