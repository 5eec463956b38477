import zlib

import pytest

from tessera.llm import langid

TRAIN = [i for i in range(9, 99) if zlib.crc32(str(i).encode()) % 3 != 1]
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def result(docs):
    return {r["doc_id"]: r for r in langid.identify_documents(docs).collect()}


def test_held_out_accuracy(docs, result):
    rows = docs.collect()
    assert len(result) == len(rows)
    hits = []
    for r in rows:
        got = result[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= got["score"] <= 1
        assert (got["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        if got["held_out"]:
            hits.append(got["lang_pred"] == r["lang"])
    assert sum(hits) / len(hits) >= 0.95


def test_equals_brute_force(docs, result):
    """Dictionaries and code lengths worked out anew."""
    import regex
    import zstandard as z

    learnt = langid.train(docs.where("crc32(cast(doc_id as string)) % 3 <> 1"))
    assert set(learnt) == {"de", "en", "es", "fr"} and all(0 < len(d) <= langid.BYTES for d in learnt.values())
    params = z.ZstdCompressionParameters.from_level(3, min_match=3, write_content_size=0, write_checksum=0, write_dict_id=0)
    for r in docs.limit(60).collect():
        data = regex.sub(r"[^\p{L}]+", " ", r["text"].lower()).strip().encode()
        sizes = {}
        for lang, d in learnt.items():
            coder = z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=params)
            sizes[lang] = sum(len(coder.compress(data[k : k + langid.BLOCK])) for k in range(0, len(data), langid.BLOCK))
        if data:
            assert result[r["doc_id"]]["lang_pred"] == min(sizes, key=lambda k: (sizes[k], k))


def test_training_ignores_held_out_rows(spark):
    rows = [(i, "alpha beta gamma", "a" if zlib.crc32(str(i).encode()) % 3 != 1 else "b") for i in range(60)]
    out = langid.identify_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r["lang_pred"] for r in out} == {"a"}


def test_only_letters_make_a_text(spark):
    rows = [(TRAIN[0], "wort und satz", "de"), (100, "² ½ ²", "x"), (101, "Ⅷ ①", "x"), (102, "12 _ 3", "x"), (103, "²a½", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df, langid.train(df.limit(1))).collect()}
    assert got == {TRAIN[0]: "de", 100: "und", 101: "und", 102: "und", 103: "de"}
    assert langid.normal("²a½ Ⅷb") == "a b"


def test_dictionary_of_distinct_texts_and_pieces(spark):
    copies = [(k, "same text again", "a") for k in range(500)]
    others = [(1000 + k, f"{'1 ' * 3000}{chr(97 + k) * 9} only here", "a") for k in range(20)]
    df = spark.createDataFrame(copies + others, "doc_id long, text string, lang string")
    d = langid.train(df, docs_per_lang=21)["a"].decode()
    assert d.count("same text again") == 1 and all(chr(97 + k) * 9 in d for k in range(20))
    long = [(1, " ".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(600)), "b")]
    piece = langid.train(spark.createDataFrame(long, "doc_id long, text string, lang string"), chars=100)["b"].decode()
    assert not piece.startswith("waa") and len(piece) <= 100


def test_odd_rows(spark):
    rows = [(0, None, "x"), (2, "", "x"), (3, "123 !!", "x"), (3, "123 !!", "x"), (None, "wort", None), (TRAIN[0], "wort und satz", "de"), (TRAIN[1], "le mot " * 9000, "fr")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    out = langid.identify_documents(df).collect()
    assert len(out) == len(rows)
    assert sorted(r["lang_pred"] == "und" for r in out) == [False] * 3 + [True] * 4
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.identify_documents(empty).count() == 0


def test_narrow_margin_is_rejected():
    coder = langid.Coder({"a": b"the same words", "b": b"the same words"})
    lang, score, shown, margin, rejected = coder.classify("the same words")
    assert (lang, shown, rejected) == ("a", "und", True) and score == 0.5
