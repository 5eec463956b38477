import struct
import zlib
from collections import Counter

import pytest

from tessera.llm import packing
from tessera.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


ODD = [
    "", " ", "  a", "a  ", "a  b", "a \n b", "\n", "don't stop", "x <|endoftext|> y", "é ñ  ü\tß", "a b c   d",
    "1234 !!! ??", "a\x1c b", "́ a ́b", "hello   world\n\nnew  line ", "词 词语 🙂 🙂🙂",
]


def ids(encoded):
    return list(struct.unpack(f"<{len(encoded) // 4}I", encoded))


def test_encoder_equals_tokenizer(tokenizer):
    enc = packing.Encoder(tokenizer_path())
    assert enc.fast is not None
    signs = [chr(c) for c in [*range(0x250), 0x300, 0x301, 0x660, 0x1680, 0x2003, 0x2028, 0x20AC, 0x3000, 0x4E00, 0xAC00, 0x1F642, 0x10FFFD]]
    for text in [*ODD, *[f"a{c}b {c} 1{c}1\n{c}{c}" for c in signs], "".join(signs), " " * 5000 + "a" * 5000]:
        assert ids(enc.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_texts_of_characters_apart_go_to_the_tokenizer(tokenizer, monkeypatch):
    enc = packing.Encoder(tokenizer_path())
    text = "some 日本 text"
    monkeypatch.setattr(enc, "_plainly", lambda t: [0] if t != text else tokenizer.encode(t, add_special_tokens=False).ids)
    assert ids(enc.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids and enc.apart == set("日本")


def test_a_file_of_another_kind_is_left_to_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    enc = packing.Encoder(path)
    assert enc.fast is None
    want = Tokenizer.from_file(path).encode("Some Words here", add_special_tokens=False).ids
    assert ids(enc.encode("Some Words here")) == want


def test_plan_uses_every_piece_once():
    hist = {700: 3, 500: 4, 324: 2, 300: 5, 200: 7, 24: 1, 1: 9, 1024: 2}
    plan = packing.plan_bins(hist)
    used = Counter()
    for take, times in plan:
        assert sum(take) <= 1024
        for n in take:
            used[n] += times
    assert used == hist
    total = sum(n * c for n, c in hist.items())
    assert sum(t for _, t in plan) <= -(-total // 1024) + 1


def test_exchange_of_smallest_for_two():
    # greedy 600 + 300 leaves 124; 300 out, 212 + 212 in fills the bin
    assert packing.plan_bins({600: 1, 300: 1, 212: 2})[0][0] == [600, 212, 212]


def test_pack_documents(spark, tokenizer):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, "x"), (1, " ", "x"), (77, "the cat sat " * 3000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    out = [r.asDict() for r in packing.pack_documents(df, tokenizer_path()).collect()]
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out[0])
    want = Counter()
    for i, t, _ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        for k, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            want[i, k, s, n, zlib.crc32(struct.pack(f"<{n}I", *ids[s : s + n]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 1024


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, tokenizer_path()).count() == 0
