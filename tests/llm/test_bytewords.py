"""Words in byte buffers against the pattern of words."""

import random
import re

import numpy as np
import pytest

from tessera.llm import bytewords as B


def buffers():
    r = random.Random(1)
    yield b""
    yield b" \t\n"
    yield b"one"
    for n in (5, 40, 400):
        yield b"".join(r.choice([b"a", b"bc", "é".encode(), b" ", b"\n", b"\x0b", b"  ", b"W" * 9, b"Zz"]) for _ in range(n))
    yield b"x" * 100 + b" y " + b"x" * 100 + b" " + b"x" * 32 + b" " + b"X" * 100


@pytest.mark.parametrize("part", [1 << 18, 32, 7])
def test_places_and_hashes(monkeypatch, part):
    monkeypatch.setattr(B, "PART_BYTES", part)
    for lower in (False, True):
        seen = {}
        for buffer in buffers():
            begin, end, hashes = B.words_in(buffer, lower)
            want = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", buffer)]
            assert list(zip(begin.tolist(), end.tolist(), strict=True)) == want
            for (s, e), h in zip(want, hashes.tolist(), strict=True):
                word = buffer[s:e].lower() if lower else buffer[s:e]
                assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("part", [1 << 18, 11])
def test_numbers_of_equal_words(monkeypatch, part):
    monkeypatch.setattr(B, "PART_BYTES", part)
    for buffer in buffers():
        begin, end, hashes = B.words_in(buffer)
        words = [buffer[s:e] for s, e in zip(begin.tolist(), end.tolist(), strict=True)]
        for h in (hashes, np.zeros_like(hashes), hashes & np.uint64(1)):  # also where hashes collide
            number = B.numbered(buffer, begin, end, h).tolist()
            assert len(set(zip(words, number, strict=True))) == len(set(words)) == len(set(number))
