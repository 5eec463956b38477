"""Best-two-fit packing of token sequences.

Documents are tokenised in tasks (Arrow batches), cut into pieces of at most ``capacity`` tokens and
reduced to a histogram of piece lengths.  There are only ``capacity`` lengths, so the histogram stays
small at any corpus size: the packing is planned on it, as bin patterns with a repeat count, and each
piece finds its place in the plan by its rank among the pieces of its length.  The ranks come from a
two-level numbering in parts, so no task holds all pieces of one length; full pieces need none.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import give_back, unused, written

END_ID = 2
CAPACITY = 1024
#: Groups that the numbering of the pieces is spread over.
GROUPS = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Fixed value: the pattern of byte-level pre-tokenizers.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of_signs() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer file, as little-endian 32-bit bytes.

    In such a file the merges stand in the order of the ids they make, so the vocabulary is a table of
    ranks, by which ``tiktoken`` finds the same ids faster and without a cache.  Both cut a text by the
    classes of its characters, which stand fixed up to U+024F; any other character is first tried in both,
    once a worker.  Texts with a character that they treat differently, or with an added token of the
    file, go to the tokenizer itself, and so does everything if the file is of another kind."""

    def __init__(self, path: str):
        self.path, self._tokenizer, self.fast = path, None, None
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.added = [t["content"] for t in file.get("added_tokens") or []]
        self.agreed, self.apart = set(map(chr, range(0x250))), set()
        self.fast = self._ranked(file)

    def _ranked(self, file: dict):
        import tiktoken

        model, cut = file["model"], file.get("pre_tokenizer") or {}
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
        if model.get("type") != "BPE" or file.get("normalizer") or any(model.get(x) for x in options):
            return None
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            return None
        byte, vocab = _bytes_of_signs(), model["vocab"]
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        made = [vocab.get(m, -1) for m in merges]
        if made != sorted(set(made)) or (made and made[0] < 256):
            return None
        ranks = {bytes(byte[c] for c in t): n for t, n in vocab.items() if t not in self.added}
        return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def _plainly(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _same(self, text: str) -> bool:
        """Whether both ways agree on all characters of a text."""
        signs = set(text) - self.agreed
        for c in signs - self.apart:
            probes = [f"a{c}a 1{c}1 .{c}. {c}  {c}\n{c}", c * 3]
            same = all(self.fast.encode_ordinary(p) == self._plainly(p) for p in probes)
            (self.agreed if same else self.apart).add(c)
        return not signs & self.apart

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(t in text for t in self.added) or not (text.isascii() or self._same(text)):
            return np.array(self._plainly(text), "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One a worker; it holds the vocabulary and nothing of the texts."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones but for the first, which takes the rest."""
    first = n if n <= capacity else (n % capacity or capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.  A null text is an empty one (its
    only token is the end id)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer_path)
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["ident"], pdf["text"], strict=True):
                buf = encoder.encode(text or "") + END_ID.to_bytes(4, "little")
                for k, (s, n) in enumerate(cut(len(buf) // 4, capacity)):
                    out.append((int(doc) if doc else None, k, s, n, zlib.crc32(buf[4 * s : 4 * (s + n)])))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.assign(doc_id=pd.array([x[0] for x in out], "Int64"))
        give_back()

    return docs.select(F.col("doc_id").cast("long").cast("string").alias("ident"), F.col("text")).mapInPandas(run, PIECES)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Best-two-fit on a histogram of lengths: (lengths in the bin, number of such bins).

    A bin is filled greedily with the largest length that still fits.  Then its smallest document is
    exchanged for two unpacked ones whose sum fits the expanded gap more tightly, if there are any.
    The same bin is repeated for as long as the histogram has all its lengths."""
    left = {n: c for n, c in histogram.items() if c > 0}
    lengths = sorted(left)
    plan = []
    while lengths:
        used: dict[int, int] = {}
        take: list[int] = []
        gap = capacity

        def free(n: int) -> int:
            return left[n] - used.get(n, 0)  # noqa: B023

        k = len(lengths) - 1
        while gap > 0 and k >= 0:
            k = min(k, bisect.bisect_right(lengths, gap) - 1)
            while k >= 0 and not free(lengths[k]):
                k -= 1
            if k >= 0:
                n = lengths[k]
                used[n] = used.get(n, 0) + 1
                take.append(n)
                gap -= n
        if gap > 0 and len(take) > 1:
            small = take[-1]
            room, best = gap + small, (small, 0, 0)
            for i in range(bisect.bisect_right(lengths, room) - 1, -1, -1):
                a = lengths[i]
                if 2 * a <= best[0]:
                    break
                if not free(a):
                    continue
                j = min(i, bisect.bisect_right(lengths, room - a) - 1)
                while j >= 0 and free(lengths[j]) < 1 + (j == i):
                    j -= 1
                if j >= 0 and a + lengths[j] > best[0]:
                    best = (a + lengths[j], a, lengths[j])
                    if best[0] == room:
                        break
            if best[0] > small:
                take[-1:] = best[1:]
        need: dict[int, int] = {}
        for n in take:
            need[n] = need.get(n, 0) + 1
        times = min(left[n] // c for n, c in need.items())
        plan.append((take, times))
        for n, c in need.items():
            left[n] -= times * c
        lengths = [n for n in lengths if left[n]]
    return plan


def plan_places(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): where the pieces of a length go."""
    rank: dict[int, int] = {}
    places, sequence = [], 0
    for take, times in plan:
        offset = 0
        for n in take:
            r = rank.get(n, 0)
            places.append((n, r, r + times, sequence, offset))
            rank[n] = r + times
            offset += n
        sequence += times
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length``.  Rows that are equal in all columns
    get different places; an empty table stays empty.  ``pieces`` must be a table that has been
    written, as it is read more than once.

    A full piece is a sequence by itself, with a negative number.  The others are numbered within
    their length; a frequent length is numbered in so many parts that there are about ``groups`` of them
    in all, however many rows there are."""
    spark = pieces.sparkSession
    keys = [c for c in pieces.columns if c != "length"]
    part, ahead, first, last, sequence, own, place = unused(pieces.columns, "part", "before", "from", "to", "first", "rank", "offset_")
    full = pieces.where(F.col("length") >= capacity)
    rest = pieces.where(F.col("length") < capacity)
    histogram = {r["length"]: r["n"] for r in rest.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    each = max(512, sum(histogram.values()) // groups)
    parts = spark.createDataFrame([(n, -(-c // each)) for n, c in histogram.items()], f"length long, {part} long")
    rest = rest.join(F.broadcast(parts), "length").withColumn(part, F.pmod(F.xxhash64(*keys), F.col(part)).cast("int"))
    counts = rest.groupBy("length", part).agg(F.count(F.lit(1)).alias(own))
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", part, F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias(ahead))
    places = spark.createDataFrame(plan_places(plan_bins(histogram, capacity)), f"length long, {first} long, {last} long, {sequence} long, {place} long")
    # bounds of both broadcasts: groups + capacity counts, and a few places for each length
    numbered = F.row_number().over(Window.partitionBy("length", part).orderBy(*keys))
    ranked = rest.join(F.broadcast(counts), ["length", part]).withColumn(own, F.col(ahead) + numbered - 1)
    found = ranked.join(F.broadcast(places.withColumnRenamed("length", f"{place}n")), (F.col("length") == F.col(f"{place}n")) & (F.col(own) >= F.col(first)) & (F.col(own) < F.col(last)))
    packed = found.select(*pieces.columns, (F.col(sequence) + F.col(own) - F.col(first)).alias("sequence_id"), F.col(place).alias("offset"))
    return packed.unionByName(full.select(*pieces.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack documents (doc_id, text; other columns are ignored).  One row per piece:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset.  A null text is empty; documents of
    the same id are packed each on their own; an empty table gives no rows."""
    return pack(written(tokenized_pieces(docs, tokenizer_path, capacity), "packing-pieces"), capacity)
