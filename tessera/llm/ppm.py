"""Language-model scores: prediction by partial matching over bytes, beside a unigram word model.

Training counts all byte strings of up to ORDER + 1 bytes.  A byte is predicted in the longest known
context; if it is new there, the escape estimate is paid (method D: each follower of a context gives
half an occurrence to its escape) and the next shorter context predicts it, without the bytes that the
longer one has excluded.

The model grows with the corpus, so no task holds it.  Blocks of documents ship their distinct strings,
with the training counts, to buckets by the last SUFFIX bytes of the context: all longer contexts with
that end are in one bucket, and the strings of up to SUFFIX bytes are a bounded table, which is
broadcast.  A bucket adds up the counts, predicts its strings and returns their values to each block.

The unigram model needs the count of every word.  Blocks of documents ship their distinct words to
buckets by hash, each with the documents it is in; a bucket knows its words' counts, so it adds up its
share of each document's score and returns one packed row for each block.  Words frequent enough to
make a hot bucket are a bounded list, whose counts are broadcast instead.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytewords import mix
from tessera.llm.common import give_back, shared_folder, split_of, written

#: Bytes of the longest context.
ORDER = 6
#: Last bytes of a context that choose its bucket.
SUFFIX = 3
#: Characters of the texts in a block of strings, and for each bucket; strings predicted at once.
STRING_CHARS, BUCKET_CHARS, PREDICTED = 6_000_000, 8_000_000, 1 << 18
#: Bytes that a task keeps of what the blocks have sent to one bucket.
SPOOL_BYTES = 64 << 20
#: Characters of the texts that are counted, and scored, at once.
COUNT_CHARS, SCORE_CHARS = 6_000_000, 1_500_000
#: The end of a text, and what stands before it: a byte that UTF-8 doesn't use.
END = 0xFF
#: Words of a block and of a bucket; a word above this share of the corpus is frequent.
BLOCK_WORDS, BUCKET_WORDS, FREQUENT_SHARE, FREQUENT_IN_BLOCK = 1_000_000, 8_000_000, 1e-5, 8


def lowered(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def strings(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end, that byte and the ``order`` before it as one number;
    and where each text begins among them."""
    pad, end = bytes([END]) * order, bytes([END])
    raw = np.frombuffer(b"".join(itertools.chain.from_iterable((pad, t, end) for t in texts)), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(sizes + order) - sizes - order
    code = np.zeros(max(0, len(raw) - order), np.uint64)
    for k in range(order + 1):
        code <<= np.uint64(8)
        code |= raw[k : len(raw) - order + k]
    inside = np.ones(len(code) + order, bool)  # what ends in the bytes before a text doesn't count
    inside[((first + sizes)[:, None] + np.arange(order)).ravel()] = False
    return code[inside[: len(code)]], np.cumsum(sizes) - sizes


class Model:
    """Contexts and byte strings of each order with what prediction needs of them."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]):
        """tables[k]: sorted strings of k + 1 bytes and their counts; a string's shorter ends are there."""
        self.strings, self.counts, self.contexts = [], [], []
        self.total, self.kinds, self.rest, self.left = [], [], [], []
        short = lambda x: x.astype(np.float32)  # noqa: E731  after all sums and differences
        total = kinds = np.zeros(0)
        for k, (code, count) in enumerate(tables):
            context, place = np.unique(code >> np.uint64(8), return_inverse=True)
            lower_total, lower_kinds = total, kinds
            total = np.bincount(place, count, len(context))
            kinds = np.bincount(place, minlength=len(context))
            self.strings.append(code)
            self.counts.append(short(count))
            self.contexts.append(context)
            self.total.append(short(total))
            self.kinds.append(short(kinds))
            if k:  # what the next shorter context has besides the bytes of this one
                lower = code & np.uint64((1 << 8 * k) - 1)
                seen = tables[k - 1][1][np.searchsorted(self.strings[k - 1], lower)]
                parent = np.searchsorted(self.contexts[k - 1], context & np.uint64((1 << 8 * (k - 1)) - 1))
                self.rest.append(short(lower_total[parent] - np.bincount(place, seen, len(context))))
                self.left.append(short(lower_kinds[parent] - kinds))
            else:
                self.rest.append(short(np.zeros(len(context))))
                self.left.append(short(256 - kinds))

    @staticmethod
    def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Place in a sorted table, -1 if absent."""
        if not len(table):
            return np.full(len(x), -1)
        at = np.minimum(np.searchsorted(table, x), len(table) - 1)
        return np.where(table[at] == x, at, -1)

    def log10(self, code: np.ndarray) -> np.ndarray:
        """Log10 probability of the last byte of each string after the others."""
        out = np.zeros(len(code))
        todo = np.arange(len(code))
        above = np.full(len(code), -1)  # the context one byte longer, if known
        for k in range(len(self.strings) - 1, -1, -1):
            x = code[todo] & np.uint64((1 << 8 * (k + 1)) - 1)
            context = self._find(self.contexts[k], x >> np.uint64(8))
            known, v = context >= 0, above[todo]
            fresh = known & (v < 0)
            c, after = np.maximum(context, 0), np.maximum(v, 0)
            total, kinds = np.zeros(len(x)), np.zeros(len(x))
            total[fresh], kinds[fresh] = self.total[k][c[fresh]], self.kinds[k][c[fresh]]
            if k + 1 < len(self.strings):
                old = known & (v >= 0)
                total[old], kinds[old] = self.rest[k + 1][after[old]], self.left[k + 1][after[old]]
            at = np.where(known, self._find(self.strings[k], x), -1)
            hit = at >= 0
            out[todo[hit]] += np.log10((self.counts[k][at[hit]] - 0.5) / total[hit])
            miss = known & ~hit & (kinds > 0)
            out[todo[miss]] += np.log10(0.5 * kinds[miss] / total[miss])
            above[todo] = context
            todo = todo[~hit]
        if len(todo):
            none = 256.0 if not len(self.strings) or not len(self.contexts[0]) else max(float(self.left[0][0]), 1.0)
            out[todo] -= math.log10(none)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Log10 probability of each text and its end."""
        if not texts:
            return np.zeros(0)
        code, starts = strings(texts)
        kinds, place = np.unique(code, return_inverse=True)
        return np.add.reduceat(self.log10(kinds)[place], starts)


def _texts(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """Parts of batches with about ``limit`` characters, a row at least."""
    for pdf in batches:
        size = pdf["text"].map(lambda t: len(t) if t else 0).cumsum().to_numpy()
        cut = np.flatnonzero(np.diff(size // limit)) + 1
        for a, b in zip([0, *cut], [*cut, len(pdf)], strict=True):
            if b > a:
                yield pdf.iloc[a:b]


_LAST: list = [None, None]


def _model(tables: list) -> Model:
    """The model of a broadcast, built once by a worker; the tables are kept to know them again."""
    if _LAST[0] is not tables:
        _LAST[:] = tables, Model(tables)
    return _LAST[1]


def train(texts: DataFrame, entries: int | None = None, order: int = ORDER) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tables of the model from all rows of (text).  The driver gets all strings, or with ``entries``
    the most frequent ones, so many at most (and the single bytes)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _texts(batches, COUNT_CHARS):
            code, n = np.unique(strings([lowered(t) for t in pdf["text"]], order)[0], return_counts=True)
            yield pd.DataFrame({"code": code.astype(np.int64), "n": n})

    longest = texts.select("text").mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    ends = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("code").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("code")) for k in range(order + 1)]))
    every = longest.select(ends.alias("e"), "n").groupBy("e.k", "e.code").agg(F.sum("n").alias("n"))
    every = written(every, "ppm-strings")
    least = 0
    if entries is not None:
        sizes = every.groupBy(F.floor(F.log2("n") * 8).alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("n")).orderBy(F.desc("b")).collect()
        least, kept = 1 << 62, 0
        for r in sizes:
            kept += r["c"]
            if kept > entries:
                break
            least = r["n"]
    table = every.where((F.col("n") >= least) | (F.col("k") == 0)).toArrow()
    of, code, n = (table[c].to_numpy() for c in ("k", "code", "n"))
    out = []
    for k in range(order + 1):
        at = np.flatnonzero(of == k)
        at = at[np.argsort(code[at])]
        out.append((code[at].astype(np.uint64), n[at]))
    return out


# --- the whole model, in buckets ---


def _suffix_bucket(code: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each string by the last SUFFIX bytes of its context."""
    end = (code >> np.uint64(8)) & np.uint64((1 << 8 * SUFFIX) - 1)
    return (mix(end) % np.uint64(buckets)).astype(np.int64)


def _planes(a: np.ndarray) -> bytes:
    """Compressed, all first bytes before all second bytes and so on."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())


def _unplaned(x: bytes, t: type) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(t).itemsize, -1).T).view(t).ravel()


def _by_bucket(code: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Places of sorted strings in each bucket, in order."""
    to = _suffix_bucket(code, buckets)
    by = np.argsort(to, kind="stable")
    return [(int(to[g[0]]), g) for g in np.split(by, np.flatnonzero(np.diff(to[by])) + 1)] if len(by) else []


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct strings and their counts."""
    code, n = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat(n, first)


def _values(code: np.ndarray, n: np.ndarray, short: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log10 probabilities of a bucket's sorted strings (``n``: training counts, 0 for the others)."""
    known, tables = n > 0, list(short)
    for k in range(SUFFIX, ORDER + 1):
        end = code[known] & np.uint64((1 << 8 * (k + 1)) - 1)
        tables.append(_added([(end, n[known])]) if len(end) else (end, n[known]))
    model = Model(tables)
    return np.concatenate([model.log10(code[a : a + PREDICTED]) for a in range(0, len(code), PREDICTED)]).astype(np.float32)


class Spool:
    """What the blocks have sent to a bucket, kept until its values are known: in memory up to
    ``SPOOL_BYTES``, beyond that in a file of the shared folder that the cluster names."""

    def __init__(self, folder: str):
        self.folder, self.held, self.size, self.path, self.stream = folder, [], 0, None, None

    def add(self, block: int, codes: bytes) -> None:
        self.held.append((block, codes))
        self.size += len(codes)
        if self.size > SPOOL_BYTES:
            self._write()

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder)

    def _write(self) -> None:
        if self.stream is None:
            files, folder = self._files()
            files.create_dir(folder, recursive=True)
            self.path = f"{folder}/{uuid.uuid4().hex}"
            self.stream = files.open_output_stream(self.path)
        for block, codes in self.held:
            self.stream.write(np.array([block, len(codes)], np.int64).tobytes() + codes)
        self.held, self.size = [], 0

    def drain(self) -> Iterator[tuple[int, bytes]]:
        """All that was added, once; the file goes."""
        if self.stream is not None:
            self.stream.close()
            files, _ = self._files()
            with files.open_input_stream(self.path) as f:
                while head := f.read(16):
                    block, length = np.frombuffer(head, np.int64).tolist()
                    yield block, f.read(length)
            files.delete_file(self.path)
        yield from self.held
        self.held, self.stream = [], None


STRINGS = "bucket int, block long, codes binary, counts binary, rows binary, texts binary"
VALUES = "block long, bucket int, vals binary, rows binary, texts binary"


def _predicted(keyed: DataFrame, short: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> DataFrame:
    """Two kinds of rows for each block: the values of its strings of a bucket, and its documents."""
    shared = keyed.sparkSession.sparkContext.broadcast(short)
    folder = shared_folder(keyed.sparkSession, "ppm-spool")

    def ship(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        part = TaskContext.get().partitionId()
        for number, pdf in enumerate(_joined(batches, STRING_CHARS)):
            me = part * (1 << 32) + number
            low, held = [lowered(t) for t in pdf["text"]], pdf["held_out"].to_numpy(bool)
            rows = np.column_stack([np.asarray(x, np.int64) for x in (pdf["_k1"], pdf["_k2"], pdf["doc_id"], pdf["_none"], held, [len(t) for t in low])])
            out = [(me % buckets, me, None, None, rows.tobytes(), zstandard.ZstdCompressor(level=1).compress(b"".join(low)))]
            code, starts = strings(low)
            code <<= np.uint64(1)
            code |= np.repeat(held.astype(np.uint8), np.diff(starts, append=len(code)))
            code.sort()
            learnt = (code & np.uint64(1)) == 0
            code >>= np.uint64(1)
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            code, n = code[first], np.add.reduceat(learnt.astype(np.int32), first)
            for k, at in _by_bucket(code, buckets):
                out.append((k, me, _planes(np.diff(code[at], prepend=np.uint64(0))), _planes(n[at].astype(np.int32)), None, None))
            for a in range(0, len(out), 64):
                yield pd.DataFrame(out[a : a + 64], columns=[c.split()[0] for c in STRINGS.split(", ")])

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in VALUES.split(", ")]
        now, parts, size, least, spool = None, [], 0, 1 << 20, Spool(folder)

        def end() -> Iterator[pd.DataFrame]:
            code, n = _added(parts)
            value = _values(code, n, shared.value)
            for block, codes in spool.drain():
                x = np.cumsum(_unplaned(codes, np.uint64), dtype=np.uint64)
                yield pd.DataFrame([(block, now, _planes(value[np.searchsorted(code, x)]), None, None)], columns=columns)

        for pdf in batches:
            for r in pdf.itertuples():
                if r.codes is None:
                    yield pd.DataFrame([(r.block, r.bucket, None, r.rows, r.texts)], columns=columns)
                    continue
                if r.bucket != now:
                    if parts:
                        yield from end()
                    now, parts, size, least = r.bucket, [], 0, 1 << 20
                spool.add(r.block, r.codes)
                parts.append((np.cumsum(_unplaned(r.codes, np.uint64), dtype=np.uint64), _unplaned(r.counts, np.int32).astype(np.int64)))
                size += len(parts[-1][0])
                if size > least:  # the shipped counts never stay, only those of distinct strings
                    parts = [_added(parts)]
                    size = len(parts[0][0])
                    least = max(1 << 20, 2 * size)
        if parts:
            yield from end()

    sent = keyed.withColumn("_none", F.col("doc_id").isNull()).fillna(0, ["doc_id"]).mapInPandas(ship, STRINGS)
    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(predict, VALUES)


def _joined(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """Rows of one partition in blocks of about ``limit`` characters."""
    held, size = [], 0
    for pdf in _texts(batches, limit):
        held.append(pdf)
        size += int(pdf["text"].map(lambda t: len(t) if t else 0).sum())
        if size >= limit:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _block_scores(pdf: pd.DataFrame, buckets: int) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Rows (both keys, id, id is null, held out, bytes), texts and log10 probabilities of a block."""
    import zstandard

    own = pdf.loc[pdf["rows"].notna()].iloc[0]
    rows = np.frombuffer(own["rows"], np.int64).reshape(-1, 6)
    body, ends = zstandard.ZstdDecompressor().decompress(own["texts"]), np.cumsum(rows[:, 5])
    low = [body[a:b] for a, b in zip((ends - rows[:, 5]).tolist(), ends.tolist(), strict=True)]
    whole, starts = strings(low)
    code = np.sort(whole)
    code = code[np.concatenate([[True], code[1:] != code[:-1]])]
    got = {int(b): v for b, v in zip(pdf["bucket"], pdf["vals"], strict=True) if v is not None}
    value = np.empty(len(code))
    for k, at in _by_bucket(code, buckets):
        value[at] = _unplaned(got[k], np.float32)
    each = np.empty(len(whole))
    for a in range(0, len(whole), PREDICTED):
        x, place = np.unique(whole[a : a + PREDICTED], return_inverse=True)
        each[a : a + PREDICTED] = value[np.searchsorted(code, x)][place]
    return rows, low, np.add.reduceat(each, starts)


# --- the unigram model ---


def _blocks(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[tuple[list[int], list[int], np.ndarray, list[list[bytes]]]]:
    one, two, held, texts, n = [], [], [], [], 0
    for pdf in batches:
        for a, b, h, t in zip(pdf["_k1"], pdf["_k2"], pdf["held_out"], pdf["text"], strict=True):
            w = lowered(t).split()
            one.append(a)
            two.append(b)
            held.append(h)
            texts.append(w)
            n += len(w) + 1
            if n >= limit:
                yield one, two, np.array(held, bool), texts
                one, two, held, texts, n = [], [], [], [], 0
    if texts:
        yield one, two, np.array(held, bool), texts


class Counted:
    """Words of a block as numbers, with the document of each."""

    def __init__(self, texts: list[list[bytes]]):
        flat = list(itertools.chain.from_iterable(texts))
        number = {w: k for k, w in enumerate(dict.fromkeys(flat))}
        self.words = list(number)
        self.ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        self.doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def _frequent(keyed: DataFrame, block: int, share: float) -> tuple[int, int, int, list[bytes]]:
    """Words, training words, training documents, and the frequent words (1 / share at most)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, held, texts in _blocks(batches, block):
            b = Counted(texts)
            n = np.bincount(b.ids, minlength=len(b.words))
            often = np.flatnonzero(n >= FREQUENT_IN_BLOCK)
            words = [b.words[k] for k in often.tolist()]
            sizes = [int((~held[b.doc]).sum()), int((~held).sum())]
            yield pd.DataFrame({"word": [None, *words], "n": [len(b.ids), *n[often]], "train": [sizes[0]] + [0] * len(words), "docs": [sizes[1]] + [0] * len(words)})

    sums = keyed.mapInPandas(count, "word binary, n long, train long, docs long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("train").alias("train"), F.sum("docs").alias("docs"))
    sums = written(sums, "ppm-frequent")
    r = sums.where("word is null").first()
    if r is None:
        return 0, 0, 0, []
    return r["n"], r["train"], r["docs"], [bytes(x["word"]) for x in sums.where(F.col("word").isNotNull() & (F.col("n") > r["n"] * share)).select("word").collect()]


SHIPPED = "bucket int, block long, words binary, counts binary, per_word binary, docs binary, times binary, keys binary"
SHARES = "block long, word binary, c long, docs binary, sums binary, known binary, keys binary"


def _shares(keyed: DataFrame, frequent: list[bytes], buckets: int, block: int) -> DataFrame:
    """Rows of three kinds: packed shares of a block's documents, the keys of a block's documents, and
    counts of words (``word`` null: the number of distinct training words of a bucket)."""
    shared = keyed.sparkSession.sparkContext.broadcast(frozenset(frequent))

    def ship(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        import zstandard

        pack = lambda a: zstandard.ZstdCompressor(level=1).compress(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes())
        part, often = TaskContext.get().partitionId(), shared.value
        for number, (one, two, held, texts) in enumerate(_blocks(batches, block)):
            me = part * (1 << 32) + number
            b = Counted(texts)
            keys = pack(np.array([one, two], np.int64).T)
            rows = [(me % buckets, me, None, None, None, None, None, keys)]
            n = len(b.words)
            train = np.bincount(b.ids[~held[b.doc]], minlength=n).astype(np.int32)
            rare = np.fromiter((w not in often for w in b.words), bool, n)
            pair, times = np.unique(b.ids * len(texts) + b.doc, return_counts=True)
            pair, times = pair[rare[pair // len(texts)]], times[rare[pair // len(texts)]].astype(np.int32)
            word, doc = pair // len(texts), (pair % len(texts)).astype(np.int32)
            per = np.bincount(word, minlength=n).astype(np.int32)
            to = np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in b.words), np.int64, n)
            order = np.argsort(to[word], kind="stable")
            doc, times, home = doc[order], times[order], to[word][order]
            by = np.argsort(to, kind="stable")
            for group in np.split(by, np.flatnonzero(np.diff(to[by])) + 1) if n else []:
                k = int(to[group[0]])
                s, e = np.searchsorted(home, (k, k + 1))
                rows.append((k, me, pack(b"\n".join([b.words[j] for j in group.tolist()])), pack(train[group]), pack(per[group]), pack(doc[s:e]), pack(times[s:e]), None))
            for k in range(0, len(rows), 64):
                yield pd.DataFrame(rows[k : k + 64], columns=[c.split()[0] for c in SHIPPED.split(", ")])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        load = lambda x, t=np.int32: np.frombuffer(zstandard.ZstdDecompressor().decompress(x), t)
        often, out, number, parts = shared.value, [], {}, []
        for r in pdf.itertuples():
            if r.words is None:
                out.append((r.block, None, 0, None, None, None, r.keys))
                continue
            words = zstandard.ZstdDecompressor().decompress(r.words).split(b"\n")
            parts.append((r, np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))))
        c = np.zeros(len(number), np.int64)
        for r, ids in parts:
            np.add.at(c, ids, load(r.counts))
        log = np.log10(c + 0.1)
        for r, ids in parts:
            word, doc, times = np.repeat(ids, load(r.per_word)), load(r.docs), load(r.times)
            there, place = np.unique(doc, return_inverse=True)
            if len(there):
                sums = np.bincount(place, times * log[word], len(there))
                known = np.bincount(place, times * (c[word] > 0), len(there)).astype(np.int32)
                out.append((r.block, None, 0, there.astype(np.int32).tobytes(), sums.tobytes(), known.tobytes(), None))
        out.append((-1, None, int((c > 0).sum()), None, None, None, None))
        out += [(-1, w, int(c[number[w]]), None, None, None, None) for w in often if w in number]
        return pd.DataFrame(out, columns=[x.split()[0] for x in SHARES.split(", ")])

    return keyed.mapInPandas(ship, SHIPPED).groupBy("bucket").applyInPandas(add, SHARES)


def _gather(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for each document of a block from the packed shares."""
    import zstandard

    body = pdf.loc[pdf["keys"].notna(), "keys"].iloc[0]
    keys = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.int64).reshape(-1, 2)
    total, known = np.zeros(len(keys)), np.zeros(len(keys), np.int64)
    for d, s, k in zip(pdf["docs"], pdf["sums"], pdf["known"], strict=True):
        if d is not None:
            at = np.frombuffer(d, np.int32)
            total[at] += np.frombuffer(s, np.float64)
            known[at] += np.frombuffer(k, np.int32)
    return pd.DataFrame({"_k1": keys[:, 0], "_k2": keys[:, 1], "_sum": total, "_known": known})


def score_documents(docs: DataFrame, entries: int | None = None) -> DataFrame:
    """Learn from the documents whose crc32 of the id mod 10 is not 0, score all of (doc_id, text;
    other columns are ignored): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte.  A null text is empty (its one token is the end); with nothing to learn from, all
    bytes are as likely; repeated rows score alike and an empty table gives no rows.  The model has all
    strings; with ``entries`` it is the most frequent ones, broadcast."""
    text, ident = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (split_of(F.col("doc_id"), 10) == 0).alias("held_out"),
        F.xxhash64(ident, text).alias("_k1"), F.xxhash64(text, ident, F.lit(1)).alias("_k2"),
    )
    context = docs.sparkSession.sparkContext
    words, train_words, train_docs, frequent = _frequent(keyed, BLOCK_WORDS, FREQUENT_SHARE)
    shares = written(_shares(keyed, frequent, max(1, words // BUCKET_WORDS), BLOCK_WORDS), "ppm-shares")
    counts = {bytes(r["word"]): r["c"] for r in shares.where(F.col("word").isNotNull()).select("word", "c").collect()}
    distinct = (shares.where((F.col("block") == -1) & F.col("word").isNull()).agg(F.sum("c")).first()[0] or 0) + (train_docs > 0)
    tokens = train_words + train_docs
    base = math.log10(tokens + 0.1 * (distinct + 1))
    learnt = keyed.where(~F.col("held_out"))
    tables = train(learnt, entries) if entries is not None else train(learnt, order=SUFFIX - 1)
    shared = context.broadcast((counts, train_docs, tables if entries is not None else None))
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, size // BUCKET_CHARS)

    def words(low: list[bytes]) -> dict[str, list]:
        counts, train_docs, _ = shared.value
        value = {w: math.log10(c + 0.1) for w, c in counts.items()}
        known = {w for w, c in counts.items() if c}
        sums, seen, size = [], [], []
        for t in low:
            w = t.split()
            sums.append(sum([value[x] for x in w if x in value]) + math.log10(train_docs + 0.1))
            seen.append(sum([x in known for x in w]) + (train_docs > 0))
            size.append(len(w) + 1)
        return {"n_tokens": size, "_often": sums, "_seen": seen}

    def bits(p: np.ndarray, low: list[bytes]) -> np.ndarray:
        return -p / math.log10(2) / np.array([len(t) + 1 for t in low])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(shared.value[2])
        for pdf in _texts(batches, SCORE_CHARS):
            low = [lowered(t) for t in pdf["text"]]
            p = model.score(low)
            yield pdf[["doc_id", "held_out", "_k1", "_k2"]].assign(**words(low), score=p, bits_per_byte=bits(p, low))

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, low, p = _block_scores(pdf, buckets)
        ids = pd.Series(rows[:, 2]).astype("Int64").mask(rows[:, 3] == 1)
        out = pd.DataFrame({"doc_id": ids, "held_out": rows[:, 4] == 1, "_k1": rows[:, 0], "_k2": rows[:, 1]})
        return out.assign(**words(low), score=p, bits_per_byte=bits(p, low))

    schema = "doc_id long, held_out boolean, _k1 long, _k2 long, n_tokens long, _often double, _seen long, score double, bits_per_byte double"
    if entries is None:
        scored = _predicted(keyed, tables, buckets).groupBy("block").applyInPandas(whole, schema)
    else:
        scored = keyed.mapInPandas(run, schema)
    rest = shares.where("block >= 0").groupBy("block").applyInPandas(_gather, "_k1 long, _k2 long, _sum double, _known long")
    rest = rest.groupBy("_k1", "_k2").agg(F.max("_sum").alias("_sum"), F.max("_known").alias("_known"))
    return scored.join(rest, ["_k1", "_k2"], "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("_seen") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("_often") + F.coalesce("_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        "score", "bits_per_byte",
    )
