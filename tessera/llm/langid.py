"""Language identification by compression.

Each language has a zstandard raw-content dictionary cut from a bounded sample of labelled texts.  A
text is encoded with every dictionary, in blocks short enough that the dictionary matters to all of
it; the language with the smallest code wins, and a narrow margin is reported as a rejection.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ident_text, ids_of, split_of

#: The sample: distinct texts a language, characters from each, bytes of the dictionary.
DOCS, CHARS, BYTES = 64, 4096, 1 << 17
#: Texts are encoded in blocks of so many bytes.
BLOCK = 2048
#: Below this share of the smallest code, the lead over the second one counts as narrow.
MARGIN = 0.01
UNKNOWN = "und"

_JUNK = re.compile(r"[\W\d_]+")
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, lang string, margin double, rejected boolean"


def normal(text: str | None) -> str:
    """Lower case, with every run of anything but letters as one space."""
    out = _JUNK.sub(" ", text.lower()).strip() if text else ""
    if out and not out.replace(" ", "").isalpha():  # numbers that are no digits
        out = " ".join("".join(c if c.isalpha() else " " for c in out).split())
    return out


def train(docs: DataFrame, docs_per_lang: int = DOCS, chars: int = CHARS, size: int = BYTES) -> dict[str, bytes]:
    """Dictionary of each non-null ``lang``: pieces of the letters of the ``docs_per_lang`` distinct texts
    with the smallest hash, each from a place that the hash gives, cut to ``size`` bytes.  Copies of a text
    count once.  The driver gets at most languages * docs_per_lang * chars characters."""
    full = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text", F.lit(11)).alias("h"))
    smallest = Window.partitionBy("lang").orderBy("h")
    drawn = full.select("lang", "h").distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= docs_per_lang)
    # so many texts of each language: a bounded list
    few = full.join(F.broadcast(drawn.drop("n")), ["lang", "h"])
    letters = few.select("lang", "h", F.trim(F.lower(F.regexp_replace("text", r"[^\p{L}]+", " "))).alias("text"))
    start = F.pmod("h", F.greatest(F.length("text") - chars + 1, F.lit(1))) + 1
    pieces = letters.select("lang", "h", F.substring("text", start, F.lit(chars)).alias("text")).groupBy("lang", "h").agg(F.min("text").alias("text"))
    by: dict[str, list[tuple[int, str]]] = {}
    for r in pieces.collect():
        by.setdefault(r["lang"], []).append((r["h"], normal(r["text"])))
    return {k: " ".join(t for _, t in sorted(v)).encode()[:size] for k, v in sorted(by.items())}


class Coder:
    """Code lengths of a text under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], block: int = BLOCK):
        import zstandard as z

        self.block = block
        params = z.ZstdCompressionParameters.from_level(3, min_match=3, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.coders = {
            k: z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=params)
            for k, d in dictionaries.items()
        }

    def sizes(self, text: str) -> list[tuple[int, str]]:
        """(bytes, language), the smallest first; ties go by name."""
        data, step = text.encode(), self.block
        blocks = [data[i : i + step] for i in range(0, len(data), step)]
        return sorted((sum(len(c.compress(b)) for b in blocks), k) for k, c in self.coders.items())

    def classify(self, text: str | None, margin: float = MARGIN) -> tuple[str, float, str, float, bool]:
        """(best language, score, language or ``und`` if rejected, margin, rejected)."""
        clean = normal(text)
        if not clean or not self.coders:
            return UNKNOWN, 0.0, UNKNOWN, 0.0, True
        sizes = self.sizes(clean)
        best, lang = sizes[0]
        lead = (sizes[1][0] - best) if len(sizes) > 1 else best
        gap = lead / max(best, 1)
        # a byte less is eight times as likely a doubling; long texts saturate
        return lang, 1.0 - 0.5 * 2.0 ** (-min(lead, 60) / 2), UNKNOWN if gap < margin else lang, gap, gap < margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """Classify every text of (doc_id, text; other columns are ignored): doc_id, held_out (crc32 of
    the id mod 3 is 1), lang_pred (the smallest code), score, lang (``und`` where rejected), margin,
    rejected.  A null text, a text without a letter and an empty set of dictionaries give ``und``
    with score 0.  The broadcast is bounded by languages * dictionary size."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(shared.value)
        for pdf in batches:
            got = [coder.classify(t, margin) for t in pdf["text"].tolist()]
            out = pd.DataFrame(got, columns=["lang_pred", "score", "lang", "margin", "rejected"])
            out.insert(0, "held_out", pdf["held_out"].to_numpy())
            out.insert(0, "doc_id", ids_of(pdf["ident"]))
            yield out

    rows = docs.select(ident_text().alias("ident"), (split_of(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return rows.mapInPandas(run, RESULT)


def identify_documents(docs: DataFrame) -> DataFrame:
    """Learn from the documents whose crc32 of the id mod 3 is not 1, classify all of them."""
    return identify(docs, train(docs.where(split_of(F.col("doc_id"), 3) != 1)))
