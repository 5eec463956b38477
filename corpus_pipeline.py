"""From raw documents to packed training sequences: quality rules, near-duplicates, repeated passages,
benchmark decontamination, packing.  Each stage works on all that the one before it has kept."""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, neardup, packing, quality, substring
from tessera.llm.common import discard, documents, noting, written
from tessera.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return neardup.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a repeated window are cut out; documents left without a word go."""
    out = substring.remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


#: Rows of a batch that goes to a Python worker.
BATCH_ROWS = 1000


class _Intermediate(threading.local):
    """Folders of the tables that the last stage of this thread has read its result from."""

    def __init__(self) -> None:
        self.folders: list[str] = []


_last = _Intermediate()


def _stage(function, first: bool = False):
    """A stage that begins by deleting the intermediate tables of the stage before it in this thread,
    whose result has been written by then; the first one has none before it.  Those of the last stage stay
    until the application ends, as its result is read from them."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # rows hold whole texts: the default of 10,000 rows a batch takes far more memory than it saves time
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        if not first:
            discard(spark, _last.folders)
        with noting() as paths:
            out = function(spark, docs, sf_dir)
        _last.folders = paths
        return out

    return run_stage


STAGES = [
    ("quality_rules", _stage(quality_rules, first=True)),
    ("near_duplicates", _stage(near_duplicates)),
    ("repeated_passages", _stage(repeated_passages)),
    ("decontamination", _stage(decontamination)),
    ("packing", _stage(packed)),
]

#: No statement: expectation-maximisation and packing have no SQL form (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
