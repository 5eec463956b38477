"""Helpers shared by the corpus operators: reading, words, hash splits and written intermediates."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Words of every contract: runs of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)
#: ``bytes.lower`` semantics on text: only A-Z are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8: ``bytes.split`` splits at exactly the bytes of ``WORD``."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def give_back() -> None:
    """Return freed memory to the system at the end of a task: a worker goes on with other tasks, and
    allocators keep what the largest of them took."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ident_text() -> Column:
    """The id as text, empty if it is null: numbers beside a null would come to Python as doubles."""
    return F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))


def ids_of(idents):
    """The ids again, as a nullable column."""
    import pandas as pd

    return pd.array([int(x) if x else None for x in idents], "Int64")


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many ``_`` before it as make it differ from all columns (in any case)."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def split_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


#: Where ``written`` notes its folders while a ``noting`` block runs.
_noted: list[list[str]] = []


def _folder(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder and read it back.  The
    folder is deleted when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    hadoop, files = _folder(spark, path)
    files.deleteOnExit(hadoop)
    if _noted:
        _noted[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder below the shared checkpoint folder for files of tasks, deleted when the application
    ends."""
    path = scratch_path(spark, name)
    hadoop, files = _folder(spark, path)
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    if _noted:
        _noted[-1].append(path)
    return path


@contextlib.contextmanager
def noting() -> Iterator[list[str]]:
    """The folders that ``written`` makes inside the block, for ``discard`` once they are read."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield paths
    finally:
        _noted.pop()


def discard(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        hadoop, files = _folder(spark, path)
        files.delete(hadoop, True)


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` evaluates it once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)
