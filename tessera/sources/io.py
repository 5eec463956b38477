"""Scans and sinks (inventory section A).  Readers take declared schemas where the reference
declares them; writers go to paths on the shared file system (never machine-local folders)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.indexing import with_row_index
from tessera.sources.fixedrecords import SPLIT_BYTES, FixedRecordSource


# ---------------------------------------------------------------------------- readers
def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Avro dataset with its embedded schema (needs the spark-avro package on the classpath)."""
    return spark.read.format("avro").load(path)


def read_csv(spark: SparkSession, path: str, header: bool = True, schema: str | T.StructType | None = None,
             quote: str = '"', infer: bool = False) -> DataFrame:
    """CSV with a header and type inference, or with a declared schema and a custom quote."""
    r = spark.read.option("header", header).option("quote", quote)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", infer).csv(path)


def read_csv_defaults(spark: SparkSession, path: str, schema: str, defaults: Mapping[str, object],
                      unused: Sequence[str] = (), header: bool = False) -> DataFrame:
    """CSV with declared columns, a default for every missing field and unused columns removed."""
    df = spark.read.option("header", header).schema(schema).csv(path)
    df = df.na.fill(dict(defaults))
    return df.drop(*unused)


def _fewer_tasks(files: DataFrame) -> DataFrame:
    """Scans count a small file as 4 MB, so folders of small files become tasks of some 30 files: several
    of these are put in one task, but four tasks are left to each core."""
    parts = files.rdd.getNumPartitions()
    return files.coalesce(max(parts // 16, 4 * files.sparkSession.sparkContext.defaultParallelism, 1))


def read_docs(spark: SparkSession, path: str, mode: str = "file") -> DataFrame:
    """A folder of text files, at any depth: one row per file (path, text) or one row per stripped line."""
    deep = {"recursiveFileLookup": True}
    if mode == "file":
        return _fewer_tasks(spark.read.text(path, wholetext=True, **deep).select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
        ))
    lines = spark.read.text(path, **deep).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    lines = _fewer_tasks(lines)
    return lines.select("path", F.regexp_replace("line", r"^\s+|\s+$", "").alias("line"))


def read_labelled_dirs(spark: SparkSession, root: str, ext: str) -> DataFrame:
    """Files under root/<class>/... to (path, class_name, class_id); ids follow the sorted class
    names (the class table has one row per folder: broadcast)."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*{ext}").option("recursiveFileLookup", True).load(root)
        .select(F.col("path"))
    )
    files = files.withColumn("class_name", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1))
    classes = with_row_index(files.select("class_name").distinct(), ["class_name"], "class_id")
    return files.join(F.broadcast(classes), "class_name")


def read_files_base64(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Binary files read in parallel to (filename, base64 content)."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return _fewer_tasks(b.select(F.col("path").alias("filename"), F.col("content"))).select("filename", F.base64("content").alias("b64"))


def read_fixed_records(spark: SparkSession, path: str, rec_len: int, header_len: int, magic: int, trailer_len: int = 0,
                       split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Fixed-length binary records after a big-endian header whose first 4 bytes must equal
    ``magic``; bytes become pixels scaled to 0..1.  A file is read in ranges of about ``split_bytes``,
    without ``trailer_len`` bytes at its end; a bad magic number or a truncated record fails the job."""
    spark.dataSource.register(FixedRecordSource)
    options = {"recordBytes": rec_len, "headerBytes": header_len, "magic": magic, "trailerBytes": trailer_len, "splitBytes": split_bytes}
    return spark.read.format("fixed_records").options(**options).load(path)


def parse_requests(df: DataFrame, col: str, schema: str, explode: bool = False) -> DataFrame:
    """JSON request bodies to typed rows (``from_json`` with a declared schema); list bodies are
    exploded to one row per element."""
    parsed = df.withColumn("_req", F.from_json(F.col(col), schema))
    if explode:
        parsed = parsed.withColumn("_req", F.explode("_req"))
    return parsed.select(*[c for c in df.columns if c != col], "_req.*")


# ---------------------------------------------------------------------------- writers
def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def write_text_files(df: DataFrame, key: str, text: str, path: str) -> None:
    """One text file for each key of a partition, ``<path>/part-<n>/<key column>=<key>.txt``; each row ends
    with one line separator.  A task fills one folder and names it when it is complete, so nothing is
    left to the driver, however many files there are.  Files are written through Arrow's file systems."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        task = TaskContext.get()
        done, folder = f"{root}/part-{task.partitionId():05d}", f"{root}/_part-{task.partitionId():05d}-{task.taskAttemptId()}"
        files.create_dir(folder, recursive=True)
        count, last, out = 0, None, None
        for pdf in batches:
            for k, value in zip(pdf["key"], pdf["text"], strict=True):
                if k != last:
                    if out is not None:
                        out.close()
                    last, count = k, count + 1
                    out = files.open_output_stream(f"{folder}/{key}={k}.txt", compression=None)
                out.write((value or "").encode() + b"\n")
        if out is not None:
            out.close()
        if files.get_file_info(done).type == fs.FileType.NotFound:
            files.move(folder, done)
        yield pd.DataFrame({"files": [count]})

    # the name that a writer of partition folders gives to null
    named = F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    rows = df.select(named.alias("key"), F.col(text).alias("text")).sortWithinPartitions("key")
    rows.mapInPandas(run, "files long").agg(F.sum("files")).first()


def write_sharded(df: DataFrame, path: str, n: int, order: Sequence[str]) -> DataFrame:
    """Write rows round-robin (by ``order``) to exactly ``n`` shards, skipped when the output
    exists.  Returns the shard assignment."""
    assigned = with_row_index(df, order, "_i").withColumn("shard", (F.col("_i") % n).cast("int")).drop("_i")
    if not path_exists(df.sparkSession, path):
        assigned.repartition(n, "shard").write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.parquet(path)


def metric_rows(df: DataFrame, name: str, value: str, unit: str | None, step: str, ts: str, extras: Mapping[str, str]) -> DataFrame:
    """Metric records (name, value, unit, global_step, timestamp, extras); rows whose value is not
    a number are skipped."""
    v = F.expr(f"try_cast(`{value}` AS double)")
    return df.select(
        F.col(name).cast("string").alias("name"),
        v.alias("value"),
        F.lit(unit).cast("string").alias("unit"),
        F.col(step).cast("long").alias("global_step"),
        F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.array(*[F.struct(F.lit(k).alias("name"), F.col(c).cast("string").alias("value")) for k, c in extras.items()]).alias("extras"),
    ).filter(F.col("value").isNotNull())


def write_metrics(df: DataFrame, path: str) -> None:
    """Append metric rows as JSON lines."""
    df.write.mode("append").json(path)


def write_tsv(df: DataFrame, path: str, most: int = 1_000_000) -> None:
    """A small tab-separated report with a header (one file).  A report of more than ``most`` rows is an
    error, as one task writes it."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"the report has more than {most} rows")
    df.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


METRIC_SCHEMA = (
    "name string, value double, unit string, global_step long, timestamp string, "
    "extras array<struct<name:string,value:string>>"
)


def load_metrics(spark: SparkSession, path: str, table_path: str, run_id: str) -> DataFrame:
    """Read a JSON-lines metric log (blank lines dropped), stamp the run id and append it to a
    table stored at ``table_path``."""
    raw = spark.read.text(path).filter(F.trim("value") != "")
    rows = raw.select(F.from_json("value", METRIC_SCHEMA).alias("m")).select("m.*").withColumn("run_id", F.lit(run_id))
    rows.write.mode("append").parquet(table_path)
    return spark.read.parquet(table_path)


def upsert_status(status: DataFrame, updates: DataFrame, key: str, ts: str, col: str) -> DataFrame:
    """Run lifecycle: the latest row per run wins (insert 'running', later success or failure)."""
    u = status.unionByName(updates)
    return u.groupBy(key).agg(F.max_by(col, ts).alias(col), F.max(ts).alias(ts))


def cache_or_compute(spark: SparkSession, path: str, fn: Callable[[], DataFrame]) -> DataFrame:
    """Return the saved result when a complete one exists (Spark writes a _SUCCESS marker last),
    otherwise compute it, save it to the shared path and return the saved copy."""
    if not path_exists(spark, path.rstrip("/") + "/_SUCCESS"):
        fn().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
