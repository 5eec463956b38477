"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A session tuned for these jobs.  On a cluster the master and the partition count come
    from the submit configuration; the settings below only switch on adaptive execution."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a folder of a shared file system; without it this raises, as
    a folder of one machine would lose what other machines write.  Only a session with a local master,
    as in tests, gets a private folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not share the driver's folders.  Once for
    an application."""
    context = spark.sparkContext
    if getattr(context, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    handle, path = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._tessera_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder (never a machine-local temp folder)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


# Tables whose rows hold free text: per-row work on them (regular expressions, tokenisers) is
# CPU-bound, so their scan must run in parallel.
TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the test tables.  A file of one row group can't be split by the partition size of
    the scan; a text table with fewer partitions than cores is dealt out by its key."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if name in TEXT_TABLES and df.rdd.getNumPartitions() < cores else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss and bounds the plan
    of iterative jobs.  ``localCheckpoint`` is deliberately not used."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
