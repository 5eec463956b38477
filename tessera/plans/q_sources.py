"""Queries for section A (scans and sinks): each writes test tables to a fresh folder below the
shared checkpoint directory with Spark's writers and reads them back through the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.sources import io as A
from tessera.plans.catalog import register
from tessera.session import scratch_path, table


@register("read_csv_inferred", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def q_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "part-csv")
    table(spark, sf_dir, "part").write.option("header", True).csv(path)
    df = A.read_csv(spark, path, header=True, infer=True)
    return df.select(F.col("p_partkey").cast("bigint"), "p_name", "p_brand", "p_type", F.col("p_size").cast("int"),
                     F.col("p_retailprice").cast("double"))


_EVENTS_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, props string"


@register("read_csv_quoted", "SELECT event_id, user_id, event_type, value, props FROM events")
def q_csv_quoted(spark, sf_dir):
    path = scratch_path(spark, "events-csv")
    table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props").write.option(
        "quote", "|"
    ).csv(path)
    return A.read_csv(spark, path, header=False, schema=_EVENTS_SCHEMA, quote="|")


@register(
    "read_csv_typed_defaults",
    """SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
              CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
)
def q_csv_defaults(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    c = table(spark, sf_dir, "customer")
    c.select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("c_mktsegment"),
    ).write.csv(path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return A.read_csv_defaults(spark, path, schema, {"c_acctbal": 0.0, "c_mktsegment": "unknown"}, unused=["c_name"])


def _docs_folder(spark, sf_dir):
    path = scratch_path(spark, "docs-text")
    A.write_text_files(table(spark, sf_dir, "documents"), "doc_id", "text", path)
    return path


@register("read_text_docs", "SELECT doc_id, text FROM documents")
def q_text_docs(spark, sf_dir):
    d = A.read_docs(spark, _docs_folder(spark, sf_dir), "file")
    # the text writer ends every row with one line separator
    return d.select(
        F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id"),
        F.expr("substring(text, 1, length(text) - 1)").alias("text"),
    )


@register(
    "read_text_lines",
    """SELECT doc_id, count(*) AS n_lines, sum(length(regexp_replace(line, '^\\s+|\\s+$', '', 'g'))) AS n_chars FROM (
         SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
)
def q_text_lines(spark, sf_dir):
    d = A.read_docs(spark, _docs_folder(spark, sf_dir), "lines")
    return d.groupBy(F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars")
    )


@register(
    "read_labelled_dirs",
    """SELECT class_name, CAST(row_number() OVER (ORDER BY class_name) - 1 AS BIGINT) AS class_id FROM (
         SELECT DISTINCT 'label=' || label AS class_name FROM embeddings)""",
)
def q_labelled(spark, sf_dir):
    path = scratch_path(spark, "images")
    table(spark, sf_dir, "embeddings").write.partitionBy("label").json(path)
    return A.read_labelled_dirs(spark, path, ".json").select("class_name", "class_id").distinct()


@register("read_files_base64", "SELECT page_id, strlen(html) + 1 AS n_bytes FROM pages")
def q_base64(spark, sf_dir):
    path = scratch_path(spark, "pages-text")
    A.write_text_files(table(spark, sf_dir, "pages"), "page_id", "html", path)
    b = A.read_files_base64(spark, path, "*.txt")
    return b.select(
        F.regexp_extract("filename", r"page_id=(\d+)", 1).cast("bigint").alias("page_id"),
        F.octet_length(F.unbase64("b64")).alias("n_bytes"),
    )


@register("read_json_requests", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def q_requests(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return A.parse_requests(ev, "props", "k int")


@register("write_sharded", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 4 AS INTEGER) AS shard FROM documents")
def q_sharded(spark, sf_dir):
    path = scratch_path(spark, "shards")
    out = A.write_sharded(table(spark, sf_dir, "documents").select("doc_id"), path, 4, ["doc_id"])
    return out.select("doc_id", F.col("shard").cast("int"))


def _metric_source(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("ts")
    )
    return g.select(
        F.concat(F.lit("avg_qty_"), "l_returnflag", "l_linestatus").alias("name"),
        F.when(F.col("l_returnflag") == "N", F.lit("n/a")).otherwise(F.col("avg_qty").cast("string")).alias("value"),
        "n", "ts", "l_returnflag",
    )


_METRIC_SQL = """SELECT 'avg_qty_' || l_returnflag || l_linestatus AS name, round(avg(l_quantity), 6) AS value, 'items' AS unit,
                        count(*) AS global_step, strftime(max(l_shipdate), '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp
                 FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING l_returnflag <> 'N'"""


@register("write_jsonl_metrics", _METRIC_SQL)
def q_metrics_jsonl(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    m = A.metric_rows(_metric_source(spark, sf_dir), "name", "value", "items", "n", "ts", {"flag": "l_returnflag"})
    A.write_metrics(m, path)
    back = spark.read.schema(A.METRIC_SCHEMA).json(path)
    return back.select("name", "value", "unit", "global_step", "timestamp")


@register("write_tsv_report", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_tsv(spark, sf_dir):
    path = scratch_path(spark, "nation-tsv")
    A.write_tsv(table(spark, sf_dir, "nation"), path)
    back = spark.read.option("sep", "\t").option("header", True).csv(path)
    return back.select(F.col("n_nationkey").cast("int"), "n_name", F.col("n_regionkey").cast("int"))


@register("load_metrics_table", f"SELECT name, value, 'run-1' AS run_id FROM ({_METRIC_SQL})")
def q_load_metrics(spark, sf_dir):
    log = scratch_path(spark, "metric-log")
    m = A.metric_rows(_metric_source(spark, sf_dir), "name", "value", "items", "n", "ts", {"flag": "l_returnflag"})
    lines = m.select(F.to_json(F.struct(*m.columns)).alias("value"))
    lines.unionByName(spark.range(3).select(F.lit("").alias("value"))).write.text(log)
    t = A.load_metrics(spark, log, scratch_path(spark, "metric-table"), "run-1")
    return t.select("name", "value", "run_id")


@register(
    "run_status_upsert",
    """WITH s AS (SELECT user_id, min(ts) AS ts, 'running' AS status FROM events GROUP BY user_id
                  UNION ALL
                  SELECT user_id, ts, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END FROM events
                  WHERE event_type IN ('error', 'purchase'))
       SELECT user_id, arg_max(status, ts) AS status, max(ts) AS ts FROM s GROUP BY user_id""",
)
def q_status(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    start = ev.groupBy("user_id").agg(F.min("ts").alias("ts")).withColumn("status", F.lit("running"))
    upd = ev.filter(F.col("event_type").isin("error", "purchase")).select(
        "user_id", "ts", F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status")
    )
    return A.upsert_status(start, upd, "user_id", "ts", "status").select("user_id", "status", "ts")


@register(
    "cache_or_compute",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus",
)
def q_cache(spark, sf_dir):
    path = scratch_path(spark, "cached-report")

    def compute():
        o = table(spark, sf_dir, "orders")
        return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))

    A.cache_or_compute(spark, path, compute)
    return A.cache_or_compute(spark, path, compute)


# The header of the fixed-record files (magic number 2051, then a zero word).
MAGIC = 2051
_HEADER_LEN = 8
_REC_LEN = 64


@register(
    "read_fixed_records",
    """SELECT CAST(vec_id // 4096 AS BIGINT) AS bucket, row_number() OVER (PARTITION BY vec_id // 4096 ORDER BY vec_id) - 1 AS record,
              list_transform(embedding, lambda x: round(least(greatest(floor((x::DOUBLE + 0.5) * 127), 0), 127) / 255.0, 6)) AS pixels
       FROM embeddings""",
)
def q_fixed_records(spark, sf_dir):
    """Embeddings quantised to 7-bit pixels are written as fixed-length records after an
    8-byte big-endian header (one file per block of 4096 ids, so a file never grows with the
    data; ASCII-safe bytes so Spark's text writer stores them unchanged) and read back through
    ``read_fixed_records``."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 4096).alias("bucket"), "embedding")
    px = F.transform("embedding", lambda x: F.least(F.greatest(F.floor((x.cast("double") + 0.5) * 127), F.lit(0)), F.lit(127)))
    rec = e.select("bucket", "vec_id", F.array_join(F.transform(px, lambda b: F.chr(b)), "").alias("rec"))
    files = rec.groupBy("bucket").agg(
        F.concat(
            F.lit("\u0000\u0000\u0008\u0003\u0000\u0000\u0000\u0000"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "rec"))), lambda s: s["rec"]), ""),
        ).alias("value")
    )
    path = scratch_path(spark, "fixed-records")
    files.write.partitionBy("bucket").text(path)
    # the writer ends the file with a line end; a range of 512 records is a task's
    r = A.read_fixed_records(spark, path, _REC_LEN, _HEADER_LEN, MAGIC, trailer_len=1, split_bytes=512 * _REC_LEN)
    return r.select(
        F.regexp_extract("path", r"bucket=(\d+)", 1).cast("bigint").alias("bucket"),
        "record",
        F.transform("pixels", lambda x: F.round(x, 6)).alias("pixels"),
    )
