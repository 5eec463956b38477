"""Queries for section M (streams), run with file sources and drained with availableNow
triggers, compared with their batch equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.indexing import with_group_index
from tessera.plans.catalog import register
from tessera.session import scratch_path, table
from tessera.sources import messagelog as L
from tessera.streaming import streams as M


def _messages(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), "event_id",
        F.col("props").alias("value"),
    )
    return with_group_index(ev, ["topic", "partition"], ["event_id"], "offset")


_MSG_SQL = """(SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id, props AS value,
                row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1 AS "offset" FROM events)"""


@register(
    "st_kafka_range",
    f"""SELECT topic, "partition", "offset", value, 0 AS range_idx FROM {_MSG_SQL} WHERE topic = 'click' AND "offset" BETWEEN 0 AND 4
        UNION ALL SELECT topic, "partition", "offset", value, 1 FROM {_MSG_SQL} WHERE topic = 'click' AND "offset" >= 5
        UNION ALL SELECT topic, "partition", "offset", value, 2 FROM {_MSG_SQL} WHERE topic = 'error' AND "offset" >= 0""",
)
def q_kafka_range(spark, sf_dir):
    """Events as a message log in files (segments of 256 offsets), read by ranges of offsets."""
    path = scratch_path(spark, "message-log")
    L.write_log(_messages(spark, sf_dir), path, rows=256)
    return L.read_log(spark, path, {"click": [(0, 4), (5, -1)], "error": [(0, -1)]})


@register(
    "st_kafka_restart",
    f"""SELECT topic, "partition", "offset", value, CASE WHEN "offset" < 300 THEN 1 ELSE 2 END AS run FROM {_MSG_SQL}""",
)
def q_kafka_restart(spark, sf_dir):
    """A stream over the log is drained, the log grows, and a second query with the same checkpoint goes on
    at the stored offsets: every message once."""
    path, out, ckpt = (scratch_path(spark, f"message-{x}") for x in ("grown-log", "sink", "offsets"))
    m = _messages(spark, sf_dir)
    for run, part in ((1, m.where("offset < 300")), (2, m.where("offset >= 300"))):
        L.write_log(part, path, rows=256)
        s = L.stream_log(spark, path).withColumn("run", F.lit(run))
        s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("topic", "partition", "offset", "value", "run")


@register(
    "st_repeat_batch",
    """SELECT CAST(floor(i / 5) AS BIGINT) AS batch, list(event_id ORDER BY i) AS "values" FROM (
         SELECT event_id, row_number() OVER (ORDER BY e, event_id) - 1 AS i FROM events, range(0, 3) r(e)) GROUP BY 1""",
)
def q_repeat_batch(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    return M.repeat_batch(ev, ["event_id"], 3, 5, "event_id")


@register(
    "st_score_stream",
    """SELECT event_id, to_json({'k': CAST(json_extract_string(props, '$.k') AS INTEGER),
                                 'score': CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 + value}) AS response FROM events""",
)
def q_score_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    s = M.file_stream(spark, sf_dir, "events", schema)
    return M.drain_to_parquet(M.score_stream(s, "k int"), spark, "score-stream")


@register(
    "st_running_state",
    "SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, round(sum(value * value), 2) AS total_sq FROM events GROUP BY user_id",
)
def q_running_state(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    s = M.file_stream(spark, sf_dir, "events", schema)
    out = M.drain_to_parquet(M.running_state(s, "user_id", "value"), spark, "running-state", key=["user_id"])
    return out.select("user_id", "n", F.round("total", 4).alias("total"), F.round("total_sq", 2).alias("total_sq"))


@register("st_metric_stream", "SELECT 'value' AS name, value, event_id AS global_step FROM events WHERE event_id % 100 = 0")
def q_metric_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    s = M.file_stream(spark, sf_dir, "events", schema)
    return M.drain_to_parquet(M.metric_stream(s, "event_id", "value", every_n=100), spark, "metric-stream")


# Seconds of event time between two metric rows of one event type.
_EVERY = 6 * 3600


@register(
    "st_metric_seconds",
    f"""WITH RECURSIVE first AS (SELECT event_type, min({{'ts': ts, 'id': event_id, 'value': value}}) AS e FROM events GROUP BY event_type),
        due AS (SELECT event_type, e FROM first
                UNION ALL
                SELECT d.event_type, min({{'ts': x.ts, 'id': x.event_id, 'value': x.value}}) FROM due d JOIN events x
                  ON x.event_type = d.event_type AND x.ts >= d.e.ts + INTERVAL {_EVERY} SECOND GROUP BY d.event_type)
        SELECT event_type AS name, e.value AS value, e.id AS global_step, e.ts AS "at" FROM due""",
)
def q_metric_seconds(spark, sf_dir):
    """A metric row for each event type every six hours of event time.  The stream reads events and then
    a row of a later time, which closes it."""
    path = scratch_path(spark, "metric-events")
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    ev.write.parquet(path)
    end = ev.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    end.selectExpr("cast(null as bigint) event_id", "cast(null as string) event_type", "cast(null as double) value", "ts").write.mode("append").parquet(path)
    s = spark.readStream.schema(ev.schema).parquet(path)
    rows = M.metric_stream(s, "event_id", "value", every_secs=_EVERY, ts="ts", name="event_type")
    return M.drain_to_parquet(rows, spark, "metric-seconds").withColumn("at", F.col("at").cast(ev.schema["ts"].dataType))


@register(
    "st_shuffle_batch",
    """SELECT event_id, CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 64) AS BIGINT) AS batch FROM events
       QUALIFY floor((row_number() OVER (ORDER BY event_id) - 1) / 64) < floor(count(*) OVER () / 64)""",
)
def q_shuffle_batch(spark, sf_dir):
    """Input order kept (no shuffle seed) so batches can be compared; drop the short last batch."""
    ev = table(spark, sf_dir, "events").select("event_id")
    return M.input_batches(ev, ["event_id"], 64, drop_remainder=True, seed=None)


@register("st_shuffle_batch_seeded")
def q_shuffle_batch_seeded(spark, sf_dir):
    """Seeded shuffle then batches of 64 with the remainder kept."""
    ev = table(spark, sf_dir, "events").select("event_id")
    return M.input_batches(ev, ["event_id"], 64, drop_remainder=False, seed=11)
