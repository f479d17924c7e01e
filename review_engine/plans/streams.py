"""Streams over the driver tables, run until their input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_engine.plans.registry import query
from review_engine.plans.tables import table
from review_engine.session import shared_path
from review_engine.streaming import dedup, ingest, trend


def event_stream(spark: SparkSession, folder: str, file_column: str | None = None) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return ingest.read_parquet_stream(spark, folder, schema, "events.parquet", file_column=file_column)


def finish(query_) -> None:
    query_.awaitTermination()
    if query_.exception():
        raise query_.exception()


EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value")


@query("stream_incremental_ingest", f"SELECT {', '.join(EVENT_COLUMNS)} FROM events")
def stream_incremental_ingest(spark, folder):
    """Two runs over one checkpoint: the second finds nothing new."""
    output, checkpoint = shared_path(spark, "ingest"), shared_path(spark, "ingest_checkpoint")
    for _ in range(2):
        finish(ingest.ingest(event_stream(spark, folder).select(*EVENT_COLUMNS), output, checkpoint))
    return spark.read.parquet(output)


@query("stream_idempotent_sink", f"SELECT {', '.join(EVENT_COLUMNS)}, CAST(0 AS BIGINT) AS batch_id FROM events")
def stream_idempotent_sink(spark, folder):
    """A run repeated from its start, as after a lost checkpoint, replaces what it wrote."""
    output = shared_path(spark, "idempotent")
    for _ in range(2):
        stream = event_stream(spark, folder, "source_file").select(*EVENT_COLUMNS, "source_file")
        finish(ingest.ingest_idempotent(stream, output, shared_path(spark, "idempotent_checkpoint")))
    return spark.read.parquet(output).select(*EVENT_COLUMNS, F.col("batch_id").cast("bigint").alias("batch_id"))


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, folder):
    output, checkpoint = shared_path(spark, "dedup"), shared_path(spark, "dedup_checkpoint")
    unique = dedup.stream_dedup(event_stream(spark, folder), ["user_id", "event_type"], "ts", "365 days")
    finish(ingest.ingest(unique.select("user_id", "event_type"), output, checkpoint))
    return spark.read.parquet(output)


@query("stream_dedup_across_runs", """
SELECT user_id, event_type, CASE WHEN bool_or(event_id % 2 = 0) THEN 'first' ELSE 'second' END AS kept_by,
       coalesce(min(event_id) FILTER (WHERE event_id % 2 = 0), min(event_id)) AS event_id
FROM events GROUP BY 1, 2""")
def stream_dedup_across_runs(spark, folder):
    """Two runs over two halves, each with a checkpoint of its own; the second keeps what the first has not met."""
    output, state = shared_path(spark, "unique"), shared_path(spark, "unique-keys")
    for half, run in enumerate(("first", "second")):
        stream = event_stream(spark, folder).filter(F.col("event_id") % 2 == half).select("event_id", "user_id", "event_type")
        finish(dedup.dedup_across_runs(stream, output, state, shared_path(spark, "unique_checkpoint"),
                                       ["user_id", "event_type"], ["event_id"], run))
    kept_by = F.split("run", "-")[0].alias("kept_by")
    return spark.read.parquet(output).select("user_id", "event_type", kept_by, "event_id")


LABEL = "CASE event_type WHEN 'purchase' THEN 'POSITIVE' WHEN 'error' THEN 'NEGATIVE' WHEN 'signup' THEN NULL ELSE 'NEUTRAL' END"


def trend_sql(start: str) -> str:
    return (f"SELECT strftime({start}, '%Y-%m-%d') AS period_start, {LABEL} AS label, count(*) AS mentions "
            "FROM events GROUP BY 1, 2")


def stream_trend(spark: SparkSession, folder: str, width: str) -> DataFrame:
    events = event_stream(spark, folder).withColumn("label", F.expr(LABEL))
    counted = trend.sentiment_trend(events, "ts", "label", "30 days", width)
    output, checkpoint = shared_path(spark, "trend"), shared_path(spark, "trend_checkpoint")
    finish(ingest.publish_totals(counted, output, checkpoint, ["period_start", "label"]))
    return ingest.read_totals(spark, output, counted.schema)


@query("stream_sentiment_trend", trend_sql("date_trunc('day', ts)"))
def stream_sentiment_trend(spark, folder):
    return stream_trend(spark, folder, "1 day")


@query("stream_weekly_trend", trend_sql("time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01')"))
def stream_weekly_trend(spark, folder):
    return stream_trend(spark, folder, "7 days")


@query("batch_weekly_trend", trend_sql("time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01')"))
def batch_weekly_trend(spark, folder):
    """The same trend over the table at rest."""
    events = table(spark, folder, "events").withColumn("label", F.expr(LABEL))
    return trend.sentiment_trend(events, "ts", "label", "30 days", "7 days")
