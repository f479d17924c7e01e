"""Dedup across batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from review_engine.operators.dedup import keep_first
from review_engine.session import shared_path

SALTS = 32


def stream_dedup(stream: DataFrame, keys: list[str], event_time: str, watermark: str, salts: int = SALTS) -> DataFrame:
    """One row per key among those within ``watermark`` of each other.

    The watermark is required: it bounds the keys held in state. The rows of a
    hot key are first made distinct within ``salts`` slices, so that no task
    receives all of them; at most ``salts`` rows per key and batch go on to the
    second, exact step. The slice follows the task, because copies are equal and
    a hash would send them all to one place.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, watermark)
    if salts > 1:
        slice_ = F.pmod(F.spark_partition_id(), F.lit(salts))
        timed = timed.withColumn("_slice", slice_).dropDuplicatesWithinWatermark([*keys, "_slice"]).drop("_slice")
    return timed.dropDuplicatesWithinWatermark(keys)


# --- across runs ----------------------------------------------------------------


def with_digest(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``key_digest``: 32 bytes that tell key tuples apart, null from empty."""
    return df.withColumn("key_digest", F.unhex(F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)))


def known_digests(spark: SparkSession, state: str, run: str) -> DataFrame | None:
    """Digests that other runs have kept; None before the first."""
    try:
        kept = spark.read.schema("key_digest binary, run string").parquet(state)
    except AnalysisException:
        return None
    return kept.filter(F.col("run") != run).select("key_digest")


def unknown_rows(df: DataFrame, known: DataFrame | None, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key that no other run has kept, with its digest.

    The kept digests are first reduced to those of this batch. That semi-join is one the planner
    puts a Bloom filter of the batch in front of, so a large state is filtered where it is read
    and not shuffled whole.
    """
    first = keep_first(with_digest(df, keys), ["key_digest"], order)
    if known is None:
        return first
    met = known.join(first.select("key_digest"), "key_digest", "left_semi")
    return first.join(met, "key_digest", "left_anti")


def across_runs_writer(output: str, state: str, keys: list[str], order: list[str], run: str) -> Callable[[DataFrame, int], None]:
    """Writer of a batch's unknown rows to ``output`` and of their digests to ``state``.

    Both are partitioned by run and batch. A batch that is repeated leaves its own digests out
    of what is known and replaces what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{run}-{batch_id}"
        path = shared_path(spark, "unknown-rows")
        unknown_rows(batch, known_digests(spark, state, name), keys, [F.col(c) for c in order]).write.parquet(path)
        rows = spark.read.parquet(path).withColumn("run", F.lit(name))
        for df, target in ((rows.drop("key_digest"), output), (rows.select("key_digest", "run"), state)):
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(target)

    return write


def dedup_across_runs(stream: DataFrame, output: str, state: str, checkpoint: str, keys: list[str], order: list[str],
                      run: str) -> StreamingQuery:
    """One row for each key over all runs that share ``state``, whatever their checkpoints.

    ``run`` names this run: the same for a retry over the same checkpoint, another for each new
    one. ``order`` decides among the rows of a batch.
    """
    return (
        stream.writeStream.foreachBatch(across_runs_writer(output, state, keys, order, run))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
