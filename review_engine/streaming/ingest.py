"""Each file once, and writes that a retry may repeat."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from review_engine.session import shared_path
from review_engine.sources.bronze import source_type


def read_parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet",
                        files_per_trigger: int = 1000, file_column: str | None = None) -> DataFrame:
    """A folder as a stream; the checkpoint remembers which files were read.

    ``file_column`` names a column to add with the name of each row's file.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )
    return stream if file_column is None else stream.select("*", F.col("_metadata.file_name").alias(file_column))


def read_document_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.json",
                         files_per_trigger: int = 1000) -> DataFrame:
    """Raw JSON documents as a stream, with file name and source type."""
    name = F.col("_metadata.file_name")
    return (
        spark.readStream.schema(schema)
        .option("multiLine", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(folder)
        .select("*", name.alias("bronze_file_name"), source_type(name).alias("bronze_source_type"))
    )


def ingest(stream: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append what is new and stop. The file sink commits each batch once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def batch_writer(output: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Writer that replaces the partitions a batch has rows of, and no others."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(output)
        )

    return write


def ingest_idempotent(stream: DataFrame, output: str, checkpoint: str, file_column: str = "source_file") -> StreamingQuery:
    """Each input file into a partition of its own name, with the batch it last came in.

    A file is never cut between batches, so a replay overwrites what it wrote before, however
    it cuts the files into batches. File names must be unique over the input.
    """
    return (
        stream.writeStream.foreachBatch(batch_writer(output, [file_column]))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def totals_writer(output: str, window: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Writer that merges a batch's totals into the windows they belong to.

    A window is a partition of one file. The windows a batch touches are read, the batch's
    totals take the place of those of the same keys, and the windows are replaced.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, names = batch.sparkSession, batch.columns
        stage = lambda df: _staged(df, f"totals-{batch_id}")
        changed = stage(batch)
        # A batch touches the windows the watermark leaves open; their names prune what is read.
        touched = [row[window] for row in changed.select(window).distinct().collect()]
        if not touched:
            return
        merged = changed
        try:
            stored = read_totals(spark, output, batch.schema)
        except AnalysisException:
            stored = None
        if stored is not None:
            held = F.col(window).isin([t for t in touched if t is not None])
            held = held | F.col(window).isNull() if None in touched else held
            same = [stored[k].eqNullSafe(changed[k]) for k in keys]
            kept = stored.filter(held).join(changed, reduce(Column.__and__, same), "left_anti")
            merged = stage(kept.select(*names).unionByName(changed))
        (merged.repartition(window).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(window).parquet(output))

    return write


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_totals(counted: DataFrame, output: str, checkpoint: str, keys: list[str], window: str = "period_start") -> StreamingQuery:
    """Totals by ``keys``, those of each ``window`` (one of the keys) in a partition of its own.

    In update mode a batch brings the totals it changed and replaces only those; windows it does
    not touch are not written again, and the watermark frees their state. A replay ends in
    the same totals, however it cuts its batches, as long as no row is later than the
    watermark allows. The window must not be empty text, which reads back as null.
    """
    return (
        counted.writeStream.foreachBatch(totals_writer(output, window, keys))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_totals(spark: SparkSession, output: str, schema: T.StructType) -> DataFrame:
    """The published totals, with the columns of ``schema``."""
    return spark.read.schema(schema).parquet(output).select(*schema.names)
