"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Set on every session an operator runs in; all are session-scoped.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Lists of files are looked up many to a task; Spark's own bound of 10,000 makes it a task for each file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "review_engine", cores: str = "8") -> SparkSession:
    """A single-host session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that every executor can see.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session may fall back to a temporary folder of this host.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="review_engine_")
    return f"{base.rstrip('/')}/review_engine/{label}-{uuid.uuid4().hex}"


def small_table(spark: SparkSession, schema: T.StructType | str, rows: list[tuple]) -> DataFrame:
    """A constant table the planner knows the size of, so it can broadcast it on its own.

    (``createDataFrame`` on a list hides the size behind an RDD.)
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = pa.table({f.name: [r[i] for r in rows] for i, f in enumerate(schema.fields)}, to_arrow_schema(schema))
    return spark.createDataFrame(arrow, schema)
