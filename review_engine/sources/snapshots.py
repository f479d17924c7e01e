"""Stamped snapshots: one folder per family, one ``run_stamp`` partition per run."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from review_engine.functions.text import null_sentinels
from review_engine.session import small_table
from review_engine.sources.bronze import list_files

# Beside the families: the schema each run was written with.
REGISTRY = "schema_registry"
REGISTRY_ROW = "fingerprint string, schema_json string, family string, run_stamp string"


def _replace(df: DataFrame, path: str, *keys: str) -> None:
    """Replace the partitions that rows are given for, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_snapshot(df: DataFrame, base: str, family: str, run_stamp: str) -> str:
    """Write one run of a family; the same stamp again replaces that run only.

    The job committer publishes the files at the end, so a failed attempt leaves
    nothing visible. Spark sizes the files; nothing is forced into one part. The run's schema
    goes to the registry after the rows; a run without an entry is read by its own files.
    """
    path = f"{base}/{family}"
    _replace(df.withColumn("run_stamp", F.lit(run_stamp)), path, "run_stamp")
    schema = df.schema.json()
    entry = small_table(df.sparkSession, "schema_json string", [(schema,)])
    _replace(entry.select(F.sha2("schema_json", 256).alias("fingerprint"), "schema_json", F.lit(family).alias("family"),
                          F.lit(run_stamp).alias("run_stamp")), f"{base}/{REGISTRY}", "family", "run_stamp")
    return path


def registered_schemas(spark: SparkSession, base: str, family: str) -> DataFrame:
    """(run_stamp, fingerprint, schema_json) of the runs of a family, in one read."""
    try:
        found = spark.read.schema(REGISTRY_ROW).parquet(f"{base}/{REGISTRY}")
    except AnalysisException:
        found = spark.createDataFrame([], REGISTRY_ROW)
    return found.filter(F.col("family") == family).select("run_stamp", "fingerprint", "schema_json")


def write_snapshot_if_any(df: DataFrame, base: str, family: str, run_stamp: str) -> str | None:
    """As ``write_snapshot``, but an empty result counts as no run; a run of that stamp left by an earlier attempt is emptied.

    The rows are counted while they are written.
    """
    seen = Observation()
    path = write_snapshot(df.observe(seen, F.count(F.lit(1)).alias("rows")), base, family, run_stamp)
    if seen.get["rows"]:
        return path
    stale = f"{base}/{family}/run_stamp={run_stamp}"
    try:
        df.sparkSession.read.parquet(stale)
    except AnalysisException:
        return None
    df.limit(0).write.mode("overwrite").parquet(stale)
    return None


def scan_family(spark: SparkSession, base: str, family: str) -> DataFrame:
    """Native scan of all runs of a family whose schema has not drifted."""
    return spark.read.option("basePath", f"{base}/{family}").parquet(f"{base}/{family}")


def latest(df: DataFrame, stamp: Column | str = "run_stamp") -> DataFrame:
    """Rows of the newest run; the stamp filter prunes partitions."""
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    newest = df.agg(F.max(stamp)).scalar()
    return df.filter(stamp == newest)


def _run_folders(spark: SparkSession, path: str) -> DataFrame:
    """The run folders of a family, from a listing alone."""
    files = list_files(spark, path, "*.parquet", recursive=True)
    folder = F.regexp_extract("file_path", r"^(.*/run_stamp=[^/]+)/", 1)
    return files.select(folder.alias("folder")).filter("folder <> ''").distinct()


def latest_or_empty(spark: SparkSession, base: str, family: str, schema: T.StructType) -> DataFrame:
    """The newest run of a family, or an empty table of the given schema.

    The run is chosen by its folder name, so no file of an older run is opened.
    """
    path = f"{base}/{family}"
    try:
        newest = _run_folders(spark, path).agg(F.max("folder").alias("folder")).first().folder
    except AnalysisException:
        newest = None
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", path).parquet(newest).select(*schema.fieldNames())


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, with leaked NULL spellings undone."""
    return df.select([null_sentinels(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def read_family_drift(spark: SparkSession, base: str, family: str, skip_unreadable: bool = False) -> DataFrame | None:
    """All runs of a family as text, whatever types each run was written with.

    Runs that share a schema are read by one scan, so the plan grows with the
    number of schemas and not with the number of runs; the registry gives the schemas in one
    read, and only runs without an entry are opened to ask for theirs. A file that cannot be read
    fails the job by name: facts over a part of the rows would look like facts over all.
    ``skip_unreadable`` leaves such files out instead; ``unreadable_files`` names them.
    """
    path = f"{base}/{family}"
    stamp = F.regexp_extract("folder", "/run_stamp=([^/]+)$", 1).alias("run_stamp")
    try:
        # One name per run: few by nature, and needed to plan the scans.
        known = _run_folders(spark, path).select("folder", stamp).join(
            registered_schemas(spark, base, family), "run_stamp", "left").orderBy("folder").collect()
    except AnalysisException:
        return None
    groups: dict[str, list[str]] = {}
    for row in known:
        schema_json = row.schema_json or _own_schema(spark, row.folder, skip_unreadable)
        if schema_json is not None:
            groups.setdefault(schema_json, []).append(row.folder)
    combined = None
    for schema_json, members in groups.items():
        scan = (
            spark.read.schema(T.StructType.fromJson(json.loads(schema_json)))
            .option("basePath", path)
            .option("ignoreCorruptFiles", str(skip_unreadable).lower())
            .parquet(*members)
        )
        part = as_text(scan)
        combined = part if combined is None else combined.unionByName(part, allowMissingColumns=True)
    return combined


def _own_schema(spark: SparkSession, path: str, skip_unreadable: bool = False) -> str | None:
    try:
        return spark.read.option("ignoreCorruptFiles", str(skip_unreadable).lower()).parquet(path).schema.json()
    except AnalysisException:
        if skip_unreadable:  # no file of it can be read
            return None
        raise


def unreadable_files(spark: SparkSession, base: str, family: str) -> DataFrame:
    """(file_path, bytes): files of a family that ``skip_unreadable`` leaves out.

    Files that give no row are found by a join of the listing with what was read; only
    those are opened one by one, as a file may rightly hold no rows.
    """
    path = f"{base}/{family}"
    files = list_files(spark, path, "*.parquet", recursive=True).select("file_path", "bytes")
    read = (spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").schema("run_stamp string").parquet(path)
            .select(F.col("_metadata.file_path").alias("file_path")).distinct())
    same = lambda c: F.regexp_replace(c, "^file:/+", "/")
    rowless = files.join(read.select(same(F.col("file_path")).alias("seen")), same(F.col("file_path")) == F.col("seen"), "left_anti")
    broken = [(r.file_path, r.bytes) for r in rowless.toLocalIterator() if _own_schema(spark, r.file_path, True) is None]
    return small_table(spark, "file_path string, bytes bigint", broken)


def run_summary(outputs: dict[str, tuple[DataFrame, str]], rejected: dict[str, int] | None = None) -> DataFrame:
    """Family, row count and path of what a run wrote; no path for an empty family.

    With ``rejected`` also the number of broken files of each family.
    """
    combined = None
    for family, (df, path) in outputs.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(family).alias("family"),
            "rows",
            F.when(F.col("rows") > 0, path).alias("path"),
        )
        if rejected is not None:
            row = row.withColumn("rejected", F.lit(rejected.get(family, 0)).cast("bigint"))
        combined = row if combined is None else combined.unionByName(row)
    return combined
