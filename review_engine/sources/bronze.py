"""Raw files: listing, classification, routing and typed JSON reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine.schemas import FAMILY_BY_SOURCE_TYPE, IGNORED_FAMILY, SOURCE_TYPE_BY_PREFIX
from review_engine.session import shared_path, small_table

REJECT = "file_path string, file_name string, reason string"
NOT_JSON, NOT_OF_SCHEMA = "not JSON", "does not fit the schema"


def list_files(spark: SparkSession, folder: str, glob: str = "*.json", recursive: bool = False) -> DataFrame:
    """One row per file: path, name, size and time. File contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select(
            F.col("path").alias("file_path"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def file_inventory(files: DataFrame) -> DataFrame:
    """Size in MB per file, plus a total row."""
    mb = F.round(F.col("bytes") / (1024 * 1024), 2)
    per_file = files.select("file_name", F.lit(1).cast("bigint").alias("files"), mb.alias("size_mb"))
    total = files.agg(
        F.lit("TOTAL").alias("file_name"),
        F.count(F.lit(1)).alias("files"),
        F.round(F.sum("bytes") / (1024 * 1024), 2).alias("size_mb"),
    )
    return per_file.unionByName(total)


def missing_outputs(expected: DataFrame, files: DataFrame, key: str = "file_name") -> DataFrame:
    """Expected files that are absent or empty."""
    return expected.join(files.filter(F.col("bytes") > 0).select(key).distinct(), key, "left_anti")


def require_outputs(expected: DataFrame, files: DataFrame, key: str = "file_name") -> None:
    """Fail the run when an expected file is absent or empty."""
    missing = missing_outputs(expected, files, key).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")).first()
    if missing.n:
        raise FileNotFoundError(f"{missing.n} outputs missing or empty, the first by name: {missing["first"]}")


def source_type(file_name: Column, rules: dict[str, str] = SOURCE_TYPE_BY_PREFIX) -> Column:
    """Source type of a file by its name; the longest matching prefix decides."""
    choice = F.lit(None).cast("string")
    for prefix in sorted(rules, key=len):
        choice = F.when(file_name.startswith(prefix), rules[prefix]).otherwise(choice)
    return choice


def route(files: DataFrame, families: DataFrame, type_column: str = "source_type") -> DataFrame:
    """Add the family of each file; an unknown type goes to ``ignored``.

    ``families`` is a lookup (``source_type``, ``family``). No broadcast hint:
    the planner broadcasts it when its measured size allows.
    """
    lookup = families.select(F.col("source_type").alias(type_column), "family")
    return files.join(lookup, type_column, "left").withColumn(
        "family", F.coalesce("family", F.lit(IGNORED_FAMILY))
    )


def family_lookup(spark: SparkSession) -> DataFrame:
    return small_table(spark, "source_type string, family string", list(FAMILY_BY_SOURCE_TYPE.items()))


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose path is not in the manifest yet."""
    return files.join(manifest.select("file_path"), "file_path", "left_anti")


def read_documents(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Multi-line JSON documents with a pinned schema and their file name.

    A file that is not valid JSON fails the job, and Spark's error names it. Read as NULL
    fields its entries would be lost, and the file would count as processed.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", "true")
        .option("mode", "FAILFAST")
        .json(paths)
        .select("*", F.col("_metadata.file_name").alias("bronze_file_name"))
    )


def sorted_documents(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The readable documents, and the broken ones as (file_path, file_name, reason).

    As ``read_documents``, but a document that is no JSON, or does not fit the schema in some
    field, is set aside whole; none of its entries are taken. The parsed documents are written once below
    the shared folder: each file is opened once, every field is parsed before a document counts as readable,
    and later steps are planned over that one table, as Spark compares the list of all paths at each step.
    """
    read = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField("_broken", T.StringType())]))
        .option("multiLine", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_broken")
        .json(paths)
    )
    reason = F.when(F.try_parse_json("_broken").isNull(), NOT_JSON).otherwise(NOT_OF_SCHEMA)
    parsed = read.select(
        *schema.names, F.when(F.col("_broken").isNotNull(), reason).alias("reason"),
        F.col("_metadata.file_name").alias("bronze_file_name"), F.col("_metadata.file_path").alias("file_path"))
    path = shared_path(spark, "documents")
    parsed.write.parquet(path)
    stored = spark.read.schema(parsed.schema).parquet(path)
    rejects = stored.filter(F.col("reason").isNotNull()).select("file_path", F.col("bronze_file_name").alias("file_name"), "reason")
    return stored.filter(F.col("reason").isNull()).drop("reason", "file_path"), rejects
