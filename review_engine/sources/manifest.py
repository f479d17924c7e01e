"""The table of files already processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from review_engine.functions.text import to_null
from review_engine.schemas import MANIFEST

# Fixed value: the stamp at the end of a file name.
STAMP = r"_(\d{8})_(\d{6})\.[^.]+$"


def stamp_day(file_name: Column) -> Column:
    digits = F.regexp_extract(file_name, STAMP, 1)
    return F.when(digits != "", F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"))


def stamp_time(file_name: Column) -> Column:
    digits = F.regexp_extract(file_name, STAMP, 2)
    return F.when(digits != "", F.regexp_replace(digits, r"^(\d{2})(\d{2})(\d{2})$", "$1:$2:$3"))


def manifest_rows(paths: DataFrame) -> DataFrame:
    """Manifest rows for ``file_path`` values; an unstamped name keeps NULL day and time."""
    name = F.element_at(F.split("file_path", "/"), -1)
    return paths.select(
        "file_path",
        name.alias("file_name"),
        stamp_day(name).alias("creation_day"),
        stamp_time(name).alias("creation_time"),
    )


def import_text_list(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows out of a plain list of paths, one per line."""
    lines = spark.read.text(path).select(to_null(F.col("value")).alias("file_path"))
    return manifest_rows(lines.filter(F.col("file_path").isNotNull()).distinct())


def load_manifest(spark: SparkSession, path: str, text_list: str | None = None) -> DataFrame:
    """The manifest; failing that the older text list; failing that an empty table."""
    for read in (lambda: spark.read.schema(MANIFEST).parquet(path),
                 lambda: import_text_list(spark, text_list) if text_list else None):
        try:
            found = read()
        except AnalysisException:
            continue
        if found is not None:
            return found
    return spark.createDataFrame([], MANIFEST)


def additions(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows to append to the manifest: processed files it does not hold yet."""
    fresh = manifest_rows(processed.select("file_path").distinct())
    return fresh.join(manifest.select("file_path"), "file_path", "left_anti")


def append_to_manifest(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """The manifest after a run, one row per path."""
    return manifest.unionByName(additions(manifest, processed))
