"""The two batch runs: raw documents to silver tables, silver tables to facts."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_engine import schemas
from review_engine.operators import flatten, governance, merge, storytelling
from review_engine.operators.governance import Run
from review_engine.session import configure, shared_path
from review_engine.sources import bronze, manifest, snapshots

log = logging.getLogger(__name__)

# family -> (document schema, transform of its documents)
SILVER_STEPS = {
    "silver_titles": (
        schemas.CATALOG_DOC,
        lambda docs, at: flatten.transform_titles(docs, docs, at),  # each shape takes its own source types
    ),
    "silver_rt_reviews": (schemas.TITLE_REVIEWS_DOC, flatten.transform_title_reviews),
    "silver_tmdb_reviews": (schemas.USER_REVIEWS_DOC, flatten.transform_user_reviews),
}


def run_silver(spark: SparkSession, raw: str, silver: str, manifest_path: str, run_stamp: str,
               processed_at: str, rejects: str | None = None) -> DataFrame:
    """Process the raw files the manifest does not list; returns a summary per family.

    The manifest grows only after every family is written, so a run that failed
    is repeated whole and replaces its own partitions. A broken document fails the run. With
    ``rejects`` it goes to that table instead, with its name, the reason and the run; it stays out
    of the manifest, so a mended file is taken up later, and the run goes on. Files without any
    content are not listed, so they wait until they have some.
    """
    configure(spark)
    known = manifest.load_manifest(spark, manifest_path)
    files = bronze.new_files(bronze.list_files(spark, raw), known)
    typed = files.withColumn("source_type", bronze.source_type(F.col("file_name")))
    # Written, so that a file that comes in meanwhile is left to the next run by every step.
    listed = _kept(bronze.route(typed, bronze.family_lookup(spark)).select("file_path", "file_name", "family"), "listing")
    # Spark keeps the list of files it reads on the driver, so their names come here; nothing else does.
    paths: dict[str, list[str]] = {}
    for row in listed.select("family", "file_path").toLocalIterator():
        paths.setdefault(row.family, []).append(row.file_path)

    at, outputs, broken = F.lit(processed_at).cast("timestamp"), {}, []
    for family, (schema, transform) in SILVER_STEPS.items():
        if family in paths:
            names = sorted(paths[family])
            if rejects is None:
                documents = bronze.read_documents(spark, names, schema)
            else:
                documents, rejected = bronze.sorted_documents(spark, names, schema)
                broken.append(rejected)
            path = snapshots.write_snapshot_if_any(transform(documents, at), silver, family, run_stamp)
            if path is None:
                continue
            written = spark.read.parquet(f"{path}/run_stamp={run_stamp}")
            outputs[family] = (written, path)
    counts, taken = (None if rejects is None else {}), listed
    if broken:
        kept = _kept(reduce(DataFrame.unionByName, broken).join(listed.select("file_name", "family"), "file_name"), "rejects")
        kept.withColumn("run_stamp", F.lit(run_stamp)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run_stamp").parquet(rejects)
        counts = {row.family: row["count"] for row in kept.groupBy("family").count().collect()}
        log.warning("run %s: %d broken documents set aside", run_stamp, sum(counts.values()))
        taken = listed.join(kept.select("file_name").distinct(), "file_name", "left_anti")
    if paths:
        manifest.additions(known, taken.select("file_path")).write.mode("append").parquet(manifest_path)
    if outputs:
        return snapshots.run_summary(outputs, counts)
    return spark.createDataFrame([], "family string, rows bigint, path string" + (", rejected bigint" if counts is not None else ""))


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_gold(spark: SparkSession, silver: str, gold: str, run: Run, lexicon: DataFrame) -> None:
    """Both fact tables over all silver runs, read as text whatever types they were written with."""
    configure(spark)
    families = {
        name: snapshots.read_family_drift(spark, silver, f"silver_{name}") for name in schemas.SILVER_SPECS
    }
    # Facts are about the family's own columns, not the run folder's name or joined copies of typed columns.
    families = {
        name: df if df is None else df.select(
            *[c for c in df.columns if c != "run_stamp" and not c.endswith(merge.ALL_SUFFIX)])
        for name, df in families.items()
    }
    quality = governance.governance_report(spark, families, schemas.SILVER_SPECS, run)
    snapshots.write_snapshot(quality, gold, "governance", run.run_stamp)
    labelled = {
        name: storytelling.with_labels(df, None, lexicon) if df is not None and "review_text" in df.columns else df
        for name, df in families.items()
    }
    story = storytelling.storytelling_report(spark, labelled, schemas.SILVER_SPECS, run)
    snapshots.write_snapshot(story, gold, "storytelling", run.run_stamp)
