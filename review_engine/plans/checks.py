"""Validation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_engine.functions.text import date_text
from review_engine.operators import extraction, merge, validation as v
from review_engine.plans.registry import query
from review_engine.plans.tables import COLUMNS, FAMILIES, FAMILY_SQL, SPECS, critic_reviews, families, table

ALL = tuple(FAMILIES)


def union_sql(selects) -> str:
    return FAMILY_SQL + "\nUNION ALL\n".join(selects)


@query("val_shape", union_sql(
    f"SELECT '{f}' AS dataset, count(*) AS rows, CAST({len(COLUMNS[f])} AS BIGINT) AS cols, '{', '.join(COLUMNS[f])}' AS columns FROM {f}"
    for f in ALL))
def val_shape(spark, folder):
    return v.shape(families(spark, folder))


SCHEMA_TYPES = {"review_id": "bigint", "critics_score": "double", "audience_score": "double"}


@query("val_schema", FAMILY_SQL + "\nUNION ALL\n".join(
    f"SELECT {i}::INTEGER AS position, '{c}' AS name, '{SCHEMA_TYPES.get(c, 'string')}' AS type, true AS nullable, "
    f"count({c}) AS present FROM critic_reviews" for i, c in enumerate(COLUMNS["critic_reviews"])))
def val_schema(spark, folder):
    return v.schema_rows(critic_reviews(spark, folder))


@query("val_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2")
def val_head(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return v.head(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("val_null_report", FAMILY_SQL + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
    f"round(100.0 * (count(*) - count({c})) / count(*), 1) AS null_pct FROM critic_reviews"
    for c in COLUMNS["critic_reviews"]) + ") WHERE null_count > 0")
def val_null_report(spark, folder):
    return v.null_report(critic_reviews(spark, folder))


CHECKED_KEYS = {
    "titles": ("canonical_title", "source"),
    "critic_reviews": ("canonical_title", "critics_score"),
    "user_reviews": ("movie_id", "sentiment_label"),
    "dated_reviews": ("movie_id", "absent", "review_date"),
}


def duplicates_sql(f: str) -> str:
    keys = [k for k in CHECKED_KEYS[f] if k in COLUMNS[f]]
    return (f"SELECT '{f}' AS dataset, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, "
            f"'{', '.join(keys)}' AS dedup_keys FROM (SELECT count(*) AS n FROM {f} GROUP BY {', '.join(keys)})")


@query("val_duplicates", union_sql(duplicates_sql(f) for f in ALL))
def val_duplicates(spark, folder):
    return v.union_all([v.duplicates(f, df, CHECKED_KEYS[f]) for f, df in families(spark, folder).items()])


@query("val_distribution", f"{FAMILY_SQL} SELECT sentiment_label AS value, count(*) AS rows FROM user_reviews GROUP BY 1")
def val_distribution(spark, folder):
    return v.distribution(families(spark, folder, ("user_reviews",))["user_reviews"], "sentiment_label")


CLEANED_SQL = f"{FAMILY_SQL}, cleaned AS (SELECT * REPLACE (CASE WHEN review_id % 5 > 0 THEN review_text_clean END AS review_text_clean) FROM critic_reviews)"


def cleaned(spark, folder) -> DataFrame:
    clean = F.when(F.col("review_id") % 5 > 0, F.col("review_text_clean"))
    return critic_reviews(spark, folder).withColumn("review_text_clean", clean)


@query("val_text_clean", f"""{CLEANED_SQL}
SELECT unnest(['total_rows', 'raw_text_not_null', 'clean_text_not_null', 'both_present', 'changed_after_cleaning']) AS metric,
       unnest([count(*), count(review_text), count(review_text_clean),
               count(*) FILTER (WHERE review_text IS NOT NULL AND review_text_clean IS NOT NULL),
               count(*) FILTER (WHERE review_text <> review_text_clean)]) AS value
FROM cleaned""")
def val_text_clean(spark, folder):
    return v.text_cleaning(cleaned(spark, folder))


@query("val_changed_sample", f"""{CLEANED_SQL}
SELECT review_id, review_text, review_text_clean FROM cleaned WHERE review_text <> review_text_clean ORDER BY review_id LIMIT 3""")
def val_changed_sample(spark, folder):
    return v.changed_sample(cleaned(spark, folder), [F.col("review_id")], ["review_id", "review_text", "review_text_clean"])


TRACED_SQL = f"""{FAMILY_SQL}, traced AS (
  SELECT review_id, CASE WHEN review_id % 3 > 0 THEN source || ', ' || review_type || '.json' END AS bronze_file_name,
         review_type AS bronze_source_type FROM critic_reviews)"""


def traced(spark, folder) -> DataFrame:
    name = F.when(F.col("review_id") % 3 > 0, F.concat("source", F.lit(", "), "review_type", F.lit(".json")))
    return critic_reviews(spark, folder).select(
        "review_id", name.alias("bronze_file_name"), F.col("review_type").alias("bronze_source_type"))


@query("val_lineage", TRACED_SQL + " UNION ALL ".join(
    f"SELECT 'traced' AS dataset, '{c}' AS column_name, {n} AS not_null_rows, count(*) AS total_rows, "
    f"round(100.0 * {n} / count(*), 1) AS coverage_pct FROM traced"
    for c, n in (("bronze_file_name", "count(bronze_file_name)"), ("bronze_source_type", "count(bronze_source_type)"),
                 ("processed_at", "CAST(0 AS BIGINT)"))))
def val_lineage(spark, folder):
    return v.lineage("traced", traced(spark, folder))


@query("val_source_files", f"""{TRACED_SQL}
SELECT DISTINCT 'traced' AS dataset, trim(unnest(string_split(bronze_file_name, ','))) AS bronze_file FROM traced""")
def val_source_files(spark, folder):
    return v.source_files("traced", traced(spark, folder))


def summary_sql(f: str) -> str:
    present = " + ".join(f"count({c})" for c in COLUMNS[f])
    cells = f"(count(*) * {len(COLUMNS[f])})"
    return (f"SELECT '{f}' AS dataset, count(*) AS rows, CAST({len(COLUMNS[f])} AS BIGINT) AS cols, "
            f"count(DISTINCT source) AS unique_sources, round(100.0 * ({cells} - ({present})) / {cells}, 1) AS null_pct_avg, "
            f"'{f}.parquet' AS parquet_file FROM {f}")


@query("val_summary", union_sql(summary_sql(f) for f in ALL))
def val_summary(spark, folder):
    return v.union_all([v.summary(f, df, "source", f"{f}.parquet") for f, df in families(spark, folder).items()])


@query("val_before_after", union_sql(
    f"SELECT '{f}' AS family, CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after FROM "
    f"(SELECT count(*) AS n FROM {f} GROUP BY {', '.join(SPECS[f].duplicate_keys)})" for f in ALL))
def val_before_after(spark, folder):
    return v.union_all([v.before_after(f, df, SPECS[f].duplicate_keys) for f, df in families(spark, folder).items()])


@query("val_extraction_quality", r"""
WITH items AS (
  SELECT regexp_extract(html, '(?s)<title\b[^>]*>(.*?)</title>', 1) AS title,
         regexp_extract(html, '(?s)<h1\b[^>]*>(.*?)</h1>', 1) AS critics_score,
         regexp_extract(html, '(?s)<footer\b[^>]*>(.*?)</footer>', 1) AS audience_score,
         regexp_extract(html, '(?i)(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]?\s+\d{1,2},?\s+\d{4}') AS release_date
  FROM pages)
SELECT count(*) AS items, count(*) FILTER (WHERE critics_score <> '') AS with_critics_score,
       count(*) FILTER (WHERE audience_score <> '') AS with_audience_score,
       count(*) FILTER (WHERE release_date <> '') AS with_release_date,
       count(*) FILTER (WHERE contains(title, 'the ')) AS noise_the, count(*) FILTER (WHERE contains(title, 'Link to')) AS noise_link_to
FROM items""")
def val_extraction_quality(spark, folder):
    html = F.col("html")
    body = lambda tag: extraction.find(html, extraction.tag_body(tag))
    items = table(spark, folder, "pages").select(
        body("title").alias("title"), body("h1").alias("critics_score"), body("footer").alias("audience_score"),
        date_text(html).alias("release_date"))
    counted = v.extraction_quality(items, noise=("the ", "Link to"))
    return counted.withColumnRenamed("noise_the_", "noise_the")


@query("val_ingest_totals", "SELECT count(DISTINCT conv_id) AS parents, count(*) AS children FROM conversations")
def val_ingest_totals(spark, folder):
    nested = merge.nest_children(table(spark, folder, "conversations"), "conv_id", "turn", ["role", "text"], "turns")
    per_parent = nested.groupBy("conv_id").agg(F.sum("total_turns").alias("turns"))
    return v.ingest_totals(per_parent, "turns")
