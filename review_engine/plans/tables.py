"""Driver tables, and the review families seen as views over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from review_engine.functions.markup import clean_review_text
from review_engine.functions.text import canonical_title
from review_engine.operators.governance import Run
from review_engine.schemas import FamilySpec

RUN = Run("20250101_000000", "2025-01-01T00:00:00")

SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
WORDS = r"[\p{L}\p{N}_]{3,}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_file(name: str) -> Column:
    """Name of the file a row of the table came from. A table kept as a folder of parts is one file: its parts are named anew by every copy."""
    entry = F.regexp_extract("_metadata.file_path", rf"/({name}\.parquet)(?:/.*)?$", 1)
    return F.coalesce(F.nullif(entry, F.lit("")), F.col("_metadata.file_name"))


# --- SQL pieces --------------------------------------------------------------


def sql_space(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{SPACE}+', ' ', 'g')), '')"


def sql_strip(x: str) -> str:
    return f"nullif(regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g'), '')"


def sql_clean(x: str) -> str:
    return rf"regexp_replace(trim(regexp_replace(lower({sql_strip(x)}), '{SPACE}+', ' ', 'g')), '\.{{2,}}', '.', 'g')"


# --- families ----------------------------------------------------------------

SPECS = {
    "titles": FamilySpec(
        "titles", "title", "title", ("canonical_title", "source"),
        ("source_id", "release_year", "popularity", "vote_average"), ("canonical_title", "source"),
    ),
    "critic_reviews": FamilySpec(
        "critic_reviews", "critic", "critic", ("review_text",), ("critics_score", "audience_score"),
        ("canonical_title", "review_text", "critics_score"),
    ),
    "user_reviews": FamilySpec(
        "user_reviews", "critic", "user", ("movie_id", "source"), ("movie_id", "rating"),
        ("canonical_title", "review_date", "sentiment_label"),
    ),
    "dated_reviews": FamilySpec(
        "dated_reviews", "user", "dated", ("movie_id", "review_date"), ("movie_id", "rating"),
        ("canonical_title", "review_date"),
    ),
}

COLUMNS = {
    "titles": ("canonical_title", "source_title", "source", "source_type", "source_id", "release_year", "popularity",
               "vote_average"),
    "critic_reviews": ("review_id", "canonical_title", "source", "review_type", "review_text", "review_text_clean",
                       "sentiment_label", "critics_score", "audience_score"),
    "user_reviews": ("review_id", "movie_id", "canonical_title", "source", "reviewer_name", "review_date", "rating",
                     "sentiment_label", "props"),
    "dated_reviews": ("review_id", "movie_id", "canonical_title", "source", "reviewer_name", "review_date", "rating",
                      "sentiment_label"),
}
TEXT_COLUMNS = {"critic_reviews": ("review_text", "review_text_clean")}
DATE_COLUMN = {"user_reviews": "review_date", "dated_reviews": "review_date"}

FAMILY_SQL = f"""WITH titles AS (
  SELECT lower({sql_space('p_name')}) AS canonical_title, p_name AS source_title, p_brand AS source,
         p_type AS source_type, p_partkey AS source_id, p_size AS release_year, p_retailprice AS popularity,
         p_retailprice AS vote_average
  FROM part),
critic_reviews AS (
  SELECT d.doc_id AS review_id, d.source AS canonical_title, d.source AS source, d.lang AS review_type,
         d.text AS review_text, {sql_clean('d.text')} AS review_text_clean, CAST(NULL AS VARCHAR) AS sentiment_label,
         CAST(100 * l.quality AS DOUBLE) AS critics_score, CAST(100 * l.toxic AS DOUBLE) AS audience_score
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
user_reviews AS (
  SELECT event_id AS review_id, user_id AS movie_id, 'title ' || user_id AS canonical_title, event_type AS source,
         CAST(user_id AS VARCHAR) AS reviewer_name, ts AS review_date, value AS rating,
         CASE event_type WHEN 'purchase' THEN 'POSITIVE' WHEN 'error' THEN 'NEGATIVE' WHEN 'view' THEN 'NEUTRAL'
                         WHEN 'click' THEN 'NEUTRAL' END AS sentiment_label,
         props
  FROM events),
dated_reviews AS (
  SELECT o_orderkey AS review_id, o_custkey AS movie_id, 'title ' || o_custkey AS canonical_title,
         o_orderpriority AS source, CAST(o_custkey AS VARCHAR) AS reviewer_name, o_orderdate AS review_date,
         o_totalprice AS rating,
         CASE o_orderstatus WHEN 'F' THEN 'POSITIVE' WHEN 'O' THEN 'NEUTRAL' END AS sentiment_label
  FROM orders)
"""


def titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        canonical_title(F.col("p_name")).alias("canonical_title"),
        F.col("p_name").alias("source_title"),
        F.col("p_brand").alias("source"),
        F.col("p_type").alias("source_type"),
        F.col("p_partkey").alias("source_id"),
        F.col("p_size").alias("release_year"),
        F.col("p_retailprice").alias("popularity"),
        F.col("p_retailprice").alias("vote_average"),
    )


def critic_reviews(spark: SparkSession, folder: str) -> DataFrame:
    # One row of labels per document. The planner then knows that the join cannot
    # multiply rows, and leaves it out of every query that reads no label.
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    joined = table(spark, folder, "documents").join(labels, "doc_id", "left")
    return joined.select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("canonical_title"),
        "source",
        F.col("lang").alias("review_type"),
        F.col("text").alias("review_text"),
        clean_review_text(F.col("text")).alias("review_text_clean"),
        F.lit(None).cast("string").alias("sentiment_label"),
        (F.col("quality") * 100).cast("double").alias("critics_score"),
        (F.col("toxic") * 100).cast("double").alias("audience_score"),
    )


def user_reviews(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("review_id"),
        F.col("user_id").alias("movie_id"),
        F.concat(F.lit("title "), F.col("user_id").cast("string")).alias("canonical_title"),
        kind.alias("source"),
        F.col("user_id").cast("string").alias("reviewer_name"),
        F.col("ts").alias("review_date"),
        F.col("value").alias("rating"),
        F.when(kind == "purchase", "POSITIVE").when(kind == "error", "NEGATIVE")
        .when(kind.isin("view", "click"), "NEUTRAL").alias("sentiment_label"),
        "props",
    )


def dated_reviews(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_custkey").alias("movie_id"),
        F.concat(F.lit("title "), F.col("o_custkey").cast("string")).alias("canonical_title"),
        F.col("o_orderpriority").alias("source"),
        F.col("o_custkey").cast("string").alias("reviewer_name"),
        F.col("o_orderdate").alias("review_date"),
        F.col("o_totalprice").alias("rating"),
        F.when(status == "F", "POSITIVE").when(status == "O", "NEUTRAL").alias("sentiment_label"),
    )


FAMILIES = {
    "titles": titles,
    "critic_reviews": critic_reviews,
    "user_reviews": user_reviews,
    "dated_reviews": dated_reviews,
}


def families(spark: SparkSession, folder: str, names=tuple(FAMILIES)) -> dict[str, DataFrame]:
    return {name: FAMILIES[name](spark, folder) for name in names}
