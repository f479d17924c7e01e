"""Raw nested documents composed from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from review_engine.operators.merge import nest_children
from review_engine.plans.tables import table

# Entries of one composed catalog document. Keys are unique, so this bounds a group.
DOC_ITEMS = 100
STAMPED = "_20250102_030405.json"


def file_name(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"), F.lit(STAMPED))


def title_documents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Catalog documents of both shapes, at most a hundred entries each, over parts and suppliers."""
    part = table(spark, folder, "part")
    item = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("popularity"),
        F.lit(None).cast("double").alias("vote_average"),
        F.col("p_size").cast("bigint").alias("vote_count"),
        F.array(F.col("p_size").cast("bigint"), F.lit(7).cast("bigint")).alias("genre_ids"),
        F.lit("2024-01-05").alias("release_date"),
        F.concat(F.lit("  A  "), F.col("p_type")).alias("overview"),
    )
    block = F.floor(F.col("p_partkey") / DOC_ITEMS)
    api = part.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list(item)).alias("results")).select(
        "results",
        F.lit("2025-01-02T03:04:05").alias("ingested_at"),
        file_name("tmdb_now_playing_", F.col("block")).alias("bronze_file_name"),
    )
    supplier = table(spark, folder, "supplier")
    scraped_item = F.struct(
        F.col("s_name").alias("title"),
        F.lit("Opened May 12, 2026").alias("release_date"),
        F.concat(F.col("s_nationkey").cast("string"), F.lit("%")).alias("critics_score"),
        F.lit("").alias("audience_score"),
        F.concat(F.lit("/m/"), F.col("s_suppkey").cast("string")).alias("url"),
        F.lit(None).cast("string").alias("poster_url"),
        F.lit("2025-01-02T03:04:05").alias("scraped_at"),
        F.col("s_suppkey").alias("_order"),
    )
    block = F.floor(F.col("s_suppkey") / DOC_ITEMS)
    scraped = supplier.groupBy(block.alias("block")).agg(
        F.array_sort(F.collect_list(scraped_item), lambda a, b: (a["_order"] - b["_order"]).cast("int")).alias("results")
    ).select(
        "results",
        F.lit(None).cast("string").alias("ingested_at"),
        file_name("rottentomatoes_theaters_", F.col("block")).alias("bronze_file_name"),
    )
    return api, scraped


def review_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Review documents with both arrays, one title per conversation: users are the audience, all others critics."""
    talks = nest_children(table(spark, folder, "conversations"), "conv_id", "turn", ["role", "text"], "turns")
    of_user = lambda t: t["role"] == "user"
    pick = lambda chosen, item: F.transform(F.filter("turns", chosen), item)
    text = F.lit(None).cast("string")
    critics = pick(lambda t: ~of_user(t), lambda t: F.struct(
        F.concat(F.lit("critic "), t["turn"].cast("string")).alias("critic"), text.alias("publication"),
        t["text"].alias("review_text"), F.lit("POSITIVE").alias("sentiment"), text.alias("original_score"),
        F.lit("Yes").alias("is_top_critic"), F.lit("2024-01-05T10:00:00+02:00").alias("date"), text.alias("source_url"),
        text.alias("publication_review_url"), text.alias("scraped_at")))
    audience = pick(of_user, lambda t: F.struct(
        F.concat(F.lit("user "), t["turn"].cast("string")).alias("user"), t["turn"].cast("string").alias("rating"),
        F.lit("0").alias("is_verified"), t["text"].alias("review_text"), F.lit("junk").alias("date"),
        text.alias("source_url"), text.alias("scraped_at")))
    title = F.struct(
        F.concat(F.lit(" Talk  "), F.col("conv_id").cast("string")).alias("title"),
        F.lit("u").alias("url"), F.lit("90%").alias("critics_score"), text.alias("audience_score"),
        critics.alias("critic_reviews"), audience.alias("audience_reviews"),
    )
    return talks.select(
        F.array(title).alias("results"), text.alias("ingested_at"),
        file_name("rottentomatoes_reviews_", F.col("conv_id")).alias("bronze_file_name"),
    )


def user_review_documents(spark: SparkSession, folder: str) -> DataFrame:
    talks = nest_children(table(spark, folder, "conversations"), "conv_id", "turn", ["role", "text"], "turns")
    text = F.lit(None).cast("string")
    movie = F.struct(
        F.col("conv_id").alias("id"), F.concat(F.lit("Talk "), F.col("conv_id").cast("string")).alias("title"),
        F.lit(1.5).alias("popularity"), F.lit(None).cast("double").alias("vote_average"),
        F.col("total_turns").alias("vote_count"), F.array(F.col("conv_id")).alias("genre_ids"),
        F.lit("May 12, 2026").alias("release_date"), text.alias("overview"),
    )
    reviews = F.transform("turns", lambda t: F.struct(
        t["role"].alias("author"), t["text"].alias("content"), t["turn"].cast("double").alias("rating"),
        F.lit("2024-01-05").alias("created_at"),
        # turns after the third repeat its id: duplicates within the movie
        F.concat(F.lit("r"), F.least(t["turn"], F.lit(3)).cast("string")).alias("review_id"), text.alias("url")))
    entry = F.struct(movie.alias("movie"), reviews.alias("reviews"), F.col("total_turns").alias("total_reviews"),
                     F.lit("2025-01-02T03:04:05").alias("scraped_at"))
    return talks.select(
        F.array(entry).alias("results"), text.alias("ingested_at"),
        file_name("tmdb_movie_reviews_", F.col("conv_id")).alias("bronze_file_name"),
    )
