"""Pinned schemas, key sets and fixed names of the data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "bigints": T.ArrayType(T.LongType()),
}


def _schema(text: str, **nested: T.DataType) -> T.StructType:
    """Schema from ``name type`` pairs; works before a session exists."""
    pairs = [part.split() for part in text.split(", ")]
    return T.StructType([T.StructField(name, nested.get(kind) or _TYPES[kind]) for name, kind in pairs])


def _results(item: T.StructType, more: str) -> T.StructType:
    return _schema(f"results items, {more}", items=T.ArrayType(item))


# --- raw documents -----------------------------------------------------------

CATALOG_ITEM = _schema(
    "id bigint, title string, popularity double, vote_average double, vote_count bigint, "
    "genre_ids bigints, release_date string, overview string"
)
SCRAPED_ITEM = _schema(
    "title string, release_date string, critics_score string, audience_score string, "
    "url string, poster_url string, scraped_at string"
)
CRITIC_ITEM = _schema(
    "critic string, publication string, review_text string, sentiment string, original_score string, "
    "is_top_critic string, date string, source_url string, publication_review_url string, scraped_at string"
)
AUDIENCE_ITEM = _schema(
    "user string, rating string, is_verified string, review_text string, date string, "
    "source_url string, scraped_at string"
)
USER_REVIEW_ITEM = _schema(
    "author string, content string, rating double, created_at string, review_id string, url string"
)
REVIEWED_TITLE = _schema(
    "title string, url string, critics_score string, audience_score string, critic_reviews critics, "
    "audience_reviews audience, total_critic_reviews bigint, total_audience_reviews bigint, scraped_at string",
    critics=T.ArrayType(CRITIC_ITEM),
    audience=T.ArrayType(AUDIENCE_ITEM),
)
REVIEWED_MOVIE = _schema(
    "movie movie, reviews reviews, total_reviews bigint, scraped_at string, source string",
    movie=CATALOG_ITEM,
    reviews=T.ArrayType(USER_REVIEW_ITEM),
)

API_CATALOG_DOC = _results(CATALOG_ITEM, "ingested_at string, source string")
# Both catalog shapes at once: an entry has the fields of its own source.
CATALOG_DOC = _results(
    T.StructType(CATALOG_ITEM.fields + [f for f in SCRAPED_ITEM.fields if f.name not in CATALOG_ITEM.names]),
    "total bigint, ingested_at string, source string",
)
SCRAPED_CATALOG_DOC = _results(SCRAPED_ITEM, "total bigint, ingested_at string, source string")
TITLE_REVIEWS_DOC = _results(REVIEWED_TITLE, "total_movies bigint, ingested_at string, source string")
USER_REVIEWS_DOC = _results(REVIEWED_MOVIE, "total_movies bigint, ingested_at string, source string")

# --- silver tables -----------------------------------------------------------

# Columns of the silver tables and the key sets rows are deduplicated by.

TITLES = _schema(
    "canonical_title string, source_title string, source string, source_type string, source_id bigint, "
    "url string, poster_url string, release_date date, release_year int, popularity double, "
    "vote_average double, vote_count bigint, critics_score double, audience_score double, overview string, "
    "genre_ids string, scraped_at timestamp, bronze_file_name string, bronze_source_type string, "
    "processed_at timestamp"
)
TITLE_REVIEWS = _schema(
    "canonical_title string, source string, review_type string, reviewer_name string, publication string, "
    "review_text string, review_text_clean string, sentiment_label string, original_score string, "
    "rating double, is_verified boolean, is_top_critic boolean, review_date timestamp, source_url string, "
    "publication_review_url string, title_url string, critics_score double, audience_score double, "
    "scraped_at timestamp, bronze_file_name string, bronze_source_type string, processed_at timestamp"
)
USER_REVIEWS = _schema(
    "movie_id bigint, canonical_title string, source string, reviewer_name string, review_text string, "
    "review_text_clean string, rating double, review_date timestamp, review_id string, review_url string, "
    "popularity double, vote_average double, vote_count bigint, release_date date, release_year int, "
    "overview string, genre_ids string, total_reviews bigint, scraped_at timestamp, bronze_file_name string, "
    "bronze_source_type string, processed_at timestamp"
)

TITLES_KEYS = ("source", "source_title", "url", "source_id")
TITLE_REVIEWS_KEYS = ("canonical_title", "review_type", "reviewer_name", "review_date", "review_text")
USER_REVIEWS_KEYS = ("movie_id", "review_id")

# --- gold facts and the manifest ---------------------------------------------

GOVERNANCE_FACT = _schema(
    "kpi_type string, metric_name string, family string, column_name string, value double, unit string, "
    "computed_at string, run_stamp string"
)
STORY_FACT = _schema(
    "aggregation_type string, metric_name string, dimension string, dimension_value string, family string, "
    "value double, unit string, computed_at string, run_stamp string"
)
MANIFEST = _schema("file_path string, file_name string, creation_day string, creation_time string")

# --- routing -----------------------------------------------------------------

# File-name prefix -> source type.
SOURCE_TYPE_BY_PREFIX = {
    "tmdb_trending_movie_day_": "tmdb_catalog_trending_day",
    "tmdb_now_playing_": "tmdb_catalog_now_playing",
    "tmdb_movie_reviews_": "tmdb_reviews",
    "rottentomatoes_theaters_": "rt_catalog_theaters",
    "rottentomatoes_at_home_": "rt_catalog_at_home",
    "rottentomatoes_reviews_": "rt_reviews_theaters",
    "rottentomatoes_at_home_reviews_": "rt_reviews_at_home",
}
# Source type -> silver family.
FAMILY_BY_SOURCE_TYPE = {
    "tmdb_catalog_trending_day": "silver_titles",
    "tmdb_catalog_now_playing": "silver_titles",
    "rt_catalog_theaters": "silver_titles",
    "rt_catalog_at_home": "silver_titles",
    "rt_reviews_theaters": "silver_rt_reviews",
    "rt_reviews_at_home": "silver_rt_reviews",
    "tmdb_reviews": "silver_tmdb_reviews",
}
IGNORED_FAMILY = "ignored"


@dataclass(frozen=True)
class FamilySpec:
    """What the quality and opinion facts need to know about one family."""

    name: str
    kind: str  # "critic", "title" or "user": which opinion aggregates apply
    prefix: str  # leads the metric names of the opinion facts
    duplicate_keys: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    required: tuple[str, ...] = ("canonical_title",)


# Names, keys and columns per family of the silver layer.
SILVER_SPECS = {
    "rt_reviews": FamilySpec(
        "rt_reviews", "critic", "rt",
        duplicate_keys=TITLE_REVIEWS_KEYS,
        numeric=("critics_score", "audience_score", "rating"),
        required=("canonical_title", "review_text", "review_date"),
    ),
    "titles": FamilySpec(
        "titles", "title", "title",
        duplicate_keys=("canonical_title", "source"),
        numeric=("source_id", "release_year", "popularity", "vote_average", "vote_count",
                 "critics_score", "audience_score"),
        required=("canonical_title", "source"),
    ),
    "tmdb_reviews": FamilySpec(
        "tmdb_reviews", "user", "tmdb",
        duplicate_keys=USER_REVIEWS_KEYS,
        numeric=("movie_id", "popularity", "vote_average", "vote_count", "release_year", "rating",
                 "total_reviews"),
        required=("canonical_title", "review_text", "review_date"),
    ),
}
