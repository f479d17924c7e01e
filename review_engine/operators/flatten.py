"""Raw documents to flat silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine import schemas
from review_engine.functions.markup import clean_review_text
from review_engine.functions.parsing import (
    ids_text,
    parse_date,
    parse_flag,
    parse_percent,
    parse_release_date,
    parse_timestamp,
    safe_double,
)
from review_engine.functions.text import canonical_title, normalize_space, to_null
from review_engine.operators.dedup import keep_first
from review_engine.operators.merge import ALL_SUFFIX, ORDINAL_FILE, ORDINAL_POSITION, merge_entities
from review_engine.operators.shaping import conform, require
from review_engine.sources.bronze import source_type

API_CATALOG = "tmdb_catalog"
SCRAPED_CATALOG = "rt_catalog"
USER_REVIEW_TYPE = "tmdb_reviews"
# Order columns every flattened row carries until it is conformed.
ORDER = ("bronze_file_name", "_pos", "_child")


def explode_items(documents: DataFrame, results: str = "results") -> DataFrame:
    """One row per entry of a document's result list, with its position."""
    known = documents.withColumn("bronze_source_type", source_type(F.col("bronze_file_name")))
    return known.filter(F.col("bronze_source_type").isNotNull()).select(
        "bronze_file_name", "bronze_source_type", "ingested_at", F.posexplode(results).alias("_pos", "item")
    )


def explode_pages(pages: DataFrame, parent: str, page: str, results: str, metadata: list[str],
                  first_page: int = 1) -> DataFrame:
    """Entries of all pages in page order; metadata is that of the first page."""
    first = pages.filter(F.col(page) == first_page).select(
        parent, *[F.col(m).alias(f"first_{m}") for m in metadata]
    )
    entries = pages.select(parent, page, F.posexplode(results).alias("pos", "item"))
    return entries.join(first, parent, "left")


def normalize_item(item: str) -> list[Column]:
    """Catalog fields of an API item; absent ids read as an empty list."""
    names = ("id", "title", "popularity", "vote_average", "vote_count", "genre_ids", "release_date", "overview")
    fields = {n: F.col(f"{item}.{n}") for n in names}
    fields["genre_ids"] = F.coalesce(fields["genre_ids"], F.array().cast("array<bigint>"))
    return [column.alias(n) for n, column in fields.items()]


def normalize_user_review(item: str) -> list[Column]:
    """Review fields of an API review; the rating is lifted out of the author."""
    return [
        F.col(f"{item}.author").alias("author"),
        F.col(f"{item}.content").alias("content"),
        F.col(f"{item}.author_details.rating").alias("rating"),
        F.col(f"{item}.created_at").alias("created_at"),
        F.col(f"{item}.id").alias("review_id"),
        F.col(f"{item}.url").alias("url"),
    ]


def reviewer_name(*choices: Column) -> Column:
    """First non-blank name, else ``Anonymous``."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices], F.lit("Anonymous"))


def normalize_critic(item: str) -> list[Column]:
    return [
        F.col(f"{item}.critic.displayName").alias("critic"),
        F.col(f"{item}.publication.name").alias("publication"),
        F.col(f"{item}.reviewQuote").alias("review_text"),
        F.col(f"{item}.scoreSentiment").alias("sentiment"),
        F.col(f"{item}.originalScore").alias("original_score"),
        F.coalesce(F.col(f"{item}.critic.isTopCritic"), F.lit(False)).alias("is_top_critic"),
        F.col(f"{item}.createDate").alias("date"),
        F.col(f"{item}.publicationReviewUrl").alias("publication_review_url"),
    ]


def normalize_audience(item: str) -> list[Column]:
    return [
        reviewer_name(F.col(f"{item}.displayName"), F.col(f"{item}.user.displayName")).alias("user"),
        F.col(f"{item}.rating").alias("rating"),
        F.coalesce(F.col(f"{item}.isVerified"), F.lit(False)).alias("is_verified"),
        F.col(f"{item}.review").alias("review_text"),
        F.col(f"{item}.createDate").alias("date"),
    ]


# --- titles ------------------------------------------------------------------


def _api_title() -> dict[str, Column]:
    """Columns of an entry of the API's catalogs."""
    title = normalize_space(F.col("item.title"))
    released = parse_date(F.col("item.release_date"))
    return {
        "canonical_title": F.lower(title),
        "source_title": title,
        "source": F.lit("tmdb"),
        "source_type": F.lit(API_CATALOG),
        "source_id": F.col("item.id"),
        "release_date": released,
        "release_year": F.year(released),
        "popularity": F.col("item.popularity"),
        "vote_average": F.col("item.vote_average"),
        "vote_count": F.col("item.vote_count"),
        "overview": normalize_space(F.col("item.overview")),
        "genre_ids": ids_text(F.col("item.genre_ids")),
        "scraped_at": parse_timestamp(F.col("ingested_at")),
    }


def _scraped_title() -> dict[str, Column]:
    """Columns of an entry of the scraped catalogs."""
    title = normalize_space(F.col("item.title"))
    released = parse_release_date(F.col("item.release_date"))
    return {
        "canonical_title": F.lower(title),
        "source_title": title,
        "source": F.lit("rottentomatoes"),
        "source_type": F.col("bronze_source_type"),
        "url": to_null(F.col("item.url")),
        "poster_url": to_null(F.col("item.poster_url")),
        "release_date": released,
        "release_year": F.year(released),
        "critics_score": parse_percent(F.col("item.critics_score")),
        "audience_score": parse_percent(F.col("item.audience_score")),
        "scraped_at": parse_timestamp(F.col("item.scraped_at")),
    }


KEPT = (*ORDER[:2], "bronze_source_type")


def _titles(items: DataFrame, source: str, columns: dict[str, Column]) -> DataFrame:
    rows = items.filter(F.col("bronze_source_type").startswith(source))
    return rows.select(*[c.alias(name) for name, c in columns.items()], *KEPT)


def flatten_titles(api: DataFrame | None, scraped: DataFrame | None, processed_at: Column) -> DataFrame:
    """Both catalog shapes as one table of 20 columns, before dedup and merge.

    Documents that hold both shapes at once (entries have the fields of either source) are
    given as ``api`` and ``scraped`` alike, and are then read and exploded once.
    """
    if api is not None and api is scraped:
        sides = {API_CATALOG: _api_title(), SCRAPED_CATALOG: _scraped_title()}
        items = explode_items(api)
        of = {source: F.col("bronze_source_type").startswith(source) for source in sides}
        names = dict.fromkeys(name for columns in sides.values() for name in columns)
        chosen = {n: F.coalesce(*[F.when(of[source], columns[n]) for source, columns in sides.items() if n in columns]) for n in names}
        merged = items.filter(of[API_CATALOG] | of[SCRAPED_CATALOG]).select(*[c.alias(n) for n, c in chosen.items()], *KEPT)
    else:
        parts = [_titles(explode_items(api), API_CATALOG, _api_title())] if api is not None else []
        parts += [_titles(explode_items(scraped), SCRAPED_CATALOG, _scraped_title())] if scraped is not None else []
        merged = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return conform(merged.withColumn("processed_at", processed_at), schemas.TITLES, keep=("_pos",))


def transform_titles(api: DataFrame | None, scraped: DataFrame | None, processed_at: Column) -> DataFrame:
    """Silver titles: flatten, drop rows without a title, dedup, merge per title.

    Text columns hold all distinct values of a title; typed columns the first, with all of
    them as text beside it.
    """
    rows = require(flatten_titles(api, scraped, processed_at), "canonical_title")
    order = F.struct(F.col("bronze_file_name").alias(ORDINAL_FILE), F.col("_pos").alias(ORDINAL_POSITION))
    rows = keep_first(rows.withColumn("_ord", order), schemas.TITLES_KEYS, [F.col("_ord")])
    fields = [f for f in schemas.TITLES.fields if f.name != "canonical_title"]
    typed = [f.name for f in fields if not isinstance(f.dataType, T.StringType)]
    merged = merge_entities(
        rows,
        "canonical_title",
        [f.name for f in fields if isinstance(f.dataType, T.StringType)],
        "_ord",
        first_columns=typed,
    )
    return conform(merged, schemas.TITLES, keep=tuple(c + ALL_SUFFIX for c in typed))


# --- reviews -----------------------------------------------------------------


def flatten_title_reviews(documents: DataFrame, processed_at: Column) -> DataFrame:
    """Critic and audience arrays as one table; a missing array gives no rows.

    Both arrays are brought to one shape and exploded together, so the documents
    are read once.
    """
    none = F.lit(None).cast("string")
    critic = F.transform(
        "item.critic_reviews",
        lambda c, i: F.struct(
            F.lit("critic").alias("review_type"), i.alias("_child"), c["critic"].alias("reviewer_name"),
            c["publication"].alias("publication"), c["review_text"].alias("review_text"),
            c["sentiment"].alias("sentiment_label"), c["original_score"].alias("original_score"),
            none.alias("rating"), none.alias("is_verified"),
            c["is_top_critic"].alias("is_top_critic"), c["date"].alias("review_date"),
            c["source_url"].alias("source_url"), c["publication_review_url"].alias("publication_review_url"),
            c["scraped_at"].alias("scraped_at"),
        ),
    )
    audience = F.transform(
        "item.audience_reviews",
        lambda a, i: F.struct(
            F.lit("audience").alias("review_type"), i.alias("_child"), a["user"].alias("reviewer_name"),
            none.alias("publication"), a["review_text"].alias("review_text"),
            none.alias("sentiment_label"), none.alias("original_score"),
            a["rating"].alias("rating"), a["is_verified"].alias("is_verified"),
            none.alias("is_top_critic"), a["date"].alias("review_date"),
            a["source_url"].alias("source_url"), none.alias("publication_review_url"),
            a["scraped_at"].alias("scraped_at"),
        ),
    )
    empty = F.array()
    reviews = F.concat(F.coalesce(critic, empty), F.coalesce(audience, empty))
    rows = explode_items(documents).select(
        *ORDER[:2],
        "bronze_source_type",
        canonical_title(F.col("item.title")).alias("canonical_title"),
        to_null(F.col("item.url")).alias("title_url"),
        parse_percent(F.col("item.critics_score")).alias("critics_score"),
        parse_percent(F.col("item.audience_score")).alias("audience_score"),
        F.inline(reviews),
    )
    spaced = ("reviewer_name", "publication", "sentiment_label", "original_score")
    trimmed = ("review_text", "source_url", "publication_review_url")
    cleaned = rows.withColumns(
        {c: normalize_space(F.col(c)) for c in spaced}
        | {c: to_null(F.col(c)) for c in trimmed}
        | {c: parse_timestamp(F.col(c)) for c in ("review_date", "scraped_at")}
        | {c: parse_flag(F.col(c)) for c in ("is_verified", "is_top_critic")}
        | {"rating": safe_double(F.col("rating"))}
    ).withColumns(
        {
            "source": F.lit("rottentomatoes"),
            "review_text_clean": clean_review_text(F.col("review_text")),
            "processed_at": processed_at,
        }
    )
    return conform(cleaned, schemas.TITLE_REVIEWS, keep=ORDER[1:])


def transform_title_reviews(documents: DataFrame, processed_at: Column) -> DataFrame:
    """Silver critic and audience reviews: flatten, require title and text, dedup."""
    rows = require(flatten_title_reviews(documents, processed_at), "canonical_title", "review_text")
    # Within a title the critics come before the audience.
    order = [F.col("bronze_file_name"), F.col("_pos"), F.col("review_type").desc(), F.col("_child")]
    return conform(keep_first(rows, schemas.TITLE_REVIEWS_KEYS, order), schemas.TITLE_REVIEWS)


def flatten_user_reviews(documents: DataFrame, processed_at: Column) -> DataFrame:
    """One row per review with the fields of its movie; other documents are skipped."""
    entries = explode_items(documents).filter(F.col("bronze_source_type") == USER_REVIEW_TYPE)
    rows = entries.select(
        *ORDER[:2], "bronze_source_type", "item.movie", "item.total_reviews",
        F.col("item.scraped_at").alias("scraped_text"),
        F.posexplode("item.reviews").alias("_child", "review"),
    )
    text = to_null(F.col("review.content"))
    released = parse_date(F.col("movie.release_date"))
    flat = rows.select(
        *ORDER,
        "bronze_source_type",
        F.col("movie.id").alias("movie_id"),
        canonical_title(F.col("movie.title")).alias("canonical_title"),
        F.lit("tmdb").alias("source"),
        normalize_space(F.col("review.author")).alias("reviewer_name"),
        text.alias("review_text"),
        clean_review_text(text).alias("review_text_clean"),
        "review.rating",
        parse_timestamp(F.col("review.created_at")).alias("review_date"),
        to_null(F.col("review.review_id")).alias("review_id"),
        to_null(F.col("review.url")).alias("review_url"),
        "movie.popularity",
        "movie.vote_average",
        "movie.vote_count",
        released.alias("release_date"),
        F.year(released).alias("release_year"),
        normalize_space(F.col("movie.overview")).alias("overview"),
        ids_text(F.col("movie.genre_ids")).alias("genre_ids"),
        "total_reviews",
        parse_timestamp(F.col("scraped_text")).alias("scraped_at"),
        processed_at.alias("processed_at"),
    )
    return conform(flat, schemas.USER_REVIEWS, keep=ORDER[1:])


def transform_user_reviews(documents: DataFrame, processed_at: Column) -> DataFrame:
    """Silver user reviews: flatten, require movie and review id, dedup."""
    rows = require(flatten_user_reviews(documents, processed_at), *schemas.USER_REVIEWS_KEYS)
    order = [F.col(c) for c in ORDER]
    return conform(keep_first(rows, schemas.USER_REVIEWS_KEYS, order), schemas.USER_REVIEWS)
