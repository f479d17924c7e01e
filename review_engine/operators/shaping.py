"""Filters, projections and conforming to a pinned schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine.functions.parsing import double_of
from review_engine.functions.text import has_text, keyword_letters

# Keywords that carry no meaning in a keyword ranking.
BANNED_KEYWORDS = (
    "", "<na>", "nan", "none", "unknown", "the", "and", "with", "for", "this", "that", "but", "his",
    "like", "movie", "film", "story", "review", "reviews", "watch", "watching", "series", "show", "was",
    "were", "are", "have", "been", "from", "you", "your", "they", "them", "their",
)


def all_present(columns: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.filter(all_present(columns))


def with_text(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither NULL nor blank."""
    return df.filter(has_text(F.col(column)))


def where_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows of one kind; a table without that column gives no rows."""
    return df.filter(F.col(column) == value) if column in df.columns else df.limit(0)


def where_in(df: DataFrame, column: str, values, keep: bool = True) -> DataFrame:
    """Rows whose value is (not) listed; NULL counts as not listed. Both forms reach the scan."""
    listed = F.col(column).isin(*values)
    return df.filter(listed if keep else F.col(column).isNull() | ~listed)


def top_critics_only(df: DataFrame, flag: str = "is_top_critic") -> DataFrame:
    """Reviews of top critics; an unknown flag is not one."""
    return df.filter(F.col(flag))


def verified_only(df: DataFrame, flag: str = "is_verified") -> DataFrame:
    """Verified audience reviews; an unknown flag is not one."""
    return df.filter(F.col(flag))


def meaningful_keywords(df: DataFrame, keyword: str, value: str) -> DataFrame:
    """Letters-only keywords outside the ban list, of three letters or more, with a numeric value."""
    return (
        df.withColumn(keyword, keyword_letters(F.col(keyword)))
        .withColumn(value, double_of(df, value))
        .filter((F.length(keyword) >= 3) & ~F.col(keyword).isin(*BANNED_KEYWORDS) & F.col(value).isNotNull())
    )


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the schema's columns in its order and types; a missing one is NULL.

    Columns named in ``keep`` follow them as they are.
    """
    have = set(df.columns)
    return df.select(
        [
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
        + list(keep)
    )


def enrich(df: DataFrame, family: str, processed_at: Column) -> DataFrame:
    return df.withColumn("gold_processed_at", processed_at).withColumn("gold_family", F.lit(family))


def with_lineage(df: DataFrame, file_name: Column, source_type: Column, processed_at: Column,
                 scraped_at: Column) -> DataFrame:
    """Where each row came from. The processing time is passed in, so a retry repeats it."""
    return df.withColumns(
        {
            "scraped_at": scraped_at,
            "bronze_file_name": file_name,
            "bronze_source_type": source_type,
            "processed_at": processed_at,
        }
    )
