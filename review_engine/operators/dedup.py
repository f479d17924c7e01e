"""Keep-first deduplication and caps per group.

Both rank rows inside a key and keep the low ranks. Spark limits each group in
every map task before it shuffles (``WindowGroupLimit``), so a key that holds a
large part of the table still sends only ``n`` rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine.functions.parsing import sorted_json


def key_part(df: DataFrame, name: str) -> Column:
    """One key column in comparable form: NULL equals empty text.

    Long text is compared by its SHA-256, so a shuffle moves 32 bytes and not
    the text; nested values are compared as JSON with sorted fields.
    """
    if name not in df.columns:
        return F.lit("")
    dtype = df.schema[name].dataType
    value = F.col(name)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        value = sorted_json(value, dtype)
    text = F.coalesce(value.cast("string"), F.lit(""))
    if isinstance(dtype, (T.StringType, T.StructType, T.ArrayType, T.MapType)):
        return F.unhex(F.sha2(text, 256))
    return text


def first_per_key(df: DataFrame, keys: list[Column], order: list[Column], n: int = 1) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def keep_first(df: DataFrame, keys: tuple[str, ...] | list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must be a total order."""
    return first_per_key(df, [key_part(df, k) for k in keys], order)


def unique_by_id(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each id; rows without an id are dropped."""
    return first_per_key(df.filter(F.col(key).isNotNull()), [F.col(key)], order)


def cap_children(df: DataFrame, parent: str, order: list[Column], n: int) -> DataFrame:
    """At most ``n`` children per parent, in order."""
    return first_per_key(df, [F.col(parent)], order, n)


def cap_parents(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` parents."""
    return df.orderBy(*order).limit(n)


def consolidation_keys(df: DataFrame) -> list[str]:
    """Key set of the consolidation step, by the columns that exist."""
    return [c for c in ("canonical_title", "review_id") if c in df.columns]


def consolidate(df: DataFrame, order: list[Column], keys: list[str] | None = None) -> DataFrame:
    keys = keys if keys is not None else consolidation_keys(df)
    return first_per_key(df, [key_part(df, k) for k in keys], order) if keys else df


def duplicate_groups(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """Row count per key, shuffled by digest after a partial count in each task."""
    return df.groupBy(*[key_part(df, k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("copies")
    )
